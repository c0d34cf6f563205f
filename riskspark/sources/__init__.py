"""Schemas, readers, writers and the test-table views."""
