"""Column expressions. Batch jobs and streams use the same ones."""
