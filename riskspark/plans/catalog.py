"""Importing this module registers every query."""

from riskspark.plans import (  # noqa: F401
    drift_queries,
    feature_queries,
    metric_queries,
    model_queries,
    stream_queries,
)
from riskspark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
