"""Every query of the engine with its SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickflow.plans import feature_queries, job_queries, listing_queries, model_queries, monitor_queries

FLAGSHIP = "latest_features_per_symbol"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for part in (feature_queries, model_queries, monitor_queries, job_queries, listing_queries):
    QUERIES |= part.QUERIES
    SQL |= part.SQL
