"""Sizes by which plans are chosen."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of a table, the one it plans broadcasts by."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
