"""The newest row per key, for tables that arrive as a log of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    changes: DataFrame, keys: list[str], values: list[str], version: str = "offset"
) -> DataFrame:
    """For each key the values of its row with the highest version.

    Versions must be unique per key. Values are picked one by one rather than as a struct:
    for numbers that keeps the aggregation hashed instead of sorted.
    """
    return changes.groupBy(*keys).agg(*[F.max_by(v, version).alias(v) for v in values])
