"""Counts by nation, gate and plate.

All of them aggregate on the map side first, so a frequent key sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.schemas import UNKNOWN_NATION

# Every gate's plate counts come as up to so many maps, whatever its traffic.
MAP_PARTS = 64


def known_nation() -> Column:
    """True unless the nation is the unknown marker; a missing nation stays."""
    return ~F.col("nation").eqNullSafe(UNKNOWN_NATION)


def nation_counts(detections: DataFrame) -> DataFrame:
    return detections.groupBy("nation").count()


def most_frequent_first(counts: DataFrame, count: str = "count") -> DataFrame:
    return counts.orderBy(F.desc(count))


def known_nation_counts(detections: DataFrame) -> DataFrame:
    return nation_counts(detections.filter(known_nation()))


def gate_plate_counts(detections: DataFrame) -> DataFrame:
    return detections.groupBy("gate", "plate").agg(F.count("*").alias("cnt"))


def plate_counts(detections: DataFrame) -> DataFrame:
    return detections.groupBy("plate").agg(F.count("*").alias("cnt"))


def single_count_maps(counts: DataFrame, key: str, count: str) -> DataFrame:
    """Each count as a message: its key and a map with that one entry."""
    # A map key must not be NULL; the missing key is the text that it prints as.
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return counts.select(F.col(key), F.create_map(name, F.col(count)).alias("counts"))


def gate_plate_maps(detections: DataFrame, parts: int = MAP_PARTS) -> DataFrame:
    """Plate counts per gate as maps, each with a ``part`` of the gate's plates.

    The part of a plate is a hash modulo ``parts``, by one rule for all gates. Together the maps
    of a gate hold every plate once; parts without plates are absent.
    """
    # A map key must not be NULL; a missing plate counts as the text that it prints as.
    named = detections.select("gate", F.coalesce("plate", F.lit("null")).alias("plate"))
    part = F.pmod(F.xxhash64("plate"), F.lit(parts)).cast("int")
    entry = F.struct(F.col("plate").alias("key"), F.col("cnt").alias("value"))
    return (
        gate_plate_counts(named)
        .groupBy("gate", part.alias("part"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("counts"))
    )
