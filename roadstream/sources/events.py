"""The ``events`` table in the role of the detection topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadstream.functions.text import decode_detections
from roadstream.schemas import SEPARATOR, TIME_FORMAT, UNKNOWN_NATION


PLATE = "concat('P', user_id)"
LINE = f"""concat_ws('{SEPARATOR}',
    {PLATE},
    event_id % 30,
    CAST(event_id % 3 + 1 AS DOUBLE),
    date_format(ts, '{TIME_FORMAT}'),
    CASE WHEN event_type = 'error' THEN '{UNKNOWN_NATION}' ELSE event_type END)"""


CHANGED_GATE = "event_id DIV 10 % 30"


def _as_envelope(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        f"CAST({PLATE} AS BINARY) AS key",
        f"CAST({LINE} AS BINARY) AS value",
        "'origin' AS topic",
        "0 AS partition",
        "event_id AS offset",
        "CAST(ts AS TIMESTAMP) AS timestamp",
    )


def event_messages(spark: SparkSession, sf_dir: str, *, streaming: bool = False) -> DataFrame:
    """Every row of ``events`` as one message on the detection topic."""
    path = f"{sf_dir}/events.parquet"
    if not streaming:
        return _as_envelope(spark.read.parquet(path))
    schema = spark.read.parquet(path).schema
    # A file stream takes folders and globs only; this glob matches the one name.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/[e]vents.parquet")
    return _as_envelope(events)


def event_gate_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event as a message that moves a gate, or, without a value, takes its position away."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").filter("event_id % 10 = 0").selectExpr(
        f"CAST(CAST({CHANGED_GATE} AS STRING) AS BINARY) AS key",
        f"""CASE WHEN event_id DIV 10 % 7 <> 3 THEN CAST(concat_ws('{SEPARATOR}', {CHANGED_GATE},
            event_id % 1000 / 10.0D) AS BINARY) END AS value""",
        "'locations' AS topic",
        "0 AS partition",
        "event_id AS offset",
        "CAST(ts AS TIMESTAMP) AS timestamp",
    )


def event_detections(spark: SparkSession, sf_dir: str, *, streaming: bool = False) -> DataFrame:
    """The same messages decoded to detections."""
    return decode_detections(event_messages(spark, sf_dir, streaming=streaming))
