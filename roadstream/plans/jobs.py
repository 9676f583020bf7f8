"""The standing jobs: a stream of detection messages to a sink, as a running query.

``messages`` comes from ``read_messages``. Each job returns its ``StreamingQuery``; the caller
waits for it or stops it. Without a trigger, results come every second.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadstream.functions.text import decode_detections
from roadstream.operators import counts
from roadstream.operators.enrich import with_location
from roadstream.operators.hot import hot_keys
from roadstream.operators.tracks import VEHICLE, located
from roadstream.sources.messages import (
    as_messages,
    gates_as_messages,
    read_back_counts,
    read_detection_lines,
)
from roadstream.streaming.fines import added_fines, pin_hot_keys, total_fines
from roadstream.streaming.sinks import count_messages, to_console, to_rows, to_topic

Trigger = dict[str, Any] | None


def nation_counts(messages: DataFrame, checkpoint: str, trigger: Trigger = None) -> StreamingQuery:
    """All nations to the console, the most frequent first."""
    result = counts.nation_counts(decode_detections(messages))
    return to_console(counts.most_frequent_first(result), "complete", checkpoint, trigger)


def known_nation_counts(
    messages: DataFrame,
    checkpoint: str,
    trigger: Trigger = None,
    *,
    topic: str = "kafka-destination",
    enriched: bool = False,
    gates: DataFrame | None = None,
    **sink: str,
) -> StreamingQuery:
    """Known nations to a topic: an upsert of a one-entry map for each change."""
    detections = decode_detections(messages)
    if enriched:
        detections = with_location(detections, gates, "left")
    maps = counts.single_count_maps(counts.known_nation_counts(detections), "nation", "count")
    rows = count_messages(maps, F.col("nation"))
    return to_topic(rows, topic, checkpoint=checkpoint, trigger=trigger, **sink)


def plate_counts_by_gate(
    messages: DataFrame, checkpoint: str, trigger: Trigger = None, *, row_writer: Any = None
) -> StreamingQuery:
    """Plates per gate to a row writer, or to the console."""
    result = counts.gate_plate_counts(decode_detections(messages))
    return _to_rows_or_console(result, checkpoint, trigger, row_writer)


def fines_by_nation(
    messages: DataFrame,
    checkpoint: str,
    trigger: Trigger = None,
    *,
    history: DataFrame | None = None,
    **options: Any,
) -> StreamingQuery:
    """Speeding fines per nation to the console; options as for ``added_fines``.

    ``history`` holds stored messages in which to find hot vehicles, which then are cut into cells.
    """
    options |= _hot(history, VEHICLE, checkpoint)
    result = total_fines(added_fines(decode_detections(messages), **options))
    return to_console(result, "update", checkpoint, trigger)


def tickets_by_plate(
    messages: DataFrame,
    checkpoint: str,
    trigger: Trigger = None,
    *,
    row_writer: Any = None,
    history: DataFrame | None = None,
    **options: Any,
) -> StreamingQuery:
    """Speeding tickets per plate to a row writer, or to the console; ``history`` as for the fines."""
    options |= _hot(history, ["plate"], checkpoint)
    added = added_fines(decode_detections(messages), ["plate"], **options)
    result = total_fines(added, "plate", "tickets")
    return _to_rows_or_console(result, checkpoint, trigger, row_writer)


def _hot(history: DataFrame | None, keys: list[str], checkpoint: str) -> dict[str, DataFrame]:
    """The hot keys among stored messages, found at the first start and kept beside the checkpoint."""
    if history is None:
        return {}
    found = hot_keys(located(decode_detections(history)), keys)
    return {"hot": pin_hot_keys(found, f"{checkpoint.rstrip('/')}-hot")}


def results(messages: DataFrame, checkpoint: str, trigger: Trigger = None) -> StreamingQuery:
    """The entries of result maps, as they arrive, to the console."""
    return to_console(read_back_counts(messages), "append", checkpoint, trigger)


def load_topics(
    spark: SparkSession,
    detection_files: str,
    gates: DataFrame,
    *,
    detections_topic: str = "origin",
    gates_topic: str = "locations",
    **sink: str,
) -> None:
    """Write a gate table and the lines of detection files to their topics."""
    to_topic(gates_as_messages(gates), gates_topic, **sink)
    lines = read_detection_lines(spark, detection_files)
    to_topic(as_messages(lines), detections_topic, **sink)


def _to_rows_or_console(
    result: DataFrame, checkpoint: str, trigger: Trigger, row_writer: Any
) -> StreamingQuery:
    if row_writer is None:
        return to_console(result, "update", checkpoint, trigger)
    return to_rows(result, row_writer, "update", checkpoint, trigger)
