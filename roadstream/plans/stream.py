"""The streaming queries: run over all of ``events`` as a stream and return the result."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from roadstream.functions.text import decode_detections
from roadstream.operators import counts
from roadstream.operators.enrich import with_location
from roadstream.operators.hot import hot_keys
from roadstream.operators.latest import latest_per_key
from roadstream.operators.tracks import VEHICLE, located
from roadstream.session import PARTITIONS, delete_folder, work_folder
from roadstream.sources.events import event_detections, event_gate_changes, event_messages
from roadstream.sources.messages import decode_gate_changes, read_back_counts, read_messages
from roadstream.streaming.fines import added_fines, pin_hot_keys, stored_tracks, total_fines
from roadstream.streaming.joins import joined_within, with_changing_location
from roadstream.streaming.periodic import periodic_counts
from roadstream.streaming.sinks import (
    ALL_AVAILABLE,
    EVERY_SECOND,
    PartitionFiles,
    compact_changes,
    count_messages,
    read_changes,
    read_result,
    read_state,
    read_table,
    to_changes,
    to_files,
    to_rows,
    to_table,
    to_topic,
)

# A stored topic is read in about so many batches.
BATCHES = 4
# A topic that is replayed in order is stored as so many files, more if one would have more messages.
REPLAYED_FILES = 6
REPLAYED_MESSAGES = 2_000_000
REPLAYED_BLOCK = 8 << 20
# A query's state is kept in at most so many partitions a thread, or in so many in all.
STATES_A_THREAD = 4
LEAST_STATES = 32


@contextmanager
def few_states(spark: SparkSession) -> Iterator[None]:
    """Streams that first start in here keep their state in no more partitions than the threads can use.

    Every batch opens and commits the stores of all partitions and runs the state logic in them, whatever they hold, so
    a number that is meant for the shuffles of large batch jobs would cost most of a batch's time.
    """
    chosen = spark.conf.get(PARTITIONS)
    most = max(LEAST_STATES, STATES_A_THREAD * spark.sparkContext.defaultParallelism)
    spark.conf.set(PARTITIONS, str(min(int(chosen), most)))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, chosen)


def run_updates(
    result: DataFrame,
    keys: list[str],
    values: list[str],
    folder: str | None = None,
    trigger: dict[str, Any] = ALL_AVAILABLE,
) -> DataFrame:
    """Run a stream over what is there, in update mode, and return its current rows."""
    spark = result.sparkSession
    folder = folder or work_folder(spark, "updates")
    with few_states(spark):
        query = to_changes(result, f"{folder}/changes", f"{folder}/checkpoint", trigger)
    if trigger != ALL_AVAILABLE:
        query.processAllAvailable()
        query.stop()
    query.awaitTermination()
    return read_changes(spark, f"{folder}/changes", result.schema, keys, values)


def run_complete(result: DataFrame, folder: str | None = None) -> DataFrame:
    """Run a stream over what is there, in complete mode, and return its last result."""
    spark = result.sparkSession
    folder = folder or work_folder(spark, "complete")
    with few_states(spark):
        query = to_table(result, f"{folder}/result", f"{folder}/checkpoint", ALL_AVAILABLE)
    query.awaitTermination()
    return read_result(spark, f"{folder}/result", result.schema)


def nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = event_detections(spark, sf_dir, streaming=True)
    result = run_complete(counts.most_frequent_first(counts.nation_counts(detections)))
    return counts.most_frequent_first(result)


def known_nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = event_detections(spark, sf_dir, streaming=True)
    return run_updates(counts.known_nation_counts(detections), ["nation"], ["count"])


def enriched_nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = event_detections(spark, sf_dir, streaming=True)
    enriched = with_location(detections.filter(counts.known_nation()), how="left")
    result = enriched.groupBy("nation").agg(
        F.count("*").alias("count"), F.count("loc").alias("located")
    )
    return run_updates(result, ["nation"], ["count", "located"])


def gate_plate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = event_detections(spark, sf_dir, streaming=True)
    return run_updates(counts.gate_plate_counts(detections), ["gate", "plate"], ["cnt"])


def latest_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = event_detections(spark, sf_dir, streaming=True)
    return run_updates(
        latest_per_key(detections, ["plate"], ["gate", "ts"]), ["plate"], ["gate", "ts"]
    )


def _added_fines(
    spark: SparkSession,
    sf_dir: str,
    keys: list[str],
    folder: str,
    watermark: str | None = None,
    stream: DataFrame | None = None,
) -> DataFrame:
    """Added fines, with the hot keys taken from what the table holds at the start."""
    found = hot_keys(located(event_detections(spark, sf_dir)), keys)
    hot = pin_hot_keys(found, f"{folder}/hot")
    return added_fines(
        event_detections(spark, sf_dir, streaming=True) if stream is None else stream,
        keys,
        hot=hot,
        watermark=watermark,
    )


def fines_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "fines")
    added = _added_fines(spark, sf_dir, VEHICLE, folder)
    return run_updates(total_fines(added), ["nation"], ["tot_fines"], folder)


def tickets_by_plate(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "tickets")
    added = _added_fines(spark, sf_dir, ["plate"], folder)
    return run_updates(total_fines(added, "plate", "tickets"), ["plate"], ["tickets"], folder)


def fines_watermarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "watermarked")
    added = _added_fines(spark, sf_dir, VEHICLE, folder, watermark="10 minutes")
    return run_complete(total_fines(added), folder)


def _store_events(spark: SparkSession, sf_dir: str, path: str, half: int | None = None) -> int:
    """Every event as a message of a stored topic, dealt to files by a hash; their number.

    ``half`` stores one of two halves. A file holds events of all times, so those of later
    files come between those of earlier ones.
    """
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    messages = event_messages(spark, sf_dir)
    if half is not None:
        messages = messages.filter(F.pmod(F.xxhash64("offset", F.lit("half")), F.lit(2)) == half)
    to_topic(messages.repartition(files, F.xxhash64("offset")), "origin", format="parquet", path=path)
    return files


def _replay_in_order(messages: DataFrame, path: str, delay: str = "0") -> None:
    """Store messages by ranges of their offset, one file after the other, to be read in that order, one a batch.

    ``delay`` says how many files later than its range a message arrives; what would come after the last file
    comes with it. The messages are dealt to their files in one pass, beside ``path``, and each file is written from
    its own share, so the input is not read again for every file.
    """
    first, last, count = messages.selectExpr("min(offset)", "max(offset)", "count(*)").first()
    if not count:
        return
    files = max(REPLAYED_FILES, -(-count // REPLAYED_MESSAGES))
    arrival = F.expr(f"least({files - 1}, (offset - {first}) * {files} DIV {last - first + 1} + {delay})")
    dealt = f"{path}-dealt"
    messages.withColumn("arrival", arrival.cast("int")).write.partitionBy("arrival").parquet(dealt)
    schema = StructType([*messages.schema.fields, StructField("arrival", IntegerType())])
    numbered = messages.sparkSession.read.schema(schema).parquet(dealt)
    for file in range(files):
        batch = numbered.filter(F.col("arrival") == file).drop("arrival").coalesce(1)
        # Small row groups, so that many tasks read the one file of a batch.
        batch.write.option("parquet.block.size", REPLAYED_BLOCK).mode("append").parquet(path)
    delete_folder(messages.sparkSession, dealt)


def _replayed(spark: SparkSession, path: str, topic: str = "origin") -> DataFrame:
    return read_messages(spark, topic, format="parquet", path=path, maxFilesPerTrigger="1")


def _stored_detections(spark: SparkSession, path: str, files: int) -> DataFrame:
    a_batch = str(-(-files // BATCHES))
    return decode_detections(
        read_messages(spark, format="parquet", path=path, maxFilesPerTrigger=a_batch)
    )


def fines_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events in several batches, a stop, and the other half after a restart."""
    folder = work_folder(spark, "restarted")
    topic = f"{folder}/topic"
    for half in (0, 1):
        files = _store_events(spark, sf_dir, topic, half)
        stream = _stored_detections(spark, topic, files)
        added = _added_fines(spark, sf_dir, VEHICLE, folder, stream=stream)
        result = run_updates(total_fines(added), ["nation"], ["tot_fines"], folder)
    return result


def topic_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known nations as upserts of a topic, in several batches; the newest message of each key."""
    folder = work_folder(spark, "upserts")
    detections = _stored_detections(
        spark, f"{folder}/topic", _store_events(spark, sf_dir, f"{folder}/topic")
    )
    maps = counts.single_count_maps(counts.known_nation_counts(detections), "nation", "count")
    results = f"{folder}/results"
    to_topic(
        count_messages(maps, F.col("nation")),
        "kafka-destination",
        format="parquet",
        path=results,
        checkpoint=f"{folder}/checkpoint",
        trigger=ALL_AVAILABLE,
    ).awaitTermination()
    stored = read_messages(
        spark, "kafka-destination", streaming=False, format="parquet", path=results
    )
    newest = latest_per_key(stored, ["key"], ["value"])
    return read_back_counts(newest).select(F.col("name").alias("nation"), "cnt")


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of known nations, looked up in the state of the stream that made them."""
    folder = work_folder(spark, "lookup")
    detections = event_detections(spark, sf_dir, streaming=True)
    run_updates(counts.known_nation_counts(detections), ["nation"], ["count"], folder)
    return read_state(spark, f"{folder}/checkpoint").select("key.nation", "value.count")


def every_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stored topic with a batch each second, stopped once all is read."""
    folder = work_folder(spark, "seconds")
    detections = _stored_detections(
        spark, f"{folder}/topic", _store_events(spark, sf_dir, f"{folder}/topic")
    )
    result = counts.nation_counts(detections)
    return run_updates(result, ["nation"], ["count"], folder, EVERY_SECOND)


def fines_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some messages arrive one or two files late; what is behind the watermark then is dropped."""
    folder = work_folder(spark, "late")
    delay = "CASE offset % 7 WHEN 3 THEN 2 WHEN 5 THEN 1 ELSE 0 END"
    _replay_in_order(event_messages(spark, sf_dir), f"{folder}/topic", delay)
    stream = decode_detections(_replayed(spark, f"{folder}/topic"))
    added = _added_fines(spark, sf_dir, VEHICLE, folder, "10 minutes", stream)
    return run_complete(total_fines(added), folder)


def _detections_and_changes(spark: SparkSession, sf_dir: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two topics in the same files: each batch has the messages of both of a range of offsets."""
    topic = f"{folder}/topic"
    _replay_in_order(event_messages(spark, sf_dir).unionByName(event_gate_changes(spark, sf_dir)), topic)
    return decode_detections(_replayed(spark, topic)), decode_gate_changes(_replayed(spark, topic, "locations"))


def run_appends(result: DataFrame, folder: str) -> DataFrame:
    """Run a stream of rows that stay over what is there, and return all of them."""
    with few_states(result.sparkSession):
        query = to_files(result, f"{folder}/rows", f"{folder}/checkpoint", ALL_AVAILABLE)
    query.awaitTermination()
    return read_table(result.sparkSession, f"{folder}/rows", result.schema)


def changing_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message with the position that its gate has at that offset."""
    folder = work_folder(spark, "gates")
    detections, changes = _detections_and_changes(spark, sf_dir, folder)
    joined = with_changing_location(detections, changes)
    return run_appends(joined.select("offset", "plate", "gate", "loc", "version"), folder)


def two_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message with the changes of its gate within an hour."""
    folder = work_folder(spark, "within")
    joined = joined_within(*_detections_and_changes(spark, sf_dir, folder))
    return run_appends(joined.select("offset", "plate", "gate", "loc", "version"), folder)


def track_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracks that a fines stream keeps, looked up in its state."""
    folder = work_folder(spark, "tracks")
    added = _added_fines(spark, sf_dir, VEHICLE, folder)
    run_updates(total_fines(added), ["nation"], ["tot_fines"], folder)
    return stored_tracks(spark, f"{folder}/checkpoint", operator=2)


def firings(result: DataFrame, folder: str, idle_batches: int = 6) -> DataFrame:
    """Run a stream of firings over what is there, and on until so many batches in a row had no input."""
    query = to_files(result, f"{folder}/rows", f"{folder}/checkpoint", EVERY_SECOND)
    seen, idle = -1, 0
    while idle < idle_batches and query.isActive:
        progress = query.lastProgress
        if progress is not None and progress["batchId"] > seen:
            seen = progress["batchId"]
            idle = 0 if progress["numInputRows"] else idle + 1
        time.sleep(0.1)
    query.stop()
    query.awaitTermination()
    return read_table(result.sparkSession, f"{folder}/rows", result.schema)


def every_second_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by gate that fire each second; the last count of each gate, and whether it fired again unchanged."""
    folder = work_folder(spark, "firings")
    fired = firings(periodic_counts(event_detections(spark, sf_dir, streaming=True)), folder)
    by_count = fired.groupBy("gate", "cnt").agg(F.count("*").alias("times"))
    newest = by_count.groupBy("gate").agg(F.max("cnt").alias("cnt"), F.max_by("times", "cnt").alias("times"))
    return newest.select("gate", "cnt", (F.col("times") > 1).alias("again"))


def changes_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plate counts in several batches before and after a restart, whose changes are compacted after each run."""
    folder = work_folder(spark, "compacted")
    changes = f"{folder}/changes"
    for half in (0, 1):
        files = _store_events(spark, sf_dir, f"{folder}/topic", half)
        result = counts.plate_counts(_stored_detections(spark, f"{folder}/topic", files))
        to_changes(result, changes, f"{folder}/checkpoint", ALL_AVAILABLE).awaitTermination()
        compact_changes(spark, changes, result.schema, ["plate"], ["cnt"])
    return read_changes(spark, changes, result.schema, ["plate"], ["cnt"])


def row_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known detections through the row writer, read back from its files."""
    folder = work_folder(spark, "rows")
    rows = event_detections(spark, sf_dir, streaming=True).filter(counts.known_nation())
    rows = rows.select("offset", "plate", "gate", "nation")
    writer = PartitionFiles(f"{folder}/rows")
    to_rows(rows, writer, "append", f"{folder}/checkpoint", ALL_AVAILABLE).awaitTermination()
    return spark.read.schema(rows.schema).json(f"{folder}/rows").select(rows.columns)


STREAM_QUERIES = {
    "S_nation_counts": nation_counts,
    "S_known_nation_counts": known_nation_counts,
    "S_enriched_nation_counts": enriched_nation_counts,
    "S_gate_plate_counts": gate_plate_counts,
    "S_latest_per_key": latest_position,
    "S_fines_by_nation": fines_by_nation,
    "S_tickets_by_plate": tickets_by_plate,
    "S_fines_watermarked": fines_watermarked,
    "S_fines_restarted": fines_restarted,
    "S_topic_upserts": topic_upserts,
    "S_state_lookup": state_lookup,
    "S_every_second": every_second,
    "S_every_second_again": every_second_again,
    "S_fines_late": fines_late,
    "S_changing_gates": changing_gates,
    "S_two_stream_join": two_stream_join,
    "S_track_lookup": track_lookup,
    "S_row_files": row_files,
    "S_changes_compacted": changes_compacted,
}
