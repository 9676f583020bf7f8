"""Where results go: console, a row writer, a topic, or tables of changes and results."""

from __future__ import annotations

import sys
from typing import Any

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from roadstream.functions.text import encode_counts
from roadstream.operators.latest import latest_per_key
from roadstream.schemas import ENVELOPE
from roadstream.session import delete_folder

# Row writers run where the rows are, and executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EVERY_SECOND = {"processingTime": "1 second"}
ALL_AVAILABLE = {"availableNow": True}


def _writer(
    result: DataFrame, mode: str, checkpoint: str | None, trigger: dict[str, Any] | None
) -> DataStreamWriter:
    writer = result.writeStream.outputMode(mode).trigger(**(trigger or EVERY_SECOND))
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def to_console(
    result: DataFrame,
    mode: str = "update",
    checkpoint: str | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    return _writer(result, mode, checkpoint, trigger).format("console").start()


def to_rows(
    result: DataFrame,
    row_writer: Any,
    mode: str = "update",
    checkpoint: str | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Hand each row to ``row_writer.process``, with optional ``open`` and ``close``."""
    return _writer(result, mode, checkpoint, trigger).foreach(row_writer).start()


class PartitionFiles:
    """A row writer for ``to_rows``: one file of JSON lines for each partition of each batch, whole or not at all.

    A file appears under its name when the partition is complete. A partition that is written again, after a restart or
    a lost task, finds its file and is skipped. The folder has to be one that all executors share.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder.removeprefix("file://")

    def open(self, partition_id: int, epoch_id: int) -> bool:
        import os
        import uuid

        batch = f"{self.folder}/batch={epoch_id}"
        self.path = f"{batch}/part-{partition_id:05d}.json"
        self.rows = 0
        if os.path.exists(self.path):
            self.file = None
            return False
        os.makedirs(batch, exist_ok=True)
        # Names that begin with a dot are not read.
        self.unfinished = f"{batch}/.{partition_id}-{uuid.uuid4().hex}"
        self.file = open(self.unfinished, "w", encoding="utf-8")
        return True

    def process(self, row: Any) -> None:
        import json

        self.file.write(json.dumps(row.asDict(recursive=True), default=str) + "\n")
        self.rows += 1

    def close(self, error: Exception | None) -> None:
        import os

        if self.file is None:
            return
        self.file.flush()
        os.fsync(self.file.fileno())
        self.file.close()
        if error is None and self.rows:
            os.replace(self.unfinished, self.path)
        else:
            os.remove(self.unfinished)


def count_messages(counts: DataFrame, key: Column, map_column: str = "counts") -> DataFrame:
    """Count maps to messages. Pass ``F.lit("key")`` as key to put all under one key."""
    return counts.select(
        key.cast("string").cast("binary").alias("key"),
        encode_counts(F.col(map_column)).alias("value"),
    )


def to_topic(
    messages: DataFrame,
    topic: str,
    *,
    servers: str = "localhost:9092",
    format: str = "kafka",
    path: str | None = None,
    mode: str = "update",
    checkpoint: str | None = None,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery | None:
    """Write ``key, value`` rows to a topic, as a batch or as a stream of upserts.

    With a file format the rows are stored below ``path`` in the message envelope. Files take
    no upserts, so a stream with updates adds a message per change, as the topic would.
    """
    if format == "kafka":
        options = {"kafka.bootstrap.servers": servers, "topic": topic}
        if messages.isStreaming:
            writer = _writer(messages, mode, checkpoint, trigger).format(format)
            return writer.options(**options).start()
        messages.write.format(format).options(**options).save()
        return None
    if not messages.isStreaming:
        # In the order of the input and after what is stored, as a topic would number them.
        own = "offset" in messages.columns
        first = 0 if own else _next_offset(messages.sparkSession, topic, format, path)
        numbered = _stored(messages, topic, F.monotonically_increasing_id() + first)
        numbered.write.format(format).mode("append").save(path)
        return None

    def store(batch: DataFrame, batch_id: int) -> None:
        # A batch has one row per key; its number keeps later changes after earlier ones.
        numbered = _stored(batch, topic, F.lit(batch_id).cast("bigint"))
        numbered.write.format(format).mode("overwrite").save(f"{path}/batch={batch_id}")

    return _writer(messages, mode, checkpoint, trigger).foreachBatch(store).start()


def _next_offset(spark: SparkSession, topic: str, format: str, path: str) -> int:
    """One past the highest offset of a stored topic; 0 for a topic without messages."""
    try:
        stored = spark.read.format(format).schema(ENVELOPE).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    last = stored.filter(F.col("topic") == topic).agg(F.max("offset")).first()[0]
    return 0 if last is None else last + 1


def _stored(messages: DataFrame, topic: str, offset: Column) -> DataFrame:
    return messages.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        (F.col("offset") if "offset" in messages.columns else offset).alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )


def to_changes(
    result: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Store the groups that each batch changed; a repeated batch replaces its own rows."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return _writer(result, "update", checkpoint, trigger).foreachBatch(store).start()


def read_changes(
    spark: SparkSession, folder: str, schema: StructType, keys: list[str], values: list[str]
) -> DataFrame:
    """The current row of each group from a folder of changes to results of that schema."""
    return latest_per_key(_changes(spark, folder, schema), keys, values, version="batch")


def _changes(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The newest base of a folder of changes and what changed after it, with the ``batch`` of each row."""
    with_batch = StructType([*schema.fields, StructField("batch", LongType())])
    changes = read_table(spark, folder, with_batch)
    bases = _complete(spark, f"{folder}-bases", "upto")
    if not bases:
        return changes
    base = spark.read.schema(with_batch).parquet(f"{folder}-bases/upto={bases[-1]}")
    return changes.filter(F.col("batch") > bases[-1]).unionByName(base)


def compact_changes(
    spark: SparkSession, folder: str, schema: StructType, keys: list[str], values: list[str]
) -> int | None:
    """Merge the changes stored so far to one row a group; return the last batch that the new base holds.

    A base counts once it is complete, which its marker file says, so a reader sees the base before or the new one and
    never half of either, and a compaction that was lost is repeated as a whole. What the base before covers is removed
    only now: readers that began since then still find their files. A stream that repeats a batch after a restart
    stores it again below the base, where nobody reads it. The folder so keeps two rows a group and the batches since
    the last compaction but one.
    """
    batches = _complete(spark, folder, "batch")
    bases = _complete(spark, f"{folder}-bases", "upto")
    if not batches or (bases and batches[-1] <= bases[-1]):
        return bases[-1] if bases else None
    upto = batches[-1]
    rows = _changes(spark, folder, schema).filter(F.col("batch") <= upto).groupBy(*keys)
    newest = rows.agg(*[F.max_by(v, "batch").alias(v) for v in values], F.max("batch").alias("batch"))
    newest.write.mode("overwrite").parquet(f"{folder}-bases/upto={upto}")
    if bases:
        covered = [f"{folder}/batch={n}" for n in batches if n <= bases[-1]]
        for path in [*covered, *[f"{folder}-bases/upto={n}" for n in bases[:-1]]]:
            delete_folder(spark, path)
    return upto


def _complete(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers of the parts ``name=number`` of a folder that were written to their end, ascending."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
    return sorted(int(mark.getPath().getParent().getName().split("=")[1]) for mark in found)


def to_files(
    result: DataFrame, folder: str, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Add the rows of a result that is never taken back to a folder, each batch once."""
    return _writer(result, "append", checkpoint, trigger).format("parquet").option("path", folder).start()


def to_table(
    result: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: dict[str, Any] | None = None,
) -> StreamingQuery:
    """Store the whole result after each batch.

    Two slots take turns, so the result before stays readable until the new one is there.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch", F.lit(batch_id).cast("bigint"))
        numbered.write.mode("overwrite").parquet(f"{folder}/slot={batch_id % 2}")

    return _writer(result, "complete", checkpoint, trigger).foreachBatch(store).start()


def read_result(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The newest result that ``to_table`` has stored."""
    stored = read_table(spark, folder, StructType([*schema.fields, StructField("batch", LongType())]))
    newest = stored.agg(F.max("batch")).first()[0]
    return stored.filter(F.col("batch") == F.lit(newest)).select(schema.fieldNames())


def read_table(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """A folder of results; empty where its stream has not had a batch yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_state(
    spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None
) -> DataFrame:
    """The state of one operator of a stream, by key, from its checkpoint.

    Of an operator with named state variables one has to be named.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)


def read_state_changes(
    spark: SparkSession,
    checkpoint: str,
    first_batch: int,
    last_batch: int,
    operator: int = 0,
    variable: str | None = None,
) -> DataFrame:
    """What batches from the first to the last one changed in a state, with ``batch_id`` and ``change_type``."""
    reader = spark.read.format("statestore").option("operatorId", operator).option("readChangeFeed", True)
    reader = reader.option("changeStartBatchId", first_batch).option("changeEndBatchId", last_batch)
    if variable is not None:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)
