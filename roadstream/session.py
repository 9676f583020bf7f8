"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Event time is text without a zone; it is read as UTC.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A batch then stores what it changed instead of a snapshot of all state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
PARTITIONS = "spark.sql.shuffle.partitions"
FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
# Spark's default runs a process of the operating system for every file that a checkpoint on a local disk gets, which is
# most of the time that the state stores of a small batch take to commit. This one renames the file by itself.
LOCAL_FILE_MANAGER = (
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
)
_own_folder: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job here relies on to a running session.

    A local session that was started without a number of shuffle partitions gets one per thread
    in place of the default of 200, as each partition of a stream keeps state stores of its own.
    A cluster's setting stays. Checkpoints on a local disk are written without processes of the
    operating system, unless the session has chosen how.
    """
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    context = spark.sparkContext
    chosen = spark.conf.get(PARTITIONS) != "200" or context.getConf().get(PARTITIONS) == "200"
    if (context.master == "local" or context.master.startswith("local[")) and not chosen:
        spark.conf.set(PARTITIONS, str(context.defaultParallelism))
    if spark.conf.get(FILE_MANAGER, None) is None and _on_local_disk(spark):
        spark.conf.set(FILE_MANAGER, LOCAL_FILE_MANAGER)
    return spark


def _on_local_disk(spark: SparkSession) -> bool:
    """Whether files are on a local disk by default and the shared folder is, too."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ""
    scheme = base.split(":", 1)[0] if ":" in base.split("/", 1)[0] else "file"
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return scheme == "file" and str(default).startswith("file:")


def delete_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the executors
    would each write to their own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # The setting cannot be changed in a running session.
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="roadstream-"))
        base = _own_folder[0]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
