"""The gate position table: built in, from a file, or by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.schemas import GATE_LINE, GATE_POSITIONS

# More gates than any road network has; beyond it a table is joined without broadcast.
MAX_BROADCAST_GATES = 100_000


def builtin_gates(spark: SparkSession) -> DataFrame:
    """The fixed gate table as ``gate int, loc double``."""
    rows = ", ".join(f"({gate}, {loc}D)" for gate, loc in GATE_POSITIONS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS gates(gate, loc)")


def read_gates(spark: SparkSession, path: str) -> DataFrame:
    """A headerless comma-separated gate file as ``gate int, position double``."""
    return spark.read.schema(GATE_LINE).option("header", False).csv(path)


def register_gates(gates: DataFrame, name: str = "gate_positions") -> None:
    """Make a gate table available to ``spark.table`` and SQL under a name."""
    gates.createOrReplaceTempView(name)


def scan_gates(spark: SparkSession, name: str = "gate_positions") -> DataFrame:
    """A registered gate table as ``gate int, loc double``, ready to join."""
    return spark.table(name).selectExpr("gate", "position AS loc")


def broadcast_if_small(gates: DataFrame, max_rows: int = MAX_BROADCAST_GATES) -> DataFrame:
    """Mark a caller's gate table for broadcast when a bounded count shows it is small.

    A larger one comes back as it is, so Spark joins it by shuffle and splits skewed gates.
    """
    if gates.isStreaming or gates.limit(max_rows + 1).count() > max_rows:
        return gates
    return F.broadcast(gates)
