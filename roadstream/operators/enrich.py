"""Joins of detections with the gate positions, on a batch or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.sources.gates import broadcast_if_small, builtin_gates


def with_location(
    detections: DataFrame, gates: DataFrame | None = None, how: str = "inner"
) -> DataFrame:
    """Add ``loc`` by gate: ``inner`` drops unknown gates, ``left`` leaves ``loc`` NULL.

    The built-in table has 21 rows and is broadcast; a caller's table only after a size check.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if gates is None:
        side = F.broadcast(builtin_gates(detections.sparkSession))
    else:
        side = broadcast_if_small(gates)
    return detections.join(side, "gate", how)
