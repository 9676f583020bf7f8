"""Text forms of the records, as column expressions.

Expressions are written in SQL: one call to the JVM each, where the function API takes many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.schemas import COUNT_MAP, SEPARATOR, TIME_FORMAT, TIME_PATTERN

ENVELOPE_FIELDS = ("key", "partition", "offset", "timestamp")
DETECTION_FIELDS = ("plate", "gate", "lane", "ts", "nation")


def epoch_seconds(text: str) -> str:
    """Seconds since 1970 of a timestamp text; NULL where the text does not parse.

    The pattern holds the text to the one format, and the cast then parses it in about half
    the time that parsing by format takes.
    """
    parsed = f"CASE WHEN {text} RLIKE r'{TIME_PATTERN}' THEN try_cast({text} AS TIMESTAMP) END"
    return f"CAST({parsed} AS BIGINT)"


def time_text(seconds: str) -> str:
    return f"from_unixtime({seconds}, '{TIME_FORMAT}')"


def whole_number(text: str) -> str:
    """Integer from ``1`` or ``1.0``; NULL where the text is no number that fits."""
    return f"try_cast(try_cast({text} AS DOUBLE) AS INT)"


def decode_detections(messages: DataFrame, with_location: bool = False) -> DataFrame:
    """Messages to detections; fields that are missing or malformed become NULL.

    Columns past the last known one are ignored. Envelope columns present in the input are
    kept. Works on a batch or a stream.

    The line is split in a generator of one row, because the optimizer moves later filters
    and join conditions below a projection, where they would split each line again.
    """
    kept = [c for c in ENVELOPE_FIELDS if c in messages.columns]
    line = f"split(CAST(value AS STRING), '{SEPARATOR}')"
    columns = [
        "get(fields, 0) AS plate",
        f"{whole_number('get(fields, 1)')} AS gate",
        f"{whole_number('get(fields, 2)')} AS lane",
        f"{epoch_seconds('get(fields, 3)')} AS ts",
        "get(fields, 4) AS nation",
    ]
    if with_location:
        columns.append("try_cast(get(fields, 5) AS DOUBLE) AS loc")
    return messages.selectExpr(*kept, f"explode(array({line})) AS fields").selectExpr(
        *["CAST(key AS STRING) AS key" if c == "key" else c for c in kept], *columns
    )


def _joined(separator: str, columns: tuple[str, ...]) -> str:
    """The fields as one text; a missing one prints as the word ``null``."""
    texts = [time_text(c) if c == "ts" else f"CAST({c} AS STRING)" for c in columns]
    printed = ", ".join(f"coalesce({t}, 'null')" for t in texts)
    return f"concat_ws('{separator}', {printed})"


def _fields(with_location: bool) -> tuple[str, ...]:
    return DETECTION_FIELDS + (("loc",) if with_location else ())


def encode_detection(with_location: bool = False) -> Column:
    """Detection columns to one delimited line; a record without any field is NULL."""
    columns = _fields(with_location)
    missing = " AND ".join(f"{c} IS NULL" for c in columns)
    return F.expr(f"CASE WHEN NOT ({missing}) THEN {_joined(SEPARATOR, columns)} END")


def display_detection(with_location: bool = False) -> Column:
    """Detection columns separated by blanks, for people to read."""
    return F.expr(_joined(" ", _fields(with_location)))


def display_gate(gate: str = "gate", position: str = "position") -> Column:
    return F.expr(_joined(" ", (gate, position)))


def encode_counts(counts: Column) -> Column:
    """A map of counts as JSON bytes; NULL stays NULL."""
    return F.to_json(counts).cast("binary")


def decode_counts(value: Column) -> Column:
    """JSON bytes to a map of counts; NULL where they are not such a map."""
    return F.from_json(value.cast("string"), COUNT_MAP)
