from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadstream.functions.text import (
    decode_counts,
    decode_detections,
    display_detection,
    display_gate,
    encode_counts,
    encode_detection,
    time_text,
)
from roadstream.sources.gates import builtin_gates


def decode(spark, *lines, **options):
    messages = spark.createDataFrame([(v,) for v in lines], "value string").select(
        F.col("value").cast("binary").alias("value")
    )
    return decode_detections(messages, **options)


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("AB,1,1,2016-01-01 00:00:00,it", ("AB", 1, 1, 1451606400, "it")),
        ("AB,1,1.0,2016-01-01 00:00:00,it", ("AB", 1, 1, 1451606400, "it")),
        ("AB,1,1.9,2016-01-01 00:00:00,it", ("AB", 1, 1, 1451606400, "it")),
        ("AB,1,1,2016-01-01 00:00:00,it,more,columns", ("AB", 1, 1, 1451606400, "it")),
        ("AB,1", ("AB", 1, None, None, None)),
        ("", ("", None, None, None, None)),
        ("AB,1,1,xx,it", ("AB", 1, 1, None, "it")),
        ("AB,1,1,2016-01-01,it", ("AB", 1, 1, None, "it")),
        ("AB,1,1,2016-02-30 00:00:00,it", ("AB", 1, 1, None, "it")),
        ("AB,1,1,2016-01-01 00:00:00 ,it", ("AB", 1, 1, None, "it")),
        ("AB,x,NaN,2016-01-01 00:00:00,?", ("AB", None, None, 1451606400, "?")),
        ("AB,99999999999,1,2016-01-01 00:00:00,", ("AB", None, 1, 1451606400, "")),
        (None, (None, None, None, None, None)),
    ],
)
def test_decode(spark, line, expected):
    assert tuple(decode(spark, line).first()) == expected


def test_decode_keeps_the_envelope(spark):
    messages = spark.sql(
        "SELECT CAST('AB' AS BINARY) AS key, CAST('AB,1,1,x,it' AS BINARY) AS value,"
        " 'origin' AS topic, 3 AS partition, 7L AS offset, TIMESTAMP'2016-01-01' AS timestamp"
    )
    decoded = decode_detections(messages)
    assert decoded.columns[:4] == ["key", "partition", "offset", "timestamp"]
    assert decoded.first()["key"] == "AB"
    assert decoded.schema["ts"].dataType.simpleString() == "bigint"


def test_encode_is_the_inverse_of_decode(spark):
    line = "AB,1,2,2016-01-01 08:09:10,it"
    decoded = decode(spark, line)
    assert decoded.select(encode_detection()).first()[0] == line
    located = decode(spark, line + ",124.7", with_location=True)
    assert located.select(encode_detection(with_location=True)).first()[0] == line + ",124.7"


def test_missing_fields_print_as_null_and_a_missing_record_is_null(spark):
    short = decode(spark, "AB,1")
    assert short.select(encode_detection()).first()[0] == "AB,1,null,null,null"
    assert short.select(display_detection()).first()[0] == "AB 1 null null null"
    missing = decode(spark, None)
    assert missing.select(encode_detection()).first()[0] is None


def test_display(spark):
    located = decode(spark, "AB,1,2,2016-01-01 08:09:10,it,124.7", with_location=True)
    row = located.select(display_detection().alias("a"), display_detection(True).alias("b"))
    assert tuple(row.first()) == (
        "AB 1 2 2016-01-01 08:09:10 it",
        "AB 1 2 2016-01-01 08:09:10 it 124.7",
    )
    gates = builtin_gates(spark).filter("gate = 22").select(display_gate("gate", "loc"))
    assert gates.first()[0] == "22 135.3"


def test_time_text(spark):
    assert spark.range(1).selectExpr(time_text("1451606400")).first()[0] == "2016-01-01 00:00:00"


def test_count_maps_survive_a_round_trip(spark):
    maps = spark.sql("SELECT map('it', 3L, '?', 5L) AS m UNION ALL SELECT NULL")
    back = maps.select(decode_counts(encode_counts(F.col("m")))).collect()
    assert [r[0] for r in back] == [{"it": 3, "?": 5}, None]


def test_malformed_count_maps_are_null(spark):
    broken = spark.sql("SELECT CAST('not a map' AS BINARY) AS v")
    assert broken.select(decode_counts(F.col("v"))).first()[0] is None
