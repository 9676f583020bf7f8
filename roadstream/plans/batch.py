"""The batch queries over the ``events`` table, by name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.functions.text import (
    decode_detections,
    display_detection,
    display_gate,
    encode_counts,
    encode_detection,
)
from roadstream.operators import counts, tracks
from roadstream.operators.enrich import with_location
from roadstream.operators.latest import latest_per_key
from roadstream.schemas import SEPARATOR
from roadstream.session import work_folder
from roadstream.sources.events import event_detections, event_messages
from roadstream.sources.gates import builtin_gates, read_gates, register_gates, scan_gates
from roadstream.sources.messages import (
    NEVER_IN_TEXT,
    as_messages,
    gates_as_messages,
    read_back_counts,
    read_detection_lines,
    read_messages,
)
from roadstream.streaming.sinks import to_topic

TRACK_PART = 8


def decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = event_detections(spark, sf_dir)
    return detections.select("offset", "plate", "gate", "lane", "ts", "nation")


def gate_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named gate table with the detections seen at each gate."""
    # A name of its own, so that no view of the caller's is replaced.
    name = f"gate_positions_{uuid.uuid4().hex}"
    register_gates(builtin_gates(spark).withColumnRenamed("loc", "position"), name)
    seen = event_detections(spark, sf_dir).groupBy("gate").agg(F.count("*").alias("cnt"))
    return scan_gates(spark, name).join(seen, "gate", "left").select(
        "gate",
        "loc",
        display_gate("gate", "loc").alias("text"),
        F.coalesce("cnt", F.lit(0)).alias("cnt"),
    )


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = event_messages(spark, sf_dir).select("value")
    return as_messages(lines).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = event_detections(spark, sf_dir)
    return detections.select("offset", encode_detection().alias("line"))


def encode_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = with_location(event_detections(spark, sf_dir), how="left")
    line = encode_detection(with_location=True).cast("binary").alias("value")
    return decode_detections(enriched.select("offset", line), with_location=True)


def display(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = with_location(event_detections(spark, sf_dir), how="left")
    return enriched.select(
        "offset",
        display_detection().alias("text"),
        display_detection(with_location=True).alias("located_text"),
    )


def map_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of known nations written as messages with a map and read back."""
    by_nation = counts.known_nation_counts(event_detections(spark, sf_dir))
    maps = counts.single_count_maps(by_nation, "nation", "count")
    messages = maps.select(
        F.col("nation").cast("binary").alias("key"), encode_counts(F.col("counts")).alias("value")
    )
    return read_back_counts(messages).select(F.col("name").alias("nation"), "cnt")


def latest_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    detections = event_detections(spark, sf_dir)
    return latest_per_key(detections, ["plate"], ["gate", "ts"])


def nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.most_frequent_first(counts.nation_counts(event_detections(spark, sf_dir)))


def known_nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.known_nation_counts(event_detections(spark, sf_dir))


def enriched_nation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over enriched detections, with how many of them have a location."""
    known = event_detections(spark, sf_dir).filter(counts.known_nation())
    return (
        with_location(known, how="left")
        .groupBy("nation")
        .agg(F.count("*").alias("count"), F.count("loc").alias("located"))
    )


def gate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_location(event_detections(spark, sf_dir)).select("offset", "gate", "loc")


def gate_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = with_location(event_detections(spark, sf_dir), how="left")
    return joined.select("offset", "gate", "loc")


def gate_plate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.gate_plate_counts(event_detections(spark, sf_dir))


def plate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.plate_counts(event_detections(spark, sf_dir))


def gate_plate_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and total of each gate's plate maps."""
    maps = counts.gate_plate_maps(event_detections(spark, sf_dir))
    total = F.aggregate(F.map_values("counts"), F.lit(0).cast("bigint"), lambda a, n: a + n)
    return (
        maps.select("gate", F.size("counts").cast("bigint").alias("n"), total.alias("total"))
        .groupBy("gate")
        .agg(F.sum("n").alias("plates"), F.sum("total").alias("cnt"))
    )


def vehicle_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks in parts so short that ordinary vehicles have several, as their SQL has them."""
    point = F.transform(
        "track", lambda p: F.concat_ws("@", p["gate"].cast("string"), p["ts"].cast("string"))
    )
    found = tracks.vehicle_tracks(event_detections(spark, sf_dir), entries=TRACK_PART)
    return found.select(
        "plate", "nation", "part", "start_ts", "cnt", F.concat_ws(SEPARATOR, point).alias("track")
    )


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.consecutive_pairs(event_detections(spark, sf_dir))


def consecutive_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select(
        "plate",
        "nation",
        F.col("prev_ts").alias("pts"),
        "ts",
        F.col("prev_loc").alias("ploc"),
        "loc",
    )


def speed_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.speed_violations(_pairs(spark, sf_dir)).select(
        "plate", "nation", "ts", F.round("speed", 6).alias("speed")
    )


def speed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and maximum of each vehicle's violating speeds."""
    return (
        tracks.speed_values(_pairs(spark, sf_dir))
        .filter(F.size("speed_values") > 0)
        .groupBy("plate", "nation")
        .agg(
            F.sum(F.size("speed_values")).alias("fines"),
            F.round(F.max(F.array_max("speed_values")), 6).alias("max_speed"),
        )
    )


def fines_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.fines_by_nation(_pairs(spark, sf_dir))


def tickets_by_plate(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_plate = tracks.consecutive_pairs(event_detections(spark, sf_dir), keys=["plate"])
    return tracks.tickets_by_plate(by_plate)


def average_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.average_speed(_pairs(spark, sf_dir)).select(
        "nation", F.round("avg_speed", 6).alias("avg_speed")
    )


def event_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.event_gaps(event_detections(spark, sf_dir)).select("offset", "gap_ms")


def line_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line of files with headers, loaded to a topic and decoded from there."""
    folder = work_folder(spark, "lines")
    line = F.col("value").cast("string").alias("plate,gate,lane,ts,nation")
    lines = event_messages(spark, sf_dir).select(line).write.option("sep", NEVER_IN_TEXT)
    lines.option("header", True).csv(f"{folder}/files")
    messages = as_messages(read_detection_lines(spark, f"{folder}/files"))
    to_topic(messages, "origin", format="parquet", path=f"{folder}/topic")
    stored = read_messages(spark, streaming=False, format="parquet", path=f"{folder}/topic")
    return decode_detections(stored).select("plate", "gate", "lane", "ts", "nation")


def gate_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gates that events name, by way of a gate file and a topic, with their detections."""
    folder = work_folder(spark, "gates")
    seen = with_location(event_detections(spark, sf_dir)).select("gate", "loc").distinct()
    seen.write.csv(f"{folder}/files")
    messages = gates_as_messages(read_gates(spark, f"{folder}/files"))
    to_topic(messages, "locations", format="parquet", path=f"{folder}/topic")
    stored = read_messages(
        spark, "locations", streaming=False, format="parquet", path=f"{folder}/topic"
    )
    gates = stored.selectExpr(f"split(CAST(value AS STRING), '{SEPARATOR}') AS fields").selectExpr(
        "CAST(fields[0] AS INT) AS gate", "CAST(fields[1] AS DOUBLE) AS loc"
    )
    return (
        with_location(event_detections(spark, sf_dir), gates)
        .groupBy("gate", "loc")
        .agg(F.count("*").alias("cnt"))
    )


BATCH_QUERIES = {
    "Q_decode": decode,
    "Q_gate_positions": gate_positions,
    "Q_topic_rows": topic_rows,
    "Q_encode": encode,
    "Q_encode_enriched": encode_enriched,
    "Q_display": display,
    "Q_map_roundtrip": map_roundtrip,
    "Q_latest_per_key": latest_position,
    "Q_nation_counts": nation_counts,
    "Q_known_nation_counts": known_nation_counts,
    "Q_enriched_nation_counts": enriched_nation_counts,
    "Q_gate_join": gate_join,
    "Q_gate_left_join": gate_left_join,
    "Q_gate_plate_counts": gate_plate_counts,
    "Q_plate_counts": plate_counts,
    "Q_gate_plate_map": gate_plate_map,
    "Q_vehicle_track": vehicle_track,
    "Q_consecutive_pairs": consecutive_pairs,
    "Q_speed_violations": speed_violations,
    "Q_speed_values": speed_values,
    "Q_fines_by_nation": fines_by_nation,
    "Q_tickets_by_plate": tickets_by_plate,
    "Q_avg_speed": average_speed,
    "Q_event_gap": event_gap,
    "Q_line_files": line_files,
    "Q_gate_file": gate_file,
}
