from __future__ import annotations

import datetime
import random
import sys

import duckdb
import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F

from roadstream.functions.text import decode_detections
from roadstream.operators import counts
from roadstream.operators.enrich import with_location
from roadstream.operators.hot import Split, hot_keys
from roadstream.operators.latest import latest_per_key
from roadstream.operators.tracks import VEHICLE
from roadstream.plans import stream
from roadstream.plans.oracle import ORACLE_SQL
from roadstream.plans.stream import firings, run_appends, run_complete, run_updates
from roadstream.session import PARTITIONS
from roadstream.sources.messages import read_back_counts, read_messages
from roadstream.streaming.fines import (
    added_fines,
    fines_between,
    pin_hot_keys,
    stored_tracks,
    total_fines,
)
from roadstream.streaming.joins import joined_within, with_changing_location
from roadstream.streaming.periodic import periodic_counts
from roadstream.streaming.sinks import (
    ALL_AVAILABLE,
    PartitionFiles,
    compact_changes,
    count_messages,
    read_changes,
    read_result,
    read_state,
    read_state_changes,
    to_changes,
    to_console,
    to_rows,
    to_table,
    to_topic,
)
from tests.samples import fines_by_hand, skewed_rows


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Topic:
    """A folder of stored messages that a test adds files to."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = str(folder)
        self.size = 0

    def add(self, rows, files=1, shuffle=None):
        numbered = list(enumerate(rows, start=self.size))
        self.size += len(rows)
        if shuffle is not None:
            random.Random(shuffle).shuffle(numbered)
        lines = [(offset, *row) for offset, row in numbered]
        for i in range(files):
            frame = self.spark.createDataFrame(
                lines[i::files], "offset long, plate string, gate int, ts long, nation string"
            )
            text = F.concat_ws(
                ",", "plate", "gate", F.lit("1.0"), F.from_unixtime("ts"), "nation"
            )
            frame.coalesce(1).select(
                F.col("plate").cast("binary").alias("key"),
                text.cast("binary").alias("value"),
                F.lit("origin").alias("topic"),
                F.lit(0).alias("partition"),
                "offset",
                F.timestamp_seconds("ts").alias("timestamp"),
            ).write.mode("append").parquet(self.folder)

    def detections(self, streaming=True):
        options = {"maxFilesPerTrigger": "1"} if streaming else {}
        return decode_detections(
            read_messages(
                self.spark, streaming=streaming, format="parquet", path=self.folder, **options
            )
        )


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "origin")


def totals(frame, key="nation"):
    return {r[key]: r["tot_fines"] for r in frame.collect()}


def sorted_rows(frame):
    return sorted(map(tuple, frame.select(*sorted(frame.columns)).collect()), key=repr)


COUNTS = {
    "nations": (counts.nation_counts, ["nation"], ["count"]),
    "known": (counts.known_nation_counts, ["nation"], ["count"]),
    "gates": (counts.gate_plate_counts, ["gate", "plate"], ["cnt"]),
    "latest": (
        lambda d: latest_per_key(d, ["plate"], ["gate", "ts"]),
        ["plate"],
        ["gate", "ts"],
    ),
    "enriched": (
        lambda d: with_location(d, how="left").groupBy("nation").agg(F.count("loc").alias("n")),
        ["nation"],
        ["n"],
    ),
}


@pytest.mark.parametrize("name", COUNTS)
def test_stream_equals_batch(topic, name):
    topic.add(skewed_rows(1, 300), files=3, shuffle=1)
    query, keys, values = COUNTS[name]
    streamed = run_updates(query(topic.detections()), keys, values)
    assert sorted_rows(streamed) == sorted_rows(query(topic.detections(streaming=False)))


def test_complete_mode_keeps_the_whole_result(topic):
    topic.add(skewed_rows(2, 200), files=2)
    result = run_complete(counts.most_frequent_first(counts.nation_counts(topic.detections())))
    batch = counts.nation_counts(topic.detections(streaming=False))
    assert sorted_rows(result) == sorted_rows(batch)


def test_the_result_before_stays_readable(topic, tmp_path):
    """A batch writes beside the result of the batch before; the newest one is read."""
    topic.add([("A", 1, 0, "it")] * 3, files=3)
    found = counts.nation_counts(topic.detections())
    folder = str(tmp_path / "result")
    to_table(found, folder, str(tmp_path / "cp"), ALL_AVAILABLE).awaitTermination()
    slots = topic.spark.read.parquet(folder).select("slot", "batch", "count").collect()
    assert {tuple(r) for r in slots} == {(0, 2, 3), (1, 1, 2)}
    assert sorted_rows(read_result(topic.spark, folder, found.schema)) == [(3, "it")]


def test_a_stream_without_input_has_an_empty_result(topic, tmp_path):
    (tmp_path / "origin").mkdir()
    result = run_updates(counts.nation_counts(topic.detections()), ["nation"], ["count"])
    assert result.columns == ["nation", "count"] and result.isEmpty()


def added(topic, **options):
    return added_fines(topic.detections(), **options)


def test_fines_in_any_order_of_arrival(topic):
    rows = skewed_rows(4, 240)
    topic.add(rows, files=3, shuffle=7)
    result = run_updates(total_fines(added(topic)), ["nation"], ["tot_fines"])
    assert totals(result) == fines_by_hand(rows)


def test_hot_cells_give_the_same_fines(topic, tmp_path):
    """The hot vehicle is split by second and by three offsets, and late rows fall between."""
    rows = skewed_rows(5, 180)
    topic.add(rows, files=3, shuffle=3)
    found = hot_keys(topic.detections(False), VEHICLE, Split(hot_rows=60, sample_every=1))
    hot = pin_hot_keys(found, str(tmp_path / "hot"))
    assert [r["plate"] for r in hot.collect()] == ["HOT"]
    stream = added(topic, hot=hot, split=Split(part_offsets=3))
    result = run_updates(total_fines(stream), ["nation"], ["tot_fines"])
    assert totals(result) == fines_by_hand(rows)


def test_pinned_hot_keys_do_not_change(spark, tmp_path):
    folder = str(tmp_path / "hot")
    schema = "plate string, nation string, crowded_slots array<bigint>"
    first = spark.createDataFrame([("A", "it", [1])], schema)
    other = spark.createDataFrame([("B", "it", [1])], schema)
    assert pin_hot_keys(first, folder).first()["plate"] == "A"
    assert pin_hot_keys(other, folder).first()["plate"] == "A"
    (tmp_path / "lost").mkdir()
    assert pin_hot_keys(other, str(tmp_path / "lost")).first()["plate"] == "B"


def test_tickets_by_plate(topic):
    rows = skewed_rows(6, 120)
    topic.add(rows, files=2, shuffle=2)
    tickets = total_fines(added(topic, keys=["plate"]), "plate", "tickets")
    result = run_updates(tickets, ["plate"], ["tickets"])
    expected = fines_by_hand(rows, key=0, by_plate=True)
    assert {r["plate"]: r["tickets"] for r in result.collect()} == expected


def test_restart_continues_from_the_checkpoint(topic, tmp_path):
    rows = skewed_rows(8, 160)
    folder = str(tmp_path / "job")
    topic.add(rows[:80])
    run_updates(total_fines(added(topic)), ["nation"], ["tot_fines"], folder)
    topic.add(rows[80:], files=2)
    result = run_updates(total_fines(added(topic)), ["nation"], ["tot_fines"], folder)
    assert totals(result) == fines_by_hand(rows)


def test_a_late_detection_pairs_again(spark, topic, tmp_path):
    gates = spark.createDataFrame([(1, 0.0), (2, 100.0), (3, 10.0)], "gate int, loc double")
    folder = str(tmp_path / "job")
    start = 10_000
    for row in [("A", 1, start, "it"), ("A", 2, start + 2400, "it"), ("A", 3, start + 2000, "it")]:
        topic.add([row])
    stream = total_fines(added(topic, gates=gates))
    assert totals(run_updates(stream, ["nation"], ["tot_fines"], folder)) == {"it": 1}


def test_nations_without_a_fine_do_not_appear(topic):
    topic.add([("A", 21, 0, "it"), ("A", 4, 3600, "it"), ("B", 21, 0, "fr"), ("B", 4, 600, "fr")])
    result = run_updates(total_fines(added(topic)), ["nation"], ["tot_fines"])
    assert totals(result) == {"fr": 1}


MONTH = 30 * 86_400


def test_retention_forgets_old_detections_only(topic):
    """In order of time, 3171 s lose nothing, also where a new bucket has begun."""
    rows = [("A", 21, MONTH - 300, "it"), ("A", 4, MONTH + 300, "it")]
    rows += [("A", 21, 2 * MONTH - 10, "it"), ("A", 4, 2 * MONTH + 10_000, "it")]
    for row in rows:
        topic.add([row])
    kept = run_updates(total_fines(added(topic, retention_s=3171)), ["nation"], ["tot_fines"])
    assert totals(kept) == fines_by_hand(rows) == {"it": 1}


def test_retention_ignores_what_is_older(topic):
    for row in [("A", 21, 100_000, "it"), ("A", 4, 600, "it"), ("A", 21, 0, "it")]:
        topic.add([row])
    whole = run_updates(total_fines(added(topic)), ["nation"], ["tot_fines"])
    assert totals(whole) == {"it": 1}
    short = run_updates(total_fines(added(topic, retention_s=3171)), ["nation"], ["tot_fines"])
    assert totals(short) == {}


@pytest.mark.parametrize("split_hot", [False, True])
def test_watermark_drops_late_messages(spark, topic, split_hot):
    """A batch drops what is later than the watermark that the batch before it began with."""
    for row in [("A", 21, 100_000), ("A", 21, 200_000), ("B", 21, 200_001), ("A", 4, 100_600)]:
        topic.add([(*row, "it")])
    hot = spark.createDataFrame(
        [("A", "it", [])], "plate string, nation string, crowded_slots array<bigint>"
    )
    options = {"hot": hot} if split_hot else {}
    late = added(topic, watermark="10 minutes", **options)
    assert totals(run_complete(total_fines(late))) == {}
    on_time = added(topic, watermark="2 days", **options)
    assert totals(run_complete(total_fines(on_time))) == {"it": 1}


def test_hot_cells_expire_behind_the_watermark(spark, topic, tmp_path):
    for row in [("A", 21, 100_000), ("A", 4, 100_600), ("A", 4, 200_000), ("A", 4, 200_001)]:
        topic.add([(*row, "it")])
    hot = spark.createDataFrame(
        [("A", "it", [])], "plate string, nation string, crowded_slots array<bigint>"
    )
    stream = added(topic, hot=hot, watermark="10 minutes", retention_s=3171)
    folder = str(tmp_path / "job")
    assert totals(run_complete(total_fines(stream), folder)) == {"it": 1}
    cells = read_state(spark, f"{folder}/checkpoint", 2, "nodes")
    assert {r["key"]["cell"] for r in cells.collect()} == {"200000/0", "200001/0"}


def test_idle_vehicles_expire_behind_the_watermark(topic, tmp_path):
    """A vehicle that is seen no more is forgotten, one that is seen again keeps what is new enough."""
    for row in [("A", 21, 100_000), ("B", 4, 100_600), ("B", 4, 102_000), ("C", 4, 104_500), ("C", 5, 104_501)]:
        topic.add([(*row, "it")])
    folder = str(tmp_path / "job")
    stream = added(topic, watermark="10 minutes", retention_s=3171)
    run_complete(total_fines(stream), folder)
    kept = stored_tracks(topic.spark, f"{folder}/checkpoint", operator=1)
    assert {(r.plate, r.ts) for r in kept.collect()} == {("B", 100_600), ("B", 102_000), ("C", 104_500), ("C", 104_501)}


def test_what_batches_changed_in_a_state(topic, tmp_path):
    for row in [("A", 21, 0), ("A", 4, 60), ("B", 4, 120)]:
        topic.add([(*row, "it")])
    folder = str(tmp_path / "job")
    run_updates(counts.plate_counts(topic.detections()), ["plate"], ["cnt"], folder)
    changes = read_state_changes(topic.spark, f"{folder}/checkpoint", 1, 2)
    assert {(r.batch_id, r.change_type, r.key.plate) for r in changes.collect()} == {(1, "update", "A"), (2, "update", "B")}


def located_rows(frame):
    return {r["offset"]: (r["loc"], r["version"]) for r in frame.collect()}


def gate_changes(spark, folder, batches):
    """A stream of changes ``(gate, loc, offset, seconds)``, one file a batch."""
    schema = "gate int, loc double, offset bigint, seconds bigint"
    for rows in batches:
        frame = spark.createDataFrame(rows, schema).withColumn("timestamp", F.timestamp_seconds("seconds"))
        frame.drop("seconds").coalesce(1).write.mode("append").parquet(str(folder))
    reader = spark.readStream.schema("gate int, loc double, offset bigint, timestamp timestamp")
    return reader.option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_a_table_that_changes(spark, topic, tmp_path):
    """A position comes, moves within a batch, goes, and comes back; other gates and missing ones see none of it."""
    for rows in ([0, 1, 2, 3], [4, 5], [6]):
        topic.add([("A", 7 if i in (2, 3) else 1, i, "it") for i in rows])
    changes = gate_changes(
        spark, tmp_path / "gates", [[(1, 5.0, 0, 0), (1, 6.0, 1, 0), (8, 9.0, 0, 0)], [(1, None, 4, 0)], [(1, 7.0, 5, 0), (None, 1.0, 2, 0)]]
    )
    joined = with_changing_location(topic.detections(), changes, parts=3).select("offset", "loc", "version")
    found = located_rows(run_appends(joined, str(tmp_path / "job")))
    assert found == {0: (None, None), 1: (5.0, 0), 2: (None, None), 3: (None, None), 4: (6.0, 1), 5: (None, 4), 6: (7.0, 5)}


def test_a_change_of_an_earlier_batch_is_what_a_late_message_sees(spark, topic, tmp_path):
    topic.add([("A", 2, 0, "it"), ("A", 2, 1, "it")])
    topic.add([("A", 1, 2, "it")])
    changes = gate_changes(spark, tmp_path / "gates", [[(1, 5.0, 10, 0), (1, 6.0, 20, 0)], [(3, 1.0, 30, 0)]])
    joined = with_changing_location(topic.detections(), changes, parts=2).select("offset", "loc", "version")
    assert located_rows(run_appends(joined, str(tmp_path / "job")))[2] == (6.0, 20)


def test_a_changing_table_after_a_restart(spark, topic, tmp_path):
    changes = gate_changes(spark, tmp_path / "gates", [[(1, 5.0, -1, 0)]])
    folder = str(tmp_path / "job")
    for i in range(2):
        topic.add([("A", 1, i, "it")])
        joined = with_changing_location(topic.detections(), changes, parts=2).select("offset", "loc", "version")
        found = located_rows(run_appends(joined, folder))
    assert found == {0: (5.0, -1), 1: (5.0, -1)}


def test_two_streams_meet_once_and_leave_the_state(spark, topic, tmp_path):
    hours = [100, 101, 102, 130, 160]
    for h in hours:
        topic.add([("A", 1, h * 3600, "it"), ("B", 2, h * 3600, "it")])
    changes = gate_changes(spark, tmp_path / "gates", [[(1, float(h), h, h * 3600 + 60)] for h in hours])
    joined = joined_within(topic.detections(), changes, within="1 hour", parts=3).select("plate", "ts", "version")
    folder = str(tmp_path / "job")
    found = [tuple(r) for r in run_appends(joined, folder).collect()]
    pairs = [("A", a * 3600, b) for a in hours for b in hours if abs(a * 3600 - b * 3600 - 60) <= 3600]
    assert sorted(found) == sorted(pairs)
    left = spark.read.format("statestore").option("joinSide", "left").load(f"{folder}/checkpoint")
    right = spark.read.format("statestore").option("joinSide", "right").load(f"{folder}/checkpoint")
    # Only what is near the last hour is left.
    assert {r.value.ts for r in left.collect()} <= {160 * 3600} and {r.value.version for r in right.collect()} <= {160}


def test_a_partition_is_written_once(spark, topic, tmp_path):
    writer = PartitionFiles(f"file://{tmp_path}/rows")
    assert writer.open(3, 7)
    writer.process(Row(a=1, b=None))
    writer.process(Row(a=2, b="x"))
    assert not list(tmp_path.glob("rows/batch=7/part-*"))
    writer.close(None)
    again = PartitionFiles(f"{tmp_path}/rows")
    assert not again.open(3, 7)
    again.close(None)
    failed = PartitionFiles(f"{tmp_path}/rows")
    assert failed.open(4, 7)
    failed.process(Row(a=3, b=None))
    failed.close(ValueError("lost"))
    assert failed.open(5, 7)
    failed.close(None)
    assert {(r.a, r.b, r.batch) for r in spark.read.schema("a int, b string, batch int").json(f"{tmp_path}/rows").collect()} == {(1, None, 7), (2, "x", 7)}
    assert len(list(tmp_path.glob("rows/batch=7/*"))) == 1


def test_fines_between_compares_ends_with_starts():
    track = tuple(map(np.array, ([0, 100, 100], [0, 1, 2], [0.0, 5.0, 9.0], [10, 100, 100], [1.0, 5.0, 9.0])))
    assert fines_between(track, 130.0) == 2
    assert fines_between(tuple(f[:1] for f in track), 130.0) == 0


def test_changes_keep_the_newest_row(topic, tmp_path):
    topic.add([("A", 1, 0, "it"), ("B", 1, 0, "fr")])
    topic.add([("A", 1, 1, "it")])
    folder = str(tmp_path / "changes")
    result = counts.nation_counts(topic.detections())
    to_changes(result, folder, str(tmp_path / "cp"), ALL_AVAILABLE).awaitTermination()
    spark = topic.spark
    assert spark.read.parquet(folder).count() == 3
    current = read_changes(spark, folder, result.schema, ["nation"], ["count"])
    assert {tuple(r) for r in current.collect()} == {("it", 2), ("fr", 1)}


def test_upserts_to_a_topic_and_back(topic, tmp_path):
    topic.add([("A", 1, 0, "it"), ("B", 1, 0, "?")])
    topic.add([("C", 1, 0, "it")])
    known = counts.known_nation_counts(topic.detections())
    messages = count_messages(
        counts.single_count_maps(known, "nation", "count"), F.col("nation")
    )
    query = to_topic(
        messages,
        "results",
        format="parquet",
        path=str(tmp_path / "out"),
        checkpoint=str(tmp_path / "cp"),
        trigger=ALL_AVAILABLE,
    )
    query.awaitTermination()
    stored = read_messages(
        topic.spark, "results", streaming=False, format="parquet", path=str(tmp_path / "out")
    )
    assert sorted(map(tuple, read_back_counts(stored).collect())) == [
        ("it", "it", 1),
        ("it", "it", 2),
    ]
    newest = latest_per_key(stored, ["key"], ["value"])
    assert [tuple(r) for r in read_back_counts(newest).collect()] == [("it", "it", 2)]


def test_state_can_be_looked_up(topic, tmp_path):
    topic.add([("A", 1, 0, "it"), ("B", 1, 0, "fr"), ("C", 1, 0, "it")])
    run_updates(
        counts.nation_counts(topic.detections()), ["nation"], ["count"], str(tmp_path / "job")
    )
    state = read_state(topic.spark, str(tmp_path / "job" / "checkpoint"))
    found = state.filter("key.nation = 'it'").select("value.count").first()
    assert found[0] == 2


class FileWriter:
    """Appends rows to one file per partition and batch, as a sink of the user's own."""

    def __init__(self, folder):
        self.folder = folder

    def open(self, partition_id, epoch_id):
        self.out = open(f"{self.folder}/{epoch_id}-{partition_id}", "w")
        return True

    def process(self, row):
        self.out.write(f"{row['nation']} {row['count']}\n")

    def close(self, error):
        self.out.close()


def test_row_writer(topic, tmp_path):
    topic.add([("A", 1, 0, "it"), ("B", 1, 0, "fr"), ("C", 1, 0, "it")])
    folder = tmp_path / "written"
    folder.mkdir()
    query = to_rows(
        counts.nation_counts(topic.detections()),
        FileWriter(str(folder)),
        checkpoint=str(tmp_path / "cp"),
        trigger=ALL_AVAILABLE,
    )
    query.awaitTermination()
    lines = "".join(p.read_text() for p in folder.iterdir()).splitlines()
    assert sorted(lines) == ["fr 1", "it 2"]


def test_console_with_a_one_second_trigger(topic):
    topic.add([("A", 1, 0, "it")])
    query = to_console(counts.nation_counts(topic.detections()))
    try:
        query.processAllAvailable()
        assert query.lastProgress["sink"]["description"].startswith("org.apache.spark")
        assert query.isActive
    finally:
        query.stop()


def test_sorting_needs_complete_mode(topic, tmp_path):
    topic.add([("A", 1, 0, "it")])
    ordered = counts.most_frequent_first(counts.nation_counts(topic.detections()))
    with pytest.raises(Exception, match="(?i)sort"):
        to_changes(ordered, str(tmp_path / "x"), str(tmp_path / "cp")).awaitTermination()


def test_a_failing_stream_raises(topic, tmp_path):
    topic.add([("A", 1, 0, "it")])
    broken = topic.detections().select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
    with pytest.raises(StreamingQueryException, match="broken"):
        run_updates(broken, ["x"], [], str(tmp_path / "job"))


def test_compacted_changes_stay_bounded_and_whole(spark, topic, tmp_path):
    """Runs with a compaction after each; one is lost half-way, and the last batch of a run is repeated."""
    folder, checkpoint = str(tmp_path / "changes"), str(tmp_path / "cp")
    rows, stored = [], []
    for run in range(4):
        fresh = [(f"P{i % 5}", 1, 60 * i, "it") for i in range(7 * run, 7 * run + 6)]
        rows += fresh
        topic.add(fresh, files=3)
        result = counts.plate_counts(topic.detections())
        to_changes(result, folder, checkpoint, ALL_AVAILABLE).awaitTermination()
        if run == 2:
            # A base that was not finished, and one file of it.
            lost = tmp_path / "changes-bases" / "upto=8"
            spark.createDataFrame([("P0", 999, 8)], "plate string, cnt long, batch long").write.parquet(str(lost))
            (lost / "_SUCCESS").unlink()
        before = sorted_rows(read_changes(spark, folder, result.schema, ["plate"], ["cnt"]))
        assert compact_changes(spark, folder, result.schema, ["plate"], ["cnt"]) == 3 * run + 2
        assert compact_changes(spark, folder, result.schema, ["plate"], ["cnt"]) == 3 * run + 2
        assert sorted_rows(read_changes(spark, folder, result.schema, ["plate"], ["cnt"])) == before
        assert before == sorted((sum(r[0] == p for r in rows), p) for p in {r[0] for r in rows})
        stored.append((len(list((tmp_path / "changes").glob("batch=*"))), len(list((tmp_path / "changes-bases").glob("upto=*")))))
    assert stored == [(3, 1), (3, 2), (3, 2), (3, 2)]


def test_nothing_to_compact(spark, tmp_path):
    schema = counts.plate_counts(spark.createDataFrame([], "plate string")).schema
    assert compact_changes(spark, str(tmp_path / "none"), schema, ["plate"], ["cnt"]) is None
    assert read_changes(spark, str(tmp_path / "none"), schema, ["plate"], ["cnt"]).isEmpty()


def test_counts_fire_again_without_input(topic, tmp_path):
    """Each key fires about once a second from its first row on, with counts that never fall, also after a restart."""
    topic.add([("A", 1, 0, "it"), ("B", 1, 0, "it"), ("C", 2, 0, "it")])
    folder = str(tmp_path / "job")
    firings(periodic_counts(topic.detections()), folder, idle_batches=4)
    topic.add([("A", 2, 60, "it")])
    fired = firings(periodic_counts(topic.detections()), folder, idle_batches=4)
    rows = sorted((r.gate, r.fired_ms, r.cnt) for r in fired.collect())
    counted = {gate: [cnt for g, _, cnt in rows if g == gate] for gate in (1, 2)}
    assert set(counted[1]) == {2} and len(counted[1]) >= 4
    assert set(counted[2]) == {1, 2} and counted[2] == sorted(counted[2]) and counted[2].count(2) >= 2
    times = [ms for g, ms, _ in rows if g == 1]
    assert min(b - a for a, b in zip(times, times[1:])) >= 1000


def test_two_streams_meet_by_their_time_span(spark, topic, tmp_path):
    """Rows are matched within spans of the window's length, so a pair across a span's border is found, once."""
    seconds = [3599, 3600, 3601, 7199, 7200, 10800, 14400]
    topic.add([("A", 1, s, "it") for s in seconds])
    changes = gate_changes(spark, tmp_path / "gates", [[(1, 1.0, 1, 7200), (1, 2.0, 2, 3600)]])
    joined = joined_within(topic.detections(), changes, within="1 hour", parts=2)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "changed_span" in plan and "span" in plan
    found = [tuple(r) for r in run_appends(joined.select("ts", "version"), str(tmp_path / "job")).collect()]
    changed = {1: 7200, 2: 3600}
    assert sorted(found) == sorted((s, v) for s in seconds for v, at in changed.items() if abs(s - at) <= 3600)


def test_a_replay_reads_its_input_as_often_for_any_number_of_files(spark, tmp_path, monkeypatch):
    """Files hold the messages of their range, late ones included, in the order in which they are read."""
    monkeypatch.setattr(stream, "REPLAYED_MESSAGES", 10)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 200, numPartitions=2).selectExpr("id AS offset", "id * 3 AS value")
    rows = rows.mapInArrow(counted, "offset bigint, value bigint")
    path = tmp_path / "topic"
    stream._replay_in_order(rows, str(path), "CASE offset % 7 WHEN 3 THEN 2 WHEN 5 THEN 1 ELSE 0 END")
    files = sorted(path.glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    late = {3: 2, 5: 1}
    wanted = [[o for o in range(200) if min(19, o // 10 + late.get(o % 7, 0)) == file] for file in range(20)]
    assert [sorted(r.offset for r in spark.read.parquet(str(f)).collect()) for f in files] == wanted
    assert read.value <= 3 * 200
    assert [p.name for p in tmp_path.iterdir()] == ["topic"]


def test_a_replay_keeps_ranges_without_messages_as_empty_files(spark, tmp_path):
    path = tmp_path / "topic"
    stream._replay_in_order(spark.createDataFrame([(0,), (0,), (99,)], "offset bigint"), str(path))
    files = sorted(path.glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    assert [spark.read.schema("offset bigint").parquet(str(f)).count() for f in files] == [2, 0, 0, 0, 0, 1]


def test_queries_keep_their_state_in_few_partitions(spark, topic, tmp_path):
    """Every batch opens the state of all partitions, so a number meant for large shuffles is not taken for it."""
    topic.add([("A", 1, 0, "it")])
    before = spark.conf.get(PARTITIONS)
    most = max(stream.LEAST_STATES, stream.STATES_A_THREAD * spark.sparkContext.defaultParallelism)
    spark.conf.set(PARTITIONS, str(most + 8))
    try:
        result = run_complete(counts.nation_counts(topic.detections()), str(tmp_path / "job"))
        assert spark.conf.get(PARTITIONS) == str(most + 8)
    finally:
        spark.conf.set(PARTITIONS, before)
    assert [tuple(r) for r in result.collect()] == [("it", 1)]
    assert len(list((tmp_path / "job/checkpoint/state/0").glob("[0-9]*"))) == most


def test_a_change_has_few_copies_in_the_state(spark, topic, tmp_path):
    topic.add([("A", 1, 7200, "it")])
    changes = gate_changes(spark, tmp_path / "gates", [[(1, 1.0, 1, 7200)]])
    folder = str(tmp_path / "job")
    assert run_appends(joined_within(topic.detections(), changes).select("ts", "version"), folder).count() == 1
    right = spark.read.format("statestore").option("joinSide", "right").load(f"{folder}/checkpoint")
    assert right.count() <= 12


def test_late_fines_keep_their_state_in_few_partitions(spark, tmp_path, monkeypatch):
    """Each of the three stateful steps does, and the fines are those of the SQL, which knows what comes too late."""
    start = datetime.datetime(2024, 1, 1)
    events = [(i, start + datetime.timedelta(minutes=2 * i), i % 5, ["it", "error"][i % 2], 0.0, "") for i in range(240)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).coalesce(1).write.parquet(str(tmp_path / "sf/events.parquet"))
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/sf/events.parquet/*.parquet'")
        wanted = connection.execute(ORACLE_SQL["S_fines_late"]).fetchall()
    monkeypatch.setattr(stream, "work_folder", lambda *_: str(tmp_path / "job"))
    most = max(stream.LEAST_STATES, stream.STATES_A_THREAD * spark.sparkContext.defaultParallelism)
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(most + 8))
    try:
        found = stream.fines_late(spark, str(tmp_path / "sf")).collect()
    finally:
        spark.conf.set(PARTITIONS, before)
    assert wanted and sorted(map(tuple, found)) == sorted(wanted)
    steps = tmp_path / "job/checkpoint/state"
    assert [len(list((steps / str(n)).glob("[0-9]*"))) for n in range(3)] == [most] * 3
