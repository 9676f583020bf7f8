from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from roadstream.operators import counts
from roadstream.operators.latest import latest_per_key
from tests.samples import skewed_rows

NATIONS = [("A", 1, 0, "it"), ("B", 1, 0, "?"), ("C", 2, 0, ""), ("D", 2, 0, None), ("A", 1, 9, "it")]


def as_dict(frame):
    return {tuple(r)[:-1] if len(r) > 2 else r[0]: r[-1] for r in frame.collect()}


def test_nation_counts(detections):
    rows = detections(NATIONS)
    assert as_dict(counts.nation_counts(rows)) == {"it": 2, "?": 1, "": 1, None: 1}
    first = counts.most_frequent_first(counts.nation_counts(rows)).first()
    assert tuple(first) == ("it", 2)


def test_only_the_marker_is_an_unknown_nation(detections):
    assert as_dict(counts.known_nation_counts(detections(NATIONS))) == {"it": 2, "": 1, None: 1}


def test_plate_counts(detections):
    rows = detections(NATIONS)
    assert as_dict(counts.gate_plate_counts(rows)) == {
        (1, "A"): 2,
        (1, "B"): 1,
        (2, "C"): 1,
        (2, "D"): 1,
    }
    assert as_dict(counts.plate_counts(rows)) == {"A": 2, "B": 1, "C": 1, "D": 1}


def test_one_part_is_one_map_per_gate(detections):
    rows = detections([*NATIONS, (None, 2, 0, "it"), ("null", 2, 0, "it")])
    maps = counts.gate_plate_maps(rows, parts=1)
    assert {r["gate"]: r["counts"] for r in maps.collect()} == {
        1: {"A": 2, "B": 1},
        2: {"C": 1, "D": 1, "null": 2},
    }


def test_every_gate_is_split_without_loss(detections):
    rows = [(f"P{i % 97}", 4 if i % 3 else i % 7, 0, "it") for i in range(900)]
    maps = counts.gate_plate_maps(detections(rows), parts=8).collect()
    assert Counter(r["gate"] for r in maps)[4] > 5
    merged = Counter()
    for row in maps:
        for plate, count in row["counts"].items():
            assert (row["gate"], plate) not in merged
            merged[row["gate"], plate] = count
    assert merged == Counter((gate, plate) for plate, gate, _, _ in rows)


def test_single_count_maps(detections):
    maps = counts.single_count_maps(counts.nation_counts(detections(NATIONS)), "nation", "count")
    assert {r["nation"]: r["counts"] for r in maps.collect()} == {
        "it": {"it": 2},
        "?": {"?": 1},
        "": {"": 1},
        None: {"null": 1},
    }


def test_latest_per_key(detections):
    rows = skewed_rows(3)
    latest = latest_per_key(detections(rows), ["plate"], ["gate", "ts"])
    expected = {plate: (gate, ts) for plate, gate, ts, _ in rows}
    assert {r["plate"]: (r["gate"], r["ts"]) for r in latest.collect()} == expected


def test_latest_per_key_is_a_hash_aggregation(detections):
    plan = latest_per_key(detections(NATIONS), ["plate"], ["gate", "ts"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_counts_aggregate_before_the_shuffle(detections):
    plan = counts.nation_counts(detections(NATIONS).withColumn("x", F.lit(1)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text.split("Exchange")[1]
