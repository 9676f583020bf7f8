"""What the physical plans of the batch queries must and must not hold."""

from __future__ import annotations

import re

import pytest

from roadstream.operators import tracks
from roadstream.operators.hot import Split
from roadstream.plans.batch import BATCH_QUERIES
from roadstream.sources.events import event_detections

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_batch_plans(spark, name):
    plan = plan_of(BATCH_QUERIES[name](spark, SF_DIR))
    for unwanted in ("Python", "CartesianProduct", "NestedLoop", "SinglePartition", "SortMergeJoin"):
        if unwanted == "SortMergeJoin" and name == "Q_gate_positions":
            continue  # both sides are one row per gate
        assert unwanted not in plan, unwanted
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        # The event's own value, a number; that of a stored message is its line.
        assert "props" not in schema and "value:double" not in schema


def test_only_the_offset_is_hashed_for_the_sample(spark):
    plan = plan_of(tracks.consecutive_pairs(event_detections(spark, SF_DIR)))
    scans = [line for line in plan.splitlines() if "Filter" in line and "xxhash64" in line]
    assert scans and all("event_id" in line and "split" not in line for line in scans)


def test_hot_keys_are_looked_up_in_one_table(spark):
    pairs = tracks.consecutive_pairs(
        event_detections(spark, SF_DIR), split=Split(hot_rows=5, sample_every=1)
    )
    pairs.collect()
    final = plan_of(pairs).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
