"""Counts that fire at fixed intervals of processing time, changed or not."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Ship the state logic with the query, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PeriodicCount(StatefulProcessor):
    """Counts the rows of a key, and hands the count out whenever its timer is due."""

    def __init__(self, out: list[str], every_ms: int) -> None:
        self.out = out
        self.every_ms = every_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "cnt bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        stored = self.count.get()
        if stored is None:
            # From the first row on, each firing sets the next one.
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every_ms)
        self.count.update(((stored[0] if stored else 0) + sum(map(len, rows)),))
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(now + self.every_ms)
        values = [*key, self.count.get()[0], now]
        yield pd.DataFrame({name: [value] for name, value in zip([*self.out, "cnt", "fired_ms"], values)})


def periodic_counts(detections: DataFrame, key: str = "gate", every_ms: int = 1000) -> DataFrame:
    """A stream of ``key, cnt, fired_ms``: the running count of each key that has had a row, once every interval.

    A firing comes with the first batch after it is due, so the trigger should be as frequent. NULL is a key. A key's
    rows are counted by whole Arrow batches, not one by one.
    """
    schema = detections.select(key).schema.add("cnt", "long").add("fired_ms", "long")
    return detections.select(key).groupBy(key).transformWithStateInPandas(
        PeriodicCount([key], every_ms), schema, "append", "ProcessingTime"
    )
