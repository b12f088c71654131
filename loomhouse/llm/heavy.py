"""Frequent values by Misra-Gries summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = 1 << 16


class Summary:
    """At most `counters` values with counts that fall short of the true ones by no more
    than the number of values seen, divided by `counters`."""

    def __init__(self, counters: int):
        self.counters, self.seen = counters, 0
        self.values, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        self.seen += len(values)
        found, counts = np.unique(values.view(np.int64), return_counts=True)
        both = np.concatenate([self.values, found])
        merged, place = np.unique(both, return_inverse=True)
        total = np.bincount(place, np.concatenate([self.counts, counts])).astype(np.int64)
        if len(merged) > self.counters:
            total -= np.partition(total, len(total) - self.counters - 1)[
                len(total) - self.counters - 1]
            merged, total = merged[total > 0], total[total > 0]
        self.values, self.counts = merged, total

    def table(self) -> pa.RecordBatch:
        """Values that make up more than their share of what this task has seen."""
        often = self.counts > max(1, self.seen // self.counters)
        return pa.RecordBatch.from_pydict(
            {"value": self.values[often], "n": self.counts[often]})


def frequent(df: DataFrame, values_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]],
             at_least: int, counters: int = COUNTERS) -> DataFrame:
    """(value, n) of the values found at least `at_least` times.

    Each task sends one summary, so a value falls short of its true count by at most two
    `counters`-ths of all values and one per task; n is a lower bound. No more than
    `counters` values are returned, the most frequent ones. `values_of` turns an Arrow
    batch into arrays of 64-bit values.
    """
    def summarise(batches):
        seen = Summary(counters)
        for batch in batches:
            for values in values_of(batch):
                seen.add(values)
        yield seen.table()

    return (df.mapInArrow(summarise, "value long, n long")
            .groupBy("value").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= at_least)
            .orderBy(F.desc("n"), "value").limit(counters))
