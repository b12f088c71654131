"""Best-fit packing of token pieces into sequences, in supersteps over sizes.

Sizes are whole numbers up to the capacity, so documents and gaps, sorted by size, are runs
of equal sizes; a piece is known by its size and its rank among pieces of that size. The
ranks are counted where the pieces are (partition by partition), and only the counts of the
sizes, at most one a token of capacity, meet: on the driver, where one loop stands in for
distributed rounds. Each of its supersteps takes the largest size left:
its pieces are matched in order of rank with the gaps that succeed it, smallest first (best
fit), so no two pieces claim one gap; the gaps they shrink are sorted in again, and the rest
of them open new sequences. The result of a superstep is a few runs of ranks with the first
sequence and place of each. Every piece then looks up its run.

Rows: a missing text is empty (its end id alone); rows with one doc_id are packed one by
one. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import (byte_rows, column, doc_key, groups, numbers, own_id, ship, whole_text)
from .tokens import byte_encoder, ragged, with_end

CAPACITY = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.json"

_PIECE = ("slice int, place long, doc_id long, piece int, start long, length long, "
          "ids_crc32 long")


def _pieces(offsets: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number and start (in its row) of every piece, in order."""
    sizes = np.diff(offsets)
    number = -(-sizes // capacity)
    row = np.repeat(np.arange(len(sizes)), number)
    piece = ragged(np.zeros(len(sizes), np.int64), number)
    first = sizes - (number - 1) * capacity
    start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
    return row, piece, start


def _cutter(vocabulary, end_id, capacity, with_ids):
    def cut(batches):
        encoder = byte_encoder(vocabulary)
        part, counts = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            doc = numbers(batch, "doc")
            data, offsets = byte_rows(column(batch, "text"))
            for low, high in groups(offsets):
                ids, at = with_end(*encoder.encode(data[offsets[low]:offsets[high]],
                                                   offsets[low:high + 1] - offsets[low]), end_id)
                row, piece, start = _pieces(at, capacity)
                begin = at[row] + start
                end = np.append(begin[1:], len(ids))
                length = end - begin
                # How many of the same size came before in this slice.
                order = np.argsort(length, kind="stable")
                new = np.flatnonzero(np.diff(length[order], prepend=-1))
                times = np.diff(np.append(new, len(order)))
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order)) - np.repeat(new, times)
                place += counts[length]
                counts[length[order][new]] += times
                raw = memoryview(ids.tobytes())
                cut_out = [raw[4 * a:4 * b] for a, b in zip(begin.tolist(), end.tolist())]
                columns = {
                    "slice": pa.array(np.full(len(row), part, np.int32)), "place": place,
                    "doc_id": doc[low:high][row], "piece": piece.astype(np.int32),
                    "start": start, "length": length,
                    "ids_crc32": np.array([zlib.crc32(c) for c in cut_out], np.int64)}
                if with_ids:
                    columns["ids"] = pa.array([c.tobytes() for c in cut_out], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)
    return cut


def token_pieces(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` ids, written once: only longer documents are cut, and the
    first piece takes what is over. `place` numbers the pieces of one size in a slice, which is
    what one task wrote. `with_ids` adds the ids themselves, as little-endian 32-bit numbers."""
    ship(docs)
    rows = docs.select(doc_key().alias("doc"), whole_text().alias("text"))
    schema = _PIECE + (", ids binary" if with_ids else "")
    return stage(rows.mapInArrow(_cutter(vocabulary, end_id, capacity, with_ids), schema), "pieces")


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """(size, first rank, first sequence, place, pieces a sequence): runs of ranks.

    A run ends where the next one of its size begins. Its pieces go to consecutive sequences,
    so many to each, one after the other from that place.
    """
    gaps: list[int] = []                       # sizes of the gaps, sorted
    held: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    runs, sequence = [], 0

    def put(gap, first, number):
        if gap and number:
            if gap not in held:
                bisect.insort(gaps, gap)
                held[gap] = []
            held[gap].append((first, number))

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            at = bisect.bisect_left(gaps, size)
            if at == len(gaps):
                break
            gap = gaps[at]
            first, number = held[gap].pop()
            if not held[gap]:
                del held[gap], gaps[at]
            taken = min(number, left)
            runs.append((size, rank, first, capacity - gap, 1))
            put(gap, first + taken, number - taken)
            put(gap - size, first, taken)
            rank, left = rank + taken, left - taken
        if left:
            each = capacity // size
            runs.append((size, rank, sequence, 0, each))
            full, over = divmod(left, each)
            put(capacity - each * size, sequence, full)
            if over:
                put(capacity - over * size, sequence + full, 1)
            sequence += full + (over > 0)
    return runs


def _placer(runs):
    table = np.array(runs, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    # One number for (size, rank): sizes fit in 20 bits, ranks in the rest.
    key = (table[:, 0] << 43) + table[:, 1]

    def place(batches):
        for batch in batches:
            size, rank = numbers(batch, "length"), numbers(batch, "rank")
            run = table[np.searchsorted(key, (size << 43) + rank, "right") - 1]
            nth = rank - run[:, 1]
            rest = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, n) for n in rest), pa.array(run[:, 2] + nth // run[:, 4]),
                 pa.array(run[:, 3] + nth % run[:, 4] * size)],
                [*rest, "sequence_id", "offset"])
    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with the sequence that each one is put into and its place there."""
    sizes = pieces.groupBy("slice", "length").agg(F.count("*").alias("n"))
    before = (Window.partitionBy("length").orderBy("slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = stage(sizes.select("slice", "length", "n",
                                 F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                    "ranks")
    counts = {r["length"]: r["n"] for r in
              offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = (pieces.join(offsets.drop("n"), ["slice", "length"])
              .withColumn("rank", F.col("place") + F.col("before"))
              .drop("slice", "place", "before"))
    kept = ranked.drop("rank")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema),
                        "sequence_id long", "offset long"])
    return (ranked.mapInArrow(_placer(best_fit_runs(counts, capacity)), schema)
            .withColumn("doc_id", own_id()))
