"""Shared helpers: table access, sizes, and word and hash arrays over Arrow text columns.

Text columns are worked on as one byte array per small group of rows, so that a task's
arrays stay a few times `GROUP_BYTES`, whatever the size of its partition. A single longer
text forms a group of its own.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUP_BYTES = 1 << 20
U64 = np.uint64
#: Stands for a missing doc_id: it sorts before every other one.
NO_ID = -(1 << 63)
#: Written bytes up to which a table is sent to every task; a larger one is shuffled.
SENT_BYTES = 8 << 20
_SENT: list[tempfile.TemporaryDirectory] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(df: DataFrame) -> None:
    """Send this library to the executors' Python, once for each application, so that tasks can
    import it wherever they run."""
    context, package = df.sparkSession.sparkContext, Path(__file__).parents[1]
    name = f"{package.name}-{context.applicationId}.zip"
    if any(known.endswith(name) for known in context._python_includes) or not package.is_dir():
        return
    _SENT.append(tempfile.TemporaryDirectory())  # Spark serves it until the driver ends
    packed = Path(_SENT[-1].name) / name
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(packed))


def doc_key(column: str = "doc_id"):
    """doc_id as a long in which a missing one counts as the smallest."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def own_id(column: str = "doc_id"):
    """The opposite of `doc_key`."""
    return F.when(F.col(column) != NO_ID, F.col(column))


def whole_text(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored_size(df: DataFrame, unknown: int = 64 << 20) -> int:
    """Bytes of the files below `df` as the optimizer knows them; `unknown` for tables
    made in memory, whose size it does not know."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else unknown


def bucket_count(df: DataFrame, bytes_each: int) -> int:
    """Buckets for a shuffle of the texts of `df`: they follow its size, and are never fewer
    than the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-stored_size(df) // bytes_each))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts, by one scan of their lengths."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def sent_if_small(df: DataFrame, written: int) -> DataFrame:
    """`df`, marked for a broadcast if it was written in at most `SENT_BYTES`."""
    return F.broadcast(df) if written <= SENT_BYTES else df


def keyed(docs: DataFrame) -> DataFrame:
    """Whole rows as `row`, with `doc` and a hash of the text: a key to join by."""
    return docs.select(F.struct("*").alias("row"), doc_key().alias("doc"),
                       F.xxhash64(whole_text()).alias("text_id"))


def named(column: str):
    """A column by its whole name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def without(docs: DataFrame, names) -> DataFrame:
    """`docs` without the columns of these names, which are compared without their case."""
    taken = {n.lower() for n in names}
    kept = [c for c in docs.columns if c.lower() not in taken]
    if len(kept) == len(docs.columns):
        return docs
    return docs.select(*[named(c) for c in kept])


def extended(docs: DataFrame, **added: str) -> tuple[DataFrame, T.StructType]:
    """`docs` without columns that the result replaces, and the schema of the result."""
    docs = without(docs, added)
    return docs, T.StructType([*docs.schema.fields,
                               *(T.StructField(name, T._parse_datatype_string(kind))
                                 for name, kind in added.items())])


# --- Arrow ---------------------------------------------------------------------------------

def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column(batch, name).to_numpy(zero_copy_only=False)


def byte_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and the offsets of its rows; null is empty."""
    kind = pa.large_binary()
    if texts.null_count:
        texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) else b"")
    texts = texts.cast(kind)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive rows that hold about `limit` bytes together."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def with_columns(batch: pa.RecordBatch, **added: pa.Array) -> pa.RecordBatch:
    """The fields of `row`, and further columns."""
    row = column(batch, "row")
    return pa.RecordBatch.from_arrays([*row.flatten(), *added.values()],
                                      [*(f.name for f in row.type), *added])


def row_slices(batches: Iterable[pa.RecordBatch], limit: int = GROUP_BYTES
               ) -> Iterator[pa.RecordBatch]:
    """Rows of about `limit` bytes of text together, so that what a task makes of them, and sends
    at once, does not follow the number of rows that Spark puts into a batch."""
    for batch in batches:
        if not batch.num_rows:
            yield batch
        sizes = pc.fill_null(pc.binary_length(row_texts(batch)), 0).to_numpy(zero_copy_only=False)
        for first, last in groups(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), limit):
            yield batch.slice(first, last - first)


def released(work: Callable) -> Callable:
    """`work` on the batches of a task, after which the worker gives back the memory it has
    freed: it stays for other tasks, and beside others."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(AttributeError, OSError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)
    return run


def row_texts(batch: pa.RecordBatch) -> pa.Array:
    row = column(batch, "row")
    return pc.fill_null(row.flatten()[row.type.get_field_index("text")], "")


# --- hashes --------------------------------------------------------------------------------

class Base:
    """Polynomial hashes modulo 2**64 with a random odd base and random byte values."""

    def __init__(self, seed: int):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.base = int(draw.integers(1 << 62, dtype=np.int64)) * 2 + 1
        self.letters = draw.integers(1 << 64, size=256, dtype=U64) | U64(1)
        self.words = self.letters.copy()
        self.words[[9, 10, 11, 12, 13, 32]] = 0
        self.up = self.down = np.ones(1, U64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """base**i and base**-i for i < n."""
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            up, down = (np.full(size, b % (1 << 64), U64) for b in
                        (self.base, pow(self.base, -1, 1 << 64)))
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]

    def runs(self, values: np.ndarray, length: int) -> np.ndarray:
        """Hash of values[i:i + length] for every i at which that fits."""
        n = len(values)
        if n < length:
            return np.zeros(0, U64)
        up, down = self.powers(n)
        sums = np.zeros(n + 1, U64)
        np.cumsum(values * up, out=sums[1:])
        return (sums[length:] - sums[:n + 1 - length]) * down[:n + 1 - length]

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for every pair."""
        up, down = self.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[:-1], out=sums[1:])
        return (sums[ends] - sums[starts]) * down[starts]


FIRST, SECOND = Base(20240611), Base(77003)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all others; one to one."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for every i at which that fits."""
    done, best = 1, x
    while done < width:
        step = min(done, width - done)
        best = np.minimum(best[:len(best) - step], best[step:])
        done += step
    return best


# --- words ---------------------------------------------------------------------------------

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Words:
    """Words of some rows: byte positions, row of each word, and first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def hashes(self, data: np.ndarray, base: Base) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, U64)
        up, down = base.powers(len(data))
        return mix(np.add.reduceat(base.words[data] * up, self.starts) * down[self.starts])

    def whole(self, length: int) -> np.ndarray:
        """Whether `length` words from here are in one row; for every place they fit."""
        n = len(self.row) + 1 - length
        return self.row[:n] == self.row[length - 1:] if n > 0 else np.zeros(0, bool)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Maximal runs of bytes other than space and the five control gaps, per row."""
    solid = ~_GAP[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    start[edges] = solid[edges]
    end[edges - 1] = solid[edges - 1]
    starts = np.flatnonzero(start)
    row = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(row, np.arange(len(offsets)))
    return Words(starts, np.flatnonzero(end) + 1, row, first)


def minimiser_runs(grams: np.ndarray, whole: np.ndarray, row: np.ndarray, width: int
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows whose least gram is the same one.

    A window holds `width` grams; `whole` tells which windows lie in one row and `row` which
    one. Returns the first and the last window of each run and the least gram's hash.
    """
    least = sliding_min(grams, width)[:len(whole)]
    cut = np.ones(len(whole), bool)
    cut[1:] = ((least[1:] != least[:-1]) | (grams[:len(whole) - 1] == least[:-1])
               | (row[1:len(whole)] != row[:len(whole) - 1]) | ~whole[:-1])
    begin = np.flatnonzero(cut & whole)
    close = np.ones(len(whole), bool)
    close[:-1] = cut[1:] | ~whole[1:]
    return begin, np.flatnonzero(close & whole), least[begin]


def merged_spans(doc, text_id, first, last):
    """Spans joined where they touch; sorted by document, text and place."""
    order = np.lexsort((first, text_id, doc))
    doc, text_id, first, last = (x[order] for x in (doc, text_id, first, last))
    if not len(doc):
        return doc, text_id, first, last
    new = np.ones(len(doc), bool)
    same = (doc[1:] == doc[:-1]) & (text_id[1:] == text_id[:-1])
    # In order of start, the furthest end so far decides.
    reach = last.copy()
    group = np.concatenate([[0], np.cumsum(~same)])
    lift = group * (int(last.max()) + 1)
    reach = np.maximum.accumulate(reach + lift) - lift
    new[1:] = ~same | (first[1:] > reach[:-1])
    begin = np.flatnonzero(new)
    close = np.append(begin[1:], len(doc)) - 1
    return doc[begin], text_id[begin], first[begin], reach[close]
