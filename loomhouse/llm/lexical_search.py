"""Ranked lexical search in reverse: the items are indexed, the documents stream past them.

An inverted index over the terms of a block of items is broadcast; each task runs the term
counts of its documents through it and keeps one bounded heap per item; the heaps of all tasks
are merged in two rounds, so that no task sees more than a few thousand of them for an item.

Terms are maximal runs of ASCII digits and letters and of all characters beyond ASCII, only A-Z
lower-cased. With N documents that have a term, L their terms in all, n those of a document,
df the documents with a term and tf its occurrences in a document,

    weight = floor(1000 ln((2N + 2) / (2 df + 1)))
    m      = 100 - 75 + (75 n N) div L
    score  = sum over the item's terms, repeats included, of
             weight ((10**9 tf) div (1000 tf + 8 m))

Items are dealt into blocks of bounded size, at random and one broadcast each: what is broadcast
and collected does not grow with the table of items, of which there may be any number. The
documents are split into terms once for each block.

Rows: each row of documents is a document of its own and each row of items an item of its own,
also where ids are missing or repeat. Missing texts have no terms; an item without terms, or
whose terms no document has, gives no rows, neither does an empty table. Equal scores are in the
order of doc_id, a missing one first, then of the text's hash. Only ids and texts are read, so
further columns cannot clash.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import column, doc_key, numbers, own_id, ship

#: Hits of each item.
TOP = 10
#: Bytes of text, and items, of a block: what a broadcast index is made of.
BLOCK_BYTES = 8 << 20
BLOCK_ITEMS = 1 << 12
#: Scores, one for each document and item, and postings that a task holds at a time, or those
#: of one document.
CELLS = 1 << 20
#: Tasks whose heaps are merged first.
MERGED = 256

_TERM_BYTES = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _TERM_BYTES[_low:_high + 1] = True
#: What is no part of a term becomes a space, A-Z lower case; the bytes of a character beyond
#: ASCII are all from 0x80 on.
_FOLD = bytes(ord(chr(b).lower()) if b < 0x80 and _TERM_BYTES[b] else b if _TERM_BYTES[b] else 0x20
              for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class ItemIndex:
    """Postings of a block of items: for each term the items that have it, and how often."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.keys = np.array([key for key, _ in items], np.int64)
        self.places: dict[bytes, int] = {}
        rows: list[list[tuple[int, int]]] = []
        for item, (_, text) in enumerate(items):
            for term, n in Counter(terms(text)).items():
                place = self.places.setdefault(term, len(rows))
                if place == len(rows):
                    rows.append([])
                rows[place].append((item, n))
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.item, self.repeats = (np.array([x[k] for r in rows for x in r], np.int64)
                                   for k in (0, 1))
        self.weights = np.zeros(len(rows), np.int64)

    def count(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray,
                                                        np.ndarray]:
        """Terms of each text; row, place and occurrences of the terms that are indexed."""
        known, sizes, found, row = self.places, [], [], []
        for text in texts:
            words = terms(text or b"")
            sizes.append(len(words))
            hits = [known[w] for w in words if w in known]
            found.append(np.array(hits, np.int64))
            row.append(len(hits))
        place = np.concatenate(found) if found else np.zeros(0, np.int64)
        span = max(1, len(self.sizes))
        both, tf = np.unique(np.repeat(np.arange(len(row)), row) * span + place,
                             return_counts=True)
        return np.array(sizes, np.int64), both // span, both % span, tf.astype(np.int64)

    def scores(self, m: np.ndarray, row: np.ndarray, place: np.ndarray, tf: np.ndarray
               ) -> np.ndarray:
        """Scores of some documents (rows) for every item; rows ascend."""
        gain = self.weights[place] * ((10**9 * tf) // (1000 * tf + 8 * m[row]))
        size = self.sizes[place]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - self.first[place], size)
        out = np.zeros((len(m), len(self.keys)), np.int64)
        np.add.at(out.reshape(-1), np.repeat(row * len(self.keys), size) + self.item[at],
                  np.repeat(gain, size) * self.repeats[at])
        return out


class Heaps:
    """The `top` best (score, then least document) of each item seen so far."""

    def __init__(self, items: int, top: int):
        self.top, self.heaps = top, [[] for _ in range(items)]
        # What a document must beat to get in: the worst entry of a full heap.
        self.score = np.zeros(items, np.int64)
        self.doc = np.full(items, np.iinfo(np.int64).min)
        self.tie = self.doc.copy()

    def offer(self, scores: np.ndarray, doc: np.ndarray, tie: np.ndarray) -> None:
        doc_, tie_ = doc[:, None], tie[:, None]
        better = (scores > self.score) | ((scores == self.score) & (
            (doc_ < self.doc) | ((doc_ == self.doc) & (tie_ < self.tie))))
        rows, items = np.nonzero(better)
        for row, item in zip(rows.tolist(), items.tolist()):
            entry = (int(scores[row, item]), ~int(doc[row]), ~int(tie[row]))
            heap = self.heaps[item]
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                continue
            if len(heap) == self.top:
                self.score[item], self.doc[item], self.tie[item] = (
                    heap[0][0], ~heap[0][1], ~heap[0][2])

    def table(self, keys: np.ndarray, task: int) -> pa.RecordBatch:
        rows = [(int(key), *entry) for key, heap in zip(keys, self.heaps) for entry in heap]
        key, score, doc, tie = (np.array([r[k] for r in rows], np.int64) for k in range(4))
        return pa.RecordBatch.from_pydict({"task": pa.array([task] * len(rows), pa.int32()),
                                           "item": key, "score": score, "doc": ~doc, "tie": ~tie})


_COUNTS = "doc long, tie long, n long, places array<int>, tfs array<int>"
_HITS = "task int, item long, score long, doc long, tie long"


def _lists(row: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    offsets = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))


def _count(index):
    def count(batches):
        for batch in batches:
            n, row, place, tf = index.value.count(column(batch, "text").to_pylist())
            yield pa.RecordBatch.from_pydict(
                {"doc": column(batch, "doc"), "tie": column(batch, "tie"), "n": n,
                 "places": _lists(row, place, len(n)), "tfs": _lists(row, tf, len(n))})
    return count


def _search(index, n_docs: int, n_terms: int, top: int):
    def search(batches):
        items = index.value
        heaps, step = Heaps(len(items.keys), top), max(1, CELLS // len(items.keys))
        for batch in batches:
            n, doc, tie = (numbers(batch, c).astype(np.int64) for c in ("n", "doc", "tie"))
            lists = column(batch, "places")
            size = np.diff(lists.offsets.to_numpy())
            place, tf = (column(batch, c).flatten().to_numpy().astype(np.int64)
                         for c in ("places", "tfs"))
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            row = np.repeat(np.arange(len(n)), size)
            first = np.concatenate([[0], np.cumsum(size)])
            postings = np.concatenate([[0], np.cumsum(items.sizes[place])])[first]
            low = 0
            while low < len(n):
                high = int(np.searchsorted(postings, postings[low] + CELLS, "right")) - 1
                high = min(max(high, low + 1), low + step, len(n))
                a, b = first[low], first[high]
                heaps.offer(items.scores(m[low:high], row[a:b] - low, place[a:b], tf[a:b]),
                            doc[low:high], tie[low:high])
                low = high
        yield heaps.table(items.keys, TaskContext.get().partitionId())
    return search


def _best(hits: DataFrame, top: int, *within) -> DataFrame:
    best = (Window.partitionBy("item", *within)
            .orderBy(F.desc("score"), "doc", "tie"))
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def _blocks(items: DataFrame, block_bytes: int, block_items: int) -> Iterator[list]:
    """Items by blocks as (key, text); a block is all the driver holds."""
    size = items.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-size[0] // block_items), -(-(size[1] or 0) // block_bytes))
    if not size[0]:
        return
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block)
        found = [(r["key"], bytes(r["text"])) for r in rows.collect()]
        if found:
            yield found


def _search_block(docs: DataFrame, block: list, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    index = ItemIndex(block)
    sent = spark.sparkContext.broadcast(index)
    counts = stage(docs.mapInArrow(_count(sent), _COUNTS), "term_counts")
    all_docs = counts.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not all_docs[0] or not len(index.sizes):
        return None
    # At most one row for each indexed term.
    df = (counts.select(F.explode("places").alias("place")).groupBy("place").count().collect())
    held = np.zeros(len(index.sizes), np.int64)
    for r in df:
        held[r["place"]] = r["count"]
    index.weights[:] = [math.floor(1000 * math.log((2 * all_docs[0] + 2) / (2 * n + 1)))
                        for n in held.tolist()]
    weighted = spark.sparkContext.broadcast(index)
    hits = counts.filter(F.size("places") > 0).mapInArrow(
        _search(weighted, all_docs[0], all_docs[1], top), _HITS)
    few = _best(hits, top, F.floor(F.col("task") / MERGED)).drop("rank")
    ranked = stage(_best(few, top).select("item", "rank", "doc", "score"), "ranked")
    for done in (sent, weighted):
        done.unpersist()
    return ranked


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP, item_id: str = "item_id",
                     block_bytes: int = BLOCK_BYTES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with a score above 0."""
    ship(docs)
    text = F.col("text").cast("string").cast("binary").alias("text")
    # Rows get a key of their own, fixed by writing them.
    keyed = stage(items.select(F.monotonically_increasing_id().alias("key"),
                               F.col(item_id).alias("item_id"),
                               F.coalesce(text, F.lit(b"")).alias("text")), "items")
    rows = docs.select(doc_key().alias("doc"), F.xxhash64("text").alias("tie"), text)
    found = [_search_block(rows, block, top) for block in
             _blocks(keyed.select("key", "text"), block_bytes, block_items)]
    ranked = keyed.sparkSession.createDataFrame([], "item long, rank int, doc long, score long")
    for part in found:
        ranked = ranked if part is None else ranked.unionByName(part)
    return (ranked.join(keyed.select("key", "item_id"), F.col("item") == F.col("key"))
            .select("item_id", "rank", own_id("doc").alias("doc_id"), "score"))
