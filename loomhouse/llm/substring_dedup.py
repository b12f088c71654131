"""Repeated passages of words, by super-k-mers.

Each window of `WINDOW` words belongs to its minimiser, the least-hashing run of `GRAM`
words in it. Consecutive windows with one minimiser travel as one packed string to the
bucket of that minimiser, so equal windows meet there; sorting a bucket's windows shows
which of them also start in a document with a smaller doc_id. Windows are compared by two
independent 64-bit hashes of their words.

A minimiser found very often (a common phrase) would make one huge bucket. Misra-Gries
summaries name those; their windows travel one by one to the bucket of the whole window.
The summaries can miss a minimiser whose share of a very large corpus is small and whose bucket
is too large all the same, so no bucket is held whole: a task reads its buckets as a stream, and
of one that goes beyond `MOST_BYTES` it passes the windows on, one by one, to be grouped by
what they hold. Each bucket is a task of its own.
Strings of `HELD_BYTES` of text are packed together, so that those for one bucket compress well.
Equal strings among them travel once, for the smallest doc_id; the others are
settled where they are read. So a passage with very many copies is small in its bucket.

The texts with spans are shuffled to meet them; a bitmap of hashes of their keys, of at most
8 MiB, tells the others apart where they are read.

Rows: a missing text has no words; a missing doc_id counts as smaller than every other;
rows with one doc_id are one document, and do not repeat each other. Texts shorter than a
window stay whole. An empty table gives an empty result. Other columns are carried along;
any named `n_words`, `n_removed` or `kept_text`, in any case, are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import (FIRST, GROUP_BYTES, SECOND, byte_rows, column, extended, groups, keyed,
                     merged_spans, minimiser_runs, mix, numbers, released, row_slices, row_texts,
                     ship, text_bytes, with_columns, words)
from .heavy import COUNTERS, frequent

WINDOW = 13
GRAM = 4
#: The windows of a minimiser with so many runs travel one by one from the start.
OFTEN = 200_000
#: Bytes of text for each bucket, and of strings that a task holds of one, at most.
BUCKET_BYTES, MOST_BYTES = 8 << 20, 40 << 20
#: Bytes of text whose strings are packed together, and of text or strings hashed at once.
HELD_BYTES, HASHED_BYTES = 4 << 20, GROUP_BYTES // 4
#: Bits of one row of a bitmap, as Spark makes them, and rows of the bitmap at most.
_ROW_BITS, _MOST_ROWS = 1 << 15, 1 << 11

#: Strings packed for a bucket, `size` bytes when unpacked; settled spans have no strings.
_BLOCK = "bucket int, place binary, size long, data binary"
#: Spans, and windows that are not settled yet, which carry their two hashes.
_FOUND = "doc long, text_id long, first long, last long, a long, b long"


class _Group:
    """Word hashes and windows of a few rows of text."""

    def __init__(self, data, offsets, window, gram):
        self.data, self.window = data, window
        self.words = words(data, offsets)
        self.hash = self.words.hashes(data, FIRST)
        self.whole = self.words.whole(window)
        self.gram = gram

    def runs(self):
        grams = mix(FIRST.runs(self.hash, self.gram))
        return minimiser_runs(grams, self.whole, self.words.row, self.window - self.gram + 1)

    def digests(self):
        """Both hashes of every window (of those within one row only they count)."""
        second = self.words.hashes(self.data, SECOND)
        return (mix(FIRST.runs(self.hash, self.window)),
                mix(SECOND.runs(second, self.window)))


def _groups_of(texts, window, gram, limit=HASHED_BYTES):
    data, offsets = byte_rows(texts)
    for first, last in groups(offsets, limit):
        part = data[offsets[first]:offsets[last]]
        yield first, last, _Group(part, offsets[first:last + 1] - offsets[first], window, gram)


def _minimisers(window, gram):
    def values(batch):
        for _, _, group in _groups_of(column(batch, "text"), window, gram):
            yield group.runs()[2]
    return values


_ZSTD = pa.Codec("zstd", compression_level=3)


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers compressed, each byte of theirs apart: small ones take little."""
    planes = np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8).T
    return _ZSTD.compress(planes.tobytes(), asbytes=True)


def _numbers(packed: bytes, n: int) -> np.ndarray:
    """The opposite of `_planes`."""
    planes = np.frombuffer(_ZSTD.decompress(packed, 8 * n, asbytes=True), np.uint8)
    return planes.reshape(8, n).T.copy().view(np.int64).ravel()


def _places(doc, text_id, place, size) -> bytes:
    """Document, text and place of the strings of a block, and their sizes. A text's strings
    follow each other, so it is named once."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text_id[1:] != text_id[:-1])
    first = np.flatnonzero(new)
    parts = [text_id[first].tobytes(), *map(_planes, (
        np.diff(doc[first], prepend=0), np.diff(first, append=len(doc)), place, size))]
    return np.array([len(first), len(doc), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def _unpacked_places(packed: bytes):
    """The opposite of `_places`."""
    texts, n, *lengths = np.frombuffer(packed, np.int64, 7).tolist()
    ends = np.cumsum([56, *lengths]).tolist()
    text_id, doc, counts, place, size = (packed[a:b] for a, b in zip(ends, ends[1:]))
    counts = _numbers(counts, texts)
    return (np.repeat(np.cumsum(_numbers(doc, texts)), counts),
            np.repeat(np.frombuffer(text_id, np.int64), counts),
            _numbers(place, n), _numbers(size, n))


def _blocks(doc, text_id, place, first_byte, last_byte, raw, bucket, settled, buckets):
    """One row for each bucket that gets strings, and one with the settled spans."""
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    ends = np.append(edges[1:], len(order))
    out = {name: [] for name in ("bucket", "place", "size", "data")}
    for begin, end in zip(edges.tolist(), ends.tolist()):
        take = order[begin:end]
        first, last = first_byte[take], last_byte[take]
        packed = b"".join([raw[a:b] for a, b in zip(first.tolist(), last.tolist())])
        out["bucket"].append(int(bucket[take[0]]))
        out["place"].append(_places(doc[take], text_id[take], place[take], last - first))
        out["size"].append(len(packed))
        out["data"].append(_ZSTD.compress(packed, asbytes=True))
    if len(settled[0]):
        # Any bucket passes these on; the document spreads them.
        out["bucket"].append(int(settled[0][0] % buckets))
        out["place"].append(np.stack(settled).tobytes())
        out["size"].append(0)
        out["data"].append(None)
    return pa.RecordBatch.from_pydict(
        out, pa.schema([("bucket", pa.int32()), ("place", pa.binary()), ("size", pa.int64()),
                        ("data", pa.binary())]))


def _packer(window, gram, often, buckets, held_bytes=HELD_BYTES):
    often = np.sort(np.array(often, np.int64).view(np.uint64))

    def strings(ids, text_ids, group):
        """Document, text, place, words, both hashes, first and last byte and key of the strings of
        a group."""
        begin, close, least = group.runs()
        w, key = group.words, least
        hot = np.isin(least, often)
        if hot.any():
            # Windows of a common minimiser travel alone, by what they hold.
            count = (close - begin + 1)[hot]
            single = np.repeat(begin[hot] - np.cumsum(count) + count, count)
            single = single + np.arange(len(single))
            own = mix(FIRST.runs(group.hash, window))[single]
            begin = np.concatenate([begin[~hot], single])
            close = np.concatenate([close[~hot], single])
            key = np.concatenate([least[~hot], own])
        row = w.row[begin]
        a, b = (base.spans(x, begin, close + window) for base, x in
                ((FIRST, group.hash), (SECOND, w.hashes(group.data, SECOND))))
        return (ids[row], text_ids[row], begin - w.first[row], close - begin + window, a, b,
                w.starts[begin], w.ends[close + window - 1],
                (mix(key) % np.uint64(buckets)).astype(np.int64))

    def packed(held):
        """The blocks of the strings of some groups."""
        parts, texts = zip(*held)
        doc, text_id, place, span, a, b, first_byte, last_byte, bucket = (
            np.concatenate(x) for x in zip(*parts))
        # Bytes are counted on over all groups.
        before = np.repeat(np.cumsum([0, *map(len, texts[:-1])]), [len(x[0]) for x in parts])
        order = np.lexsort((doc, b, a))
        a, b = a[order], b[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        leader = doc[order][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        # Same string in a document with a larger id than another one here: settled.
        done = order[doc[order] > leader]
        go = np.ones(len(order), bool)
        go[done] = False
        settled = merged_spans(doc[done], text_id[done], place[done], (place + span)[done])
        return _blocks(doc[go], text_id[go], place[go], (first_byte + before)[go],
                       (last_byte + before)[go], b"".join(texts), bucket[go], settled, buckets)

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            ids, text_ids = numbers(batch, "doc"), numbers(batch, "text_id")
            for low, high, group in _groups_of(column(batch, "text"), window, gram):
                found = strings(ids[low:high], text_ids[low:high], group)
                if not len(found[0]):
                    continue
                held.append((found, group.data.tobytes()))
                size += len(group.data)
                if size >= held_bytes:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)
    return pack


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Each column of the parts in one array, made one by one, as a bucket's windows take some
    memory. The parts are used up."""
    columns = []
    while parts[0]:
        columns.append(np.concatenate([part.pop() for part in parts]))
    return columns[::-1]


def _windows(blocks, window, gram):
    """Document, text and place of every string of some blocks, and of every window its hashes,
    its string and its place there."""
    strings, windows, before = [], [], 0
    for block in blocks:
        *about, size = _unpacked_places(block["place"].as_py())
        packed = _ZSTD.decompress(block["data"].as_buffer(), block["size"], asbytes=True)
        data = np.frombuffer(packed, np.uint8)
        offsets = np.concatenate([[0], np.cumsum(size)])
        for first, last in groups(offsets, HASHED_BYTES):
            group = _Group(data[offsets[first]:offsets[last]],
                           offsets[first:last + 1] - offsets[first], window, gram)
            at = np.flatnonzero(group.whole)
            row = group.words.row[at]
            a, b = group.digests()
            windows.append([a[at], b[at], (row + (before + first)).astype(np.int32),
                            (at - group.words.first[row]).astype(np.int32)])
        strings.append(about)
        before += len(size)
    return _joined(strings), _joined(windows)


def _later(doc, a, b, string):
    """The windows in order of their hashes and then of their documents, and of each one in that
    order whether it also starts in an earlier document."""
    # Documents by their rank take half the memory.
    rank = np.unique(doc, return_inverse=True)[1].astype(np.int32)[string]
    order = np.lexsort((rank, b, a))
    new = np.ones(len(order), bool)
    for hashes in (a, b):
        hashes = hashes[order]
        new[1:] &= hashes[1:] == hashes[:-1]
    new[1:] = ~new[1:]
    rank = rank[order]
    least = np.repeat(rank[new], np.diff(np.append(np.flatnonzero(new), len(new))))
    return order, rank > least


def _spans(doc, text_id, first, last):
    doc, text_id, first, last = merged_spans(doc, text_id, first, last)
    none = pa.nulls(len(doc), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(text_id), pa.array(first), pa.array(last), none, none],
        ["doc", "text_id", "first", "last", "a", "b"])


def _sorter(window, gram, most):
    """Spans of the windows of each bucket that also start in an earlier document.

    Rows come sorted by bucket. Of a bucket with more than `most` bytes of strings each part is
    looked at alone: its windows are passed on for the least document of the part that has them.
    """
    def settled(blocks, whole):
        (doc, text_id, place), (a, b, string, within) = _windows(blocks, window, gram)
        order, late = _later(doc, a, b, string)

        def where(at):
            """Document, text and first and last word of some windows."""
            row = string[at]
            first = place[row] + within[at]
            return doc[row], text_id[row], first, first + window

        yield _spans(*where(order[late]))
        if not whole:
            rest = order[~late]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (*where(rest), a[rest].view(np.int64),
                                       b[rest].view(np.int64))],
                ["doc", "text_id", "first", "last", "a", "b"])

    def sort(batches):
        bucket, held, size, whole = None, [], 0, True
        for batch in batches:
            for row in range(batch.num_rows):
                block = {n: c[row] for n, c in zip(batch.schema.names, batch.columns)}
                block |= {n: block[n].as_py() for n in ("bucket", "size")}
                if not block["data"].is_valid:
                    yield _spans(*np.frombuffer(block["place"].as_py(), np.int64).reshape(4, -1))
                    continue
                if block["bucket"] != bucket:
                    if held:
                        yield from settled(held, whole)
                    bucket, held, size, whole = block["bucket"], [], 0, True
                if held and size + block["size"] > most:
                    whole = False
                    yield from settled(held, whole)
                    held, size = [], 0
                held.append(block)
                size += block["size"]
        if held:
            yield from settled(held, whole)
    return sort


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, often: int = OFTEN,
                   bucket_bytes: int = BUCKET_BYTES, counters: int = COUNTERS,
                   most_bytes: int = MOST_BYTES, held_bytes: int = HELD_BYTES) -> DataFrame:
    """(doc, text_id, first, last): word positions [first, last) of `docs` (doc, text_id, text)
    that lie in a window also found in a document with a smaller doc."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-text_bytes(docs) // bucket_bytes))
    hot = [r[0] for r in frequent(docs.select("text"), _minimisers(window, gram), often,
                                  counters).select("value").collect()]
    packed = docs.mapInArrow(released(_packer(window, gram, hot, buckets, held_bytes)), _BLOCK)
    found = stage(packed.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
                  .mapInArrow(released(_sorter(window, gram, most_bytes)), _FOUND), "passages")
    loose = found.filter(F.col("a").isNotNull())
    held = (loose.groupBy("a", "b").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
            .filter("most > least").select("a", "b", "least"))
    late = loose.join(held, ["a", "b"]).filter("doc > least")
    spans = found.filter(F.col("a").isNull()).unionByName(late.drop("least"))
    return spans.select("doc", "text_id", "first", "last")


def _marked(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """`rows` with `held`: true for every row whose key has spans, and for few others.

    The keys of `spans` are set in a bitmap by their hashes, 16 bits for each key or, where that
    would be too many, as many as go into 8 MiB.
    """
    map_rows = min(_MOST_ROWS, 1 + 16 * spans.count() // _ROW_BITS)
    bit = F.pmod(F.xxhash64("doc", "text_id"), F.lit(map_rows * _ROW_BITS)) + 1
    bitmap = spans.groupBy(F.bitmap_bucket_number(bit).alias("map_row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    place = F.bitmap_bit_position(bit).cast("int")
    byte = F.conv(F.hex(F.col("bits").substr(F.floor(place / 8).cast("int") + 1, F.lit(1))),
                  16, 10).cast("int")
    held = F.getbit(byte, place % 8) == 1
    return (rows.withColumn("map_row", F.bitmap_bucket_number(bit))
            .join(F.broadcast(bitmap), "map_row", "left")
            .select(*rows.columns, F.coalesce(held, F.lit(False)).alias("held")))


def _cutter(batches):
    for batch in row_slices(batches):
        n_words, n_removed, kept = [], [], []
        for text, found in zip(row_texts(batch).to_pylist(), column(batch, "spans").to_pylist()):
            parts = text.encode().split()
            left = parts
            if found:
                stays = np.ones(len(parts), bool)
                for span in found:
                    stays[span["first"]:span["last"]] = False
                left = [parts[i] for i in np.flatnonzero(stays).tolist()]
            n_words.append(len(parts))
            n_removed.append(len(parts) - len(left))
            kept.append(b" ".join(left).decode())
        yield with_columns(batch, n_words=pa.array(n_words, pa.int64()),
                           n_removed=pa.array(n_removed, pa.int64()),
                           kept_text=pa.array(kept, pa.string()))


def drop_repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                           often: int = OFTEN, bucket_bytes: int = BUCKET_BYTES,
                           counters: int = COUNTERS, most_bytes: int = MOST_BYTES,
                           held_bytes: int = HELD_BYTES) -> DataFrame:
    """`docs` with `n_words`, `n_removed` and `kept_text`: the words outside of passages that
    also start in an earlier document, joined by one space."""
    docs, schema = extended(docs, n_words="long", n_removed="long", kept_text="string")
    ship(docs)
    rows = keyed(docs)
    texts = rows.select("doc", "text_id", F.col("row.text").alias("text"))
    spans = stage(
        repeated_spans(texts, window, gram, often, bucket_bytes, counters, most_bytes, held_bytes)
        .groupBy("doc", "text_id")
        .agg(F.collect_list(F.struct("first", "last")).alias("spans")), "spans")
    marked = _marked(rows, spans)
    joined = marked.filter("held").join(spans, ["doc", "text_id"], "left").select("row", "spans")
    others = marked.filter("NOT held").select(
        "row", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    joined = joined.unionByName(others)
    return joined.mapInArrow(released(_cutter), schema)
