"""Repeated strings of 100 bytes within and across documents, by suffix arrays of shards.

A string of `LENGTH` bytes belongs to its anchor, the least-hashing `GRAM` bytes in it;
consecutive strings with one anchor form a run. Three steps leave little to sort:

1. Runs go to buckets by their anchor as hashes, without their bytes. Equal runs are
   settled there (all but the earliest repeat it), and an anchor with one run is unique.
2. The bytes of what remains, the earliest of each run under an anchor with several
   different ones, go to shards by anchor.
3. Each shard gets a suffix array by induced sorting and its permuted common prefixes:
   neighbours that share `LENGTH` bytes are equal strings, and all but the earliest repeat it.

Equal strings have equal anchors, so they meet. Anchors found very often are named by
Misra-Gries summaries; their strings travel one by one, by a hash of all their bytes, and
are settled in step 1.

Order: by doc_id, then by place. Rows: a missing text is empty; a missing doc_id counts as
smaller than every other; rows repeated under one doc_id are one document. Texts shorter
than the length stay whole. An empty table gives an empty result. Other columns are carried
along; any named `n_bytes`, `n_removed`, `n_spans` or `kept`, in any case, are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import (FIRST, bucket_count, byte_rows, column, extended, groups, keyed, merged_spans,
                     minimiser_runs, mix, numbers, row_texts, ship,
                     with_columns)
from .heavy import COUNTERS, frequent
from .suffix_array import common_prefixes, suffix_order

LENGTH = 100
GRAM = 32
#: Stored bytes of text for each bucket of step 1, and bytes of strings for each shard, whose
#: suffix array takes about 30 times as many.
BUCKET_BYTES = 16 << 20
SHARD_BYTES = 6 << 20
#: An anchor with so many runs, as many as fill a shard, gets no bucket of its own.
OFTEN = SHARD_BYTES // (LENGTH + GRAM)
#: Ends a string in a shard: no byte of UTF-8.
END = 255

_RUN = np.dtype([("anchor", "<u8"), ("value", "<u8"), ("doc", "<i8"), ("text_id", "<i8"),
                 ("first", "<i8"), ("size", "<i8")])
_FOUND = "doc long, text_id long, first long, last long, anchor long"


def _runs(data, offsets, length, gram):
    """Row, first place, size, anchor and hash of the runs of a few rows."""
    letters = FIRST.letters[data]
    n = len(data) + 1 - length
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), letters, row
    whole = row[:n] == row[length - 1:]
    begin, close, least = minimiser_runs(mix(FIRST.runs(letters, gram)), whole, row,
                                         length - gram + 1)
    return begin, close, row[begin], least, letters, row


def _anchors(length, gram):
    def values(batch):
        data, offsets = byte_rows(column(batch, "text"))
        for first, last in groups(offsets):
            yield _runs(data[offsets[first]:offsets[last]],
                        offsets[first:last + 1] - offsets[first], length, gram)[3]
    return values


def _packed(runs: np.ndarray) -> bytes:
    # Field by field: equal and rising numbers side by side compress well.
    raw = b"".join(np.ascontiguousarray(runs[name]).tobytes() for name in _RUN.names)
    return pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    flat = pa.decompress(raw, n * _RUN.itemsize, codec="zstd", asbytes=True)
    runs, at = np.empty(n, _RUN), 0
    for name in _RUN.names:
        runs[name] = np.frombuffer(flat, "<u8", n, at)
        at += 8 * n
    return runs


def _earliest(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs by anchor, value and order of texts, and which are the first with their value."""
    order = np.lexsort((runs["first"], runs["doc"], runs["size"], runs["value"], runs["anchor"]))
    runs = runs[order]
    new = np.ones(len(runs), bool)
    new[1:] = ((runs["anchor"][1:] != runs["anchor"][:-1])
               | (runs["value"][1:] != runs["value"][:-1])
               | (runs["size"][1:] != runs["size"][:-1]))
    return runs, new


def _repeats(runs: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Runs after the first of their value; a row repeated under one doc_id is no repeat."""
    at = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return ((runs["doc"] != runs["doc"][at]) | (runs["first"] != runs["first"][at])) & ~new


def _spans_of(runs: np.ndarray) -> tuple:
    return merged_spans(runs["doc"], runs["text_id"], runs["first"], runs["first"] + runs["size"])


def _packer(length, gram, often, buckets):
    often = np.sort(np.array(often, np.int64).view(np.uint64))

    def pack(batches):
        for batch in batches:
            ids, text_ids = numbers(batch, "doc"), numbers(batch, "text_id")
            data, offsets = byte_rows(column(batch, "text"))
            for low, high in groups(offsets):
                edges = offsets[low:high + 1] - offsets[low]
                begin, close, row, anchor, letters, rows = _runs(
                    data[offsets[low]:offsets[high]], edges, length, gram)
                if not len(begin):
                    continue
                hot = np.isin(anchor, often)
                if hot.any():
                    count = (close - begin + 1)[hot]
                    single = np.repeat(begin[hot] - np.cumsum(count) + count, count)
                    single = single + np.arange(len(single))
                    own = mix(FIRST.spans(letters, single, single + length))
                    begin = np.concatenate([begin[~hot], single])
                    close = np.concatenate([close[~hot], single])
                    anchor = np.concatenate([anchor[~hot], own])
                    row = rows[begin]
                runs = np.empty(len(begin), _RUN)
                runs["anchor"] = anchor
                runs["value"] = FIRST.spans(letters, begin, close + length)
                runs["doc"], runs["text_id"] = ids[low:high][row], text_ids[low:high][row]
                runs["first"], runs["size"] = begin - edges[row], close - begin + length
                runs, new = _earliest(runs)
                again = _repeats(runs, new)
                out = {"bucket": [], "n": [], "runs": []}
                go = runs[~again]
                bucket = (go["anchor"] % np.uint64(buckets)).astype(np.int64)
                by = np.lexsort((go["first"], go["doc"], bucket))
                go, bucket = go[by], bucket[by]
                for part in np.split(np.arange(len(go)), np.flatnonzero(np.diff(bucket)) + 1):
                    out["bucket"].append(int(bucket[part[0]]))
                    out["n"].append(len(part))
                    out["runs"].append(_packed(go[part]))
                doc, text_id, first, last = _spans_of(runs[again])
                if len(doc):
                    done = np.empty(len(doc), _RUN)
                    done["doc"], done["text_id"], done["first"] = doc, text_id, first
                    done["size"] = last - first
                    # Settled: any bucket passes them on.
                    out["bucket"].append(int(doc[0] % buckets))
                    out["n"].append(-len(doc))
                    out["runs"].append(_packed(done))
                yield pa.RecordBatch.from_pydict(
                    out, pa.schema([("bucket", pa.int32()), ("n", pa.int64()),
                                    ("runs", pa.binary())]))
    return pack


def _settle(key, table):
    """Spans known to repeat (no anchor), and runs whose bytes are needed (with anchor)."""
    open_runs, spans = [np.empty(0, _RUN)], [(np.zeros(0, np.int64),) * 4]
    for n, raw in zip(table["n"].to_pylist(), table["runs"].to_pylist()):
        runs = _unpacked(raw, abs(n))
        if n > 0:
            open_runs.append(runs)
        else:
            spans.append((runs["doc"], runs["text_id"], runs["first"],
                          runs["first"] + runs["size"]))
    runs, new = _earliest(np.concatenate(open_runs))
    again = _repeats(runs, new)
    spans.append(_spans_of(runs[again]))
    firsts = runs[new]
    start = np.ones(len(firsts), bool)
    start[1:] = firsts["anchor"][1:] != firsts["anchor"][:-1]
    several = np.bincount(np.cumsum(start) - 1, minlength=1)[np.cumsum(start) - 1] > 1
    asked = firsts[several] if len(firsts) else firsts
    doc, text_id, first, last = merged_spans(*(np.concatenate(x) for x in zip(*spans)))
    columns = [np.concatenate(x) for x in (
        (doc, asked["doc"]), (text_id, asked["text_id"]), (first, asked["first"]),
        (last, asked["first"] + asked["size"]))]
    anchors = [None] * len(doc) + asked["anchor"].view(np.int64).tolist()
    return pa.table([*(pa.array(c, pa.int64()) for c in columns),
                     pa.array(anchors, pa.int64())],
                    ["doc", "text_id", "first", "last", "anchor"])


def _fetcher(shards):
    """The bytes of the runs asked for, a block for each shard."""
    def fetch(batches):
        for batch in batches:
            blocks: dict[int, list] = {}
            for text, doc, text_id, asked in zip(
                    column(batch, "text").to_pylist(), numbers(batch, "doc").tolist(),
                    numbers(batch, "text_id").tolist(), column(batch, "asked").to_pylist()):
                raw = (text or "").encode()
                for run in asked:
                    blocks.setdefault(run["anchor"] % shards, []).append(
                        (doc, text_id, run["first"], raw[run["first"]:run["last"]]))
            out = {"shard": [], "n": [], "place": [], "size": [], "data": []}
            for shard, found in blocks.items():
                packed = b"".join(f[3] + b"\xff" for f in found)
                out["shard"].append(shard)
                out["n"].append(len(found))
                out["place"].append(np.array([f[:3] for f in found], np.int64).T.tobytes())
                out["size"].append(len(packed))
                out["data"].append(pa.compress(packed, codec="zstd", asbytes=True))
            yield pa.RecordBatch.from_pydict(
                out, pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("place", pa.binary()),
                                ("size", pa.int64()), ("data", pa.binary())]))
    return fetch


def _shard_sorter(length):
    def sort(key, table):
        blocks = table.to_pylist()
        text = np.frombuffer(b"".join(
            pa.decompress(b["data"], b["size"], codec="zstd", asbytes=True) for b in blocks),
            np.uint8)
        doc, text_id, first = np.concatenate(
            [np.frombuffer(b["place"], np.int64).reshape(3, -1) for b in blocks], 1)
        del blocks
        order = suffix_order(text, length)
        group = np.cumsum((common_prefixes(text, order) < length)[order], dtype=np.int32)
        # Longer equal stretches than a string may run on into the next one: a string fits
        # where its own text has `length` letters left.
        string_end = np.flatnonzero(text == END)
        begin = np.concatenate([[0], string_end[:-1] + 1])
        edges = np.zeros(len(text) + 1, np.int8)
        edges[np.maximum(begin, string_end - length + 1)] = 1
        edges[string_end + 1] -= 1
        keep = (np.cumsum(edges[:-1], dtype=np.int8) == 0)[order]
        at, group = order[keep], group[keep]
        del order, keep, edges
        several = (np.bincount(group) > 1)[group] if len(group) else np.zeros(0, bool)
        at, group = at[several].astype(np.int64), group[several]
        owner = np.searchsorted(string_end, at)
        place = first[owner] + at - begin[owner]
        by = np.lexsort((place, doc[owner], group))
        group, owner, place = group[by], owner[by], place[by]
        new = np.ones(len(by), bool)
        new[1:] = group[1:] != group[:-1]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        late = (doc[owner] != doc[owner[lead]]) | (place != place[lead])
        owner, place = owner[late], place[late]
        spans = merged_spans(doc[owner], text_id[owner], place, place + length)
        return pa.table(dict(zip(("doc", "text_id", "first", "last"), spans)))
    return sort


def repeated_strings(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, often: int = OFTEN,
                     counters: int = COUNTERS, bucket_bytes: int = BUCKET_BYTES,
                     shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc, text_id, first, last): bytes of `rows` (doc, text_id, text) that lie in a string
    of `length` bytes which also starts earlier."""
    buckets = bucket_count(rows, bucket_bytes)
    hot = [r[0] for r in frequent(rows.select("text"), _anchors(length, gram), often,
                                  counters).select("value").collect()]
    found = stage(rows.mapInArrow(_packer(length, gram, hot, buckets),
                                  "bucket int, n long, runs binary")
                  .groupBy("bucket").applyInArrow(_settle, _FOUND), "runs")
    asked = found.filter(F.col("anchor").isNotNull())
    total = asked.agg(F.sum(F.col("last") - F.col("first"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    wanted = (asked.groupBy("doc", "text_id")
              .agg(F.collect_list(F.struct("first", "last", "anchor")).alias("asked")))
    strings = rows.join(wanted, ["doc", "text_id"]).mapInArrow(
        _fetcher(shards), "shard long, n long, place binary, size long, data binary")
    sorted_out = strings.groupBy("shard").applyInArrow(
        _shard_sorter(length), "doc long, text_id long, first long, last long")
    return found.filter(F.col("anchor").isNull()).drop("anchor").unionByName(sorted_out)


def _cutter(batches):
    for batch in batches:
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for text, found in zip(row_texts(batch).to_pylist(), column(batch, "spans").to_pylist()):
            raw = text.encode()
            parts, end, cuts = [], 0, 0
            stop = -1
            for first, last in sorted((s["first"], s["last"]) for s in found or ()):
                if first > stop:
                    parts.append(raw[end:first])
                    cuts += 1
                stop = end = max(end, last)
            parts.append(raw[end:])
            left = b"".join(parts)
            n_bytes.append(len(raw))
            n_removed.append(len(raw) - len(left))
            n_spans.append(cuts)
            kept.append(left)
        yield with_columns(batch, n_bytes=pa.array(n_bytes, pa.int64()),
                           n_removed=pa.array(n_removed, pa.int64()),
                           n_spans=pa.array(n_spans, pa.int64()),
                           kept=pa.array(kept, pa.binary()))


def drop_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                          often: int = OFTEN, counters: int = COUNTERS,
                          bucket_bytes: int = BUCKET_BYTES,
                          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """`docs` with `n_bytes`, `n_removed`, `n_spans` (maximal removed runs) and `kept`, the
    bytes that remain."""
    docs, schema = extended(docs, n_bytes="long", n_removed="long", n_spans="long", kept="binary")
    ship(docs)
    rows = keyed(docs)
    texts = rows.select("doc", "text_id", F.col("row.text").alias("text"))
    spans = (repeated_strings(texts, length, gram, often, counters, bucket_bytes, shard_bytes)
             .groupBy("doc", "text_id")
             .agg(F.collect_list(F.struct("first", "last")).alias("spans")))
    joined = rows.join(spans, ["doc", "text_id"], "left").select("row", "spans")
    return joined.mapInArrow(_cutter, schema)
