"""Documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Chosen-path join. In each run every set picks some of its shingles by a hash of the run,
each with a chance of `PICKS` over its size; a picked shingle leads to a bucket. Similar
sets share most shingles and so, with a known chance, a bucket; a number of runs brings the
chance to miss a link in all of them below 1 - `RECALL`. A bucket of too many sets is split
again: its sets pick shingles of their sketches (the least shingle hashes) by a hash of the
path so far; no text is read for it. Buckets that stay large after `DEPTH` splits are heaps of
sets that mostly share their shingles. In a heap sets are compared with a few leaders, not with
each other: a heap in which all are near one leader is connected by that, a set close to a
leader goes, since whatever is similar to it is near that leader too, and the others go on to
the next leaders until they fit in a bucket. A heap that keeps more than `FIRM` of its sets holds
sets that share a frequent passage and little else, for which leaders are of no use: it meets no
more of them. It is compared block by block, as is what is left after `ROUNDS`.

In a bucket all pairs are compared by their sketches, below the threshold. What they connect
makes candidate groups. Within a candidate group all
pairs of sets are compared exactly, in pairs of blocks, which gives every text its number of
links, and the edges that make the classes. Pairs never leave a task: buckets and block
pairs send on one edge for each text.

Texts with one sequence of words are compared once. A text of one to four words has one
shingle, all its words; texts without words are only like each other, and have no links.

Rows: a missing text has no words; every row is a document of its own, also where its doc_id
is missing or repeats, and is known by the number that it gets when it is described. A missing
doc_id counts as smaller than every other: it is the `class_id` of a class that holds one. An
empty table gives an empty result. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage, stage_sized
from .common import (FIRST, SECOND, U64, byte_rows, column, doc_key, groups, mix, numbers, own_id,
                     sent_if_small, ship, stored_size, whole_text, words)

SHINGLE = 5
SIMILARITY = 0.8
#: Chance to find a link between two texts in one of the runs.
RECALL = 0.9999
#: Expected number of shingles that a set picks in a run.
PICKS = 2.0
#: Sets of a bucket that are compared directly, and how often larger ones are split.
BUCKET = 1024
DEPTH = 2
#: Least hashes in a sketch; the similarity that it tells must be this share of the one asked
#: for. Two sets at the threshold share 51 of the 64 least hashes of both on average, and fewer
#: than the 36 asked for with a chance of less than 1 in 100,000.
SKETCH, SLACK = 64, 0.7
#: Rounds of leaders for a heap, leaders of a round, and the similarities to a leader, told by
#: sketches, from which a set is near it or so close that all its similar sets are near, too.
ROUNDS, LEADERS, NEAR, CLOSE = 6, 4, 0.3, 0.75
#: Share of its sets that a heap keeps in a round at most, to meet leaders again.
FIRM = 0.9
#: Bytes of shingles and number of sets in a block of a candidate group, at most.
BLOCK_BYTES, BLOCK_SETS = 12 << 20, 2048


def runs_for(similarity: float = SIMILARITY, recall: float = RECALL, picks: float = PICKS,
             depth: int = DEPTH) -> int:
    """Runs after which a link is missed with a chance of at most 1 - recall, even where both
    sets must follow the same path through `depth` splits."""
    shared = (1 - math.exp(-picks * similarity)) ** depth
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - shared)))


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, with their offsets; two hashes of the
    whole sequence of words of each row."""
    rows = len(offsets) - 1
    found = words(data, offsets)
    first, second = found.hashes(data, FIRST), found.hashes(data, SECOND)
    ends = np.append(found.first[:-1], len(first))[1:] if rows else np.zeros(0, np.int64)
    begins = found.first[:rows]
    ends = np.append(begins[1:], len(first))
    whole = [mix(base.spans(h, begins, ends) + (ends - begins).astype(U64))
             for base, h in ((FIRST, first), (SECOND, second))]
    inside = found.whole(size)
    value = mix(FIRST.runs(first, size))[inside] if len(inside) else np.zeros(0, U64)
    row = found.row[:len(inside)][inside]
    short = np.flatnonzero((ends > begins) & (ends - begins < size))
    value = np.concatenate([value, whole[0][short]])
    row = np.concatenate([row, short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(rows + 1)), whole[0], whole[1]


def _picked(sets, paths, picks):
    """Of one set, the shingles picked on each path, as the paths that they lead to."""
    limit = U64(min(int(picks / len(sets) * 2.0 ** 64), 2 ** 64 - 1))
    drawn = mix(sets[None, :] ^ paths[:, None])
    at, chosen = np.nonzero(drawn <= limit)
    return at, mix(drawn[at, chosen] + paths[at])


def _first_paths(runs):
    return mix(np.arange(1, runs + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def _describe(runs, picks, size):
    """For each document: hashes of its words, size of its set, first paths, sketch."""
    roots = _first_paths(runs)

    def describe(batches):
        for batch in batches:
            doc, text_id = numbers(batch, "doc"), numbers(batch, "text_id")
            data, offsets = byte_rows(column(batch, "text"))
            for low, high in groups(offsets):
                value, edge, a, b = shingles(data[offsets[low]:offsets[high]],
                                             offsets[low:high + 1] - offsets[low], size)
                row = np.repeat(np.arange(high - low), np.diff(edge))
                numbers_in = np.maximum(np.diff(edge), 1)
                limit = np.minimum(picks / numbers_in * 2.0 ** 64, 2.0 ** 64 - 2048).astype(U64)
                rows_of, paths_of = [], []
                for root in roots:
                    drawn = mix(value ^ root)
                    at = np.flatnonzero(drawn <= limit[row])
                    rows_of.append(row[at])
                    paths_of.append(mix(drawn[at] + root))
                rows_of, paths_of = np.concatenate(rows_of), np.concatenate(paths_of)
                order = np.argsort(rows_of, kind="stable")
                paths = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(rows_of[order], np.arange(high - low + 1)),
                             pa.int32()), pa.array(paths_of[order].view(np.int64)))
                # The sets are sorted by hash: their first ones are the sketch.
                high_bits = (value >> U64(32)).astype("<u4")
                sketch = [high_bits[s:min(s + SKETCH, e)].tobytes()
                          for s, e in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.RecordBatch.from_pydict(
                    {"doc": doc[low:high], "text_id": text_id[low:high],
                     "a": a.view(np.int64), "b": b.view(np.int64),
                     "n": np.diff(edge).astype(np.int64), "paths": paths,
                     "sketch": pa.array(sketch, pa.binary())})
    return describe


def _again(picks):
    """Paths from a large bucket on, for the sets in it: picked from their sketches."""
    def split(batches):
        for batch in batches:
            out = {"rep": [], "path": []}
            for rep, paths, raw in zip(numbers(batch, "rep").tolist(), column(batch, "paths"),
                                       column(batch, "sketch").to_pylist()):
                value = np.frombuffer(raw, "<u4").astype(U64)
                _, found = _picked(value, paths.values.to_numpy().view(U64), picks)
                out["rep"] += [rep] * len(found)
                out["path"] += found.view(np.int64).tolist()
            yield pa.RecordBatch.from_pydict(
                out, pa.schema([("rep", pa.int64()), ("path", pa.int64())]))
    return split


def _connected(near: np.ndarray) -> np.ndarray:
    """For each of n things, the least thing connected to it, from an n x n table of pairs."""
    label = np.arange(len(near))
    while True:
        least = np.where(near, label[None, :], len(near)).min(1)
        least = np.minimum(least, label)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _shared(one: np.ndarray, one_row: np.ndarray, ones: int,
            other: np.ndarray, other_row: np.ndarray, others: int) -> np.ndarray:
    """How many values each row of one side shares with each row of the other."""
    total = np.zeros((ones, others), np.float32)
    value, place = np.unique(np.concatenate([one, other]), return_inverse=True)
    if not len(value):
        return total
    here = np.bincount(place[:len(one)], minlength=len(value))
    there = np.bincount(place[len(one):], minlength=len(value))
    # A value in one row of one side only says nothing about a pair.
    common = (here > 0) & (there > 0) if one is not other else here > 1
    rank = np.cumsum(common) - 1
    a, b = place[:len(one)], place[len(one):]
    keep_a, keep_b = common[a], common[b]
    a, a_row, b, b_row = rank[a[keep_a]], one_row[keep_a], rank[b[keep_b]], other_row[keep_b]
    order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    a, a_row, b, b_row = a[order_a], a_row[order_a], b[order_b], b_row[order_b]
    # Some columns at a time, so that the tables stay small.
    columns = int(common.sum())
    step = min(max(1, (4 << 20) // max(ones, others, 1)), columns)
    for low in range(0, columns, max(step, 1)):
        left, right = np.zeros((ones, step), np.float32), np.zeros((others, step), np.float32)
        s, e = np.searchsorted(a, [low, low + step])
        left[a_row[s:e], a[s:e] - low] = 1
        s, e = np.searchsorted(b, [low, low + step])
        right[b_row[s:e], b[s:e] - low] = 1
        total += left @ right.T
    return total


def _rows_of(sets):
    """All values of some sets, and the set of each."""
    return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])


def _told(ones, others):
    """Similarity of each two sets as their sketches tell it: the share of common hashes among
    all hashes up to the end of the sketch that ends first; exact where sketches are whole sets."""
    one = _rows_of(ones)
    other = one if ones is others else _rows_of(others)
    shared = _shared(*one, len(ones), *other, len(others))
    end, other_end = (np.array([s[-1] if len(s) == SKETCH else 2 ** 32 - 1 for s in side], "<u4")
                      for side in (ones, others))
    here = np.stack([np.searchsorted(s, other_end, "right") for s in ones])
    there = (here if ones is others
             else np.stack([np.searchsorted(s, end, "right") for s in others])).T
    return shared / np.maximum(here + there - shared, 1)


def _similarity(shared, sizes, other_sizes):
    union = sizes[:, None] + other_sizes[None, :] - shared
    return shared / np.maximum(union, 1)


def _sketch_edges(similarity):
    """One edge for each set that its bucket connects to another; a group holds whole
    buckets."""
    def edges(key, table):
        table = table.sort_by([("bucket", "ascending"), ("rep", "ascending")])
        bucket, reps, n = (table[c].to_numpy() for c in ("bucket", "rep", "n"))
        sketches = [np.frombuffer(s, "<u4") for s in table["sketch"].to_pylist()]
        xs, ys = [], []
        cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
        for low, high in zip(cut, [*cut[1:], len(bucket)]):
            held, size = sketches[low:high], n[low:high]
            near = _told(held, held) >= similarity * SLACK
            # Sets of very different sizes are not alike, whatever their sketches share.
            near &= (np.minimum(size[:, None], size[None, :])
                     >= similarity * np.maximum(size[:, None], size[None, :]))
            least = _connected(near)
            moved = np.flatnonzero(least != np.arange(high - low))
            xs.append(reps[low:high][moved])
            ys.append(reps[low:high][least[moved]])
        return pa.table({"x": np.concatenate(xs), "y": np.concatenate(ys)})
    return edges


def _stars(edges: DataFrame) -> bool:
    """Whether every x has one y, and no y is an x."""
    ends = edges.select(F.col("x").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(edges.select(F.col("y").alias("node"), F.lit(0).alias("out"),
                                         F.lit(1).alias("into")))
    ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.filter(F.col("out") + F.col("into") > 1).isEmpty()


def _components(edges: DataFrame) -> DataFrame:
    """(x, y): every end of an edge with the least one connected to it, which is in no row as x.

    Each round links all neighbours of a node to the least of them, first the larger ones
    and then the smaller ones, so paths shrink to about half; written after each round. Edges
    lead to the smaller end and no round cuts a connection: they are done when they are stars.
    """
    edges = stage(edges.filter("x <> y").select(F.greatest("x", "y").alias("x"),
                                                F.least("x", "y").alias("y")).distinct(), "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        larger = (both.filter("y > x").join(least, "x")
                  .select(F.col("y").alias("x"), F.col("m").alias("y")).distinct())
        larger = stage(larger.filter("x <> y"), "larger")
        down = larger.groupBy("x").agg(F.min("y").alias("m"))
        smaller = (larger.join(down, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
                   .unionByName(down.select("x", F.col("m").alias("y")))
                   .filter("x <> y").distinct())
        edges = stage(smaller, "edges")
    return edges


def _with_least(edges: DataFrame) -> DataFrame:
    """The result of `_components`, with a row for the least one of each as well."""
    return edges.unionByName(edges.select(F.col("y").alias("x"), "y").distinct())


def _sets(size):
    """The shingles of each text, as bytes."""
    def make(batches):
        for batch in batches:
            data, offsets = byte_rows(column(batch, "text"))
            rest = [n for n in batch.schema.names if n != "text"]
            for low, high in groups(offsets):
                value, edge, _, _ = shingles(data[offsets[low]:offsets[high]],
                                             offsets[low:high + 1] - offsets[low], size)
                raw = memoryview(value.tobytes())
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*(column(part, n) for n in rest),
                     pa.array([raw[8 * s:8 * e].tobytes() for s, e in
                               zip(edge[:-1].tolist(), edge[1:].tolist())], pa.binary())],
                    [*rest, "shingles"])
    return make


def _block_links(similarity):
    """Links between the sets of two blocks (or within one): their weight for each set, and
    one edge for each set that is connected to another."""
    def links(key, table):
        table = table.sort_by("rep")
        block = table["block"].to_numpy()
        low, high = key[1].as_py(), key[2].as_py()
        sides = [np.flatnonzero(block == low), np.flatnonzero(block == high)]
        if not len(sides[0]) or not len(sides[1]):
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64()),
                             "links": pa.array([], pa.int64())})
        reps, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
        raw = table["shingles"].to_pylist()
        parts = []
        for side in sides:
            sets = [np.frombuffer(raw[i], U64) for i in side.tolist()]
            sizes = np.array([len(s) for s in sets])
            parts.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), sizes))
        (va, ra, na), (vb, rb, nb) = parts
        if low == high:
            vb, rb = va, ra
        near = _similarity(_shared(va, ra, len(na), vb, rb, len(nb)), na, nb) >= similarity
        if low == high:
            np.fill_diagonal(near, False)
            weights = [(sides[0], near @ copies[sides[0]])]
            least = _connected(near)
            moved = np.flatnonzero(least != np.arange(len(na)))
            x, y = reps[sides[0][moved]], reps[sides[0][least[moved]]]
        else:
            weights = [(sides[0], near @ copies[sides[1]]), (sides[1], near.T @ copies[sides[0]])]
            k = len(na)
            whole = np.zeros((k + len(nb),) * 2, bool)
            whole[:k, k:] = near
            whole[k:, :k] = near.T
            both = reps[np.concatenate(sides)]
            least = _connected(whole)
            moved = np.flatnonzero(least != np.arange(len(both)))
            x, y = both[moved], both[least[moved]]
        ends = np.concatenate([reps[side] for side, _ in weights])
        counts = np.concatenate([w for _, w in weights]).astype(np.int64)
        return pa.table({
            "x": np.concatenate([ends, x]), "y": np.concatenate([ends, y]),
            "links": np.concatenate([counts, np.zeros(len(x), np.int64)])})
    return links


def _all(frames):
    return reduce(DataFrame.unionByName, frames)


def _buckets(reps: DataFrame, picks: float, bucket: int, depth: int, rounds: int
             ) -> tuple[list[DataFrame], DataFrame]:
    """Edges of sets to leaders; and (path, rep, sets) of the buckets of at most `bucket` sets,
    with the heaps that are still larger after `depth` splits and all rounds of leaders.

    A large bucket meets leaders before it is split, so one group of near copies is not split.
    """
    rows = reps.select(F.explode("paths").alias("path"), "rep").distinct()
    edges, members = [], []
    for level in range(1, depth + 1):
        sized = stage(rows.groupBy("path").agg(F.count("*").alias("sets")).filter("sets > 1"),
                      "buckets")
        rows = stage(rows.join(sized, "path"), "paths")
        members.append(rows.filter(F.col("sets") <= bucket))
        large = rows.filter(F.col("sets") > bucket)
        if large.isEmpty():
            break
        found, shrunk, large = _led(large, reps, bucket, rounds if level == depth else 1)
        edges, members = [*edges, *found], [*members, *shrunk]
        if level == depth:
            members.append(large)
            break
        wanted = large.groupBy("rep").agg(F.collect_set("path").alias("paths"))
        rows = stage(wanted.join(reps.select("rep", "sketch"), "rep")
                     .mapInArrow(_again(picks), "rep long, path long").distinct(), "paths")
    return edges, stage(_all(members), "members")


def _beside_leaders(batches):
    """For each set of a heap: the leaders that it is near, as a mask, and whether it is close to
    one; by name the leaders to connect it to. One set connects all leaders of a mask, the others
    with that mask need the first of them only."""
    for batch in batches:
        paths = numbers(batch, "path")
        held, leaders = column(batch, "sketch").to_pylist(), column(batch, "leaders")
        near, mask, close = ([None] * len(paths) for _ in range(3))
        order = np.argsort(paths, kind="stable")
        cuts = np.flatnonzero(np.diff(paths[order])) + 1
        for at in np.split(order, cuts) if len(order) else ():
            led = leaders[int(at[0])].as_py()
            told = _told([np.frombuffer(held[i], "<u4") for i in at],
                         [np.frombuffer(one["sketch"], "<u4") for one in led])
            names = np.array([one["rep"] for one in led])
            bits = (told >= NEAR) @ (1 << np.arange(len(led)))
            known = set()
            for i, row, all_bits in zip(at.tolist(), told, bits.tolist()):
                near[i], mask[i] = names[row >= NEAR], all_bits
                if all_bits in known:
                    near[i] = near[i][:1]
                known.add(all_bits)
                close[i] = bool((row >= CLOSE).any())
        yield pa.RecordBatch.from_arrays(
            [column(batch, "path"), column(batch, "rep"), column(batch, "sketch"),
             pa.array(near, pa.list_(pa.int64())), pa.array(mask, pa.int64()),
             pa.array(close, pa.bool_())],
            ["path", "rep", "sketch", "near", "mask", "close"])


def _led(heaps: DataFrame, reps: DataFrame, bucket: int, rounds: int
         ) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """Edges of sets to the leaders of their heaps; the buckets that are left where a heap has
    become small; and the heaps that are still large.

    A set close to a leader goes: what is similar to it is near that leader, and so connected to
    it. A heap whose sets are all near one leader goes as a whole.
    """
    edges, small, firm = [], [], []
    left = heaps.select("path", "rep", "sets")
    for turn in range(rounds):
        if left.isEmpty():
            break
        if "sketch" not in left.columns:
            left = stage(left.join(reps.select("rep", "sketch"), "rep"), "heaps")
        drawn = [F.min(F.struct(F.xxhash64("path", "rep", F.lit(turn * LEADERS + k)).alias("draw"),
                                "rep", "sketch")) for k in range(LEADERS)]
        leaders = stage(left.groupBy("path").agg(F.array(*drawn).alias("leaders")), "leaders")
        seen = stage(left.join(leaders, "path").select("path", "rep", "sketch", "leaders")
                     .mapInArrow(_beside_leaders, "path long, rep long, sketch binary, "
                                 "near array<long>, mask long, close boolean"), "led")
        edges.append(seen.select(F.col("rep").alias("x"), F.explode("near").alias("y"))
                     .filter("x <> y"))
        going_on = (seen.groupBy("path").agg(F.bit_and("mask").alias("common"),
                                             F.count_if(~F.col("close")).alias("sets"),
                                             F.count("*").alias("met"))
                    .filter("common = 0 AND sets > 1")
                    .select("path", "sets", (F.col("sets") > FIRM * F.col("met")).alias("firm")))
        rest = stage(seen.filter("NOT close").select("path", "rep", "sketch")
                     .join(going_on, "path"), "rest")
        small.append(rest.filter(F.col("sets") <= bucket).select("path", "rep", "sets"))
        left = rest.filter(F.col("sets") > bucket)
        firm.append(left.filter("firm").select("path", "rep", "sets"))
        left = left.filter("NOT firm").drop("firm")
    return edges, small, _all([*firm, left.select("path", "rep", "sets")])


def _bucket_edges(members: DataFrame, reps: DataFrame, similarity: float, bucket: int
                  ) -> DataFrame:
    """Edges of all buckets. Buckets of the same sets are compared once; one of more than
    `bucket` sets is cut into blocks, and each two of its blocks compared, with the pairs inside
    of both."""
    alike = (members.filter(F.col("sets") <= bucket).groupBy("path")
             .agg(F.sort_array(F.collect_set("rep")).alias("held")).select("held").distinct())
    small = alike.select(F.xxhash64("held").alias("bucket"), F.explode("held").alias("rep"))
    blocks = F.ceil(F.col("sets") / F.lit(bucket)).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    large = (members.filter(F.col("sets") > bucket).distinct()
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .filter("own <> other")
             .select(F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other"))
                     .alias("bucket"), "rep"))
    described = reps.select("rep", "n", "sketch")
    placed = stage(small.unionByName(large).distinct().join(described, "rep"), "placed")
    # A group is a handful of buckets: as many groups as there are megabytes of rows.
    most = F.lit(max(1, stored_size(placed) >> 20))
    return (placed.groupBy(F.pmod("bucket", most).alias("batch"))
            .applyInArrow(_sketch_edges(similarity), "x long, y long"))


def similar_rows(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL,
                 picks: float = PICKS, bucket: int = BUCKET, depth: int = DEPTH,
                 rounds: int = ROUNDS, size: int = SHINGLE, block_bytes: int = BLOCK_BYTES,
                 block_sets: int = BLOCK_SETS) -> DataFrame:
    """One row per row of `docs`: `doc` and `text_id` (its doc_id and hash of its text, as in
    `keyed`), those of the least row of its class as `class_doc` and `class_text`, and `n_links`."""
    ship(docs)
    runs = runs_for(similarity, recall, picks, depth)
    texts = docs.select(doc_key().alias("doc"), F.xxhash64(whole_text()).alias("text_id"),
                        whole_text().alias("text"))
    described = stage(texts.mapInArrow(
        _describe(runs, picks, size),
        "doc long, text_id long, a long, b long, n long, paths array<long>, sketch binary")
        .withColumn("row", F.monotonically_increasing_id()), "described")
    # Texts of the same words: the number of the least row stands for them.
    same = stage(described.groupBy("a", "b").agg(
        F.min(F.struct("doc", "text_id", "row")).alias("least"), F.count("*").alias("copies"),
        F.max("n").alias("n"))
        .select("a", "b", "least.doc", "least.text_id", F.col("least.row").alias("rep"), "copies",
                "n"), "texts")
    reps = stage(described.join(same.filter("n > 0").select(F.col("rep").alias("row"), "copies"),
                                "row")
                 .select(F.col("row").alias("rep"), "doc", "text_id", "copies", "n", "paths",
                         "sketch"), "representatives")
    edges, members = _buckets(reps, picks, bucket, depth, rounds)
    groups_of = _components(_all([_bucket_edges(members, reps, similarity, bucket), *edges]))
    # Every candidate with its group; the least of a group is in it too.
    grouped = _with_least(groups_of)
    joined = grouped.join(
        reps.select(F.col("rep").alias("x"), "doc", "text_id", "copies", "n"), "x")
    sizes = joined.groupBy("y").agg(
        F.greatest(F.ceil(F.sum(F.col("n") * 8) / F.lit(block_bytes)),
                   F.ceil(F.count("*") / F.lit(block_sets))).cast("int").alias("blocks"))
    placed, written = stage_sized(joined.join(sizes, "y").select(
        F.col("x").alias("rep"), "doc", "text_id", F.col("y").alias("grp"), "copies", "blocks",
        F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int").alias("block")), "groups")
    # The texts of all candidates, by one join; equal rows give one.
    held = (texts.join(sent_if_small(placed, written), ["doc", "text_id"])
            .dropDuplicates(["doc", "text_id"])
            .select("rep", "grp", "copies", "blocks", "block", "text")
            .mapInArrow(_sets(size), "rep long, grp long, copies long, blocks int, block int, "
                                     "shingles binary"))
    paired = (held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("low", F.least("block", "other"))
              .withColumn("high", F.greatest("block", "other")))
    linked = stage(paired.groupBy("grp", "low", "high").applyInArrow(
        _block_links(similarity), "x long, y long, links long"), "links")
    counts = linked.filter("x = y").groupBy(F.col("x").alias("rep")).agg(
        F.sum("links").alias("links"))
    classes = _with_least(_components(linked.filter("x <> y").select("x", "y")))
    least = (classes.join(same.select(F.col("rep").alias("x"), "doc", "text_id"), "x")
             .groupBy("y").agg(F.min(F.struct("doc", "text_id")).alias("least")))
    least = classes.join(least, "y").select(
        F.col("x").alias("rep"), F.col("least.doc").alias("class_doc"),
        F.col("least.text_id").alias("class_text"))
    settled = stage(same.join(least, "rep", "left").join(counts, "rep", "left").select(
        "a", "b", F.coalesce("class_doc", "doc").alias("class_doc"),
        F.coalesce("class_text", "text_id").alias("class_text"),
        F.when(F.col("n") > 0, F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        .otherwise(0).alias("n_links")), "classes")
    return (described.select("doc", "text_id", "a", "b").join(settled, ["a", "b"])
            .drop("a", "b"))


def similar_classes(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of `docs`: `class_id` (least doc_id of its class) and `n_links`, the number
    of other documents with a similarity of at least `similarity` (copies included). The settings
    are those of `similar_rows`."""
    return similar_rows(docs, **settings).select(
        own_id("doc").alias("doc_id"), own_id("class_doc").alias("class_id"), "n_links")
