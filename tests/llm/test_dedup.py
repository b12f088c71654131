"""Exact, line, passage and string deduplication against plain versions."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import NO_ID, by_id, ordered

from loomhouse.llm.exact_dedup import exact_groups
from loomhouse.llm.heavy import Summary
from loomhouse.llm.jaccard_join import _components
from loomhouse.llm.line_dedup import drop_boilerplate
from loomhouse.llm.substring_dedup import (_marked, _packer, _places, _unpacked_places,
                                           drop_repeated_passages)
from loomhouse.llm.suffix_array import common_prefixes, suffix_order
from loomhouse.llm.suffix_dedup import drop_repeated_strings


def plain_passages(docs, n=13):
    first, out = {}, {}
    split = [(i, t.encode().split()) for i, t in ordered(docs)]
    for i, words in split:
        for k in range(len(words) - n + 1):
            first.setdefault(tuple(words[k:k + n]), i)
    for i, words in split:
        dead = [False] * len(words)
        for k in range(len(words) - n + 1):
            if first[tuple(words[k:k + n])] < i:
                dead[k:k + n] = [True] * n
        out[i] = (len(words), sum(dead),
                  b" ".join(w for w, d in zip(words, dead) if not d).decode())
    return out


def plain_strings(docs, n=100):
    seen, out = set(), {}
    for i, text in ordered(docs):
        raw = text.encode()
        dead = bytearray(len(raw))
        for k in range(len(raw) - n + 1):
            if raw[k:k + n] in seen:
                dead[k:k + n] = b"\1" * n
            seen.add(raw[k:k + n])
        out[i] = (len(raw), sum(dead), len([x for x in bytes(dead).split(b"\0") if x]),
                  bytes(x for x, d in zip(raw, dead) if not d))
    return out


@pytest.mark.parametrize("settings", [{}, {"often": 3, "counters": 1000}, {"most_bytes": 300},
                                      {"bucket_bytes": 100, "most_bytes": 1}])
def test_passages(frame, passages, settings):
    found = drop_repeated_passages(frame(passages), **settings)
    assert by_id(found, "n_words", "n_removed", "kept_text") == plain_passages(passages)
    assert found.columns[:5] == ["doc_id", "text", "doc", "row", "n"]


def test_packed_strings_take_less_than_twice_their_texts():
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 9)))
             for _ in range(3000)]
    texts = [" ".join(draw.choice(words) for _ in range(400)) for _ in range(1500)]
    batch = pa.RecordBatch.from_pydict({
        "doc": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts),
        "text_id": pa.array([draw.randrange(-1 << 62, 1 << 62) for _ in texts], pa.int64())})
    blocks = list(_packer(13, 4, [], 64)([batch]))
    assert sum(b.num_rows for b in blocks) <= 65
    assert sum(b.nbytes for b in blocks) < 2.1 * sum(map(len, texts))


def test_places_of_strings_are_read_back():
    draw = np.random.default_rng(3)
    doc = np.repeat(np.array([NO_ID, 7, 7, -3, (1 << 63) - 1]), [1, 3, 2, 5, 1])
    text_id = np.repeat(draw.integers(-1 << 62, 1 << 62, 5), [1, 3, 2, 5, 1])
    place, size = draw.integers(0, 1 << 40, (2, 12))
    found = _unpacked_places(_places(doc, text_id, place, size))
    for one, other in zip(found, (doc, text_id, place, size)):
        assert one.tolist() == other.tolist()


def test_texts_with_spans_are_marked(spark):
    rows = spark.range(20_000).selectExpr("id doc", "id * 7 text_id")
    marked = _marked(rows, rows.filter("doc % 100 = 3"))
    assert marked.filter("doc % 100 = 3 AND NOT held").count() == 0
    assert marked.filter("doc % 100 = 3 AND held").count() == 200
    assert marked.filter("held").count() < 1500
    assert marked.count() == 20_000 and marked.columns == [*rows.columns, "held"]
    assert _marked(rows, rows.limit(0)).filter("held").count() == 0


@pytest.mark.parametrize("held_bytes", [1, 2000])
def test_passages_packed_in_small_groups(frame, passages, held_bytes):
    found = drop_repeated_passages(frame(passages), held_bytes=held_bytes)
    assert by_id(found, "n_words", "n_removed", "kept_text") == plain_passages(passages)


@pytest.mark.parametrize("often", [200_000, 3])
def test_strings(frame, passages, often):
    found = drop_repeated_strings(frame(passages), often=often, counters=1000, shard_bytes=5000)
    assert by_id(found, "n_bytes", "n_removed", "n_spans", "kept") == plain_strings(passages)


def test_empty_tables(frame):
    empty = frame([(1, "a")]).limit(0)
    assert drop_repeated_passages(empty).count() == 0
    assert drop_repeated_strings(empty).count() == 0
    assert exact_groups(empty).count() == 0
    assert drop_boilerplate(empty, host="doc").drop("row").count() == 0


def test_result_columns_replace_those_of_their_name(frame):
    found = drop_repeated_passages(frame([(1, "a b")]).withColumnRenamed("n", "N_Words"))
    assert found.columns == ["doc_id", "text", "doc", "row", "n_words", "n_removed", "kept_text"]
    assert found.first()["n_words"] == 2


@pytest.mark.parametrize("counters", [3, 1000])
def test_exact_groups(frame, passages, counters):
    groups = defaultdict(list)
    for i, text in passages:
        groups[text or ""].append(NO_ID if i is None else i)
    want = {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest())
            for t, g in groups.items() for i in g}
    found = exact_groups(frame(passages), counters)
    assert found.count() == len(passages)
    rows = {NO_ID if r["doc_id"] is None else r["doc_id"]:
            (NO_ID if r["keep_id"] is None else r["keep_id"], r["group_size"], r["kept"],
             r["text_sha256"]) for r in found.collect()}
    assert rows == want


def test_summary_finds_frequent_values():
    seen = Summary(10)
    draw = np.random.default_rng(1)
    for _ in range(20):
        seen.add(np.concatenate([np.full(30, 7), draw.integers(100, 10**9, 100)]))
    table = seen.table().to_pydict()
    assert len(seen.values) <= 10 and 7 in table["value"]
    assert 20 * 30 - seen.seen / 10 <= table["n"][table["value"].index(7)] <= 20 * 30


def test_boilerplate_lines(spark):
    rows = [("h", f"own {i}\nmenu\n\nmenu\n \nfoot" if i < 6 else f"own {i}\n\n", i)
            for i in range(10)]
    rows += [(None, "menu\nx", 20), (None, None, 21), ("small", "menu", 22), ("h", "", 23)]
    pages = spark.createDataFrame(rows, "source string, text string, _lost long")
    found = {r["_lost"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in
             drop_boilerplate(pages, ratio=0.5, min_pages=3).collect()}
    assert found[0] == ("own 0\n\n ", 6, 3)
    assert found[9] == ("own 9\n\n", 3, 0)
    assert found[20] == ("menu\nx", 2, 0) and found[22] == ("menu", 1, 0)
    assert found[21] == (None, 0, 0) and found[23] == ("", 1, 0)


def test_suffix_arrays():
    draw = np.random.default_rng(1)
    for t in range(200):
        text = draw.integers(t % 2, int(draw.integers(1, 4)) + 1, int(draw.integers(1, 60)))
        order = suffix_order(text, 10**9)
        letters = text.tolist()
        want = sorted(range(len(letters)), key=lambda i: letters[i:])
        assert order.tolist() == want
        shared = common_prefixes(text, order)
        for a, b in zip(want, want[1:]):
            same = 0
            while max(a, b) + same < len(letters) and letters[a + same] == letters[b + same]:
                same += 1
            assert shared[b] == same


def test_components_of_paths_trees_and_nothing(spark):
    draw = random.Random(3)
    for edges in ([(i, i + 1) for i in range(30)], [], [(4, 4)],
                  [(draw.randrange(60), draw.randrange(60)) for _ in range(40)]):
        least = {n: n for edge in edges for n in edge}
        for _ in least:
            for a, b in edges:
                least[a] = least[b] = min(least[a], least[b])
        found = _components(spark.createDataFrame(edges, "x long, y long"))
        assert sorted(map(tuple, found.collect())) == sorted(
            (n, m) for n, m in least.items() if n != m)
