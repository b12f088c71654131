"""Near words, forms and roots against comparing all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from loomhouse.llm.spelling_variants import (BitIndex, bucketed, spelling_forms, variant_groups,
                                             vocabulary)


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at:] == b[at + 1:] or (len(a) == len(b) and a[at + 1:] == b[at + 1:])


def plain_forms(counts):
    near = {w: [v for v in counts if one_apart(v, w)] for w in counts}
    form, out = {}, {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]),
                  counts[form[w]] if form[w] is not None else None)
    return out


def plain_vocabulary(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 97 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def found_forms(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def crowded():
    """Words of a few letters, many one letter apart, and some long ones."""
    draw = random.Random(11)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(5, 9))) for _ in range(900)}
    words |= {"x" * 40 + w for w in list(words)[:60]} | {w + "ü" * 33 for w in list(words)[:60]}
    words |= {"a" * n for n in range(5, 40)}
    return {w: int(3 * 1.4 ** draw.randint(0, 20)) for w in sorted(words)}


def test_bitsets_track_one_error():
    words = sorted({w for w in crowded() if len(w) < 12})[:400]
    index = BitIndex(words)
    for word in words[::7] + ["zzzzz", "aaaaa"]:
        found = (index.near(word, len(word), len(word))
                 | index.near(word, len(word), len(word) - 1))
        assert {words[i] for i in range(len(words)) if found >> i & 1} == {
            v for v in words if one_apart(v, word)}


@pytest.mark.parametrize("bucket", [2048, 8])
def test_forms(spark, bucket):
    counts = crowded()
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert found_forms(spelling_forms(words, bucket=bucket)) == plain_forms(counts)


def test_large_buckets_are_split(spark):
    words = spark.createDataFrame(list(crowded().items()), "word string, n long")
    sizes = [(r["bucket"], r["count"]) for r in
             bucketed(words, 8).groupBy("bucket").count().collect()]
    assert all(n <= 8 or b["short"] - b["begin"] - b["end"] <= 1 for b, n in sizes)
    assert max(len(b["met"]) for b, _ in sizes) > 1


def test_vocabulary_and_groups(spark, frame):
    draw = random.Random(4)
    base = ["Straße", "strasse", "ÉCOLE", "école", "Theatre", "theater", "color", "colour", "abc",
            "abcd", "x÷y×zz"]
    docs = [(i, " ".join(draw.choice(base) + draw.choice(["", "", "s", "é"])
                         + draw.choice([" ", "1", "-", "中"]) for _ in range(60)))
            for i in range(120)]
    docs += [(None, "color " * 9), (None, None), (500, ""), (501, "colour"), (501, "colour"),
             (502, "Theatre " * 20_000), (503, "q" * 100_000), (503, "q" * 100_000),
             (504, "q" * 100_000), (505, "q" * 100_001 + " " + "q" * 100_001 + "7" + "q" * 100_001)]
    want = plain_vocabulary(docs)
    assert {r["word"]: r["n"] for r in vocabulary(frame(docs)).collect()} == want
    assert found_forms(variant_groups(frame(docs))) == plain_forms(want)


def test_empty_tables(frame):
    assert variant_groups(frame([(1, "abc")]).limit(0)).count() == 0
    assert variant_groups(frame([(1, "ab cd"), (2, None)])).count() == 0
