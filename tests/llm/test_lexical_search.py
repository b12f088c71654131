"""Ranked search against plain scoring of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import NO_ID

from loomhouse.llm import lexical_search
from loomhouse.llm.lexical_search import Heaps, ranked_documents, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_ranks(docs, items, top=10):
    split = [(NO_ID if i is None else i, Counter(plain_terms(t))) for i, t in docs]
    n = sum(1 for _, c in split if c)
    total = sum(c.total() for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts in split:
            m = 25 + (75 * counts.total() * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                        for t in plain_terms(text) if counts[t])
            if score > 0:
                found.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc)
                in enumerate(sorted(found)[:top], 1)]
    return out


def ranks(found):
    return Counter((r["item_id"], r["rank"], NO_ID if r["doc_id"] is None else r["doc_id"],
                    r["score"]) for r in found.collect())


def documents():
    draw = random.Random(3)
    words = ["Été", "éTÉ", "alpha", "Alpha", "b2", "x", "ÿ中", "the", "of", "rare", "zz"]
    docs = [(i, " ,".join(draw.choices(words, [5, 3, 3, 3, 2, 2, 1, 20, 20, 1, 1],
                                       k=draw.randint(0, 40)))) for i in range(150)]
    return docs + [(900, None), (901, ""), (902, ".,;"), (None, "rare rare"), (None, "rare"),
                   (903, docs[5][1]), (903, docs[5][1]), (904, "the of rare " * 5000)]


ITEMS = [(1, "Rare the THE été"), (1, "x"), (2, None), (3, "nowhere"), (None, "b2-Alpha"),
         (4, "of the of the zz ÿ中 " * 30), (5, "")]


@pytest.mark.parametrize("size", [(8 << 20, 4096, 1 << 20), (40, 2, 7)])
def test_ranks(spark, frame, monkeypatch, size):
    monkeypatch.setattr(lexical_search, "CELLS", size[2])
    items = spark.createDataFrame(
        [(i, t, 1, "x") for i, t in ITEMS], "item_id long, text string, rank int, term string")
    docs = documents()
    found = ranked_documents(frame(docs, 7), items, block_bytes=size[0], block_items=size[1])
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranks(found) == Counter(plain_ranks(docs, ITEMS))


def test_empty_tables(spark, frame):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame([(1, "rare"), (2, "of")])
    assert ranked_documents(docs.limit(0), items).count() == 0
    assert ranked_documents(docs, items.limit(0)).count() == 0
    assert ranked_documents(frame([(1, None), (2, " ")]), items).count() == 0


def test_terms_are_those_of_the_pattern():
    draw = random.Random(1)
    for _ in range(200):
        text = "".join(chr(draw.choice([draw.randrange(128), draw.randrange(128, 0x3000)]))
                       for _ in range(50))
        assert [t.decode() for t in terms(text.encode())] == plain_terms(text)


def test_heaps_keep_the_best_in_any_order():
    draw = np.random.default_rng(2)
    scores, docs = draw.integers(0, 6, (500, 3)), draw.permutation(500) - 250
    ties = draw.integers(0, 3, 500)
    heaps = Heaps(3, 5)
    for low in range(0, 500, 60):
        heaps.offer(scores[low:low + 60], docs[low:low + 60], ties[low:low + 60])
    table = heaps.table(np.array([7, 8, 9]), 0).to_pylist()
    for item in range(3):
        want = sorted(zip(-scores[:, item], docs))[:5]
        got = sorted((-r["score"], r["doc"]) for r in table if r["item"] == item + 7)
        assert got == [(int(s), int(d)) for s, d in want]
