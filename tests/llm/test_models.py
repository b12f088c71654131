"""Toxicity, quality and the similarity join."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from helpers import NO_ID, by_id

from loomhouse.llm.common import byte_rows, groups, table
from loomhouse.llm.jaccard_join import runs_for, similar_classes
from loomhouse.llm.labelled import held_out
from loomhouse.llm.quality import COUNTS, count_features, judge_quality, learn_classifier
from loomhouse.llm.toxicity import Lexicon, fold, learn_lexicon, score_toxicity

SMALL = "/root/testdata/sf0.01"


def test_folding():
    assert fold("1d10t Іdіоt pa$$word W0RTHLESS moron!! 12345 ｃlown") == (
        "idiot idiot password worthless moron!! 12345 clown")
    assert fold("i\u0301d\u200bi\u00adot 𝐦𝐨𝐫𝐨𝐧 Ịđıøt") == "idiot moron idiot"


def test_lexicon_matches():
    lexicon = Lexicon({"lowe": 3.0, "idiot ": 5.0, "idio": 1.0}, ("idiot proof",))
    assert lexicon.weigh("loweän slowe") == 3.0
    assert lexicon.weigh("Idiots, 1d10t.") == 6.0
    assert lexicon.weigh("an idiot proof idiot") == 5.0
    phrases = "idiot proof idiot " * 20_000
    assert lexicon.weigh(phrases) == 5.0 * 20_000
    assert lexicon.weigh("") == 0.0 and Lexicon({}).weigh("idiot") == 0.0


def test_toxicity_on_held_out_labels(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    lexicon = learn_lexicon(docs, labels)
    scored = (score_toxicity(docs.select("doc_id", "text"), lexicon).join(labels, "doc_id")
              .filter(held_out()).select("toxic", "predicted").collect())
    right = sum(r["toxic"] == r["predicted"] for r in scored)
    assert right / len(scored) > 0.93
    assert not any(r["predicted"] for r in scored if not r["toxic"])


def test_without_labels(spark, frame):
    docs, labels = frame([(1, "an idiot"), (2, None)]), table(spark, SMALL, "labels").limit(0)
    scored = score_toxicity(docs, learn_lexicon(docs, labels))
    assert {(r["score"] < 1e-9, r["predicted"]) for r in scored.collect()} == {(True, 0)}
    assert learn_classifier(docs, labels) is None
    judged = by_id(judge_quality(docs.drop("n"), None), "n_words", "base_failed", "kept")
    assert judged == {1: (2, True, False), 2: (0, True, False)}


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    cover = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again,
            len(cover))


def test_counts():
    draw = random.Random(2)
    parts = ["a", "bé", " ", "\n", "\n", "a b c d e f ", "x*", "#\t", "\r\n", "\n\n"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
             for _ in range(2000)] + [None, "", "a b c d e f g " * 9000]
    data, offsets = byte_rows(pa.array(texts, pa.string()))
    for low, high in groups(offsets, 500):
        counts = count_features(data[offsets[low]:offsets[high]],
                                offsets[low:high + 1] - offsets[low])
        for k in range(high - low):
            assert tuple(int(counts[c][k]) for c in COUNTS) == plain_counts(texts[low + k] or "")


def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    judged = judge_quality(docs.select("doc_id", "text"), learn_classifier(docs, labels))
    rows = (judged.join(labels, "doc_id").filter(held_out() & ~judged["base_failed"])
            .select("quality", "kept").collect())
    assert sum((r["quality"] == 1) == r["kept"] for r in rows) / len(rows) > 0.95


def plain_classes(docs):
    sets = []
    for i, text in docs:
        words = (text or "").split()
        grams = ({tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5
                 else {tuple(words)} if words else set())
        sets.append((NO_ID if i is None else i, grams))
    parent, links = {i: i for i, _ in sets}, Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1:]:
            if x and y and len(x & y) / len(x | y) >= 0.8:
                links[i] += 1
                links[j] += 1
            elif x or y:
                continue
            p, q = find(i), find(j)
            parent[max(p, q)] = min(p, q)
    return {i: (find(i), links[i]) for i, _ in sets}


@pytest.fixture(scope="module")
def near_copies():
    draw = random.Random(7)
    words = [f"w{i}" for i in range(4000)]
    line = " ".join(draw.choice(words) for _ in range(20))
    texts = []
    for _ in range(20):
        base = [draw.choice(words) for _ in range(draw.choice([3, 6, 30, 100, 300]))]
        for _ in range(draw.choice([1, 2, 5, 25])):
            copy = list(base)
            for _ in range(int(len(copy) * draw.choice([0, 0.01, 0.02, 0.04]))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy) + ("\n" + line if draw.random() < 0.3 else ""))
    texts += [line + " " + " ".join(draw.choice(words) for _ in range(draw.randint(5, 60)))
              for _ in range(40)]
    return list(enumerate(texts + [None, "", " ", "one", "one", "one two"])) + [(None, texts[9])]


@pytest.mark.parametrize("settings", [{}, {"bucket": 4, "depth": 3, "block_sets": 3}])
def test_similar_classes(frame, near_copies, settings):
    found = similar_classes(frame(near_copies), **settings)
    rows = {NO_ID if r["doc_id"] is None else r["doc_id"]:
            (NO_ID if r["class_id"] is None else r["class_id"], r["n_links"])
            for r in found.collect()}
    assert rows == plain_classes(near_copies)


@pytest.mark.parametrize("settings", [{}, {"bucket": 4, "depth": 3, "block_sets": 3}])
def test_similar_classes_of_missing_and_repeated_ids(frame, settings):
    draw = random.Random(11)
    bases = [[f"{k}x{i}" for i in range(120)] for k in range(8)]

    def near(k):
        copy = list(bases[k])
        copy[draw.randrange(120)] = "other"
        return " ".join(copy)

    # Near copies among rows without an id only; beside a real one; one id with two texts.
    docs = [(None, near(0)), (None, near(0)), (None, near(1)), (None, near(2)), (None, near(2)),
            (None, near(2)), (None, "alone"), (None, None), (None, near(7)), (None, near(7))]
    docs += [(None, docs[0][1])] * 2
    docs += [(3, near(3)), (3, near(4)), (4, near(3)), (5, near(4)), (6, near(1)), (7, near(5)),
             (7, near(6)), (8, near(6)), (9, "  "), (10, near(5)), (10, near(5))]
    # Each row gets an id of its own, in the order of the ids.
    docs.sort(key=lambda d: NO_ID if d[0] is None else d[0])
    want = plain_classes([(k, t) for k, (_, t) in enumerate(docs)])
    found = similar_classes(frame(docs), **settings).collect()
    assert sorted(((r["doc_id"] or -1, r["class_id"] or -1, r["n_links"]) for r in found)) == sorted(
        (docs[k][0] or -1, docs[least][0] or -1, links) for k, (least, links) in want.items())


def test_heaps_of_copies_that_drift_apart(frame):
    # Copies drift away from their base word by word, so links lead from those close to a leader
    # to those beyond its reach; half of the others only share a passage, so leaders do not shrink
    # their heaps.
    draw, texts = random.Random(23), []
    for base in range(2):
        words = [f"{base}w{i}" for i in range(300)]
        for k in range(150):
            copy = list(words)
            for at in draw.sample(range(300), draw.randint(0, 12)):
                copy[at] = f"{base}c{k}x{at}"
            texts.append(" ".join(copy))
        chain = list(words)
        for k in range(60):
            chain[(k * 5) % 300] = f"{base}d{k}"
            texts.append(" ".join(chain))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"{k % 100}q{i}" for i in range(30 + k % 7))
              for k in range(150)]
    docs = list(enumerate(texts))
    found = similar_classes(frame(docs), bucket=16, block_sets=64)
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found.collect()} == plain_classes(docs)


def test_no_documents(frame):
    assert similar_classes(frame([(1, "a")]).limit(0)).count() == 0
    assert similar_classes(frame([(1, None), (2, " ")])).count() == 2
    assert runs_for(recall=0.9999) >= runs_for(recall=0.9)
