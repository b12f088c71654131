"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: compatible forms of letters, no combining marks and no characters
without width, lower case, look-alike letters of other alphabets, and digits or signs that stand
for letters inside a word. The lexicon holds beginnings of words and whole
words with their log odds, learned from labelled documents; a word counts with its heaviest
match unless it lies in an exception phrase. The sum of a text is set against its length
by a logistic model of both, fitted on labelled documents the lexicon has not seen.

Only texts and the labels of the training folds are read: the score of a text depends on
nothing else. Rows: a missing text counts as empty. An empty text has no match and the score
of the model's constant. Without labels of both kinds there is no lexicon and every score is
0. An empty table gives an empty result. Other columns are carried along; any named
`score` or `predicted`, in any case, are replaced.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, extended, keyed, row_texts, ship, with_columns
from .labelled import logistic, probability, training_sample

#: Labelled documents learned from, at most.
TRAINING_ROWS = 20_000
#: Candidate terms whose documents are counted, and terms of the lexicon, at most.
CANDIDATES, TERMS = 50_000, 5_000
#: Least likelihood ratio (G squared) of a term against the same share in both classes, so that
#: no chance find enters: 40 is exceeded by chance once in four thousand million terms. Least and
#: greatest log odds.
LEAST_RATIO, LEAST_ODDS, MOST_ODDS = 40.0, 2.5, 6.0
#: Lengths of beginnings of words that may be terms.
BEGINNINGS = range(4, 9)
#: Harmless phrases around words that may be in the lexicon, folded.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "sore loser", "idiot proof")
THRESHOLD = 0.5

# Letters of other alphabets that look like Latin ones.
_LOOK_ALIKE = str.maketrans(
    "аеорсухіјѕԁһӏвнкмтгпαεοριυκνχηωτβγσʟɡɑıɩʋłøđħœæðþ",
    "aeopcyxijsdhlbhkmtrnaeopiuknxnwtbyolgaiivlodhoadp")
# Digits and signs written for letters.
_WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
                "@": "a", "$": "s", "!": "i", "|": "l"}
_FOREIGN = re.compile("[\u0080-\u052f]")
#: Combining marks, soft hyphens, variation selectors and characters without width.
_UNSEEN = re.compile("[\u0300-\u036f\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e"
                     "\u2060-\u2064\ufe00-\ufe0f\ufeff]")
_DISGUISE = re.compile(r"(?<=[^\W\d_])[01345789@$!|]+(?=[^\W\d_])"
                       r"|(?<![^\W_])[01345789@$]+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """The text as the lexicon sees it."""
    if not text.isascii():
        text = _UNSEEN.sub("", unicodedata.normalize("NFKD", text)).lower()
        if _FOREIGN.search(text):
            text = text.translate(_LOOK_ALIKE)
    else:
        text = text.lower()
    return _DISGUISE.sub(lambda m: "".join(_WRITTEN_FOR[c] for c in m[0]), text)


def _terms(text: str) -> set[str]:
    """Beginnings of the words of a text, and whole words with a space after them."""
    found = set()
    for word in set(_WORD.findall(fold(text))):
        found.add(word + " ")
        found.update(word[:n] for n in BEGINNINGS if n <= len(word))
    return found


@dataclass
class Lexicon:
    """Terms (whole words end with a space) with weights, harmless phrases, and the logistic
    weights for the logarithms of the sum and of the number of words, and the constant."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    model: tuple[float, float, float] = (0.0, 0.0, -30.0)

    def __post_init__(self):
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick
            found = ahocorasick.Automaton()
            weights: dict[str, list[float]] = {}
            for term, weight in self.terms.items():
                pair = weights.setdefault(term.rstrip(), [0.0, 0.0])
                pair[term.endswith(" ")] = weight
            for phrase in self.exceptions:
                weights.setdefault(phrase, [-1.0, -1.0])
            for term, (begins, whole) in weights.items():
                found.add_word(term, (len(term), begins, whole))
            if len(found):
                found.make_automaton()
            self._automaton = found
        return self._automaton

    def weigh(self, text: str) -> float:
        """Sum of the heaviest match of each word outside of exception phrases."""
        automaton = self.automaton()
        if not len(automaton):
            return 0.0
        text = fold(text)
        best: dict[int, float] = {}
        harmless = []
        for end, (size, begins, whole) in automaton.iter(text):
            start = end + 1 - size
            if start and text[start - 1].isalpha():
                continue
            closed = end + 1 == len(text) or not text[end + 1].isalpha()
            if begins < 0:
                if closed:
                    harmless.append((start, end))
                continue
            weight = max(begins, whole if closed else 0.0)
            if weight > best.get(start, 0.0):
                best[start] = weight
        # One sweep over matches and phrases, both by their start.
        harmless.sort()
        total, nth, reach = 0.0, 0, -1
        for at in sorted(best):
            while nth < len(harmless) and harmless[nth][0] <= at:
                reach = max(reach, harmless[nth][1])
                nth += 1
            if at > reach:
                total += best[at]
        return total

    def features(self, texts: Sequence[str]) -> np.ndarray:
        return np.log1p(np.array([(self.weigh(t), len(t.split())) for t in texts],
                                 float).reshape(-1, 2))

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        if not self.terms:
            return np.zeros(len(texts))
        a, b, c = self.model
        x = self.features(texts)
        return probability(a * x[:, 0] + b * x[:, 1] + c)


def _count(candidates: set[str] | None):
    """Documents with each term, counted in the task first."""
    def count(batches):
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in column(batch, "text").to_pylist():
                found = _terms(text)
                seen.update(found if candidates is None else found & candidates)
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(seen), pa.string()),
                                          "n": pa.array(list(seen.values()), pa.int64())})
    return count


def _document_counts(texts: DataFrame, candidates: set[str] | None = None) -> DataFrame:
    return (texts.select("text").mapInArrow(_count(candidates), "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n")))


def likelihood_ratio(n: int, of: int, m: int, out_of: int) -> float:
    """G squared of n of `of` against m of `out_of`."""
    both = (n + m) / (of + out_of)
    cells = ((n, of * both), (of - n, of * (1 - both)),
             (m, out_of * both), (out_of - m, out_of * (1 - both)))
    return 2 * sum(seen * math.log(seen / expected) for seen, expected in cells if seen)


def _without_longer(weights: dict[str, float]) -> dict[str, float]:
    """A term goes if a shorter beginning of it weighs about as much."""
    kept: dict[str, float] = {}
    for term in sorted(weights, key=len):
        shorter = (kept.get(term[:n], 0.0) for n in range(1, len(term)))
        if weights[term] > max(shorter, default=0.0) + 0.5:
            kept[term] = weights[term]
    return kept


def learn_lexicon(docs: DataFrame, labels: DataFrame, label: str = "toxic",
                  rows: int = TRAINING_ROWS, exceptions: Sequence[str] = EXCEPTIONS) -> Lexicon:
    """Lexicon and length model from at most `rows` labelled documents.

    Terms are counted by Spark; the driver sees at most `CANDIDATES` of them with their
    counts, and two numbers for each document of the calibration part.
    """
    ship(docs)
    sample = training_sample(docs, labels, label, rows)
    sizes = {(r["label"], r["fit"]): r["n"] for r in
             sample.groupBy("label", "fit").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get((1, True), 0), sizes.get((0, True), 0)
    if not toxic or not clean:
        return Lexicon({}, tuple(exceptions))
    fit = sample.filter("fit")
    # A term that no clean document has is significant from so many toxic ones on.
    least = LEAST_RATIO / 2 / np.log((toxic + clean) / toxic)
    often = (_document_counts(fit.filter("label = 1")).filter(F.col("n") >= float(least))
             .orderBy(F.desc("n"), "term").limit(CANDIDATES).collect())
    in_toxic = {r["term"]: r["n"] for r in often}
    in_clean = {r["term"]: r["n"] for r in
                _document_counts(fit.filter("label = 0"), set(in_toxic)).collect()}
    odds = {t: np.log((n + 0.5) / (toxic + 1)) - np.log((in_clean.get(t, 0) + 0.5) / (clean + 1))
            for t, n in in_toxic.items()}
    heavy = sorted((t for t, w in odds.items() if w >= LEAST_ODDS and likelihood_ratio(
                        in_toxic[t], toxic, in_clean.get(t, 0), clean) >= LEAST_RATIO),
                   key=lambda t: (-in_toxic[t] * odds[t], t))[:TERMS]
    lexicon = Lexicon(_without_longer({t: float(min(odds[t], MOST_ODDS)) for t in heavy}),
                      tuple(exceptions))

    def weigh(batches):
        for batch in batches:
            x = lexicon.features(column(batch, "text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "label"), pa.array(x[:, 0]), pa.array(x[:, 1])],
                ["label", "weight", "words"])

    known = sample.filter("not fit") if sizes.get((1, False)) and sizes.get((0, False)) else sample
    points = known.select("label", "text").mapInArrow(
        weigh, "label int, weight double, words double").collect()
    model = logistic(np.array([(p["weight"], p["words"]) for p in points]),
                     np.array([p["label"] for p in points], float), penalty=0.1)
    lexicon.model = tuple(float(w) for w in model)
    return lexicon


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from the threshold on)."""
    ship(docs)

    def score(batches):
        for batch in batches:
            scores = lexicon.scores(row_texts(batch).to_pylist())
            yield with_columns(batch, score=pa.array(scores, pa.float64()),
                               predicted=pa.array((scores >= threshold).astype(np.int32)))

    docs, schema = extended(docs, score="double", predicted="int")
    return keyed(docs).select("row").mapInArrow(score, schema)
