"""Quality of texts: plain counts, and a classifier of hashed words and letter sequences.

The classifier is a logistic regression on the mean weights of a text's runs of `WORD_RUNS`
words and of its runs of `RUNS` code points, each hashed to a table of weights, trained on
labelled documents and calibrated (Platt) on others. Counts and scores are taken from Arrow batches and held
against fixed thresholds.

Rows: a missing text has no words. A text without words has all counts 0 and fails. Without
labels of both kinds only the counts decide. An empty table gives an empty result. Other
columns are carried along; any named like the result's, in any case, are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import (FIRST, U64, byte_rows, column, extended, groups, keyed, mix, row_texts, ship,
                     with_columns, words)
from .labelled import logistic, probability, training_sample

#: Labelled documents trained on, at most.
TRAINING_ROWS = 4_000
#: Lengths of the runs of words and of code points that are features; each length is a kind, with
#: a table of weights.
WORD_RUNS, RUNS = (1, 2, 3), (3, 5)
KINDS, TABLE_BITS = len(WORD_RUNS) + len(RUNS), 18
#: Passes of training, and the size of a step.
PASSES, STEP = 80, 1.0
#: Least calibrated probability of good quality.
THRESHOLD = 0.5
LEAST_WORDS, MOST_REPEATED, REPEAT_WINDOW = 10, 20, 5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """How many equal (row, value) pairs there are, for each pair."""
    order = np.lexsort((value, row))
    new = np.ones(len(order), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (value[order][1:] != value[order][:-1])
    group = np.cumsum(new) - 1
    times = np.empty(len(order), np.int64)
    times[order] = np.bincount(group)[group] if len(group) else 0
    return times


def count_features(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each row of texts."""
    rows = len(offsets) - 1
    found = words(data, offsets)
    n_words = np.bincount(found.row, minlength=rows)
    solid = np.zeros(len(data) + 1, np.int64)
    np.add.at(solid, found.starts, 1)
    np.add.at(solid, found.ends, -1)
    letters = (np.cumsum(solid)[:-1] > 0) & ((data & 0xC0) != 0x80)
    # Lines: what lies between line feeds, and the ends of texts.
    cut = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10), [len(data)]]))
    begin = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
    begin = begin[begin < len(data)]
    end = cut[np.searchsorted(cut, begin, "left")]
    end = np.where(data[begin] == 10, begin, cut[np.minimum(
        np.searchsorted(cut, begin, "right"), len(cut) - 1)]) if len(begin) else end
    line_row = np.searchsorted(offsets, begin, "right") - 1
    held = np.searchsorted(found.starts, end) > np.searchsorted(found.starts, begin)
    begin, end, line_row = begin[held], end[held], line_row[held]
    value = mix(FIRST.spans(FIRST.letters[data], begin, end) + (end - begin).astype(U64))
    times = _repeated(line_row, value)
    # All but one of each group of equal lines.
    extra = np.bincount(line_row, 1 - 1 / np.maximum(times, 1), rows) if len(times) else \
        np.zeros(rows)
    n = REPEAT_WINDOW
    hashes = found.hashes(data, FIRST)
    whole = np.flatnonzero(found.whole(n))
    times = _repeated(found.row[whole], mix(FIRST.runs(hashes, n))[whole]) if len(whole) else whole
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, whole[times > 1], 1)
    np.add.at(cover, whole[times > 1] + n, -1)
    repeated = np.cumsum(cover)[:-1] > 0
    return {"n_words": n_words, "word_chars": _per_row(letters, offsets),
            "n_symbols": _per_row(_SYMBOL[data], offsets),
            "n_dup_lines": np.rint(extra).astype(np.int64),
            "n_repeat_words": np.bincount(found.row[repeated], minlength=rows)}


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of every code point."""
    letters = FIRST.letters[data]
    if not len(data) or data.max() < 0x80:
        return np.arange(len(data)), letters
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    ends = np.append(starts[1:], len(data))
    value = letters[starts]
    wide = ends - starts > 1
    value[wide] = mix(FIRST.spans(letters, starts[wide], ends[wide]))
    return starts, value


def hashed_features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, place in its table) of every run of words, and of every run of code points, of each
    length."""
    shift = U64(64 - TABLE_BITS)
    found = words(data, offsets)
    starts, letters = _code_points(data)
    row = np.searchsorted(offsets, starts, "right") - 1
    kinds = []
    for rows, values, lengths in ((found.row, found.hashes(data, FIRST), WORD_RUNS),
                                  (row, letters, RUNS)):
        for n in lengths:
            last = max(len(values) + 1 - n, 0)
            whole = rows[:last] == rows[n - 1:n - 1 + last]
            place = (mix(FIRST.runs(values, n))[whole] >> shift).astype(np.int64)
            kinds.append((rows[:last][whole], place))
    return kinds


@dataclass
class Classifier:
    """A table of weights for each kind of runs, the constant, and the calibration."""

    tables: list[np.ndarray]
    constant: float
    calibration: tuple[float, float] = (1.0, 0.0)

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        total = np.full(rows, self.constant)
        for table, (row, place) in zip(self.tables, hashed_features(data, offsets)):
            number = np.maximum(np.bincount(row, minlength=rows), 1)
            total += np.bincount(row, table[place], rows) / number
        return total

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        a, b = self.calibration
        return probability(a * self.margins(data, offsets) + b)


def _sparse(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value: the share of a feature among those of its kind; by rows."""
    rows, places, values = [], [], []
    for kind, (row, place) in enumerate(hashed_features(data, offsets)):
        number = np.maximum(np.bincount(row, minlength=len(offsets) - 1), 1)
        pair, times = np.unique((row << TABLE_BITS) + place, return_counts=True)
        at = pair >> TABLE_BITS
        rows.append(at)
        places.append(((pair & ((1 << TABLE_BITS) - 1)) + (kind << TABLE_BITS)).astype(np.int32))
        values.append((times / number[at]).astype(np.float32))
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return row[order], np.concatenate(places)[order], np.concatenate(values)[order]


def _features(batches):
    """The features of each text, made where the texts are: of a text of any length no more than
    there are places in the tables."""
    for batch in batches:
        data, offsets = byte_rows(column(batch, "text"))
        for low, high in groups(offsets):
            row, place, value = _sparse(data[offsets[low]:offsets[high]],
                                        offsets[low:high + 1] - offsets[low])
            edge = np.searchsorted(row, np.arange(high - low + 1)).tolist()
            part = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays(
                [column(part, "label"), column(part, "fit"),
                 *(pa.array([x[a:b].tobytes() for a, b in zip(edge, edge[1:])], pa.binary())
                   for x in (place, value))], ["label", "fit", "places", "shares"])


def fit_classifier(doc: np.ndarray, place: np.ndarray, value: np.ndarray, labels: np.ndarray,
                   passes: int = PASSES, step: float = STEP) -> tuple[np.ndarray, float]:
    """Weights of all features and the constant: logistic regression by Adam steps over all texts
    at once; both classes weigh the same."""
    size, texts = KINDS << TABLE_BITS, len(labels)
    weights, constant = np.zeros(size), 0.0
    first, second, both = np.zeros(size), np.zeros(size), np.zeros(2)
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    for t in range(1, passes + 1):
        margin = np.bincount(doc, weights[place] * value, texts) + constant
        error = (probability(margin) - labels) * share
        slope = np.bincount(place, error[doc] * value, size) + 1e-7 * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        weights -= step * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
        both = both * (0.9, 0.99) + (0.1 * error.sum(), 0.01 * error.sum() ** 2)
        constant -= 0.1 * both[0] / (1 - 0.9 ** t) / (np.sqrt(both[1] / (1 - 0.99 ** t)) + 1e-8)
    return weights, float(constant)


def _side(rows):
    """Features and labels of some texts."""
    place = [np.frombuffer(r["places"], np.int32) for r in rows]
    value = [np.frombuffer(r["shares"], np.float32) for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(p) for p in place])
    return doc, np.concatenate(place), np.concatenate(value), np.array([r["label"] for r in rows],
                                                                       float)


def _train(batches):
    """One row of bytes: the weights of a classifier for the sample."""
    rows = sorted((r for b in batches for r in b.to_pylist()),
                  key=lambda r: (r["label"], r["fit"], r["places"], r["shares"]))
    kinds = {(r["label"], r["fit"]) for r in rows}
    if {(0, True), (1, True)} <= kinds:
        fit = [r for r in rows if r["fit"]]
        weights, constant = fit_classifier(*_side(fit))
        check = [r for r in rows if not r["fit"]] if {(0, False), (1, False)} <= kinds else fit
        doc, place, value, labels = _side(check)
        margins = np.bincount(doc, weights[place] * value, len(check)) + constant
        a, b = logistic(margins[:, None], labels, penalty=0.01)
        raw = np.concatenate([[constant, a, b], weights]).astype("<f4").tobytes()
        yield pa.RecordBatch.from_pydict({"weights": [raw]})


def learn_classifier(docs: DataFrame, labels: DataFrame, label: str = "quality",
                     rows: int = TRAINING_ROWS) -> Classifier | None:
    """Classifier from at most `rows` labelled documents: their features are made where the texts
    are, and one task fits the weights to them."""
    ship(docs)
    sample = training_sample(docs, labels, label, rows)
    made = sample.mapInArrow(_features, "label int, fit boolean, places binary, shares binary")
    found = made.repartition(1).mapInArrow(_train, "weights binary").collect()
    if not found:
        return None
    raw = np.frombuffer(bytes(found[0]["weights"]), "<f4")
    return Classifier(list(raw[3:].reshape(KINDS, -1)), float(raw[0]),
                      (float(raw[1]), float(raw[2])))


def judge_quality(docs: DataFrame, classifier: Classifier | None,
                  threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with the counts, `base_failed`, the calibrated probability `quality_score` (1
    without a classifier) and `kept`."""
    ship(docs)

    def judge(batches):
        for batch in batches:
            data, offsets = byte_rows(row_texts(batch))
            for low, high in groups(offsets):
                part = data[offsets[low]:offsets[high]]
                edges = offsets[low:high + 1] - offsets[low]
                counts = count_features(part, edges)
                score = (np.ones(high - low) if classifier is None
                         else classifier.probabilities(part, edges))
                failed = ((counts["n_words"] < LEAST_WORDS)
                          | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"]))
                yield with_columns(
                    batch.slice(low, high - low),
                    **{name: pa.array(counts[name], pa.int64()) for name in COUNTS},
                    base_failed=pa.array(failed), quality_score=pa.array(score),
                    kept=pa.array(~failed & (score >= threshold)))

    docs, schema = extended(docs, **dict.fromkeys(COUNTS, "long"), base_failed="boolean",
                            quality_score="double", kept="boolean")
    return keyed(docs).select("row").mapInArrow(judge, schema)
