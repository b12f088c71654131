"""Spelling variants: words of the vocabulary that differ by one character.

Words are compared through a bit-sliced index: for each (position, letter) a bitset over the
words of a bucket. For one word, recurrences over its letters carry four sets of all words at
once: those equal so far, and those that have had one letter replaced, one more, or one less,
the last two read at positions shifted by one. A set is one whole number, a step one operation
on it. The words of a bucket are ordered by descending number of occurrences, so the lowest
bit of the result is the best near word and the count of its bits their number: no pairs are
written.

Buckets: two words of n and n or n + 1 letters that differ by one letter agree in their first or
in their last n // 2 letters. So each word goes to the buckets of its beginnings and ends, once
for the shorter length n being its own and once for n being one less. A bucket of more than
`BUCKET` words is split by the same rule over the letters that its words do not share yet, again
and again; where a single letter is left free it holds at most 90 + 90 * 90 words, as words have
90 different letters. Pairs that agree in both halves are counted in the bucket of the first.

Rows: each row counts, also where doc_id is missing (then empty in the text that is hashed) or
repeats; missing texts have no words; an empty table gives an empty result. Only doc_id and
text are read, so further columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import column, ship

#: Code points and occurrences a word has at least.
LETTERS, OCCURRENCES = 5, 3
#: Of the runs whose hash this number divides, one letter is deleted.
MISSPELT = 97
#: A word's form occurs at least so many times as often as it.
TIMES = 2
#: Words of a bucket; above, it is split.
BUCKET = 2048
#: Different words a task holds before it passes on their counts.
HELD = 200_000

_RUNS = re.compile("[a-zÀ-ÿ]+").findall


# --- vocabulary ----------------------------------------------------------------------------

def misspelt(word: str, digest: int) -> str:
    """The word without its letter `digest` % length, if `MISSPELT` divides `digest`."""
    if digest % MISSPELT:
        return word
    at = digest % len(word)
    return word[:at] + word[at + 1:]


def _count_words(letters: int):
    def passed_on(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()),
                                           "n": pa.array(list(counts.values()), pa.int64())})

    def count(batches):
        counts: Counter[str] = Counter()
        crc = zlib.crc32
        for batch in batches:
            for doc, text in zip(column(batch, "doc").to_pylist(),
                                 column(batch, "text").to_pylist()):
                if not text:
                    continue
                begun = crc(f"{doc}:".encode())
                # bytes.lower() changes A-Z only.
                for word, n in Counter(_RUNS(text.lower().decode())).items():
                    if len(word) >= letters:
                        counts[misspelt(word, crc(word.encode(), begun))] += n
                if len(counts) > HELD:
                    yield passed_on(counts)
                    counts = Counter()
        yield passed_on(counts)
    return count


def vocabulary(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES
               ) -> DataFrame:
    """(word, n): words of at least `letters` code points, with at least `occurrences`.

    Runs shorter than a word must be are left out: deleting only shortens them.
    """
    ship(docs)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    counted = rows.mapInArrow(_count_words(letters), "word string, n long")
    return (counted.filter(F.char_length("word") >= letters)
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences))


# --- buckets -------------------------------------------------------------------------------

def _free(short, begin, end):
    return short - begin - end


def _entries(words: DataFrame) -> DataFrame:
    """Each word as the shorter and as the longer of a pair, with nothing shared yet: `short`
    is the length of the shorter, `begin` and `end` the letters known to be shared, and
    `met` the beginnings whose sharers meet in another bucket."""
    size = F.char_length("word")
    return words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short"),
                        F.lit(0).alias("begin"), F.lit(0).alias("end"),
                        F.array().cast("array<int>").alias("met"))


def _halves(entries: DataFrame) -> DataFrame:
    """Entries with half of the free letters more shared at the beginning, or at the end."""
    half = F.floor(_free(F.col("short"), F.col("begin"), F.col("end")) / 2).cast("int")
    first = F.struct((F.col("begin") + half).alias("begin"), F.col("end"), F.col("met"))
    last = F.struct(F.col("begin"), (F.col("end") + half).alias("end"),
                    F.concat("met", F.array(F.col("begin") + half)).alias("met"))
    split = entries.select("word", "n", "short", F.explode(F.array(first, last)).alias("to"))
    bucket = F.struct(
        "short", "to.begin", "to.end", F.col("word").substr(F.lit(1), F.col("to.begin")).alias("head"),
        F.when(F.col("to.end") > 0, F.expr("right(word, to.end)")).alias("tail"), "to.met")
    return split.select("word", "n", "short", "to.*", bucket.alias("bucket"))


def bucketed(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Entries by buckets of at most `bucket` words, or of words with one letter free."""
    entries, done = _halves(_entries(words)), []
    while True:
        entries = stage(entries, "bucketed")
        # One row for each large bucket: Spark broadcasts the table if its stored size is small.
        large = stage(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("words"))
                      .filter((F.col("words") > bucket) & (_free(
                          F.col("bucket.short"), F.col("bucket.begin"), F.col("bucket.end")) > 1))
                      .select("bucket"), "large")
        if large.isEmpty():
            break
        done.append(entries.join(large, "bucket", "left_anti").select(*entries.columns))
        entries = _halves(entries.join(large, "bucket", "left_semi").drop("bucket"))
    for part in done:
        entries = entries.unionByName(part)
    return entries


# --- index ---------------------------------------------------------------------------------

class BitIndex:
    """For each position and letter the set of words that have it there."""

    def __init__(self, words: list[str]):
        places: list[dict[str, list[int]]] = []
        sizes: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            sizes.setdefault(len(word), []).append(i)
            while len(places) < len(word):
                places.append({})
            for place, letter in zip(places, word):
                place.setdefault(letter, []).append(i)
        self.all, self.words = (1 << len(words)) - 1, len(words)
        self.sizes = {n: self._set(members) for n, members in sizes.items()}
        self.places = [{c: self._set(members) for c, members in place.items()}
                       for place in places]
        # Words with a letter at each place.
        self.reach = [self._set([i for members in place.values() for i in members])
                      for place in places]

    def _set(self, members: list[int]) -> int:
        if len(members) < 16:
            found = 0
            for i in members:
                found |= 1 << i
            return found
        bits = np.zeros(self.words if hasattr(self, "words") else max(members) + 1, np.uint8)
        bits[members] = 1
        return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")

    def near(self, word: str, size: int, shorter: int, met: tuple[int, ...] = ()) -> int:
        """Words one letter from `word`. For a shorter length of `size`, its own, one letter
        replaced or one more; for `size` less one, one letter less. Words that share one
        of the beginnings `met` are left out."""
        same, more, other, less = self.all, 0, 0, 0
        seen = 0
        if shorter < size:
            for i, letter in enumerate(word):
                if i in met:
                    seen |= same
                less = (less & self._at(i - 1, letter)) | same
                same &= self._at(i, letter)
            found = less & self.sizes.get(size - 1, 0)
        else:
            for i, letter in enumerate(word):
                if i in met:
                    seen |= same
                here = self._at(i, letter)
                reach = self.reach[i] if i < len(self.reach) else 0
                other = (other & here) | (same & reach & ~here)
                more = (more | same) & self._at(i + 1, letter)
                same &= here
            found = (other & self.sizes.get(size, 0)) | (
                (more | same) & self.sizes.get(size + 1, 0))
        if size in met:
            seen |= same
        return found & ~seen

    def _at(self, place: int, letter: str) -> int:
        return self.places[place].get(letter, 0) if 0 <= place < len(self.places) else 0


def _near_words(words: list[str], counts: list[int], short: int, begin: int, end: int,
                met: tuple[int, ...]) -> Iterator[tuple[str, int, int, str]]:
    """For each word of a bucket that has near words there: their number and the best."""
    order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
    words, counts = [words[i] for i in order], [counts[i] for i in order]
    # All words of a bucket share the rest.
    free = [w[begin:len(w) - end] for w in words]
    index = BitIndex(free)
    inner, met = short - begin - end, tuple(m - begin for m in met)
    for word, part in zip(words, free):
        found = index.near(part, len(part), inner, met)
        if found:
            best = (found & -found).bit_length() - 1
            yield word, found.bit_count(), counts[best], words[best]


_FOUND = "word string, n_near long, near_n long, near string"


def _compare(batches):
    """Words come in the order of their buckets; one bucket is held at a time."""
    held: list[dict] = []
    key, out = None, []

    def flushed():
        if len(held) > 1:
            _, short, begin, end, met = key
            out.extend(_near_words([w for w, _ in held], [n for _, n in held],
                                   short, begin, end, met))

    def table():
        cells = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(cells[0], pa.string()), pa.array(cells[1], pa.int64()),
             pa.array(cells[2], pa.int64()), pa.array(cells[3], pa.string())],
            ["word", "n_near", "near_n", "near"])

    for batch in batches:
        rows = zip(*(column(batch, c).to_pylist() for c in
                     ("shared", "short", "begin", "end", "met", "word", "n")))
        for shared, short, begin, end, met, word, n in rows:
            at = (shared, short, begin, end, tuple(met))
            if at != key:
                flushed()
                key, held = at, []
            held.append((word, n))
        if len(out) >= 10_000:
            yield table()
            out.clear()
    flushed()
    yield table()


def near_words(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """For each of `words` (word, n): the number of its near words, and the one with the largest
    n (of several the first in code-point order)."""
    ship(words)
    entries = bucketed(words, bucket).select(
        F.concat(F.coalesce("bucket.head", F.lit("")), F.lit("|"),
                 F.coalesce("bucket.tail", F.lit(""))).alias("shared"),
        "short", "begin", "end", "met", "word", "n")
    place = ["shared", "short", "begin", "end", "met"]
    found = (entries.repartition(*place).sortWithinPartitions(*place)
             .mapInArrow(_compare, _FOUND))
    lone = words.select("word", F.lit(0).cast("long").alias("n_near"),
                        F.lit(None).cast("long").alias("near_n"),
                        F.lit(None).cast("string").alias("near"), "n")
    both = found.withColumn("n", F.lit(None).cast("long")).unionByName(lone)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct(
        (-F.col("near_n")).alias("order"), F.col("near"))))
    return both.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n", "n_near", (-F.col("best.order")).alias("near_n"),
        F.col("best.near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last. Each round doubles the steps taken; forms
    occur ever more often, so a chain has fewer than 64 words and the rounds end."""
    known = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("_at"), F.col("root").alias("_ahead"))
        nearer = stage(known.join(ahead, F.col("root") == F.col("_at"), "left").select(
            "word", F.coalesce("_ahead", "root").alias("root"),
            F.col("_ahead").isNotNull().alias("moved")), "roots")
        known = nearer.select("word", "root")
        if nearer.filter("moved").isEmpty():
            return known


def spelling_forms(words: DataFrame, times: int = TIMES, bucket: int = BUCKET) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for `words` (word, n)."""
    words = stage(words.select("word", "n"), "vocabulary")
    near = near_words(words, bucket)
    often = F.col("near_n") >= times * F.col("n")
    formed = stage(near.select("word", F.when(often, F.col("near")).alias("form"), "n", "n_near",
                               F.when(often, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_groups(docs: DataFrame) -> DataFrame:
    return spelling_forms(vocabulary(docs))
