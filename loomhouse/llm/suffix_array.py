"""Suffix arrays of byte strings by induced sorting, in array operations.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour. The
substrings between leftmost S places are put in order and named; the order of the suffixes
that begin there follows from the names by recursive pairing of neighbours. One pass up the
first letters then induces all L suffixes and one pass down all S suffixes. A pass takes
what a letter's bucket holds at once, and what that puts into the same bucket afterwards.
"""

from __future__ import annotations

import numpy as np

from .common import FIRST

#: Letters hashed at a time.
SLICE = 1 << 18


def _classes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is S, and the leftmost S places (first place excluded)."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    small = np.zeros(n, bool)
    rises = text[change] < text[change + 1]
    lengths = np.diff(np.concatenate([[-1], change]))
    small[:n - 1] = np.repeat(rises, lengths) if len(change) == 0 or change[-1] == n - 2 else \
        np.concatenate([np.repeat(rises, lengths), np.zeros(n - 2 - change[-1], bool)])
    small[n - 1] = True
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    return small, left


def _induce(text, small, sorted_left, starts, ends):
    """All suffixes in order, from those at the leftmost S places in order."""
    n = len(text)
    order = np.full(n, -1, np.int32)
    head, tail = starts.copy(), ends.copy()
    first_left = ends.copy()
    # Leftmost S suffixes go to the ends of their buckets, in order.
    letters = text[sorted_left]
    sizes = np.bincount(letters, minlength=len(starts))
    first_left -= sizes
    order[np.repeat(first_left - np.cumsum(sizes) + sizes, sizes)
          + np.arange(len(sorted_left))] = sorted_left

    def place_up(found):
        before = found[found > 0] - 1
        before = before[~small[before]]
        if not len(before):
            return
        letter = text[before]
        by = np.argsort(letter, kind="stable")
        letter, before = letter[by], before[by]
        new = np.flatnonzero(np.append(True, letter[1:] != letter[:-1]))
        size = np.diff(np.append(new, len(letter)))
        key = letter[new]
        order[np.repeat(head[key] - new, size) + np.arange(len(letter))] = before
        head[key] += size

    def place_down(found):
        before = found[found > 0] - 1
        before = before[small[before]]
        if not len(before):
            return
        letter = text[before]
        by = np.argsort(letter, kind="stable")
        letter, before = letter[by], before[by]
        new = np.flatnonzero(np.append(True, letter[1:] != letter[:-1]))
        size = np.diff(np.append(new, len(letter)))
        key = letter[new]
        order[np.repeat(tail[key] - 1 + new, size) - np.arange(len(letter))] = before
        tail[key] -= size

    for c in range(len(starts)):
        if starts[c] == ends[c]:
            continue
        done = starts[c]
        while done < head[c]:
            upto = head[c]
            place_up(order[done:upto])
            done = upto
        if first_left[c] < ends[c]:
            place_up(order[first_left[c]:ends[c]])
    larger = head  # end of the L part of each bucket
    for c in range(len(starts) - 1, -1, -1):
        if starts[c] == ends[c]:
            continue
        done = ends[c]
        while done > tail[c]:
            upto = tail[c]
            place_down(order[upto:done][::-1])
            done = upto
        if larger[c] > starts[c]:
            place_down(order[starts[c]:larger[c]][::-1])
    return order


def _order_of_names(names: np.ndarray, enough: int) -> np.ndarray:
    """Order of the suffixes of a sequence of names: pairs of neighbouring names are named
    anew, then pairs of pairs, until all differ or each name stands for `enough`."""
    n, reach = len(names), 1
    while reach < enough:
        top = int(names.max()) + 1
        if top == n:
            break
        right = np.zeros(n, np.int64)
        right[:n - reach] = names[reach:] + 1 if reach < n else 0
        pairs = names * (top + 1) + right
        by = np.argsort(pairs)
        pairs = pairs[by]
        new = np.append(False, pairs[1:] != pairs[:-1])
        names = np.empty(n, np.int64)
        names[by] = np.cumsum(new)
        reach *= 2
        if reach >= n and int(names.max()) + 1 == n:
            break
    return np.argsort(names, kind="stable")


def _substring_values(text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and size of the substrings from each leftmost S place to the next one, inclusive."""
    stop = np.append(left[1:] + 1, len(text))
    values, low = np.empty(len(left), np.uint64), 0
    while low < len(left):
        high = max(low + 1, int(np.searchsorted(stop, left[low] + SLICE, "right")))
        begin, end = left[low], stop[high - 1]
        letters = text[begin:end].astype(np.uint64)
        letters = FIRST.letters[letters & np.uint64(255)] + (letters << np.uint64(20))
        values[low:high] = FIRST.spans(letters, left[low:high] - begin, stop[low:high] - begin)
        low = high
    return values, stop - left


def _named(text: np.ndarray, small: np.ndarray, left: np.ndarray, starts: np.ndarray,
           ends: np.ndarray) -> np.ndarray:
    """Names of the substrings that begin at the leftmost S places, in order of the text."""
    # Letters first: induction from any order of the leftmost S places puts their substrings
    # in order.
    rough = _induce(text, small, left[np.argsort(text[left], kind="stable")], starts, ends)
    is_left = np.zeros(len(text), bool)
    is_left[left] = True
    found = np.searchsorted(left, rough[is_left[rough]])
    del rough, is_left
    value, size = _substring_values(text, left)
    value, size = value[found], size[found]
    fresh = np.zeros(len(found), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (size[1:] != size[:-1])
    names = np.empty(len(left), np.int64)
    names[found] = np.cumsum(fresh)
    return names


def suffix_order(text: np.ndarray, enough: int) -> np.ndarray:
    """Order of all suffixes of `text` (small integers).

    Suffixes whose first `enough` letters agree may come in any order.
    """
    # A letter below all others ends the text; its suffix comes first and is left out.
    # 16-bit letters are put in order by counting.
    text = np.append(text.astype(np.uint16) + np.uint16(1), np.uint16(0))
    n = len(text)
    if n < 3:
        return np.arange(n - 1)
    counts = np.bincount(text)
    ends = np.cumsum(counts)
    starts = ends - counts
    small, left = _classes(text)
    if not len(left):
        return _induce(text, small, np.zeros(0, np.int32), starts, ends)[1:]
    # Each name stands for two letters at least (an S place, then an L place).
    ordered = left[_order_of_names(_named(text, small, left, starts, ends), enough)]
    return _induce(text, small, ordered.astype(np.int32), starts, ends)[1:]


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of a text of bytes, how many its suffix shares with the one before it
    in `order`.

    Counted in text order (permuted): the count drops by one from a place to the next where
    the letters before both suffixes agree, so only the other places are compared, eight
    letters at a time.
    """
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    # The neighbour of the previous place must be the place before this neighbour.
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (before[:-1] == before[1:] - 1)
    at = np.flatnonzero(follows)
    follows[at] = text[at - 1] == text[before[at] - 1]
    live = np.flatnonzero(~follows & (before >= 0))
    del at
    # The eight letters from every place, read where they lie.
    padded = np.concatenate([text.astype(np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray((n + 1,), ">u8", padded, strides=(1,))
    counted, shift = np.zeros(n, np.int32), 0
    while len(live):
        other = before[live] + shift
        inside = (live + shift < n) & (other < n)
        live, other = live[inside], other[inside]
        differs = eight[live + shift].astype(np.uint64) ^ eight[other].astype(np.uint64)
        same = np.zeros(len(live), np.int32)
        for k in range(8):
            same += differs < np.uint64(1 << (8 * k))
        # Nothing is shared beyond the end of the text.
        same = np.minimum(same, n - np.maximum(live + shift, other)).astype(np.int32)
        counted[live] += same
        live, shift = live[same == 8], shift + 8
    places = np.arange(n, dtype=np.int32)
    base = np.maximum.accumulate(np.where(follows, np.int32(0), places))
    places -= base
    return counted[base] - places
