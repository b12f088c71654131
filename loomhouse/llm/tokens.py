"""Token ids of whole texts, with a memory of words.

A vocabulary rarely joins letters across a space, so a text can be cut into parts that are
encoded one by one. Equal parts are found by a 64-bit hash and their length, and each worker
encodes a part once as long as it remembers it. Where a text names an added token of a byte-level
vocabulary (`<|endoftext|>`), it gets that token's id, as from the library by itself.
"""

from __future__ import annotations

import os
import re
from abc import ABC, abstractmethod

import numpy as np

from .common import FIRST, U64, mix

#: Parts that a worker remembers (about 30 bytes each) before it starts afresh.
REMEMBERED = 4_000_000
#: New parts are kept apart up to this number, so that the others stay in order cheaply.
YOUNG = 200_000
#: Words encoded as one text.
TOGETHER = 200

#: A space and a word that ends with a letter or mark.
_WORD = re.compile(r" \S(?:[^ ]*\S)?")
_ENCODERS: dict[str, Encoder] = {}


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; a full path stays as it is."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] numbers), then the same for the next."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


class _Known:
    """Keys in order, each with the place and number of its ids."""

    def __init__(self):
        self.keys = np.zeros(0, U64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def add(self, keys, start, count):
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.start = np.concatenate([self.start, start])[order]
        self.count = np.concatenate([self.count, count])[order]


class Encoder(ABC):
    """Texts, as one byte array with the offsets of its rows, to one array of ids with theirs."""

    def __init__(self, remembered: int = REMEMBERED, young: int = YOUNG):
        self.remembered, self.most_young = remembered, young
        self._forget()

    def _forget(self) -> None:
        self.old, self.young = _Known(), _Known()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    @abstractmethod
    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Places inside of a text at which a part may begin."""

    @abstractmethod
    def encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The parts in some order, their ids one after the other, and the number for each."""

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.old.keys) + len(self.young.keys) > self.remembered:
            self._forget()
        begins = np.zeros(len(data) + 1, bool)
        begins[self.cuts(data)] = True
        begins[offsets] = True
        begins = np.flatnonzero(begins[:-1])
        if not len(begins):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(begins[1:], len(data))
        up, down = FIRST.powers(len(data))
        hashes = np.add.reduceat(FIRST.letters[data] * up, begins) * down[begins]
        keys = mix(hashes + (ends - begins).astype(U64) * U64(0x9E3779B97F4A7C15))
        distinct, sample, place = np.unique(keys, return_index=True, return_inverse=True)
        start, count = self._places(distinct, begins[sample], ends[sample], data)
        counts = count[place]
        ids = self.ids[ragged(start[place], counts)]
        sums = np.concatenate([[0], np.cumsum(counts)])
        return ids, sums[np.searchsorted(begins, offsets)]

    def _places(self, keys, begins, ends, data):
        at, known = self.old.find(keys)
        start, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        start[known], count[known] = self.old.start[at[known]], self.old.count[at[known]]
        at, fresh = self.young.find(keys)
        start[fresh], count[fresh] = self.young.start[at[fresh]], self.young.count[at[fresh]]
        new = np.flatnonzero(~(known | fresh))
        if len(new):
            raw = data.tobytes()
            order, ids, number = self.encode_parts(
                [raw[a:b] for a, b in zip(begins[new].tolist(), ends[new].tolist())])
            count[new[order]] = number
            start[new[order]] = self.used + np.cumsum(number) - number
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
            self.young.add(keys[new], start[new], count[new])
            if len(self.young.keys) > self.most_young:
                self.old.add(self.young.keys, self.young.start, self.young.count)
                self.young = _Known()
        return start, count


def _near_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a space at these places may have white space outside of ASCII beside it."""
    n = len(data)
    after, next_after = data[np.minimum(at + 1, n - 1)], data[np.minimum(at + 2, n - 1)]
    before, next_before = data[at - 1], data[np.maximum(at - 2, 0)]
    narrow = np.array([0x85, 0xA0], np.uint8)
    return (((after >= 0xE1) & (after <= 0xE3)) | ((after == 0xC2) & np.isin(next_after, narrow))
            | ((before >= 0x80) & np.isin(next_before, np.array([0x80, 0x81, 0x9A], np.uint8)))
            | ((next_before == 0xC2) & np.isin(before, narrow)))


class ByteEncoder(Encoder):
    """A byte-level vocabulary of the tokenizers library.

    It splits text before it merges bytes, and a single space between two other characters
    always begins a new part, but for those in an added token or next to one: it is found before
    the text is split, and may take the spaces beside it.
    """

    def __init__(self, path: str, **settings):
        super().__init__(**settings)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added]
        self.names_added = re.compile("|".join(re.escape(t.content) for t in added) or "(?!)")
        # Where they are looked for in normalised text, the text itself does not show them.
        self.whole = self.tokenizer.normalizer is not None and any(t.normalized for t in added)
        tokens = self.tokenizer.get_vocab()
        self.begins_word = np.zeros(max(tokens.values()) + 1, bool)
        self.begins_word[[i for t, i in tokens.items() if t.startswith("Ġ")]] = True

    def size(self) -> int:
        return len(self.begins_word)

    def cuts(self, data):
        if self.whole:
            return np.zeros(0, np.int64)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        single = data[1:-1] == 32
        single &= ~space[:-2]
        single &= ~space[2:]
        at = np.flatnonzero(single) + 1
        odd = np.flatnonzero((data[at - 1] >= 0x80) | (data[at + 1] >= 0x80))
        keep = np.ones(len(at), bool)
        keep[odd] = ~_near_wide_space(data, at[odd])
        raw = data.tobytes()
        for name in self.added:
            found = raw.find(name)
            while found >= 0:
                low, high = np.searchsorted(at, [found - 1, found + len(name) + 1])
                keep[low:high] = False
                found = raw.find(name, found + 1)
        return at[keep]

    def encode_parts(self, parts):
        texts = [p.decode() for p in parts]
        # Words after a single space are joined: each begins at a token that begins with it.
        words = [] if self.whole else [i for i, t in enumerate(texts) if _WORD.fullmatch(t)
                                       and not self.names_added.search(t)]
        lists = [words[k:k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        joined = [("".join([texts[i] for i in chosen]), chosen) for chosen in lists]
        # Words that only name an added token together stay apart.
        joined = [(text, chosen) for text, chosen in joined if not self.names_added.search(text)]
        encoded = self._encoded([text for text, _ in joined])
        ids, counts, order = [], [], []
        for (_, chosen), found in zip(joined, encoded):
            begins = np.flatnonzero(self.begins_word[found])
            if len(begins) == len(chosen):
                ids.append(found)
                counts.append(np.diff(np.append(begins, len(found))))
                order += chosen
        done = set(order)
        rest = [i for i in range(len(texts)) if i not in done]
        for found in self._encoded([texts[i] for i in rest]):
            ids.append(found)
            counts.append(np.array([len(found)]))
        return np.array(order + rest), np.concatenate(ids), np.concatenate(counts)

    def _encoded(self, texts):
        return [np.array(e.ids, np.uint32) for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def byte_encoder(name: str) -> ByteEncoder:
    """The encoder of this worker for a vocabulary file."""
    if name not in _ENCODERS:
        _ENCODERS[name] = ByteEncoder(vocabulary(name))
    return _ENCODERS[name]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's ids followed by `end_id`."""
    rows = len(offsets) - 1
    out = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
    return out, offsets + np.arange(rows + 1)
