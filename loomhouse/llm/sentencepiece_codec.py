"""Exact SentencePiece BPE ids, by a table of the last token of every prefix.

BPE joins the neighbours whose joint piece has the highest score, the leftmost first. Each
prefix of a text has one last token: of the pieces that an automaton finds to end there, the
only one that is whole by itself and compatible with the last token of the prefix before
it. Two tokens are compatible if joining their letters gives just the two. Following
the last tokens back from the end gives the ids.

Pieces never go on after a space that follows another letter, so parts between such spaces
are encoded one by one and remembered (`tokens.Encoder`). A letter without a piece becomes
its bytes and joins with nothing. Runs of spaces share one score, so a part with such a run is
joined step by step instead.

Rows: a missing text counts as empty and has no ids. An empty table gives an empty result.
Other columns are carried along; any named `ids` or `decoded`, in any case, are replaced.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_rows, extended, groups, keyed, row_texts, ship, with_columns
from .tokens import _ENCODERS, Encoder, ragged, vocabulary

VOCABULARY = "piece_bpe_32k.model"
#: How SentencePiece writes a space.
SPACE = "▁"
#: Pairs whose compatibility a worker remembers.
PAIRS = 1_000_000


class PieceEncoder(Encoder):
    def __init__(self, path: str, **settings):
        super().__init__(**settings)
        import ahocorasick
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte_ids = np.zeros(256, np.uint32)
        self.pieces: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes_of = [b""] * size
        self.is_byte = np.zeros(size, bool)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of[i], self.is_byte[i] = bytes([int(piece[1:-1], 16)]), True
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece], self.score[piece] = i, model.get_score(i)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        self.text_of = {i: p for p, i in self.pieces.items()}
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = {c for piece in self.pieces for c in piece}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.pieces):
            raise ValueError("pieces of this model go on after a space")
        self.alone = {piece for piece in self.pieces if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.pieces.items():
            if (set(piece) != {SPACE} or piece == SPACE) and self.joined(piece) == [piece]:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        #: Keyed by left id * number of pieces + right id.
        self.size, self.pairs = size, {}

    # --- joining step by step ----------------------------------------------------------

    def joined(self, letters: str) -> list[str]:
        """BPE as defined: the best pair, leftmost first, until none is a piece."""
        n = len(letters)
        part: list = list(letters)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []

        def offer(i):
            j = after[i]
            if j < n and (s := self.score.get(part[i] + part[j])) is not None:
                heapq.heappush(queue, (-s, i, part[i] + part[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, piece = heapq.heappop(queue)
            j = after[i] if part[i] is not None else n
            if j >= n or part[i] + part[j] != piece:
                continue
            part[i], part[j] = piece, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in part if p is not None]

    # --- table of prefixes ---------------------------------------------------------------

    def _compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        a, b = self.text_of[left], self.text_of[right]
        known = self.pairs[left * self.size + right] = self.joined(a + b) == [a, b]
        return known

    def last_tokens(self, letters: str) -> list[tuple[int, int]]:
        """Id and length of the last token of letters[:1], letters[:2], ...; every letter
        has a piece."""
        last: list = [None] * len(letters)
        known, size = self.pairs.get, self.size
        for end, token in self.automaton.iter(letters):
            if last[end] is None:
                before = end - token[1]
                if before >= 0:
                    left = last[before][0]
                    fits = known(left * size + token[0])
                    if fits is None:
                        fits = self._compatible(left, token[0])
                    if not fits:
                        continue
                last[end] = token
        return last

    def _known_letters(self, letters: str) -> list[int]:
        if SPACE * 2 in letters:
            return [self.pieces[p] for p in self.joined(letters)]
        last, ids, end = self.last_tokens(letters), [], len(letters) - 1
        while end >= 0:
            token, size = last[end]
            ids.append(token)
            end -= size
        return ids[::-1]

    def part_ids(self, part: str) -> list[int]:
        """Ids of a part, written with `SPACE`."""
        if self.alone.issuperset(part):
            return self._known_letters(part)
        ids, known = [], ""
        for c in part:
            if c in self.alone:
                known += c
                continue
            ids += self._known_letters(known) if known else []
            known = ""
            ids += self.byte_ids[list(c.encode())].tolist()
        return ids + (self._known_letters(known) if known else [])

    # --- whole texts -----------------------------------------------------------------------

    def cuts(self, data):
        mark = SPACE.encode()
        space = np.zeros(len(data) + 3, bool)
        space[:len(data)] = data == 32
        wide = np.flatnonzero(data[:-2] == mark[0])
        wide = wide[(data[wide + 1] == mark[1]) & (data[wide + 2] == mark[2])]
        inside = np.zeros(len(data) + 3, bool)
        for k in range(3):
            inside[wide + k] = True
        begin = space.copy()
        begin[wide] = True
        begin[1:] &= ~(space | inside)[:-1]
        return np.flatnonzero(begin[:len(data)])

    def encode_parts(self, parts):
        found = [self.part_ids(p.decode().replace(" ", SPACE)) for p in parts]
        return (np.arange(len(parts)), np.array([i for ids in found for i in ids], np.uint32),
                np.array([len(f) for f in found], np.int64))

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts: those that are not empty begin with a space of their own."""
        some = np.diff(offsets) > 0
        led = np.insert(data, offsets[:-1][some], np.uint8(32))
        return self.encode(led, offsets + np.concatenate([[0], np.cumsum(some)]))

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of rows of ids: pieces and bytes in turn, without the space of their own."""
        sizes = self.sizes[ids]
        raw = self.flat[ragged(self.starts[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
        texts = []
        for row, (a, b) in enumerate(zip(ends, ends[1:])):
            begin = a + 1 if raw[a:a + 1] == b" " and not self.is_byte[ids[offsets[row]]] else a
            texts.append(raw[begin:b].decode("utf-8", "replace"))
        return texts


def piece_encoder(name: str) -> PieceEncoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = PieceEncoder(vocabulary(name))
    return _ENCODERS[name]


def _coder(name):
    def code(batches):
        encoder = piece_encoder(name)
        for batch in batches:
            data, offsets = byte_rows(row_texts(batch))
            for low, high in groups(offsets):
                ids, at = encoder.encode_texts(data[offsets[low]:offsets[high]],
                                               offsets[low:high + 1] - offsets[low])
                yield with_columns(
                    batch.slice(low, high - low),
                    ids=pa.ListArray.from_arrays(pa.array(at, pa.int32()),
                                                 pa.array(ids.astype(np.int32))),
                    decoded=pa.array(encoder.decode(ids, at), pa.string()))
    return code


def encode_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """`docs` with the `ids` of each text, and the text `decoded` from them."""
    ship(docs)
    docs, schema = extended(docs, ids="array<int>", decoded="string")
    return keyed(docs).select("row").mapInArrow(_coder(vocabulary), schema)
