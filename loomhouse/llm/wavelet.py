"""Wavelet matrix: a sequence of ids as bit-planes, with rank and select on each.

Plane k holds bit k (from the highest) of every id, in the order in which the planes before
it have left them: zeros first, then ones, each in their old order. A directory holds the
number of ones before every block, so a position is followed through the planes, or back,
by looking at one block a plane.
"""

from __future__ import annotations

import numpy as np

#: Bits for each entry of the directory of ones.
BLOCK = 512
_HEAD = np.dtype([("length", "<i8"), ("planes", "<i8")])


class WaveletMatrix:
    def __init__(self, length: int, zeros: np.ndarray, bits: list[np.ndarray],
                 ranks: list[np.ndarray]):
        self.length, self.zeros, self.bits, self.ranks = length, zeros, bits, ranks

    @classmethod
    def build(cls, ids: np.ndarray, planes: int) -> WaveletMatrix:
        """From ids below 2**planes."""
        rest = ids.astype(np.uint16 if planes <= 16 else np.uint32)
        zeros, bits, ranks = [], [], []
        for plane in range(planes - 1, -1, -1):
            ones = (rest & rest.dtype.type(1 << plane)) != 0
            packed = np.packbits(ones)
            bits.append(packed)
            counts = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), BLOCK // 8),
                                     dtype=np.uint32) if len(packed) else np.zeros(0, np.uint32)
            ranks.append(np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32))
            low = rest[~ones]
            zeros.append(len(low))
            rest = np.concatenate([low, rest[ones]])
        return cls(len(ids), np.array(zeros, np.int64), bits, ranks)

    def tobytes(self) -> bytes:
        head = np.array([(self.length, len(self.bits))], _HEAD)
        return b"".join([head.tobytes(), self.zeros.astype("<i8").tobytes(),
                         *(b.tobytes() for b in self.bits),
                         *(r.astype("<u4").tobytes() for r in self.ranks)])

    @classmethod
    def frombytes(cls, raw: bytes) -> WaveletMatrix:
        length, planes = (int(x) for x in np.frombuffer(raw, _HEAD, 1)[0])
        at = _HEAD.itemsize
        zeros = np.frombuffer(raw, "<i8", planes, at)
        at += 8 * planes
        wide = -(-length // 8)
        bits = [np.frombuffer(raw, np.uint8, wide, at + k * wide) for k in range(planes)]
        at += planes * wide
        blocks = -(-wide * 8 // BLOCK) + 1
        ranks = [np.frombuffer(raw, "<u4", blocks, at + 4 * k * blocks) for k in range(planes)]
        return cls(length, zeros, bits, ranks)

    def _ones(self, plane: int, position: int) -> int:
        """Ones of a plane before a position."""
        block = position // BLOCK
        total = int(self.ranks[plane][block])
        part = self.bits[plane][block * BLOCK // 8:position // 8]
        total += int(np.bitwise_count(part).sum())
        if position % 8:
            total += (int(self.bits[plane][position // 8]) >> (8 - position % 8)).bit_count()
        return total

    def _places(self, plane: int, bit: int, ranks: np.ndarray) -> np.ndarray:
        """Positions of the zeros or ones of a plane that have these ranks (from 0)."""
        if len(ranks) > self.length // BLOCK:  # about every block is needed
            return np.flatnonzero(np.unpackbits(self.bits[plane], count=self.length) == bit)[ranks]
        starts = self.ranks[plane].astype(np.int64)
        if not bit:
            starts = np.arange(len(starts)) * BLOCK - starts
        block = np.searchsorted(starts, ranks, "right") - 1
        at = block[:, None] * (BLOCK // 8) + np.arange(BLOCK // 8)
        held = np.unpackbits(np.take(self.bits[plane], at, mode="clip"), axis=1) == bit
        nth = np.cumsum(held, axis=1, dtype=np.int32) == (ranks - starts[block] + 1)[:, None]
        return block * BLOCK + nth.argmax(axis=1)

    def access(self, position: int) -> int:
        """The id at a position."""
        value = 0
        for plane in range(len(self.bits)):
            bit = int(self.bits[plane][position // 8]) >> (7 - position % 8) & 1
            ones = self._ones(plane, position)
            position = int(self.zeros[plane]) + ones if bit else position - ones
            value = value << 1 | bit
        return value

    def _range(self, value: int, position: int) -> tuple[int, int]:
        low, high = 0, position
        for plane in range(len(self.bits)):
            a, b = self._ones(plane, low), self._ones(plane, high)
            if value >> (len(self.bits) - 1 - plane) & 1:
                zeros = int(self.zeros[plane])
                low, high = zeros + a, zeros + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, value: int, position: int) -> int:
        """How often an id occurs before a position."""
        if value >> len(self.bits):
            return 0
        low, high = self._range(value, position)
        return high - low

    def count(self, value: int) -> int:
        return self.rank(value, self.length)

    def positions(self, value: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Positions of the occurrences [first, last) of an id: all of them go back up through
        the planes together."""
        if value >> len(self.bits):
            return np.zeros(0, np.int64)
        low, high = self._range(value, self.length)
        at = np.arange(low + first, high if last is None else min(low + last, high))
        for plane in range(len(self.bits) - 1, -1, -1):
            bit = value >> (len(self.bits) - 1 - plane) & 1
            at = self._places(plane, bit, at - int(self.zeros[plane]) if bit else at)
        return at

    def select(self, value: int, nth: int) -> int:
        """Position of the nth occurrence (from 0) of an id."""
        if not 0 <= nth < self.count(value):
            raise IndexError(f"{value} occurs {self.count(value)} times")
        return int(self.positions(value, nth, nth + 1)[0])

    def all(self) -> np.ndarray:
        """The whole sequence, by undoing the planes from the last to the first."""
        wide = np.uint16 if len(self.bits) <= 16 else np.uint32
        rest = np.zeros(self.length, wide)
        for plane in range(len(self.bits) - 1, -1, -1):
            ones = np.unpackbits(self.bits[plane], count=self.length).view(bool)
            zeros = int(self.zeros[plane])
            back = np.empty(self.length, wide)
            back[~ones] = rest[:zeros]
            back[ones] = rest[zeros:] | wide(1 << (len(self.bits) - 1 - plane))
            rest = back
        return rest
