"""An n-gram trie of two levels in Elias-Fano sequences, in one memory-mapped file.

A non-decreasing sequence is kept as the low bits of its values, packed, and a bit vector of the
high parts with one bit set for each value. The number of set bits before each 64-bit word is the
only directory: a search finds the word of a high part in it and ends inside that word.

Level 1 holds the contexts, pointers to where their successors begin, and a quantised backoff
weight. Level 2 holds the successors of all contexts one after the other, with quantised
probabilities. To make that one monotone sequence, the successors of a context, counted from 1, are
stored on top of the last value of the context before it; a search adds the same base and looks for
the successor value within the context's range only.
"""

from __future__ import annotations

import mmap
import os
import tempfile

import numpy as np

from tidegate.llm.common import ship

ship(__name__)

_BYTE_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
# _SELECT[b, j]: place of the j-th set bit of byte b, 8 if there is none.
_SELECT = np.array([([i for i in range(8) if b >> i & 1] + [8] * 8)[:8] for b in range(256)],
                   np.uint8)


def _select_in_words(words: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The place of the j-th set bit of each word."""
    octets = words.view(np.uint8).reshape(-1, 8)
    through = np.cumsum(_BYTE_ONES[octets], axis=1, dtype=np.int64)
    octet = (through <= j[:, None]).sum(1)
    at = np.arange(len(words))
    before = np.where(octet > 0, through[at, np.maximum(octet - 1, 0)], 0)
    return octet * 8 + _SELECT[octets[at, octet], j - before]


class Monotone:
    """A non-decreasing sequence of whole numbers from 0, as arrays that may be mapped."""

    FIELDS = ("low", "high", "ones", "shape")

    def __init__(self, low, high, ones, shape):
        self.low, self.high, self.ones = low, high, ones
        self.n, self.width = int(shape[0]), int(shape[1])
        self.zeros = None

    @classmethod
    def of(cls, values: np.ndarray) -> Monotone:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (max(top // n, 1)).bit_length() - 1) if n else 0
        bit = np.arange(n, dtype=np.int64) * width
        low = np.zeros((n * width >> 6) + 2, np.uint64)
        part = (values & ((1 << width) - 1)).astype(np.uint64)
        off = (bit & 63).astype(np.uint64)
        np.bitwise_or.at(low, bit >> 6, part << off)
        over = np.flatnonzero((off > 0) & (off.astype(np.int64) + width > 64))
        np.bitwise_or.at(low, (bit[over] >> 6) + 1, part[over] >> (np.uint64(64) - off[over]))
        place = (values >> width) + np.arange(n)
        high = np.zeros(((top >> width) + n >> 6) + 2, np.uint64)
        np.bitwise_or.at(high, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        count = _BYTE_ONES[high.view(np.uint8)].reshape(-1, 8).sum(1, dtype=np.int64)
        ones = np.concatenate([[0], np.cumsum(count)])
        return cls(low, high, ones, np.array([n, width], np.int64))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.low, self.high, self.ones, np.array([self.n, self.width], np.int64)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        bit = i * self.width
        word, off = bit >> 6, (bit & 63).astype(np.uint64)
        out = self.low[word] >> off
        over = off > 0
        out = out | np.where(over, self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)),
                             np.uint64(0))
        return (out & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        word = np.searchsorted(self.ones, i, "right") - 1
        place = word * 64 + _select_in_words(self.high[word], i - self.ones[word])
        return (place - i << self.width) | self._lows(i)

    def _first_with(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part below ``high``."""
        if self.zeros is None:
            self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        j = np.maximum(high - 1, 0)
        known = (high > 0) & (j < self.zeros[-1])
        word = np.minimum(np.searchsorted(self.zeros, j, "right") - 1, len(self.high) - 1)
        inside = np.where(known, j - self.zeros[word], 0)
        place = word * 64 + _select_in_words(~self.high[word], np.minimum(inside, 63))
        return np.where(high <= 0, 0, np.where(known, np.minimum(place - j, self.n), self.n))

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The first place whose value is x or more; n if there is none."""
        high, low = x >> self.width, x & ((1 << self.width) - 1)
        begin, end = self._first_with(high), self._first_with(high + 1)
        open_ = np.flatnonzero(begin < end)
        while len(open_):
            middle = begin[open_] + end[open_] >> 1
            less = self._lows(middle) < low[open_]
            begin[open_[less]] = middle[less] + 1
            end[open_[~less]] = middle[~less]
            open_ = open_[begin[open_] < end[open_]]
        return begin


class Trie:
    """Two levels; made by :func:`build`, searched in the file of :func:`mapped`."""

    FIELDS = tuple(f"{level}_{field}" for level in ("context", "pointer", "successor")
                   for field in Monotone.FIELDS) + ("backoff", "probability")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.context, self.pointer, self.successors = (
            Monotone(*(arrays[f"{level}_{f}"] for f in Monotone.FIELDS))
            for level in ("context", "pointer", "successor"))
        self.backoff, self.probability = arrays["backoff"], arrays["probability"]

    def find(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pair the place of its context in level 1 and of its successor in level 2,
        -1 where there is none."""
        contexts = len(self.backoff)
        if not contexts:
            return np.full(len(u), -1), np.full(len(u), -1)
        at = np.minimum(self.context.successor(u), contexts - 1)
        known = self.context.get(at) == u
        begin, end = self.pointer.get(at), self.pointer.get(at + 1)
        base = np.where(begin > 0, self.successors.get(np.maximum(begin - 1, 0)), 0)
        place = self.successors.successor(v + 1 + base)
        inside = np.minimum(place, self.successors.n - 1)
        found = (known & (place >= begin) & (place < end)
                 & (self.successors.get(inside) == v + 1 + base))
        return np.where(known, at, -1), np.where(found, place, -1)


def build(u: np.ndarray, v: np.ndarray, backoff: np.ndarray, probability: np.ndarray) -> Trie:
    """A trie of distinct pairs sorted by (u, v); ``backoff`` is one per distinct u, quantised as
    ``probability`` is."""
    context, begin = np.unique(u, return_index=True)
    ends = np.append(begin[1:], len(u)) if len(u) else begin
    # What a range adds to all later ones: its last value.
    base = (np.concatenate([[0], np.cumsum(v[ends - 1] + 1)[:-1]]) if len(u)
            else np.zeros(0, np.int64))
    relative = v + 1 + np.repeat(base, ends - begin)
    levels = {"context": Monotone.of(context), "pointer": Monotone.of(np.append(begin, len(u))),
              "successor": Monotone.of(relative)}
    arrays = {f"{name}_{f}": a for name, level in levels.items()
              for f, a in zip(Monotone.FIELDS, level.arrays(), strict=True)}
    return Trie(arrays | {"backoff": np.asarray(backoff, np.uint16),
                          "probability": np.asarray(probability, np.uint16)})


def mapped(trie: Trie) -> Trie:
    """The trie in a file of its own that is mapped into memory; the file has no name any more, so
    nothing stays behind when the task ends, however it ends."""
    with tempfile.TemporaryFile() as out:
        offsets, place = {}, 0
        for name in Trie.FIELDS:
            data = np.ascontiguousarray(trie.arrays[name])
            out.write(data.tobytes())
            offsets[name] = (place, len(data), data.dtype)
            pad = -data.nbytes % 8
            out.write(b"\0" * pad)
            place += data.nbytes + pad
        out.flush()
        os.lseek(out.fileno(), 0, os.SEEK_SET)
        view = mmap.mmap(out.fileno(), place, access=mmap.ACCESS_READ) if place else b""
    return Trie({name: np.frombuffer(view, kind, n, at) for name, (at, n, kind) in offsets.items()})
