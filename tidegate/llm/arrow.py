"""Words and numbers of a batch as flat numpy arrays, and such arrays packed for an exchange."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

from tidegate.llm.common import ship

ship(__name__)

#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def list_ends(lists: pa.ListArray) -> np.ndarray:
    """Where the rows of a list column begin in its flat values, and the end of the last."""
    lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)])


def row_slices(ends: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows with ``limit`` values at most, or a single row."""
    row, rows = 0, len(ends) - 1
    while row < rows:
        stop = int(np.searchsorted(ends, ends[row] + limit, "right")) - 1
        stop = min(max(row + 1, stop), rows)
        yield row, stop
        row = stop


def distinct_words(lists: pa.ListArray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a list column, the number of each word in order, and row offsets."""
    words = lists.flatten().dictionary_encode()
    return (words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False),
            list_ends(lists))


def byte_offsets(texts: pa.LargeBinaryArray) -> np.ndarray:
    """Where the texts of an array begin in its bytes, and the end of the last."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)
    return offsets[texts.offset:texts.offset + len(texts) + 1]


def flat_words(texts: pa.LargeBinaryArray, breaks: np.ndarray
               ) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of texts without nulls, A-Z in lower case, and where those of each text begin.

    A word is a longest run of bytes without one that ``breaks`` (256 flags) names.
    """
    offsets = byte_offsets(texts)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~breaks[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    at = np.flatnonzero(begins)
    kept = LOWER[data[inside]]
    place = np.append(np.cumsum(inside, dtype=np.int64)[at] - 1, len(kept))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(place), pa.py_buffer(kept)])
    return words, np.searchsorted(at, offsets)


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def breaks_of(*codes: int) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(codes)] = True
    return flags


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0 in as few bytes as they need, compressed; bytes of equal
    weight lie together."""
    parts = []
    for a in arrays:
        a = np.asarray(a)
        if a.dtype != np.uint8:
            a = a.astype(np.min_scalar_type(int(a.max(initial=0))))
        planes = a.view(np.uint8).reshape(-1, a.itemsize).T
        parts += [struct.pack("<BQ", a.itemsize, len(a)), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        width, n = struct.unpack_from("<BQ", raw, at)
        planes = np.frombuffer(raw, np.uint8, n * width, at + 9).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(n))
        at += 9 + width * n
    return out


def word_arrays(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of words."""
    offsets = byte_offsets(words)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return offsets - offsets[0], data


def binary_words(offsets: np.ndarray, data: np.ndarray) -> pa.LargeBinaryArray:
    """The words of :func:`word_arrays`."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
