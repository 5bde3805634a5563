"""Texts of an Arrow batch as flat numpy arrays: chunks, words, hashes, shingles.

Every function works on all texts of a chunk at once. A chunk holds whole texts and
about ``CHUNK_BYTES`` of them, so memory is bounded by the longest single text.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
U64 = np.uint64


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; another seed gives another, unrelated order."""
    x = x ^ U64(seed * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def give_back() -> None:
    """Return memory that nothing uses to the machine.

    A worker process serves many tasks, and allocators keep what was freed: without this
    it stays as large as its largest batch ever was, beside the JVM of its executor.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunks(batch: pa.RecordBatch, text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of whole rows with about ``most`` bytes of text each."""
    column = batch.column(text)
    if not len(column):
        return
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    parts = np.cumsum(sizes.astype(np.int64) + 16) // most
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
    give_back()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


#: A-Z in lower case, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The low bytes of a lane that belong to a slice with 0 to 8 bytes left.
LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
#: From this many bytes on a slice is hashed by the standard library.
LONG_SLICE = 512


class SliceHash:
    """64-bit hashes of any slices of ``data``, eight bytes a step.

    Each step mixes the state before the next eight bytes come in, so that no sum of
    powers is formed whose terms could cancel out. Long slices have a cryptographic hash.
    """

    def __init__(self, data: np.ndarray, lower: bool = False):
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[:-8] = LOWER[data] if lower else data
        self.bytes = padded
        self.lanes = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))

    def lane(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next eight bytes, or those that are left, as a number."""
        return self.lanes[at] & LANE[np.minimum(left, 8)]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        out = mix(size.astype(U64), 7)
        out = mix(out ^ self.lane(start, size))
        more = np.flatnonzero((size > 8) & (size < LONG_SLICE))
        step = 8
        while len(more):
            out[more] = mix(out[more] ^ self.lane(start[more] + step, size[more] - step), 8)
            step += 8
            more = more[size[more] > step]
        for i in np.flatnonzero(size >= LONG_SLICE).tolist():
            found = hashlib.blake2b(self.bytes[start[i] : end[i]], digest_size=8).digest()
            out[i] = int.from_bytes(found, "little")
        return out

    def equal(self, start: np.ndarray, end: np.ndarray, other: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Which slices hold the same bytes as the slices ``[other, stop)``."""
        size = end - start
        same = size == stop - other
        same &= self.lane(start, size) == self.lane(other, size)
        more = np.flatnonzero(same & (size > 8) & (size < LONG_SLICE))
        step = 8
        while len(more):
            left = size[more] - step
            same[more] &= self.lane(start[more] + step, left) == self.lane(other[more] + step, left)
            step += 8
            more = more[(size[more] > step) & same[more]]
        for i in np.flatnonzero(same & (size >= LONG_SLICE)).tolist():
            same[i] = np.array_equal(self.bytes[start[i] : end[i]], self.bytes[other[i] : stop[i]])
        return same


def slice_classes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a slice of each class, class of each slice) of the slices with the same bytes.

    Classes come from hashes, and every slice is compared with the one that stands for it.
    """
    hashed = SliceHash(data)
    place, found = pd.factorize(hashed(start, end))
    one = np.empty(len(found), np.int64)
    one[place[::-1]] = np.arange(len(place) - 1, -1, -1)
    if not hashed.equal(start, end, start[one[place]], end[one[place]]).all():
        raw = data.tobytes()
        slices = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
        numbers: dict[bytes, int] = {}
        place = np.array([numbers.setdefault(x, len(numbers)) for x in slices], np.int64)
        one = np.empty(len(numbers), np.int64)
        one[place[::-1]] = np.arange(len(place) - 1, -1, -1)
    return one, place


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of the slices ``[start, start + size)``, one after the other."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(total)


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside``, cut at the ends of the texts."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text) of the words ``[^\\x20\\x09-\\x0D]+``."""
    start, end = edges((data != 32) & ((data < 9) | (data > 13)), offsets)
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word with A-Z in lower case, first word of each text)."""
    start, end, first = word_spans(data, offsets)
    return SliceHash(data, lower=True)(start, end), first


def shingles(words: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Per text its distinct shingle hashes in ascending order.

    A text with fewer words than ``width`` has its whole sequence as one shingle; one
    without words has none.
    """
    n = max(0, len(words) - width + 1)
    weights = mix(np.arange(1, width + 1, dtype=U64), 11) | U64(1)
    total = np.zeros(n, U64)
    for k in range(width):
        total += words[k : k + n] * weights[k]
    total = mix(total)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(total[a : b - width + 1]))
        elif b > a:
            out.append(mix((words[a:b] * weights[: b - a]).sum(dtype=U64, keepdims=True), b - a))
        else:
            out.append(np.zeros(0, U64))
    return out
