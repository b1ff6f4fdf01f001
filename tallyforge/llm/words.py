"""Words, shingles and window hashes of whole Arrow text columns, as numpy arrays.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r. Nothing here loops over words: a
word's hash is a difference of two prefix sums of a polynomial over its bytes, a window's hash one over
its words' hashes. Hashes have 64 bits and are finished by a mixing step; sets that must be told apart
across the corpus carry two of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1_000_000
U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_BASES = {"byte": 6364136223846793005, "word": 3935559000370003845, "other": 2862933555777941757}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse modulo 2^64."""
    known = _POWERS.get(kind)
    if known is None or len(known[0]) <= n:
        base = _BASES[kind]
        size = max(n + 1, 1 << 16, CHUNK_BYTES + 1 if kind == "byte" else 0)

        def run(b: int) -> np.ndarray:
            out = np.full(size, b, np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        known = (run(base), run(pow(base, -1, 2**64)))
        _POWERS[kind] = known
    return known


@dataclass
class Words:
    """Words of some documents: document i has words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray  # bytes of all documents
    start: np.ndarray  # byte places of each word
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def split_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of a text column; null is empty. ``lower`` hashes A-Z as a-z."""
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, places, raw = texts.buffers()
    if len(texts) == 0 or raw is None:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    n = len(data)
    inside = ~_SPACE[data]
    follows = np.zeros(n + 1, bool)
    follows[1:] = inside
    follows[offsets] = False  # a word ends where its document ends
    start = np.flatnonzero(inside & ~follows[:-1])
    stops = np.zeros(n + 1, bool)
    stops[:-1] = inside
    stops[offsets] = False
    end = np.flatnonzero(inside & ~stops[1:]) + 1
    power, inverse = _powers("byte", n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTES)[data] * power[:n], out=total[1:])
    return Words(data, start, end, mix((total[end] - total[start]) * inverse[start]), np.searchsorted(start, offsets))


def spans_hash(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, kind: str = "word") -> np.ndarray:
    """Hash of the word sequence from ``start`` to ``end`` (exclusive), which tells lengths apart."""
    power, inverse = _powers(kind, len(hashes))
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[: len(hashes)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window of ``size`` words within one document."""
    counts = np.maximum(words.counts() - size + 1, 0)
    start = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return start, spans_hash(words.hash, start, start + size)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each document, end to end, and where each document's begin.

    A document of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    counts = words.counts()
    length = np.minimum(counts, size)
    n = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    begin = np.concatenate([[0], np.cumsum(n)])
    start = np.repeat(words.first[:-1] - begin[:-1], n) + np.arange(begin[-1])
    hashed = spans_hash(words.hash, start, start + np.repeat(length, n))
    parts, ends = [], np.zeros(len(n) + 1, np.int64)
    for i in range(len(n)):
        part = np.unique(hashed[begin[i] : begin[i + 1]])
        parts.append(part)
        ends[i + 1] = ends[i] + len(part)
    return (np.concatenate(parts) if parts else hashed), ends


def set_digest(values: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """For each run of distinct values a hash that does not depend on their order."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values, seed), out=total[1:])
    return mix(total[ends[1:]] - total[ends[:-1]] + np.diff(ends).astype(np.uint64), seed)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """An array<bigint> column from values and the places where each list ends."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), signed(values))


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, in slices of about ``most`` bytes of text (one document at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.binary_length(batch[text]).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size) // most
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)
