"""Vectorised views of texts inside Arrow batches (numpy, one bounded chunk at a time)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 20  # span of bytes hashed at once
CHUNK_BYTES = 2 << 20  # texts handled at once in a task; one longer text is a chunk of its own

# White space of every word-based operator here: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BYTE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def chunked(texts: list[bytes], limit: int = CHUNK_BYTES):
    """Yield (first, last) row ranges of at most ``limit`` bytes, one row at least."""
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > limit:
            yield first, i
            first = i
            size = 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a newline after each; and where each begins (one more at the end)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return data, begins


def words_of(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of each text's first word (one more at the end)."""
    edge = np.diff((~SPACE[data]).view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return starts, ends, np.searchsorted(starts, begins)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def feature_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of the spans [start, end) of bytes; both ends must ascend. For features only: there
    are unequal spans of equal hash.

    Prefix sums of byte * base^i give every span's hash by one subtraction;
    the inverse power takes its position out again.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _power_tables(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTE[data[a:b]] * up[: b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash (XXH3) of each word of the texts; each distinct word is hashed once."""
    words = data.tobytes().split()
    return np.fromiter(map(_Hashes().__getitem__, words), np.uint64, len(words))


def numbered(parts: list[bytes]) -> np.ndarray:
    """Numbers that are equal where the parts are."""
    return np.fromiter(map(_Numbers().__getitem__, parts), np.uint64, len(parts))


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash (XXH3) of each span [start, end) of units."""
    view, wide = memoryview(np.ascontiguousarray(units)).cast("B"), units.itemsize
    hash_of = xxhash.xxh3_64_intdigest
    return np.fromiter((hash_of(view[a:b]) for a, b in zip((starts * wide).tolist(), (ends * wide).tolist())), np.uint64, len(starts))


def repeats(keys: np.ndarray, equal: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Two masks: keys found twice or more; and those of them with an equal key before.

    Where keys are hashes, ``equal`` compares what lies at two arrays of places;
    if hashes met by chance anywhere, all places are compared by it.
    """
    again = np.zeros(len(keys), bool)
    both = np.zeros(len(keys), bool)
    if len(keys) < 2:
        return both, again
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if equal is not None:
        pairs = np.flatnonzero(same)
        if not equal(order[pairs], order[pairs + 1]).all():
            return _compared(keys, equal)
    again[order[1:][same]] = True
    both[order[:-1][same]] = True
    return both | again, again


def _compared(keys: np.ndarray, equal: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """As ``repeats``, for keys that are equal by chance: each place against the first of every class of its key."""
    both, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    firsts: dict[int, list[int]] = {}
    for i, k in enumerate(keys.tolist()):
        own = firsts.setdefault(k, [])
        match = [j for j in own if equal(np.array([j]), np.array([i]))[0]]
        if match:
            both[match[0]] = both[i] = again[i] = True
        else:
            own.append(i)
    return both, again


def covered(marked: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a window of ``length`` places that starts at a marked one."""
    edge = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(marked)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + length, n), -1)
    return np.cumsum(edge[:-1]) > 0
