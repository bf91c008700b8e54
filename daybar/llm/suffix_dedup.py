"""Suffix-array deduplication: bytes of repeated 50-byte strings, by a distributed difference-cover algorithm.

``repeats`` deals the strings that can repeat to shards, so that all suffixes
that could be equal in their first ``LENGTH`` bytes meet in one. In a shard the
suffixes at the difference cover {1, 2} modulo 3 are sorted by triples and
named; while names repeat and cover less than ``LENGTH`` bytes, the algorithm
recurses on the string of names. The remaining suffixes are sorted by their
first symbol and the rank behind it, and merged. Neighbours in the suffix
array whose first ``LENGTH`` bytes agree are one class. Order beyond that many
bytes does not matter, which bounds the recursion at four levels.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` keep all
bytes; rows without an id come after all others, and rows with one id do not
remove each other's bytes; a text of any length is compared whole; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from daybar.llm.repeats import Chunk, Units, repeated_windows

LENGTH = 50
_GRAM = 24


def _packed(a: np.ndarray, b: np.ndarray, c: np.ndarray, bound: int) -> np.ndarray:
    """Triples of integers below ``bound`` as integers in the same order."""
    bits = np.uint64(max(1, (bound - 1).bit_length()))
    a, b, c = a.astype(np.uint64), b.astype(np.uint64), c.astype(np.uint64)
    if 3 * int(bits) > 64:
        _, pair = np.unique(a << bits | b, return_inverse=True)
        return pair.astype(np.uint64) << bits | c
    return (a << bits | b) << bits | c


def suffix_array(s: np.ndarray, depth: int, covered: int = 1) -> np.ndarray:
    """Places of ``s`` (positive integers) in the order of their suffixes, right for the first ``depth`` bytes.

    ``covered`` is how many bytes a symbol of ``s`` stands for.
    """
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    s = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    bound = int(s.max()) + 1
    # The cover: places 1 and 2 modulo 3; a last triple of zeros ends the first half.
    ones = np.arange(1, n + (n % 3 == 1), 3)
    sampled = np.concatenate([ones, np.arange(2, n, 3)])
    key = _packed(s[sampled], s[sampled + 1], s[sampled + 2], bound)
    distinct, name = np.unique(key, return_inverse=True)
    if len(distinct) < len(key) and 3 * covered < depth + 3:
        order = suffix_array(name + 1, depth, 3 * covered)
        name = np.empty(len(order), np.int64)
        name[order] = np.arange(len(order))
    rank = np.zeros(n + 3, np.int64)
    rank[sampled] = name + 1
    sampled = sampled[sampled < n]
    sampled = sampled[np.argsort(rank[sampled], kind="stable")]
    # The others by first symbol and the rank behind it; then merged by counting the sampled ones before each.
    top = max(bound, len(name) + 2)
    pair = lambda at: s[at] * top + rank[at + 1]
    rest = np.arange(0, n, 3)
    rest_key = pair(rest)
    by = np.argsort(rest_key, kind="stable")
    rest, rest_key = rest[by], rest_key[by]
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    one_key = np.sort(pair(one))
    both = _packed(np.concatenate([s[two], s[rest]]), np.concatenate([s[two + 1], s[rest + 1]]),
                   np.concatenate([rank[two + 2], rank[rest + 2]]), top)
    two_key, rest_two = np.sort(both[:len(two)]), both[len(two):]
    before = np.searchsorted(one_key, rest_key) + np.searchsorted(two_key, rest_two)
    # Suffixes that agree in ``depth`` bytes have any order, so counts may fall back among them, not beyond.
    at = np.arange(len(rest)) + np.maximum.accumulate(before)
    out = np.empty(n, np.int64)
    others = np.ones(n, bool)
    others[at] = False
    out[at] = rest
    out[others] = sampled
    return out


def byte_classes(units: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """A class for each window: equal for those with the same ``LENGTH`` bytes."""
    order = suffix_array(units.astype(np.int64) + 1, LENGTH)
    wanted = np.full(len(units), -1, np.int64)
    wanted[windows] = np.arange(len(windows))
    order = order[wanted[order] >= 0]
    eight = _eights(units)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        here = eight[order + k]
        same &= here[1:] == here[:-1]
    out = np.empty(len(windows), np.int64)
    out[wanted[order]] = np.concatenate([[0], np.cumsum(~same)]) if len(order) else []
    return out


def _eights(units: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, as an integer."""
    return np.ndarray((len(units) - 7,), "<u8", np.ascontiguousarray(units), strides=(1,)).copy()


def byte_grams(units: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each place on."""
    eight = _eights(units)
    x = eight[:-16] * np.uint64(0x9E3779B97F4A7C15) + eight[8:-8] * np.uint64(0xC2B2AE3D27D4EB4F)
    x += eight[16:] * np.uint64(0x165667B19E3779F9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def split_bytes(text: bytes, lengths: np.ndarray) -> tuple:
    return np.frombuffer(text, np.uint8), np.concatenate([[0], np.cumsum(lengths)]), None


KIND = Units(LENGTH, _GRAM, split_bytes, byte_grams, byte_classes)


def _measure(c: Chunk, covered: np.ndarray) -> pd.DataFrame:
    begins = c.begins
    total = np.concatenate([[0], np.cumsum(covered)])
    new = covered.copy()
    new[1:] &= ~covered[:-1]
    at = begins[:-1][begins[:-1] < len(covered)]
    new[at] = covered[at]  # a run ends with its document
    spans = np.concatenate([[0], np.cumsum(new)])
    removed = total[begins[1:]] - total[begins[:-1]]
    kept = []
    for a, b, gone in zip(begins[:-1], begins[1:], removed):
        own = c.text[a:b] if not gone else c.units[a:b][~covered[a:b]].tobytes()
        kept.append(hashlib.sha256(own).hexdigest())
    return pd.DataFrame({"doc_id": c.named(),
                         "n_bytes": np.diff(begins), "n_removed": removed,
                         "n_spans": spans[begins[1:]] - spans[begins[:-1]], "kept_sha256": kept})


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: Units = KIND) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return repeated_windows(docs, kind, "u1", _measure, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string",
                            id_col, text_col)
