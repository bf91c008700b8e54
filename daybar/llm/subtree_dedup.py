"""Substring deduplication: words of repeated 13-word windows, by prefix-partitioned suffix trees.

``repeats`` deals the strings that can repeat to shards. In a shard the
suffixes that begin a window are split by variable-length prefixes: those with
a common first word form a group, and a group above ``SUBTREE`` suffixes is
split by one more word, until every group fits or its prefix is a whole
window. Each group grows its subtree from the prefix down, a word a level: the
suffixes of a node that share the next word are a child, and a suffix alone in
its node is a leaf and goes no deeper. A node at least ``LENGTH`` words deep
has the places of one repeat below it; the deepest common ones are the maximal
repeats. Words are compared by 64-bit hashes (XXH3).

Defined cases: a null or empty text has no words; texts of fewer words than a
window keep them all; rows without an id come after all others, and rows with
one id do not remove each other's words; a text of any length is compared
whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from daybar.llm.repeats import Chunk, Units, repeated_windows
from daybar.llm.text import joined, mix, word_hashes, words_of

LENGTH = 13
SUBTREE = 1 << 16  # suffixes whose subtree is grown at once
_GRAM = 6
_STEP = np.uint64(0xD6E8FEB86659FD93)


def prefix_groups(words: np.ndarray, suffixes: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(suffixes, words of their common prefix): groups that fit, by prefixes as long as they need to be."""
    out, todo = [], [(suffixes, 0)]
    while todo:
        own, depth = todo.pop()
        if len(own) <= SUBTREE or depth == LENGTH:
            out.append((own, depth))
            continue
        next_word = words[own + depth]
        order = np.argsort(next_word, kind="stable")
        cuts = np.flatnonzero(np.diff(next_word[order].astype(np.uint64)) != 0) + 1
        small: list[np.ndarray] = []
        for child in np.split(own[order], cuts):
            if len(child) > SUBTREE:
                todo.append((child, depth + 1))
            else:
                small.append(child)
        # Small siblings share the parent's prefix and grow together, as many as fit.
        held, size = [], 0
        for child in small:
            if held and size + len(child) > SUBTREE:
                out.append((np.concatenate(held), depth))
                held, size = [], 0
            held.append(child)
            size += len(child)
        if held:
            out.append((np.concatenate(held), depth))
    return out


def grow(words: np.ndarray, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """The node at ``LENGTH`` words (or the leaf) that each suffix of a group ends in, as a number from 0."""
    node = np.zeros(len(suffixes), np.int64)
    open_ = np.arange(len(suffixes))  # suffixes in nodes with others
    used = 1
    while depth < LENGTH and len(open_):
        word = words[suffixes[open_] + depth]
        order = np.lexsort([word, node[open_]])
        own, word = node[open_][order], word[order]
        new = np.ones(len(order), bool)
        new[1:] = (own[1:] != own[:-1]) | (word[1:] != word[:-1])
        child = np.cumsum(new) - 1
        node[open_[order]] = used + child
        size = np.bincount(child)
        used += len(size)
        open_ = open_[order][size[child] > 1]
        depth += 1
    return np.unique(node, return_inverse=True)[1]


def word_classes(units: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """A class for each window: equal for those with the same ``LENGTH`` words."""
    at = np.argsort(windows, kind="stable")
    out = np.empty(len(windows), np.int64)
    used = 0
    for group, depth in prefix_groups(units, windows[at]):
        node = grow(units, group, depth)
        place = at[np.searchsorted(windows[at], group)]
        out[place] = used + node
        used += int(node.max()) + 1 if len(node) else 0
    return out


def word_grams(units: np.ndarray) -> np.ndarray:
    """A hash of the six words from each place on."""
    n = len(units) - _GRAM + 1
    x = np.zeros(n, np.uint64)
    for k in range(_GRAM):
        x = x * _STEP + units[k:k + n]
    return mix(x)


def split_words(text: bytes, lengths: np.ndarray) -> tuple:
    ends = np.cumsum(lengths)
    data, begins = joined([text[e - n:e] for e, n in zip(ends.tolist(), lengths.tolist())])
    starts, stops, first = words_of(data, begins)
    return word_hashes(data), first, (data, starts, stops)


KIND = Units(LENGTH, _GRAM, split_words, word_grams, word_classes)


def _measure(c: Chunk, covered: np.ndarray) -> pd.DataFrame:
    data, starts, stops = c.own
    total = np.concatenate([[0], np.cumsum(covered)])
    removed = total[c.begins[1:]] - total[c.begins[:-1]]
    raw, kept = data.tobytes(), []
    for a, b in zip(c.begins[:-1], c.begins[1:]):
        at = np.flatnonzero(~covered[a:b]) + a
        kept.append(hashlib.sha256(b" ".join([raw[s:e] for s, e in zip(starts[at].tolist(), stops[at].tolist())])).hexdigest())
    return pd.DataFrame({"doc_id": c.named(), "n_words": np.diff(c.begins), "n_removed": removed, "kept_sha256": kept})


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kind: Units = KIND) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256."""
    return repeated_windows(docs, kind, "<u8", _measure, "doc_id long, n_words long, n_removed long, kept_sha256 string",
                            id_col, text_col)
