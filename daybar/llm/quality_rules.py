"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths over the words of a text find the
n-grams that occur before in the same text; what counts is the share of a
text's word characters inside such duplicated n-grams, and inside lines equal
to an earlier line. Words and lines are numbered by their bytes, and n-grams of
equal hash are compared word by word. Everything is computed per text in numpy,
over Arrow batches, so the job is one scan without a shuffle.

Defined cases: a null or empty text has no words and fails the base rules; a
repeated row gets the same result as the first; a text of any length is taken
whole; rows without an id are measured like others; an empty table gives no
rows; further input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daybar.llm.text import as_bytes, chunked, covered, joined, mix, numbered, repeats, words_of

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits in percent of a text's word characters."""
    ngram_limits: tuple[tuple[int, int], ...] = ((5, 25), (8, 20), (12, 15))
    line_limit: int = 30
    base_window: int = 8
    base_percent: int = 30
    min_words: int = 20


def _measure(texts: list[bytes], rules: RepetitionRules) -> dict[str, np.ndarray]:
    data, begins = joined(texts)
    starts, ends, first = words_of(data, begins)
    n_docs, n_words = len(texts), len(starts)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    salt = mix(np.arange(1, n_docs + 1, dtype=np.uint64))
    points = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
    chars = (points[ends - 1] - np.where(starts > 0, points[starts - 1], 0)).astype(np.int64)
    per_doc = lambda at, weights=None: np.bincount(at, weights, n_docs).astype(np.int64)
    out = {"n_words": np.diff(first), "word_chars": per_doc(doc, chars)}
    out["n_symbols"] = per_doc(np.searchsorted(begins, np.flatnonzero(_SYMBOLS[data]), side="right") - 1)

    line_ends = np.flatnonzero(data == 10)
    line_starts = np.concatenate([[0], line_ends[:-1] + 1])
    line_words = np.searchsorted(starts, np.concatenate([line_starts, [len(data)]]))
    full = np.flatnonzero(np.diff(line_words))
    line_doc = np.searchsorted(begins, line_starts[full], side="right") - 1
    lines = numbered(data.tobytes().split(b"\n"))[full]
    _, again = repeats(lines * np.uint64(n_docs) + line_doc.astype(np.uint64))  # numbers, not hashes: equal only where lines are
    out["n_dup_lines"] = per_doc(line_doc[again])
    before = np.concatenate([[0], np.cumsum(chars)])
    line_chars = before[line_words[full + 1]] - before[line_words[full]]
    out["dup_line_chars"] = per_doc(line_doc[again], line_chars[again])

    numbers = numbered(data.tobytes().split())
    hashes = mix(numbers + np.uint64(1))
    limits = dict(rules.ngram_limits)
    rolling = np.zeros(n_words, np.uint64)
    last = first[1:][doc] if n_words else np.zeros(0, np.int64)  # end of each word's text
    for n in range(1, max([rules.base_window, *limits]) + 1):
        shifted = np.zeros(n_words, np.uint64)
        shifted[: max(0, n_words - n + 1)] = hashes[n - 1:]
        rolling = rolling * _STEP + shifted
        if n != rules.base_window and n not in limits:
            continue
        whole = np.flatnonzero(np.arange(n_words) + n <= last)

        def equal(a, b, whole=whole, n=n):
            same = doc[whole[a]] == doc[whole[b]]
            for k in range(n):
                same &= numbers[whole[a] + k] == numbers[whole[b] + k]
            return same

        both, again = repeats(mix(rolling[whole] ^ salt[doc[whole]]), equal)
        if n == rules.base_window:
            marked = np.zeros(n_words, bool)
            marked[whole[both]] = True
            out["n_repeat_words"] = per_doc(doc[covered(marked, n, n_words)])
        if n in limits:
            marked = np.zeros(n_words, bool)
            marked[whole[again]] = True
            inside = covered(marked, n, n_words)
            out[f"dup_chars_{n}"] = per_doc(doc[inside], chars[inside])
    return out


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """One row per input row: the base counts, the coverage in characters, and the verdict."""
    grams = [n for n, _ in rules.ngram_limits]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    cover = ["dup_line_chars", *(f"dup_chars_{n}" for n in grams)]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, ids = as_bytes(batch.column(1)), batch.column(0)
            for a, b in chunked(texts):
                m = _measure(texts[a:b], rules)
                bad = (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.base_percent * m["n_words"])
                over = 100 * m["dup_line_chars"] > rules.line_limit * m["word_chars"]
                for n, limit in rules.ngram_limits:
                    over |= 100 * m[f"dup_chars_{n}"] > limit * m["word_chars"]
                columns = [ids.slice(a, b - a), *(pa.array(m[c]) for c in counts), pa.array(bad), pa.array(~bad & ~over),
                           *(pa.array(m[c]) for c in cover)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, *counts, "base_failed", "kept", *cover])

    schema = ", ".join([f"`{id_col}` {kind}", *(f"{c} long" for c in counts), "base_failed boolean", "kept boolean",
                        *(f"{c} long" for c in cover)])
    return docs.select(id_col, text_col).mapInArrow(run, schema)
