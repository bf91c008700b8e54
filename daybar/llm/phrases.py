"""Phrase collocations, counted by HAT-tries.

1. A task numbers the words that it meets and counts phrases of one to
   ``max_words`` words in a trie for each language: hash containers (a phrase as
   one integer of word numbers -> its count) that cover neighbouring subtrees.
   A container of more than ``burst`` phrases bursts at the first word in which
   its phrases differ, so frequent beginnings get containers of their own.
2. Beyond ``held`` phrases the largest containers are spilled whole: as runs,
   sorted by their words, one for each prefix partition (the first two words say
   which). A run carries its own words, so numbers never leave the task.
3. The runs of a partition are merged and their counts added. A partition of
   more than ``merged`` phrases is split by all words of the phrase first.
4. Phrases seen ``min_count`` times are scored against their parts by joins.

A part of a phrase is at least as frequent as the phrase, so what is rarer than
``min_count`` is dropped only once all runs are added. Scores are exact:
products are decimals of 38 digits (counts up to 10**15).

Defined cases: a null text has no words; a null language is ``und``; a text of
any length is read in slices whose phrases may cross the cuts; repeated rows
count each; equal scores go by count, then by the phrase's bytes; an empty table
has no phrases; further columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybar.llm.repeats import _pack, _unpack
from daybar.llm.tables import shards_for, written
from daybar.llm.text import as_bytes, mix

@dataclass(frozen=True)
class Limits:
    """How much is held at once. No result depends on these."""
    burst: int = 1 << 15        # phrases in a container
    held: int = 2_000_000       # phrases that a task counts before it spills
    slice: int = 1 << 20        # bytes of text taken apart at once
    word_bytes: int = 64 << 20  # bytes of words that a task numbers before it begins anew
    part_bytes: int = 16 << 20  # bytes of text for each prefix partition
    merged: int = 4_000_000     # phrases of runs merged in one group


_BREAK = b"\xff"      # no byte of UTF-8: the end of a piece
_FLAT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 10)


class Words(dict):
    """Word -> number, from 1 in the order in which they come; 0 is the end of a piece."""

    def __init__(self):
        self.list, self.bytes, self._codes = [_BREAK], 0, np.zeros(1, np.uint64)
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.list)
        self.list.append(word)
        self.bytes += len(word)
        return number

    def codes(self) -> np.ndarray:
        """A checksum of each word, alike in every task."""
        new = self.list[len(self._codes):]
        self._codes = np.concatenate([self._codes, np.array([zlib.crc32(w) + 1 for w in new], np.uint64)])
        return self._codes


class Container:
    """A hash table of phrases (positive integers) and their counts, with open addressing; never more than half full."""

    def __init__(self, room: int):
        self.keys, self.counts, self.n = np.zeros(2 << (room - 1).bit_length(), np.int64), None, 0
        self.counts = np.zeros(len(self.keys), np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct keys, all at once: those that meet another key go on to the next place."""
        last = len(self.keys) - 1
        at = (mix(keys.view(np.uint64)) & np.uint64(last)).astype(np.int64)
        while len(keys):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]  # of several keys for a free place one stays
            own = self.keys[at] == keys
            self.counts[at[own]] += counts[own]
            self.n += int((own & free).sum())
            keys, counts, at = keys[~own], counts[~own], (at[~own] + 1) & last

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.keys)
        return self.keys[at], self.counts[at]


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts added."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], np.add.reduceat(counts[order], new) if len(new) else counts


class Trie:
    """Counts of phrases. Word numbers have ``bits`` bits; a phrase of fewer words ends in zeros."""

    def __init__(self, width: int, burst: int = Limits.burst):
        self.width, self.bits, self.burst, self.held = width, 63 // width, burst, 0
        self.starts, self.containers = [0], [Container(self.burst)]  # the first key of each container's range

    def __len__(self) -> int:
        return self.held

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        counts, keys = np.diff(np.append(new, len(keys))), keys[new]
        cuts = np.append(np.searchsorted(keys, np.array(self.starts)), len(keys)).tolist()
        for i in range(len(self.starts) - 1, -1, -1):  # a burst moves only what lies behind
            if cuts[i] < cuts[i + 1]:
                self._put(i, keys[cuts[i]:cuts[i + 1]], counts[cuts[i]:cuts[i + 1]])

    def _put(self, i: int, keys: np.ndarray, counts: np.ndarray) -> None:
        own = self.containers[i]
        self.held -= own.n
        if own.n + len(keys) > self.burst:  # perhaps too many: taken out, and put back once they are in ranges that fit
            old, n = own.items()
            keys, counts = _added(np.concatenate([old, keys]), np.concatenate([n, counts]))
            self.containers[i:i + 1], self.starts[i:i + 1] = self._burst(self.starts[i], keys, counts)
        else:
            own.add(keys, counts)
            self.held += own.n

    def _burst(self, start: int, keys: np.ndarray, counts: np.ndarray) -> tuple[list[Container], list[int]]:
        """Containers for distinct keys in order: cut at the first word in which they differ, until each part fits."""
        if len(keys) <= self.burst:
            one = Container(self.burst)
            one.add(keys, counts)
            self.held += one.n
            return [one], [start]
        for level in range(self.width):
            shift = self.bits * (self.width - 1 - level)
            word = keys >> shift
            if word[0] != word[-1]:
                break
        middle = word[len(word) // 2]
        cut = int(np.searchsorted(word, middle)) if middle != word[0] else int(np.searchsorted(word, middle, "right"))
        left = self._burst(start, keys[:cut], counts[:cut])
        right = self._burst(int(word[cut] << shift), keys[cut:], counts[cut:])
        return left[0] + right[0], left[1] + right[1]

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and counts of whole containers, the largest first, until at most ``keep`` phrases stay."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in sorted(range(len(self.starts)), key=lambda i: -self.containers[i].n):
            own = self.containers[i]
            if self.held <= keep or not own.n:
                break
            self.held -= own.n
            for x, y in zip((keys, counts), own.items()):
                x.append(y)
            self.containers[i] = Container(self.burst)
        return np.concatenate(keys), np.concatenate(counts)


def _slices(data: bytes, size: int):
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def phrase_keys(numbers: np.ndarray, carried: int, width: int) -> np.ndarray:
    """Keys of all phrases inside pieces that end behind the first ``carried`` words."""
    bits, out = 63 // width, []
    for n in range(1, width + 1):
        first = max(0, carried - n + 1)
        key, whole = np.zeros(max(0, len(numbers) - n + 1 - first), np.int64), True
        if not len(key):
            continue
        for k in range(n):
            own = numbers[first + k:first + k + len(key)]
            whole &= own > 0
            key |= own << (bits * (width - 1 - k))
        out.append(key[whole])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _columns(keys: np.ndarray, width: int) -> list[np.ndarray]:
    bits = 63 // width
    return [(keys >> (bits * (width - 1 - k))) & ((1 << bits) - 1) for k in range(width)]


def _run(words: list[bytes], columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """A run: its distinct words (given as ascending numbers of ``words``), the phrases in their order, and the counts."""
    used = np.unique(np.concatenate(columns))
    used = used[used > 0]
    blob = np.frombuffer(b"\n".join(map(words.__getitem__, used.tolist())), np.uint8)
    places = [np.where(c > 0, np.searchsorted(used, c) + 1, 0).astype("<u4") for c in columns]
    places[0] = np.diff(places[0], prepend=np.uint32(0))  # first words ascend
    return _pack(blob, *places, counts.astype("<i8"))


def _read_run(data: bytes, width: int) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """Words, columns (places in the words, from 1) and counts of a run."""
    blob, first, *rest, counts = _unpack(data, "u1", *["<u4"] * width, "<i8")
    return blob.tobytes().split(b"\n"), [np.cumsum(first, dtype=np.int64), *(c.astype(np.int64) for c in rest)], counts


def _deal(codes: list[np.ndarray], salt: int, parts: int) -> np.ndarray:
    x = np.full(len(codes[0]), salt, np.uint64)
    for c in codes:
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + c)
    return (x % np.uint64(parts)).astype(np.int64)


class _Counting:
    """The tries of one task, by language, over one numbering of words."""

    def __init__(self, width: int, parts: int, limits: Limits = Limits()):
        self.limits = limits
        self.width, self.parts, self.words, self.tries = width, parts, Words(), {}

    def take(self, lang: str, texts: list[bytes]):
        """Count the texts; yield the runs that are spilled meanwhile."""
        data = (b" " + _BREAK + b" ").join(t.translate(_FLAT).replace(_BREAK, b" " + _BREAK + b" ") for t in texts)
        before = np.zeros(0, np.int64)
        for piece in _slices(data, self.limits.slice):
            if len(self.words.list) + len(piece) >= 1 << (63 // self.width) or self.words.bytes > self.limits.word_bytes:
                tail = [self.words.list[i] for i in before.tolist()]
                yield from self.spill(0)
                self.words = Words()
                before = np.array([self.words[w] for w in tail], np.int64)
            tokens = piece.split()
            numbers = np.concatenate([before, np.fromiter(map(self.words.__getitem__, tokens), np.int64, len(tokens))])
            self.tries.setdefault(lang, Trie(self.width, self.limits.burst)).add(phrase_keys(numbers, len(before), self.width))
            before = numbers[len(numbers) - min(len(numbers), self.width - 1):]
            if sum(map(len, self.tries.values())) > self.limits.held:
                yield from self.spill(self.limits.held // 2)

    def spill(self, keep: int):
        held = sum(map(len, self.tries.values()))
        codes, lists = self.words.codes(), self.words.list
        order = sorted(range(1, len(lists)), key=lists.__getitem__)
        rank = np.zeros(len(lists), np.int64)
        rank[order] = np.arange(1, len(lists))
        ranked = [_BREAK, *map(lists.__getitem__, order)]
        for lang, trie in self.tries.items():
            keys, counts = trie.spill(keep * len(trie) // held if held else 0)
            if not len(keys):
                continue
            columns = _columns(keys, self.width)
            part = _deal([codes[c] for c in columns[:2]], zlib.crc32(lang.encode()), self.parts)
            columns = [rank[c] for c in columns]
            by = np.argsort(reduce(lambda x, c: x << (63 // self.width) | c, columns))
            by = by[np.argsort(part[by], kind="stable")]
            cuts = np.flatnonzero(np.diff(part[by], prepend=-1, append=-1))
            for a, b in zip(cuts[:-1], cuts[1:]):
                at = by[a:b]
                yield int(part[at[0]]), lang, len(at), _run(ranked, [c[at] for c in columns], counts[at])


def _runs(docs: DataFrame, lang: Column, text_col: str, width: int, parts: int, limits: Limits) -> DataFrame:
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.string(), pa.int64(), pa.binary()))],
                                          names=["part", "lang", "n", "run"])

    def count(batches):
        counting, out = _Counting(width, parts, limits), []
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for own, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                by_lang.setdefault(own, []).append(text)
            for own, texts in by_lang.items():
                for row in counting.take(own, texts):
                    out.append(row)
                    if len(out) >= 64:
                        yield batch_of(out)
                        out = []
        out.extend(counting.spill(0))
        for i in range(0, len(out), 64):
            yield batch_of(out[i:i + 64])

    return docs.select(lang.alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        count, "part int, lang string, n long, run binary")


def _split(batches, width: int):
    """(part, lang, run, pieces): a run of a large partition in pieces dealt by the whole phrase."""
    for batch in batches:
        out = []
        for part, lang, run, pieces in zip(*(c.to_pylist() for c in batch.columns)):
            if pieces == 1:
                out.append((part, lang, 0, run))
                continue
            words, columns, counts = _read_run(run, width)
            words = [_BREAK, *words]
            codes = np.array([zlib.crc32(w) for w in words], np.uint64)
            piece = _deal([codes[c] for c in columns], 1, pieces)
            for k in np.unique(piece).tolist():
                at = np.flatnonzero(piece == k)
                out.append((part, lang, k, _run(words, [c[at] for c in columns], counts[at])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.string(), pa.int32(), pa.binary()))],
                                             names=["part", "lang", "piece", "run"])


def _merge(min_count: int, width: int):
    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Phrases of a partition with ``min_count``; and, under no words, the occurrences of all its single words."""
        runs = [_read_run(x, width) for x in rows["run"]]
        lang = rows["lang"].iloc[0]
        words = sorted(set().union(*(w for w, _, _ in runs)))
        number = dict(zip(words, range(1, len(words) + 1)))
        columns, counts = [[] for _ in runs[0][1]], np.concatenate([c for _, _, c in runs])
        for own, places, _ in runs:
            to = np.array([0, *map(number.__getitem__, own)], np.int64)
            for k, p in enumerate(places):
                columns[k].append(to[p])
        columns = [np.concatenate(c) for c in columns]
        code = columns[0]
        for c in columns[1:]:  # pairs of numbers, named in their order: runs stay sorted
            code = np.unique(code, return_inverse=True)[1] * (len(words) + 1) + c
        order = np.argsort(code, kind="stable")
        new = np.flatnonzero(np.diff(code[order], prepend=-1))
        total = np.add.reduceat(counts[order], new)
        first = order[new]
        single = np.flatnonzero(columns[1][first] == 0)
        out = [([], int(total[single].sum()))] if len(single) else []
        for i in np.flatnonzero(total >= min_count).tolist():
            out.append(([words[c[first[i]] - 1].decode() for c in columns if c[first[i]]], int(total[i])))
        return pd.DataFrame({"lang": [lang] * len(out), "words": [w for w, _ in out], "f": [n for _, n in out]})

    return merge


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 3,
                  min_count: int = 10, limits: Limits = Limits()) -> DataFrame:
    """(lang, words, f): phrases of 1 to ``max_words`` (2 or 3) words that occur ``min_count`` times or more.

    Rows without words add up to all word occurrences of their language.
    """
    if max_words not in (2, 3):
        raise ValueError("max_words must be 2 or 3")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    parts = shards_for(size, limits.part_bytes)
    runs = written(_runs(docs, lang, text_col, max_words, parts, limits), "runs", "uncompressed")
    # Few partitions are large; the written table says how few, and Spark sends it to all tasks only while it is small.
    large = written(runs.groupBy("part", "lang").agg(F.ceil(F.sum("n") / limits.merged).cast("int").alias("pieces")).where("pieces > 1"), "large")
    pieces = runs.join(large, ["part", "lang"], "left").select("part", "lang", "run", F.coalesce("pieces", F.lit(1))).mapInArrow(
        lambda batches: _split(batches, max_words), "part int, lang string, piece int, run binary")
    groups = pieces.repartition(max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "part", "lang", "piece")
    return groups.groupBy("part", "lang", "piece").applyInPandas(_merge(min_count, max_words), "lang string, words array<string>, f long")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 3, min_count: int = 10,
                 cover_percent: int = 50, top: int = 2000, limits: Limits = Limits()) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts = written(phrase_counts(docs, lang_col, text_col, max_words, min_count, limits), "phrases")
    text = lambda words: F.array_join(words, " ")
    n = counts.where("size(words) = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    known = counts.where("size(words) > 0").select("lang", "words", text(F.col("words")).alias("phrase"), F.col("f").alias("a"))
    found = known.where("size(words) > 1")
    part = lambda name, f: known.select("lang", F.col("phrase").alias(name), F.col("a").alias(f))
    cuts = found.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", text(F.slice("words", F.lit(1), F.col("k"))).alias("head"),
                       text(F.slice("words", F.col("k") + 1, F.size("words"))).alias("rest"))
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    score = (wide["a"] * wide["a"] * F.lit(1_000_000).cast("decimal(7,0)")).alias("top"), (wide["l"] * wide["r"]).alias("under")
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("rest", "r"), ["lang", "rest"]).select(
        "lang", "phrase", "a", "k", "l", "r", *score)
    least = F.min(F.struct(F.expr("top div under").alias("score"), "k", "l", "r")).alias("best")
    scored = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), least)
    # Every contiguous part of two words or more, with its most frequent longer phrase.
    inner = found.where("size(words) > 2").select("lang", "words", "a", F.explode(F.expr(
        "filter(flatten(transform(sequence(1, size(words) - 1), i -> transform(sequence(2, size(words) - 1), m -> "
        "if(i + m - 1 <= size(words), slice(words, i, m), null)))), x -> x is not null)")).alias("part"))
    cover = inner.groupBy("lang", text(F.col("part")).alias("phrase")).agg(F.max("a").alias("longer"))
    left = scored.join(cover, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * cover_percent))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase"))
    best = left.withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")
