"""Packing token sequences by minimum bin slack.

Documents are cut into whole windows and a remainder shorter than a window.
Only how many remainders have each length (at most window - 1 counts) decides
the packing, so it is planned on the driver from that histogram, whatever the
corpus: while remainders are left, the longest is set, and a subset-sum over
the lengths left (one integer as bitset for each length, counts taken in
binary parts) gives the sums that fit with it; the largest is traced back to
the number of pieces of each length. That pattern is used for as many
sequences as its counts allow. Pieces get their rank among the pieces of their
length, which names their sequence and place: ranks come from counts by
(length, salt), so a length that a third of all rows have is spread out.

Defined cases: a null text counts as empty, and an empty one is a piece with
the end id alone; repeated rows are packed each; a document of any length is
cut into windows; an empty table gives no pieces; further columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybar.llm import tokens
from daybar.llm.tables import shards_for, written
from daybar.llm.text import as_bytes, chunked

WINDOW = 2048
RANKED_TOGETHER = 50_000  # remainders that one task ranks

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@dataclass
class Pattern:
    """``times`` sequences with counts[length] pieces of each length."""
    counts: dict[int, int]
    times: int


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Pieces whose lengths add up closest to ``room`` without passing it."""
    lengths = sorted((n for n in counts if n <= room and counts[n]), reverse=True)
    mask, sums, seen = (1 << room + 1) - 1, 1, []
    used = []
    for n in lengths:
        seen.append(sums)
        used.append(n)
        left, part = min(counts[n], room // n), 1
        while left:
            take = min(part, left)
            sums |= sums << n * take & mask
            left -= take
            part *= 2
        if sums >> room & 1:
            break
    total = sums.bit_length() - 1
    out = {}
    for n, before in zip(reversed(used), reversed(seen)):
        k = 0
        while not before >> total & 1:
            total -= n
            k += 1
        if k:
            out[n] = k
    return out


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[Pattern]:
    left = {n: c for n, c in histogram.items() if c}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = best_fill(left, window - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // k for n, k in chosen.items())
        for n, k in chosen.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        out.append(Pattern(chosen, times))
    return out


class Places:
    """For each length, which ranks go to which pattern."""

    def __init__(self, patterns: list[Pattern]):
        of: dict[int, list[tuple[int, int, int, int]]] = {}
        self.sequences = 0
        ranks: dict[int, int] = {}
        for p in patterns:
            offset = 0
            for n in sorted(p.counts, reverse=True):
                k = p.counts[n]
                of.setdefault(n, []).append((ranks.get(n, 0), self.sequences, k, offset))
                ranks[n] = ranks.get(n, 0) + k * p.times
                offset += n * k
            self.sequences += p.times
        self.of = {n: np.array(x, np.int64).T for n, x in of.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            first, base, k, begin = self.of[int(n)]
            j = np.searchsorted(first, rank[at], side="right") - 1
            within = rank[at] - first[j]
            sequence[at] = base[j] + within // k[j]
            offset[at] = begin[j] + within % k[j] * n
        return sequence, offset


def pieces(docs: DataFrame, vocabulary: str, end_id: int, window: int, id_col: str, text_col: str) -> DataFrame:
    """Whole windows and remainders of every document."""
    tail = np.array([end_id], np.uint32).tobytes()

    def run(batches):
        for batch in batches:
            texts, doc_ids = as_bytes(batch.column(1)), batch.column(0).to_pylist()
            for a, b in chunked(texts):
                rows = []
                for doc, ids in zip(doc_ids[a:b], tokens.encode([t.decode() for t in texts[a:b]], vocabulary)):
                    ids += tail
                    n = len(ids) // 4
                    rows.extend((doc, s, min(window, n - s), zlib.crc32(ids[4 * s:4 * (s + window)]), n)
                                for s in range(0, n, window))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, _PIECE)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = written(pieces(docs, vocabulary, end_id, window, id_col, text_col), "pieces").withColumn(
        "row", F.monotonically_increasing_id())
    rest = cut.where(F.col("length") < window)
    salts = shards_for(rest.count(), RANKED_TOGETHER)
    rest = rest.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(max(16, salts))).cast("int"))
    counts = rest.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most window - 1 rows
    places = Places(plan(histogram, window))
    sent = spark.sparkContext.broadcast(places)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("row")
    ranked = rest.withColumn("nth", F.row_number().over(order) - 1).join(base, ["length", "salt"])

    def run(batches):
        for batch in batches:
            sequence, offset = sent.value.place(batch.column(2).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=[*batch.schema.names[:5], "sequence_id", "offset"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    packed = ranked.select(*names, (F.col("base") + F.col("nth")).alias("rank")).mapInArrow(
        run, f"{_PIECE}, sequence_id long, offset long")
    full = cut.where(F.col("length") == window).select(
        *names, (F.col("row") + places.sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
