"""Exact deduplication against a minimal perfect hash over historical digests.

The distinct digests of the history are dealt by their leading bits into
shards of bounded size. For each shard a task builds a minimal perfect hash
(levels of bit arrays: a key that is alone at its place of a level is settled
there, the others go on; the rank of its bit is its slot). A slot holds the
whole 32-byte digest, the locator of the winning row and the group's size.
Arrivals are first combined by digest, then looked up in the shard of their
digest: a slot whose 32 bytes differ is no match. Matches are repeats of the
history; the rest form groups of their own.

Defined cases: a null text counts as empty; of equal texts the row with the
smallest id stays, null ids come after all others, and of wholly repeated rows
one stays; a history row always wins over an arrival with the same text; an
empty history or an empty table is valid; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybar.llm.tables import shards_for, written
from daybar.llm.text import mix

KEYS_PER_SHARD = 1 << 12   # digests in one index row: about 250 kB with locators
_SPREAD = 2                # bits of a level for each key still open
_WHITE = r"[\x20\x09-\x0D]+"

_INDEX = "shard int, sizes array<int>, bits array<binary>, digests binary, winners binary, nulls binary, rows binary, counts binary"
_GROUP = "digest binary, keep_id long, keep_null boolean, keep_row long, group_size long"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space as one space."""
    normal = F.regexp_replace(F.coalesce(text, F.lit("")), _WHITE, " ")
    return F.unhex(F.sha2(F.encode(normal, "UTF-8"), 256))


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys[:, level % 4] + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits for distinct 32-byte keys (n x 4 words), and the slot of each key."""
    levels: list[np.ndarray] = []
    slot = np.zeros(len(keys), np.int64)
    todo = np.arange(len(keys))
    used = 0
    while len(todo):
        size = max(64, _SPREAD * len(todo))
        at = _places(keys[todo], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        rank = np.cumsum(alone) - 1
        settled = alone[at]
        slot[todo[settled]] = used + rank[at[settled]]
        used += int(alone.sum())
        levels.append(alone)
        todo = todo[~settled]
    return levels, slot


def find_slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot that the hash gives each key; -1 where no level has its bit."""
    out = np.full(len(keys), -1, np.int64)
    todo, used = np.arange(len(keys)), 0
    for k, alone in enumerate(levels):
        at = _places(keys[todo], k, len(alone))
        hit = alone[at]
        rank = np.cumsum(alone) - 1
        out[todo[hit]] = used + rank[at[hit]]
        used += int(alone.sum())
        todo = todo[~hit]
    return out


def _key_matrix(digests) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d) for d in digests), np.uint64).reshape(-1, 4)


def _index_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    keys = _key_matrix(rows["digest"])
    levels, slot = build_index(keys)
    order = np.argsort(slot)
    packed = [np.packbits(x).tobytes() for x in levels]
    longs = lambda c: rows[c].to_numpy(np.int64)[order].tobytes()
    return pd.DataFrame({"shard": [key[0]], "sizes": [[len(x) for x in levels]], "bits": [packed],
                         "digests": [keys[order].tobytes()], "winners": [longs("keep_id")],
                         "nulls": [rows["keep_null"].to_numpy(bool)[order].tobytes()],
                         "rows": [longs("keep_row")], "counts": [longs("n")]})


def _look_up(index: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
    """Groups of one shard: every historical digest, and every arriving one that it lacks."""
    out = []
    keys = _key_matrix(probes["digest"]) if len(probes) else np.zeros((0, 4), np.uint64)
    fresh = np.ones(len(probes), bool)
    if len(index):
        row = index.iloc[0]
        levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(row["bits"], row["sizes"])]
        digests = np.frombuffer(row["digests"], np.uint64).reshape(-1, 4)
        counts = np.frombuffer(row["counts"], np.int64).copy()
        slot = find_slots(levels, keys)
        same = slot >= 0
        same[same] = (digests[slot[same]] == keys[same]).all(axis=1)
        counts[slot[same]] += probes["n"].to_numpy(np.int64)[same]
        fresh = ~same
        raw = digests.tobytes()
        out.append(pd.DataFrame({"digest": [raw[i:i + 32] for i in range(0, len(raw), 32)],
                                 "keep_id": np.frombuffer(row["winners"], np.int64), "keep_null": np.frombuffer(row["nulls"], bool),
                                 "keep_row": np.frombuffer(row["rows"], np.int64), "group_size": counts}))
    if fresh.any():
        own = probes[fresh]
        out.append(pd.DataFrame({"digest": list(own["digest"]), "keep_id": own["keep_id"].to_numpy(np.int64),
                                 "keep_null": own["keep_null"].to_numpy(bool), "keep_row": own["keep_row"].to_numpy(np.int64), "group_size": own["n"].to_numpy(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("digest", "keep_id", "keep_null", "keep_row", "group_size")})


def _combined(rows: DataFrame, shard: Column) -> DataFrame:
    """One row per digest: the winner's locator and the number of rows (partial sums before the shuffle)."""
    best = F.min(F.struct("no_id", "id", "row"))  # null ids after all others
    return rows.groupBy("digest").agg(best.alias("w"), F.count(F.lit(1)).alias("n")).select(
        shard.alias("shard"), "digest", F.col("w.id").alias("keep_id"), F.col("w.no_id").alias("keep_null"), F.col("w.row").alias("keep_row"), "n")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 is_history: Column | None = None, row_col: str | None = None) -> DataFrame:
    """Every row's locator, digest and group: row, id, digest, keep_id, keep_row, group_size (ids null where the row has none).

    ``row_col`` is a column of unique longs that already names the rows. ``is_history`` marks the rows seen earlier, whose digests the index holds;
    without it the whole table arrives at once into an empty history.
    """
    past = F.coalesce(is_history, F.lit(False)) if is_history is not None else F.lit(False)
    rows = written(docs.select((F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
                               F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("id"),
                               F.col(id_col).isNull().alias("no_id"), past.alias("past"),
                               text_digest(F.col(text_col)).alias("digest")), "digests")
    shards = shards_for(rows.count(), KEYS_PER_SHARD)
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    index = _combined(rows.where("past"), shard).groupBy("shard").applyInPandas(_index_shard, _INDEX)
    probes = _combined(rows.where("not past"), shard)
    groups = index.groupBy("shard").cogroup(probes.groupBy("shard")).applyInPandas(_look_up, _GROUP)
    return rows.join(groups, "digest").withColumn("id", F.when(~F.col("no_id"), F.col("id"))) \
        .withColumn("keep_id", F.when(~F.col("keep_null"), F.col("keep_id")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                is_history: Column | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    g = exact_groups(docs, id_col, text_col, is_history)
    return g.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"))
