"""SimHash near-duplicates, linked through BK-trees.

Fingerprints: lower-cased words, shingles of ``shingle`` words hashed with
XXH64 (seed 42); a bit is 1 if it is set in over half of a text's shingles.
Equal fingerprints are one vertex. Seven blocks of bits: two fingerprints that
differ in at most four bits agree in three blocks whole, so each of the 35
triples of blocks deals the fingerprints into shards, and partners always meet
in one. A shard's BK-tree (children keyed by their integer Hamming distance
to the parent) is searched with the shard's fingerprints, following only the
edges within the radius. A shard beyond ``TREE_SIZE`` is cut into blocks: each
block's tree goes to the tasks that search it with one other block, so no task
holds more than two blocks and no pair is left out. The trees grow with the
corpus, so they are sent by shuffle to the tasks that need them, not to all.
Shards report links as a forest, never all pairs of a group.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; rows without an id get a component but never name one; repeated
rows fall in one component; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybar.llm.components import components
from daybar.llm.tables import shards_for, written
from daybar.llm.text import as_bytes

SHINGLE, RADIUS = 4, 4
BLOCKS = (9, 9, 9, 9, 9, 9, 10)  # bits; radius + 3 blocks, of which 3 stay equal
TREE_SIZE = 2048                 # fingerprints in one tree
SPREAD = 1 << 13                 # fingerprints that one task turns into rows
_SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    cuts = [0]
    for w in words:
        cuts.append(cuts[-1] + len(w) + 1)
    n = max(1, len(words) - shingle + 1)
    span = min(shingle, len(words))
    hash_of = xxhash.xxh64_intdigest
    h = np.fromiter((hash_of(line[a:b - 1], _SEED) for a, b in zip(cuts[:n], cuts[span:])), ">u8", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 65536):
        ones += np.unpackbits(h[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) with the fingerprint's 64 bits as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            own = np.array([fingerprint(t, shingle) for t in as_bytes(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own)], names=[id_col, "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


class _Forest:
    """Union of places; the smallest place of a set is its root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.up[at]
        while (self.up[r] != r).any():
            r = self.up[r]
        self.up[at] = r
        return r

    def join(self, at: np.ndarray) -> None:
        r = self.roots(at)
        self.up[r] = r.min()


def tree_links(tree: np.ndarray, asked: np.ndarray, radius: int, forest: _Forest, first: int, first_asked: int) -> None:
    """Search a BK-tree over ``tree`` with all of ``asked`` at once; unite what lies within the radius.

    A node is the first member of its subtree; the other members fall to its
    children by their distance to it, and a query at distance d goes on only to
    the children keyed d - radius to d + radius.
    """
    todo = [(np.arange(len(tree)), np.arange(len(asked)))]
    while todo:
        members, queries = todo.pop()
        node, members = members[0], members[1:]
        d = np.bitwise_count(asked[queries] ^ tree[node]).astype(np.int16)
        hits = queries[d <= radius]
        if len(hits):
            forest.join(np.concatenate([[first + node], first_asked + hits]))
        if len(members):
            key = np.bitwise_count(tree[members] ^ tree[node])
            for k in np.unique(key):
                follow = queries[np.abs(d - int(k)) <= radius]
                if len(follow):
                    todo.append((members[key == k], follow))


def _shard_links(fps: np.ndarray, block: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) of one shard; with ``block`` (0 or 1), of one block searched with another."""
    if len(fps) == 2:
        near = int(np.bitwise_count(fps[0] ^ fps[1])) <= radius
        return (fps[1:], fps[:1]) if near else (fps[:0], fps[:0])
    forest = _Forest(len(fps))
    if block is None or block.all() or not block.any():
        tree_links(fps, fps, radius, forest, 0, 0)
    else:
        order = np.argsort(block, kind="stable")
        fps, n = fps[order], int((block == 0).sum())
        tree_links(fps[:n], fps[n:], radius, forest, 0, n)
    root = forest.roots(np.arange(len(fps)))
    other = np.flatnonzero(root != np.arange(len(fps)))
    return fps[other], fps[root[other]]


def _search(batches, radius: int):
    """Rows sorted by shard (key1, key2), each with fp and block; a shard may span batches but is of bounded size."""
    held: list[np.ndarray] = []

    def links_of(rows: np.ndarray, last: bool):
        """rows: (4, n) of key1, key2, block, fp. Returns the links and what may go on."""
        change = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
        cuts = np.concatenate([[0], change, [rows.shape[1]]])
        if not last:
            cuts = cuts[:-1]
        a, b = [], []
        size = np.diff(cuts)
        fps = rows[3].view(np.uint64)
        # Shards of two: one comparison each, all at once.
        at = cuts[:-1][size == 2]
        near = at[np.bitwise_count(fps[at] ^ fps[at + 1]) <= radius]
        a.append(fps[near + 1])
        b.append(fps[near])
        for k in np.flatnonzero(size > 2):
            s, e = cuts[k], cuts[k + 1]
            split = rows[2, s:e]
            x, y = _shard_links(fps[s:e], None if (split < 0).all() else split, radius)
            a.append(x)
            b.append(y)
        return np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64), rows[:, cuts[-1]:]

    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]))
        if sum(x.shape[1] for x in held) >= 8192:
            a, b, rest = links_of(np.concatenate(held, axis=1), False)
            held = [rest]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    if held and sum(x.shape[1] for x in held):
        a, b, _ = links_of(np.concatenate(held, axis=1), True)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def near_links(fps: DataFrame, radius: int = RADIUS, blocks: tuple[int, ...] = BLOCKS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` connected by steps of at most ``radius`` bits."""
    if sum(blocks) != 64 or len(blocks) <= radius:
        raise ValueError("blocks must hold 64 bits, and be more than the radius")
    parts, at = [], 0
    for bits in blocks:
        parts.append(F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << bits) - 1)))
        at += bits
    keys = []
    for t, chosen in enumerate(combinations(range(len(blocks)), len(blocks) - radius)):
        key = F.lit(t).cast("long")
        for i in chosen:
            key = F.shiftleft(key, blocks[i]).bitwiseOR(parts[i])
        keys.append(key)
    # A fingerprint becomes a row for each triple: spread over many tasks first, written once, read for sizes and members.
    spread = fps.repartition(shards_for(fps.count(), SPREAD), "fp")
    dealt = written(spread.select("fp", F.explode(F.array(*keys)).alias("key")), "dealt")
    sizes = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = dealt.join(sizes, "key")
    cut = F.ceil(F.col("n") / F.lit(tree_size)).cast("int")
    own = F.pmod(F.xxhash64("fp"), cut.cast("long")).cast("int")
    # Block i meets itself (one tree, itself asked) and every other block j > i: the pair's id is i * cut + j.
    pairs = F.when(F.col("n") <= tree_size, F.array(F.struct(F.lit(0).cast("long").alias("pair"), F.lit(-1).alias("side")))) \
        .otherwise(F.transform(F.sequence(F.lit(0), cut - 1), lambda j: F.struct(
            (F.least(own, j).cast("long") * cut + F.greatest(own, j)).alias("pair"),
            F.when(own > j, F.lit(1)).otherwise(F.lit(0)).alias("side"))))
    asked = met.select("key", "fp", F.explode(pairs).alias("p")).select("key", "p.pair", "p.side", "fp")
    dealt_out = asked.repartition("key", "pair").sortWithinPartitions("key", "pair", "side", "fp")
    return dealt_out.mapInArrow(lambda batches: _search(batches, radius), "a long, b long").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the smallest id reachable)."""
    own = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    vertices = written(own.groupBy("fp").agg(F.min(id_col).alias("least")), "vertices")
    roots = components(near_links(vertices.select("fp"), radius, tree_size=tree_size))
    named = vertices.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(smallest, "root").select("fp", "component_id")
    return own.join(of, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
