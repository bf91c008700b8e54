"""Prefix trie of conversations, built by van Emde Boas recursion.

A conversation is a sequence of symbols (the SHA-256 of a turn's role and
text); a node of the trie is a prefix that conversations share. Sequences are
cut at half depth, and the halves at theirs, all blocks of one size at once:

1. Blocks of 2, 4, 8, ... symbols at even places get a name from their halves.
2. From the widest cut down, each cut prefix is named by the cut above it and
   the block between. So the upper tries and the lower forests of all blocks
   grow in the same round, and the deepest conversation takes as many rounds as
   its length has bits. Every round halves its rows: the work is linear.
3. Members, children and ends are counted for each name.
4. Totals are grafted upward in the same rounds, the smallest blocks first: the
   root of a lower forest holds the total of its block, and hands it to its
   ancestors in the upper half, along the path of one of its conversations.

Every step is a join or an aggregation whose keys are a conversation and a
place (at most ``SPAN`` rows a key) or a node's name, with partial sums before
the shuffle, so neither a node that very many conversations share nor one very
long conversation has to fit a task. Names are digests of 32 bytes.

Defined cases: rows without a conversation's id belong to none and are left
out; turns go by their number, null first, and turns of one number by their
digest; repeated rows are turns of their own; a null role or text is empty; a
text of any length is read whole; an empty table has no node, not even the
root; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybar.llm.tables import written

SPAN = 64          # places of a path that are joined under one key
ENDS_IN_ROW = 4096  # ids of one node joined into a row before they are hashed in order


def _name(kind: int, *parts: Column) -> Column:
    """The digest of ``parts`` (blobs); ``kind`` keeps symbols, blocks of each size and nodes apart."""
    return F.unhex(F.sha2(F.concat(F.lit(bytes([kind])), *parts), 256))


def ordered_turns(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns and their conversations.

    Turns: conv_id, part, inner (place in the part, from 1), symbol, chars.
    Conversations by part: conv_id, part, prior (turns in earlier parts), n (all
    turns). The parts are ranges of all turns, so a conversation of very many
    turns lies in several and its places are prior + inner.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    symbol = _name(0, F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    t = rows.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), symbol.alias("symbol"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("place"))
    order = [F.col("turn").asc_nulls_first(), "symbol", "place"]  # the place only parts equal rows
    dealt = written(t.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    inner = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order))
    of = Window.partitionBy("conv_id")
    before = of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    convs = dealt.groupBy("part", "conv_id").agg(F.count(F.lit(1)).alias("own")).select(
        "part", "conv_id", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("prior"), F.sum("own").over(of).alias("n"))
    return dealt.select("conv_id", "part", inner.cast("long").alias("inner"), "symbol", "chars"), written(convs, "convs")


def sequences(rows: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """The conversations as they are: (conv_id, d, symbol, chars), d from 1, and (conv_id, length)."""
    turns, convs = ordered_turns(rows, **columns)
    seqs = turns.join(convs, ["part", "conv_id"]).select(
        "conv_id", (F.col("prior") + F.col("inner")).alias("d"), "symbol", "chars")
    return written(seqs, "sequences"), convs.groupBy("conv_id").agg(F.max("n").alias("length"))


def branched_sequences(rows: DataFrame, family: int = 100, choices: int = 6, **columns: str) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their family does.

    Conversation c takes the first h turns of c - c % family (what there is of
    them), h = crc32(decimal c) % choices, and then its own turns after its first h.
    """
    turns, by_part = ordered_turns(rows, **columns)
    c = F.col("conv_id")
    sizes = by_part.groupBy("conv_id").agg(F.max("n").alias("n"))
    convs = sizes.select("conv_id", "n", F.pmod(F.crc32(F.encode(c.cast("string"), "UTF-8")), F.lit(choices)).alias("h"),
                         (c - c % F.lit(family)).alias("first"))
    convs = convs.join(sizes.select(c.alias("first"), F.col("n").alias("there")), "first", "left")
    given = F.least("h", F.coalesce("there", F.lit(0)))
    convs = written(convs.select("conv_id", "first", "h", given.alias("given"), (
        given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "branches")
    pos = F.col("prior") + F.col("inner")
    at = by_part.join(convs, "conv_id").select("part", "conv_id", "prior", "h", "given")
    own = turns.join(at, ["part", "conv_id"]).where(pos > F.col("h")).select(
        "conv_id", (pos - F.col("h") + F.col("given")).alias("d"), "symbol", "chars")
    heads = turns.where((F.col("inner") < choices) & (c % family == 0)).join(by_part, ["part", "conv_id"]).where(
        pos < choices).select(c.alias("first"), pos.alias("d"), "symbol", "chars")
    taken = heads.join(convs.where("given > 0").select("conv_id", "first", "given"), "first").where(
        "d <= given").select("conv_id", "d", "symbol", "chars")
    return written(own.unionByName(taken), "sequences"), convs.select("conv_id", "length")


def _paths(seqs: DataFrame, lengths: DataFrame, rounds: int) -> DataFrame:
    """(conv_id, d, name): the node of every prefix of every conversation."""
    side = lambda odd: F.max(F.when(F.col("i") % 2 == odd, F.col("name")))
    blocks = [seqs.select("conv_id", (F.col("d") - 1).alias("i"), F.col("symbol").alias("name"))]
    for j in range(1, rounds):
        pairs = blocks[-1].groupBy("conv_id", F.expr("i div 2").alias("pair")).agg(side(0).alias("a"), side(1).alias("b"))
        blocks.append(written(pairs.where("b is not null").select(
            "conv_id", F.col("pair").alias("i"), _name(j, F.col("a"), F.col("b")).alias("name")), "blocks"))
    root = _name(255)
    cuts = [lengths.select("conv_id", F.lit(0).cast("long").alias("d"), root.alias("name"))]
    for j in reversed(range(rounds)):
        below = blocks[j].where("i % 2 = 0").select("conv_id", (F.col("i") * (1 << j)).alias("d"), F.col("name").alias("block"))
        cut = reduce(DataFrame.unionByName, cuts).join(below, ["conv_id", "d"])
        cuts.append(written(cut.select("conv_id", (F.col("d") + (1 << j)).alias("d"), _name(128 + j, F.col("name"), F.col("block")).alias("name")), "cuts"))
    return reduce(DataFrame.unionByName, cuts)


def _joined_ids(batches, most: int):
    """Ids that are sorted by name: rows of at most ``most`` of them as text."""
    for batch in batches:
        names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out, a = [], 0
        for b in range(1, len(names) + 1):
            if b == len(names) or names[b] != names[a] or b - a == most:
                out.append((names[a], ids[a], ",".join(map(str, ids[a:b]))))
                a = b
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))],
                                             names=["name", "first", "ids"])


def _hashed_ids(batches):
    """Rows of ids in their order: one digest a name, whatever the number of its rows."""
    own, digest = None, None
    for batch in batches:
        out = []
        for name, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name == own:
                digest.update(b"," + ids.encode())
                continue
            if own is not None:
                out.append((own, digest.hexdigest()))
            own, digest = name, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=["name", "ends_sha256"])
    if own is not None:
        yield pa.RecordBatch.from_arrays([pa.array([own]), pa.array([digest.hexdigest()])], names=["name", "ends_sha256"])


def _ends(paths: DataFrame, lengths: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the nodes at which conversations end."""
    ends = paths.join(lengths.select("conv_id", F.col("length").alias("d")), ["conv_id", "d"]).select("name", "conv_id")
    ranged = ends.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    most = ENDS_IN_ROW
    rows = ranged.mapInArrow(lambda batches: _joined_ids(batches, most), "name binary, first long, ids string")
    return rows.repartition("name").sortWithinPartitions("name", "first").mapInArrow(
        _hashed_ids, "name binary, ends_sha256 string")


def _grafted(nodes: DataFrame, paths: DataFrame, rounds: int) -> DataFrame:
    """(name, n_leaves, saved): sums of ``leaf`` and ``saved`` over every node's subtree."""
    totals = nodes.select("name", "conv_id", "depth", F.col("leaf").alias("n_leaves"), "saved")
    for j in range(rounds):
        half, width = 1 << j, min(1 << j, SPAN)
        roots = totals.where(F.col("depth").bitwiseAND(F.lit(2 * half - 1)) == half)
        first, last = F.expr(f"(depth - {half}) div {width}"), F.expr(f"depth div {width} - 1")
        asked = roots.select("conv_id", "n_leaves", "saved",
                             F.explode(F.sequence(first, last)).alias("span"))
        above = paths.select("conv_id", F.expr(f"d div {width}").alias("span"), "name")
        none = F.lit(None).cast("long")
        gains = above.join(asked, ["conv_id", "span"]).select(
            "name", none.alias("conv_id"), none.alias("depth"), "n_leaves", "saved")
        totals = written(totals.unionByName(gains).groupBy("name").agg(
            F.max("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")), "totals")
    return totals.select("name", "n_leaves", "saved")


def prefix_trie(seqs: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256; name and parent are the digests of the node and its parent.

    ``seqs``: (conv_id, d, symbol, chars), d without gaps from 1; ``lengths``: (conv_id, length), 0 allowed.
    """
    lengths = written(lengths, "lengths")
    rounds = int(lengths.agg(F.max("length")).first()[0] or 0).bit_length()
    paths = written(_paths(seqs, lengths, rounds), "paths")
    nodes = paths.groupBy("name").agg(F.min("d").alias("depth"), F.min("conv_id").alias("conv_id"),
                                      F.count(F.lit(1)).alias("n_convs"))
    texts = seqs.select("conv_id", F.col("d").alias("depth"), "chars")
    above = paths.select("conv_id", (F.col("d") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = written(nodes.join(texts, ["conv_id", "depth"], "left").join(above, ["conv_id", "depth"], "left"), "nodes")
    children = nodes.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children.withColumnRenamed("parent", "name"), "name", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))).withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn(
        "saved", (F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0)))
    counted = written(counted.drop("chars"), "counted")
    full = counted.drop("leaf", "saved").join(_grafted(counted, paths, rounds), "name").join(
        _ends(paths, lengths), "name", "left")
    nothing = hashlib.sha256().hexdigest()
    up = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return full.join(up, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), "name", "parent")
