"""Connected components of a link table, by alternating large and small stars.

Every round links each vertex's larger neighbours (large star), then the
others (small star), to its smallest neighbour; both keep what is connected,
and the table ends as one star per component. Each step is an aggregation with
partial sums and a join, so a vertex with very many links is split by the
join's skew handling, and each result is written before it is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybar.llm.tables import discard, written

MAX_ROUNDS = 60


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return r[0], r[1]


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs (a, b): links to consider at vertex a. Each such b goes to the least of a and its neighbours."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m0")).select(
        F.col("a").alias("k"), F.least("m0", "a").alias("m"))
    j = pairs.join(least, F.col("a") == F.col("k"))
    if large:
        out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of longs -> (node, root): the smallest vertex reachable, for every vertex in a link but the roots."""
    cur = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "links")
    mark = _mark(cur)
    for _ in range(MAX_ROUNDS):
        if mark[0] == 0:
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        big = written(_star(both, True), "links")
        small = written(_star(big, False), "links")
        discard(big)
        discard(cur)
        cur, before = small, mark
        mark = _mark(cur)
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
