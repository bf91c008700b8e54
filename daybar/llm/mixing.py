"""Mixing sources to target weights by hierarchical budgets.

A tree of domains, languages and sources has a weight at every node. A node
can take its tokens times the epochs allowed. From the root down, a node's
budget is dealt to its children by weight; a child that cannot take its share
is filled, and what it leaves goes to its siblings by weight. Only what the
siblings together cannot take has been left to the level above, since a node
never gets more than its subtree can take. Each level is one window over the
(small) table of nodes: children sorted by capacity per weight are filled from
the front as long as each one's share reaches its capacity.

A leaf then takes whole epochs, and of one more epoch the longest prefix, in
the seeded order of that epoch, that its tokens pay for. Running sums of a
leaf go by buckets of the order key, so a leaf with most rows is spread over
many tasks.

Defined cases: a null level value is the name "unknown"; a weight that is not
given is 1, weight 0 takes nothing; null and empty texts have no tokens, and
are taken where the running sum before them still fits; wholly repeated rows
are one unit with their tokens added; an empty table gives an empty mixture;
further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybar.llm.tables import written

LEVELS = ("domain", "lang", "source")
BUCKET_DIGITS = 3  # leading hex digits of the order key: 4096 buckets a leaf


@dataclass(frozen=True)
class MixPlan:
    """Weights by level and value, the share of all tokens wanted in percent, epochs allowed, and the seed."""
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    percent: int = 50
    max_epochs: int = 1
    seed: str = "mix"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _weight(plan: MixPlan, level: str) -> Column:
    c = F.lit(1)
    for value, w in sorted(plan.weights.get(level, {}).items()):
        c = F.when(F.col(level) == value, w).otherwise(c)
    return c.cast("long")


def _dealt(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """children: parent columns, name, cap, w, given (the parent's budget) -> with ``budget``."""
    by = Window.partitionBy(*parent)
    order = by.orderBy(F.col("cap").cast("double") / F.col("w"), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    c = children.withColumn("given", F.least("given", F.sum("cap").over(by)))
    c = c.withColumn("rest", F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))) \
         .withColumn("rest_w", F.sum("w").over(by) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    c = c.withColumn("full", F.expr("cap * rest_w <= w * rest"))
    left = F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(by), F.lit(0))
    left_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(by)
    c = c.withColumn("left", left).withColumn("left_w", left_w)
    return c.withColumn("budget", F.expr("case when full then cap else w * left div left_w end")).select(
        *parent, name, "cap", "budget")


def leaf_budgets(leaves: DataFrame, plan: MixPlan, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """(levels..., tokens) per leaf -> with budget."""
    base = leaves.withColumn("cap", F.col("tokens") * plan.max_epochs)
    for level in levels:
        base = base.where(_weight(plan, level) > 0)
    wanted = (leaves.agg(F.sum("tokens")).first()[0] or 0) * plan.percent // 100
    dealt = None
    for k, level in enumerate(levels):
        parent = list(levels[:k])
        nodes = base.groupBy(*levels[:k + 1]).agg(F.sum("cap").alias("cap")).withColumn("w", _weight(plan, level))
        if dealt is None:
            nodes = nodes.withColumn("root", F.lit(0)).withColumn("given", F.lit(wanted).cast("long"))
            dealt = _dealt(nodes, ["root"], level).select(level, "budget")
        else:
            nodes = nodes.join(dealt.withColumnRenamed("budget", "given"), parent)
            dealt = _dealt(nodes, parent, level).select(*parent, level, "budget")
    return leaves.join(dealt, list(levels))


def select_units(units: DataFrame, plan: MixPlan, id_col: str = "doc_id", levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """units: id, levels, n_tokens and any others -> the same rows with full_epochs, in_prefix (of one epoch more) and budget."""
    leaves = units.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"))
    budgets = written(leaf_budgets(leaves, plan, levels).where("tokens > 0").withColumn(
        "full_epochs", F.expr("budget div tokens")).withColumn("rest", F.expr("budget % tokens")), "budgets")
    # Budgets are one row a leaf of the tree; Spark broadcasts them only while they are small.
    at = units.join(budgets, list(levels))
    key = F.md5(F.concat_ws(":", F.lit(plan.seed), F.col("full_epochs") + 1, F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    at = at.withColumn("order_key", key).withColumn("bucket", F.substring("order_key", 1, BUCKET_DIGITS))
    sums = at.groupBy(*levels, "bucket").agg(F.sum("n_tokens").alias("bucket_tokens"))
    before = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("prior", F.coalesce(F.sum("bucket_tokens").over(before), F.lit(0))).drop("bucket_tokens")
    upto = Window.partitionBy(*levels, "bucket").orderBy("order_key", id_col, "n_tokens").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return at.withColumn("running", F.sum("n_tokens").over(upto)).join(sums, [*levels, "bucket"]).withColumn(
        "in_prefix", (F.col("rest") > 0) & (F.col("running") + F.col("prior") <= F.col("rest"))).drop(
        "running", "prior", "bucket", "rest", "tokens")


def _named(docs: DataFrame, text_col: str, domain: Column) -> list[Column]:
    named = {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in LEVELS[1:]}
    return [F.col("doc_id"), F.coalesce(domain, F.lit("unknown")).alias("domain"),
            *(c.alias(k) for k, c in named.items()), word_count(F.col(text_col)).alias("n_tokens"),
            F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key")]


def mix_sources(docs: DataFrame, plan: MixPlan, domain: Column, text_col: str = "text") -> DataFrame:
    """One row per document and epoch in which it is taken: doc_id, levels, n_tokens, epoch, budget of its leaf."""
    return _taken(docs, plan, domain, text_col).drop("text_key")


def _taken(docs: DataFrame, plan: MixPlan, domain: Column, text_col: str) -> DataFrame:
    units = docs.select(*_named(docs, text_col, domain)).groupBy("doc_id", *LEVELS, "text_key").agg(F.sum("n_tokens").alias("n_tokens"))
    chosen = select_units(written(units, "units"), plan)
    epochs = F.col("full_epochs") + F.when(F.col("in_prefix"), 1).otherwise(0)
    return chosen.withColumn("epochs", epochs).where("epochs > 0").select(
        "doc_id", *LEVELS, "n_tokens", F.explode(F.sequence(F.lit(1).cast("long"), F.col("epochs"))).alias("epoch"),
        "budget", "text_key")


def mixed_documents(docs: DataFrame, plan: MixPlan, domain: Column, text_col: str = "text") -> DataFrame:
    """The chosen rows of ``docs`` with all their columns, once for each epoch.

    Rows are found by all that makes them one unit (id, levels, text); repeated rows are each returned.
    """
    of_unit = ("doc_id", *LEVELS, "text_key")
    keys = lambda c: [c("doc_id").isNull(), F.coalesce(c("doc_id"), F.lit(0)), *map(c, of_unit[1:])]
    own = docs.select(F.struct("*").alias("__doc"), F.struct(*_named(docs, text_col, domain)).alias("__unit"))
    own = own.select("__doc", *(k.alias(f"__k{i}") for i, k in enumerate(keys(lambda c: F.col(f"__unit.{c}")))))
    taken = _taken(docs, plan, domain, text_col)
    taken = taken.select(*(k.alias(f"__t{i}") for i, k in enumerate(keys(F.col))))
    same = [F.col(f"__k{i}") == F.col(f"__t{i}") for i in range(len(of_unit) + 1)]
    return own.join(taken, same).select(*(F.col("__doc").getField(c).alias(c) for c in docs.columns))
