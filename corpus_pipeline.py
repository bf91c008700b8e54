"""The corpus pipeline: quality, exact and near duplicates, mixture, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept, and returns the columns of ``documents`` (the last one the packed
pieces). Defined cases are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybar.llm.mixing import MixPlan, mixed_documents
from daybar.llm.mph_dedup import exact_groups
from daybar.llm.packing import pack
from daybar.llm.quality_knn import fit, quality_votes
from daybar.llm.queries import DOMAIN_SQL
from daybar.llm.simhash_bk import simhash_components
from daybar.llm.tables import documents, prepare, table, written
from daybar.llm.tokens import default_vocabulary

# One epoch: what the stages before removed as copies does not come back.
MIX = MixPlan({"domain": {"web": 2, "reference": 3, "forum": 4}, "lang": {"en": 4, "de": 2, "fr": 2}}, 80, 1, "corpus")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled ones vote good."""
    prepare(spark)
    return quality_votes(docs, fit(docs, table(spark, sf_dir, "labels")), keep=docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id, null ids last, then the first written."""
    prepare(spark)
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "placed")
    # As in op9, the lower half of the ids is the history that the index holds; its ids are the smaller ones anyway.
    middle = docs.agg(((F.min("doc_id") + F.max("doc_id")) / 2).cast("long")).first()[0]
    groups = exact_groups(rows, is_history=F.col("doc_id") <= F.lit(middle), row_col="__row")
    stay = groups.where("row = keep_row").select(F.col("row").alias("__row"))
    return rows.join(stay, "__row", "left_semi").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: that with the smallest id, null ids last, then the first written."""
    prepare(spark)
    # Ids may be null or repeated: each row is named by its place in a written table.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                     F.monotonically_increasing_id().alias("row"))
    rows = written(docs.withColumn("__place", place), "placed")
    groups = simhash_components(rows, id_col="__place")
    stay = groups.where("__place.row = component_id.row").select(F.col("__place.row").alias("__row"))
    return rows.join(stay, F.col("__place.row") == F.col("__row"), "left_semi").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to the weights of their domain, language and source."""
    prepare(spark)
    return mixed_documents(docs, MIX, F.expr(DOMAIN_SQL))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens."""
    prepare(spark)
    return pack(docs, default_vocabulary(), end_id=1)


STAGES = [("quality classifier", quality), ("exact dedup", exact_duplicates), ("SimHash near-dedup", near_duplicates),
          ("mixing", mixture), ("packing", packing)]

# SQL expresses neither the classifier, the fingerprints nor the tokenizer: tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
