"""Quality classifier: nearest neighbours vote in a latent-semantic space.

Texts become log-scaled, idf-weighted counts of hashed byte trigrams, and the
share of words that repeat the word before; the singular directions of a bounded sample of labelled texts span the latent space. The sample's vectors (``MAX_LABELLED`` rows of ``RANK`` floats,
1 MB) are sent to every task. A task takes blocks of documents, computes all
exact cosine products of a block with the labelled vectors as one matrix
product, and lets the nearest vote, weighted by (a power of) their similarity. Short texts lean to the prior. No index
and no pruning: every document meets every labelled vector.

Labels: only rows whose crc32(id) mod 5 is not 0 are learnt from, the
``MAX_LABELLED`` first by hash of the id (a documented sample; scoring covers
all rows). Scores use the text alone.

Defined cases: a null or empty text has no direction and gets the share of
positive labels in the sample; labels that are null or without a document are
left out; without any label all scores are 0.5; repeated rows score alike, and
are learnt from once for each label (of unlike texts with one id the least);
very long texts are counted whole; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybar.llm.text import as_bytes, chunked, feature_hashes, joined, words_of

MAX_LABELLED = 4096
TERMS = 2048
RANK = 64
SHARPNESS = 32       # power of the similarity by which a neighbour votes
NEIGHBOURS = 9
BLOCK = 256          # documents in one matrix product
REPEAT_WEIGHT = 1.5  # of the share of repeated words, against the trigram part's length of 1
SHORT = 20           # trigrams at which the votes count as much as the prior
THRESHOLD = 0.3
FOLDS = 5


def fold(id_col: Column) -> Column:
    return F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % FOLDS


def _term_counts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Counts of hashed byte trigrams, a row for each text; trigrams never cross texts."""
    lens = np.diff(begins) - 1
    out = np.zeros((len(lens), TERMS), np.float32)
    for a in range(len(lens)):
        n = int(lens[a])
        if n < 3:
            continue
        s = int(begins[a])
        for at in range(s, s + n - 2, 1 << 20):  # a long text in pieces that overlap by two bytes
            b = data[at:min(at + (1 << 20) + 2, s + n)].astype(np.uint32)
            code = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - 11)
            out[a] += np.bincount(code, minlength=TERMS)
    return out


def _features(texts: list[bytes]) -> np.ndarray:
    """Trigram counts, and the share of words equal to the word before (the last column)."""
    data, begins = joined(texts)
    starts, ends, first = words_of(data, begins)
    hashes = feature_hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    same = np.zeros(len(doc), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    share = np.bincount(doc[same], minlength=len(texts)) / np.maximum(1, np.diff(first))
    return np.column_stack([_term_counts(data, begins), share.astype(np.float32)])


def _weighted(features: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(features[:, :-1]) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
    return np.column_stack([x, REPEAT_WEIGHT * features[:, -1]])


class LatentVotes:
    """The fitted space and the labelled vectors in it."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int = RANK):
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.labels = labels.astype(np.float32)
        seen = (counts[:, :-1] > 0).sum(axis=0)
        self.idf = (np.log((1 + len(counts)) / (1 + seen)) + 1).astype(np.float32)
        x = _weighted(counts, self.idf)
        # Subspace iteration finds the leading right singular vectors; a fixed start makes it repeatable.
        basis = np.random.default_rng(7).standard_normal((x.shape[1], rank + 16)).astype(np.float32)
        for _ in range(4 if len(x) else 0):
            basis, _ = np.linalg.qr(x.T @ (x @ basis))
        left, _, _ = np.linalg.svd((basis.T @ x.T) if len(x) else basis.T, full_matrices=False)
        self.space = (basis @ left)[:, :rank]
        self.known = self._latent(x)

    def _latent(self, x: np.ndarray) -> np.ndarray:
        v = x @ self.space
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.known):
            return out
        k = min(NEIGHBOURS, len(self.known))
        for a in range(0, len(texts), BLOCK):
            features = _features(texts[a:a + BLOCK])
            v = self._latent(_weighted(features, self.idf))
            cosine = v @ self.known.T
            near = np.argpartition(cosine, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            got = total > 0
            votes = np.clip((weight * self.labels[near]).sum(axis=1)[got] / total[got], 0, 1)
            trust = features[got, :-1].sum(axis=1, dtype=np.float64)
            trust /= trust + SHORT
            out[a:a + BLOCK][got] = trust * votes + (1 - trust) * self.prior
        return np.round(out, 6)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", limit: int = MAX_LABELLED) -> LatentVotes:
    """Fit on the first ``limit`` labelled rows by hash of the id, outside the held-out fold."""
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & (fold(F.col(id_col)) != 0)).select(
        F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    chosen = usable.distinct().join(docs.select(F.col(id_col).alias("__id")), "__id", "left_semi").orderBy(
        F.xxhash64("__id"), "__id", "__label").limit(limit)
    # An id that repeats counts once for each label, with the least of its texts: the sample stays within the limit.
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(
        F.broadcast(chosen), "__id").groupBy("__id", "__label").agg(F.min("__text").alias("__text"))

    def count(batches):
        for batch in batches:
            own = as_bytes(batch.column(1))
            for a, b in chunked(own):
                rows = _features(own[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a),
                     pa.array([np.packbits(r > 0).tobytes() for r in rows], pa.binary()),
                     pa.array([r[r > 0].tobytes() for r in rows], pa.binary())], names=["__id", "__label", "has", "n"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows: pd.DataFrame = texts.select("__id", "__text", "__label").mapInArrow(
        count, f"__id {kind}, __label int, has binary, n binary").toPandas().sort_values(["__id", "__label"])
    counts = np.zeros((len(rows), TERMS + 1), np.float32)
    for i, (has, n) in enumerate(zip(rows["has"], rows["n"])):
        counts[i, np.unpackbits(np.frombuffer(has, np.uint8), count=TERMS + 1).astype(bool)] = np.frombuffer(n, np.float32)
    return LatentVotes(counts, rows["__label"].to_numpy())


def quality_votes(docs: DataFrame, model: LatentVotes, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """One row per input row: id, held_out, score, predicted; or, with ``keep``, those columns of the rows predicted 1."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column(1))
            scores = np.concatenate([sent.value.scores(texts[a:b]) for a, b in chunked(texts)] or [np.zeros(0)])
            if keep is not None:
                yield batch.select(range(2, 2 + len(keep))).filter(pa.array(scores >= threshold))
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=[id_col, "score"])

    if keep is not None:
        kept = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), *keep)
        return kept.mapInArrow(run, docs.select(*keep).schema)
    scored = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, F.coalesce(fold(F.col(id_col)) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
