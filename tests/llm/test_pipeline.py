"""Pipeline stages against brute force on the smallest tables."""

import re

from pyspark.sql import functions as F

import corpus_pipeline as P
from daybar.llm.mixing import mixed_documents
from daybar.llm.quality_knn import fit, quality_votes
from daybar.llm.simhash_bk import fingerprint
from daybar.llm.tables import documents, written


def test_stages(spark, sf):
    docs = documents(spark, sf)
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        before, docs = docs, written(stage(spark, docs, sf), "test-stage")
        kept[name] = docs
        if name == "exact dedup":
            least = {}
            for r in before.collect():
                t = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
                least[t] = min(least.get(t, r.doc_id), r.doc_id)
            assert sorted(r.doc_id for r in docs.collect()) == sorted(least.values())
        if name == "SimHash near-dedup":
            rows = sorted((r.doc_id, fingerprint((r.text or "").encode())) for r in before.collect())
            root = {i: i for i, _ in rows}
            for _ in rows:
                for a, x in rows:
                    for b, y in rows:
                        if (x ^ y).bit_count() <= 4:
                            root[a] = root[b] = min(root[a], root[b])
                if all(root[root[i]] == root[i] for i in root):
                    break
            assert sorted(r.doc_id for r in docs.collect()) == sorted(set(root.values()))
        if name != "packing":
            assert docs.columns == columns
            ids = {r.doc_id for r in before.select("doc_id").collect()}
            assert {r.doc_id for r in docs.select("doc_id").collect()} <= ids
    mixed, pieces = kept["mixing"], kept["packing"]
    assert pieces.where("start = 0").count() == mixed.count()


def test_clashes_and_gaps(spark, docs, empty, sf):
    for _, stage in P.STAGES[1:4]:
        assert stage(spark, empty, sf).count() == 0
        assert stage(spark, docs, sf).columns == docs.columns
    assert P.exact_duplicates(spark, docs, sf).where("doc_id = 2").count() == 0


def test_near_duplicates_without_ids_or_with_repeated_ones(spark, docs, sf):
    base = " ".join(f"word{i}" for i in range(300))
    bits = fingerprint(base.encode())
    near = [t for i in range(300) if 0 < (fingerprint((t := base.replace(f"word{i} ", "x ")).encode()) ^ bits).bit_count() <= 4]
    other = " ".join(f"thing{i}" for i in range(300))
    texts = [(5, base), (None, near[0]), (None, near[1]), (3, near[2]), (3, other), (3, near[3]), (8, other + " end"),
             (None, "quite another text without any id"), (None, "quite another text without any id"), (None, None), (9, "")]
    table = spark.createDataFrame([(i, t, f"row{k}") for k, (i, t) in enumerate(texts)], "doc_id long, text string, lang string")
    fps = [fingerprint((t or "").encode()) for _, t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(fps):
            for b, y in enumerate(fps):
                if (x ^ y).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    groups = {}
    for k, r in enumerate(root):
        groups.setdefault(r, []).append(k)
    got = sorted(int(r.lang[3:]) for r in P.near_duplicates(spark, table.repartition(3), sf).collect())
    assert len(got) == len(groups) < 7
    for own in groups.values():
        stays = [k for k in own if k in got]
        assert len(stays) == 1
        order = [(texts[k][0] is None, texts[k][0] or 0) for k in own]
        assert (texts[stays[0]][0] is None, texts[stays[0]][0] or 0) == min(order)


def test_exact_dedup_has_a_history(spark, docs, empty, sf, monkeypatch):
    seen, real = [], P.exact_groups
    monkeypatch.setattr(P, "exact_groups", lambda d, is_history=None, **more: seen.append(is_history) or real(d, is_history=is_history, **more))
    kept = [r.doc_id for r in P.exact_duplicates(spark, docs, sf).select("doc_id").collect()]
    assert sorted(kept) == [1, 3, 4, 6, 7, 8, 9, 10, 11]
    assert 0 < docs.where(seen[0]).count() < docs.count()
    assert P.exact_duplicates(spark, empty, sf).count() == 0


def test_rows_of_one_id_stay_apart(spark, docs, sf):
    """One id with texts that differ only in white space or in language, wholly repeated rows, clashing names."""
    rows = [(1, "a b", "en", "src0", "k1"), (1, "a  b", "en", "src0", "k2"), (1, "a b", "de", "src0", "k3"), (2, "c d", "en", "src0", "k4"),
            (2, "c d", "en", "src0", "k4"), (None, "e", "en", "src0", "k5"), (None, "f", "en", "src0", "k6")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, text_key string").repartition(3)
    kept = P.exact_duplicates(spark, table, sf)
    assert kept.columns == table.columns
    assert sorted(r.text.replace("  ", " ") for r in kept.collect()) == ["a b", "c d", "e", "f"]
    everything = P.MixPlan({}, 100, 1, "all")
    assert sorted(map(str, mixed_documents(table, everything, F.lit("d")).collect())) == sorted(map(str, table.collect()))
    twice = P.MixPlan({}, 200, 2, "all")
    assert mixed_documents(table, twice, F.lit("d")).count() == 2 * len(rows)
    nothing = mixed_documents(table.where("false"), everything, F.lit("d"))
    assert nothing.columns == table.columns and nothing.count() == 0


def test_quality_and_packing_meet_the_edge_cases(spark, docs, empty, sf):
    kept = P.quality(spark, docs, sf)
    scores = {str(r.doc_id): r.predicted for r in quality_votes(docs, fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()}
    assert kept.columns == docs.columns and P.quality(spark, empty, sf).count() == 0
    assert {str(r.doc_id) for r in kept.collect()} == {i for i, p in scores.items() if p == 1}
    pieces = P.packing(spark, docs, sf).collect()
    assert sum(r.start == 0 for r in pieces) == docs.count() and P.packing(spark, empty, sf).count() == 0
    used = {}
    for r in pieces:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048 and len(used) == -(-sum(r.length for r in pieces) // 2048)
