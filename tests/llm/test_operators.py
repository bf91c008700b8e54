"""Operators against brute force on edge cases and on the smallest tables."""

import hashlib
import os
import re
import textwrap
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybar.llm import packing, quality_knn, rans, repeats, simhash_bk, suffix_dedup, subtree_dedup, text, tokens
from daybar.llm.license_scan import TEMPLATES, license_scan
from daybar.llm.mixing import MixPlan, mix_sources
from daybar.llm.mph_dedup import build_index, exact_dedup, find_slots
from daybar.llm.quality_knn import fit, quality_votes
from daybar.llm.quality_rules import repetition_rules

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def rows_of(docs):
    return [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]


def key(i):
    return 1 << 62 if i is None else i


def covered_by_smaller(units_of, rows, n):
    """For each row, which units lie in a window that also starts in a row with a smaller id."""
    first = {}
    for i, t in rows:
        u = units_of(t)
        for k in range(len(u) - n + 1):
            w = tuple(u[k:k + n])
            first[w] = min(first.get(w, 1 << 63), key(i))
    for i, t in rows:
        u = units_of(t)
        gone = [False] * len(u)
        for k in range(len(u) - n + 1):
            if first[tuple(u[k:k + n])] < key(i):
                gone[k:k + n] = [True] * n
        yield i, u, gone


def short(docs):
    return docs.where(F.coalesce(F.length("text"), F.lit(0)) < 5000)


def test_byte_dedup(docs, empty):
    got = sorted(map(tuple, suffix_dedup.dedup_substrings(short(docs)).collect()), key=str)
    want = []
    for i, u, gone in covered_by_smaller(lambda t: t, rows_of(short(docs)), 50):
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want.append((i, len(u), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(u, gone) if not g)).hexdigest()))
    assert got == sorted(want, key=str)
    assert suffix_dedup.dedup_substrings(docs).count() == docs.count()
    assert suffix_dedup.dedup_substrings(empty).count() == 0


def test_word_dedup(docs, empty):
    got = sorted(map(tuple, subtree_dedup.dedup_words(docs).collect()), key=str)
    want = [(i, len(u), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(u, gone) if not g)).hexdigest())
            for i, u, gone in covered_by_smaller(WORD.findall, rows_of(docs), 13)]
    assert got == sorted(want, key=str)
    assert subtree_dedup.dedup_words(empty).count() == 0


# Many chunks and shards, anchors that are dealt by single windows, runs that are cut, several batches a shard, several hops.
TINY = repeats.Sizes(chunk=20_000, span=1024, longest_run=32, shard_bytes=60_000, hot_chunks=3, batch_units=2048, fan=2)


@pytest.mark.parametrize("operator", ["bytes", "words"])
def test_dealing_in_many_small_parts(spark, sf, operator, monkeypatch):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    passage = " ".join(f"passage{i}" for i in range(80))
    more = [(100_000 + i, f"before {i} {passage} after {i}") for i in range(40)] + [(200_000, "again and " * 3000)]
    table = table.unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(6, "doc_id")
    rows = rows_of(table)
    assert sum(len(t) for _, t in rows) > 8 * TINY.chunk
    if operator == "bytes":
        got = suffix_dedup.dedup_substrings(table, kind=replace(suffix_dedup.KIND, sizes=TINY))
        plain = suffix_dedup.dedup_substrings(table)
    else:
        got = subtree_dedup.dedup_words(table, kind=replace(subtree_dedup.KIND, sizes=TINY))
        plain = subtree_dedup.dedup_words(table)
        want = [(i, len(u), sum(gone), hashlib.sha256(b" ".join(w for w, g in zip(u, gone) if not g)).hexdigest())
                for i, u, gone in covered_by_smaller(WORD.findall, rows, 13)]
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


def test_rows_of_a_hop_grow_with_the_input(spark, sf):
    """Four times the documents: four times the rows of each exchange, not sixteen."""
    one = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    kind = replace(suffix_dedup.KIND, sizes=replace(TINY, shard_bytes=20_000, fan=3))
    rows = []
    for times in (1, 4):
        docs = one.crossJoin(spark.range(times).withColumnRenamed("id", "copy")).select(
            (F.col("doc_id") * 10 + F.col("copy")).alias("doc_id"), "text")
        chunks = repeats.written(repeats.chunk_rows(docs.repartition(8 * times), "doc_id", "text", TINY.chunk), "test-chunks")
        n = chunks.count()
        route = repeats.Route.between(n, n, 3)
        assert route.fan <= 3 and route.fan ** route.hops >= n > 8 * times
        anchors = repeats.written(repeats._anchor_rows(chunks, kind, route), "test-anchors")
        told = anchors.groupBy("hop").applyInPandas(repeats._met(route, 3), repeats._HOP_ROW)
        answers = repeats.written(route.carried(told, repeats._FLAGS, route.to_chunk), "test-answers")
        assert anchors.count() <= n * route.fan and answers.count() <= n * 2 * route.fan * 3
        assert {r.hop for r in answers.select("hop").distinct().collect()} <= {r.chunk for r in chunks.select("chunk").collect()}
        rows.append((n, anchors.count(), answers.count()))
    (n, a, b), (m, c, d) = rows
    assert m / n > 3 and c / a < 1.5 * m / n and d / b < 1.5 * m / n


@pytest.mark.parametrize("shards, most", [(1, 2), (7, 2), (64, 4), (100, 7), (5, 2048)])
def test_entries_reach_every_shard_and_come_back(spark, shards, most):
    route = repeats.Route.between(13, shards, most)
    kind = repeats.Parcel(("<u4", "<i8"), "u1")
    r = np.random.default_rng(4)
    sent = [(int(s), c * 1000, k, r.integers(0, 9, r.integers(0, 5)).astype("u1")) for c in range(13) for k, s in enumerate(np.sort(r.integers(0, shards, 30)))]
    frames = []
    for c in range(13):
        own = [x for x in sent if x[1] == c * 1000]
        to, frm, k = (np.array([x[i] for x in own]) for i in range(3))
        size = np.array([len(x[3]) for x in own])
        frames.append(kind.rows(route.to_shard(to), route.place(frm[:1])[0], to, frm, (k, size), np.concatenate([x[3] for x in own]), np.cumsum(size) - size))
        assert len(frames[-1]) <= route.fan
    rows = spark.createDataFrame([tuple(x) for f in frames for x in f.itertuples(index=False)], repeats._HOP_ROW)
    there = route.carried(rows, kind, route.to_shard).collect()
    got, back = [], []
    for row in there:
        to, frm, (k, size), units = kind.read([row.data])
        assert (to == row.hop).all()
        ends = np.cumsum(size)
        own = [(int(t), int(f), int(i), units[e - n:e].tobytes()) for t, f, i, e, n in zip(to, frm, k, ends, size)]
        for pair in {x[:2] for x in own}:
            assert [x[2] for x in own if x[:2] == pair] == sorted(x[2] for x in own if x[:2] == pair)
        got += own
        back += [tuple(x) for x in kind.rows(route.to_chunk(frm), row.hop, frm, to, (k, size), units, ends - size).itertuples(index=False)]
    assert sorted(got) == sorted((s, c, k, u.tobytes()) for s, c, k, u in sent)
    home = []
    for row in route.carried(spark.createDataFrame(back, repeats._HOP_ROW), kind, route.to_chunk).collect():
        to, frm, (k, _), _ = kind.read([row.data])
        assert (to == row.hop).all()
        home += list(zip(frm.tolist(), to.tolist(), k.tolist()))
    assert sorted(home) == sorted(x[:3] for x in sent)


def thue_morse(n):
    """Two unequal strings whose polynomial hashes modulo 2**64 are equal for every odd base."""
    one = b"a"
    for _ in range(n):
        one += one.translate(bytes.maketrans(b"ab", b"ba"))
    return one, one.translate(bytes.maketrans(b"ab", b"ba"))


def test_strings_of_equal_polynomial_hashes_stay_apart(spark, docs):
    one, two = (x.decode() for x in thue_morse(10))
    tail = " ".join(f"common{i}" for i in range(12))
    words = spark.createDataFrame([(1, f"{one} {tail}"), (2, f"{two} {tail}")], "doc_id long, text string")
    assert [r.n_removed for r in subtree_dedup.dedup_words(words).collect()] == [0, 0]
    lines = spark.createDataFrame([(1, f"{one}\n{two}\n{one}")], "doc_id long, text string")
    assert repetition_rules(lines).first()["n_dup_lines"] == 1
    got = sorted(map(tuple, suffix_dedup.dedup_substrings(words).collect()))
    want = [(i, len(u), sum(gone)) for i, u, gone in covered_by_smaller(lambda t: t, rows_of(words), 50)]
    assert [g[:3] for g in got] == sorted(want)


def test_strings_of_equal_hash_are_compared(monkeypatch):
    monkeypatch.setattr(repeats, "span_hashes", lambda units, starts, ends: np.zeros(len(starts), np.uint64))
    units = np.frombuffer(b"abcabcabdabab", np.uint8)
    got = repeats._distinct_hashes(units, np.array([0, 3, 6, 9, 11]), np.array([3, 3, 3, 2, 2]))
    assert got[0] == got[1] and got[3] == got[4] and len(set(got.tolist())) == 3
    keys = np.zeros(6, np.uint64)
    both, again = text.repeats(keys, lambda a, b: np.array([1, 2, 1, 3, 3, 1])[a] == np.array([1, 2, 1, 3, 3, 1])[b])
    assert both.tolist() == [True, False, True, True, True, True] and again.tolist() == [False, False, True, False, True, True]


def test_suffix_array_is_the_sorted_suffixes():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 7, 30, 200):
        for top in (1, 2, 50):
            s = r.integers(1, top + 1, n)
            assert suffix_dedup.suffix_array(s, 10 ** 9).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_subtrees_of_small_groups(monkeypatch):
    monkeypatch.setattr(subtree_dedup, "SUBTREE", 3)
    units = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14] * 6 + [1] * 40, np.uint64)
    at = np.arange(len(units) - 13 + 1)
    got = subtree_dedup.word_classes(units, at)
    want = [tuple(units[a:a + 13]) for a in at]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_exact_dedup(docs, empty):
    rows = rows_of(docs)
    norm = lambda t: re.sub(rb"[\x20\x09-\x0D]+", b" ", t)
    for history in (None, F.col("doc_id") <= 3):
        out = exact_dedup(docs, is_history=history).collect()
        assert len(out) == len(rows)
        groups = {}
        for i, t in rows:
            groups.setdefault(hashlib.sha256(norm(t)).hexdigest(), []).append(key(i))
        for r in out:
            own = groups[r.text_sha256]
            assert r.group_size == len(own) and key(r.keep_id) == min(own)
        kept = [r.text_sha256 for r in out if r.kept]
        assert sorted(kept) == sorted(groups)
    assert exact_dedup(empty).count() == 0


def test_the_largest_id_is_an_id(spark):
    top = (1 << 63) - 1
    table = spark.createDataFrame([(top, "a"), (None, "a"), (None, "b"), (None, "b"), (0, "c"), (-5, "c")], "doc_id long, text string")
    for history in (None, F.col("doc_id") > 0):
        got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(table, is_history=history).collect()), key=str)
        want = [(top, top, 2, True), (None, top, 2, False), (None, None, 2, True), (None, None, 2, False), (0, -5, 2, False), (-5, -5, 2, True)]
        assert got == sorted(want, key=str)


def test_perfect_hash():
    keys = np.random.default_rng(2).integers(0, 1 << 63, (5000, 4), dtype=np.uint64)
    levels, slot = build_index(keys)
    assert sorted(slot) == list(range(5000)) and (find_slots(levels, keys) == slot).all()


def test_simhash(docs, empty):
    import xxhash
    rows = rows_of(docs)

    def slow(t):
        w = t.lower().split()
        shingles = [b" ".join(w[k:k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    fp = [slow(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (fp[a] ^ fp[b]).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min(least.get(r, 1 << 62), key(i))
    want = sorted((str(i), f"{f:016x}", least[r]) for (i, _), f, r in zip(rows, fp, root))
    got = simhash_bk.simhash_components(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, key(r.component_id)) for r in got) == want
    assert simhash_bk.simhash_components(empty).count() == 0


@pytest.mark.parametrize("size", [3, 2048])
def test_tree_links_join_all_neighbours(spark, size):
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = {int(b ^ np.uint64(sum(1 << int(k) for k in r.integers(0, 64, r.integers(0, 6))))) for b in base for _ in range(25)}
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    links = simhash_bk.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), tree_size=size).collect()

    def parts(pairs):
        up = {x: x for x in signed}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in pairs:
            up[find(a)] = find(b)
        out = {}
        for x in signed:
            out.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, out.values()))

    near = [(a, b) for a in signed for b in signed if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    assert parts([(r.a, r.b) for r in links]) == parts(near)


def test_quality_rules(docs, empty):
    out = {r.doc_id: r for r in repetition_rules(docs).collect()}
    assert repetition_rules(docs).count() == docs.count() and repetition_rules(empty).count() == 0
    assert out[4].n_words == 0 and out[4].base_failed and not out[4].kept
    assert out[1].kept and out[1].n_words == 60 and out[1].n_repeat_words == 0
    assert out[11].n_dup_lines == 2 and out[9].n_words == out[9].n_repeat_words == 80000 and not out[9].kept
    assert out[8].word_chars == 30 * 5


def test_license_scan(docs, empty):
    out = {r.doc_id: r for r in license_scan(docs).collect()}
    assert (out[7].license_id, out[7].dice, out[7].line, out[7].last_line, out[7].n_matches) == ("MIT", 1.0, 1, 1, 1)
    assert out[1].license_id is None and out[4].n_matches == 0 and license_scan(empty).count() == 0
    assert license_scan(docs).count() == docs.count()


def slow_scan(text, templates=TEMPLATES, t=0.8):
    """Every run of segments against every template, by counters."""
    segs = []
    for line, u in enumerate(text.lower().split("\n"), 1):
        for s in re.sub(r"([.;:!?])[ \t\r]+", r"\1\n", u).split("\n"):
            segs += [(line, w)] if (w := re.findall("[a-z0-9]+", s)) else []
    found = []
    for i in range(len(segs)):
        for j in range(i, len(segs)):
            w = [x for _, ws in segs[i:j + 1] for x in ws]
            own = Counter(zip(w, w[1:]))
            for name, body in templates.items():
                b = re.findall("[a-z0-9]+", body.lower())
                b = Counter(zip(b, b[1:]))
                dice = 2.0 * (own & b).total() / (own.total() + b.total()) if own else 0.0
                if dice >= t:
                    found.append((i, -dice, j, name))
    n, upto = 0, -1
    for i, _, j, _ in sorted(found):
        if i > upto:
            n, upto = n + 1, j
    if not n:
        return 0, None, None, None, None
    i, dice, j, name = min(found, key=lambda f: (f[1], f[0], f[2], f[3]))
    return n, name, -dice, segs[i][0], segs[j][0]


def test_licenses_among_other_text(spark):
    mit, wrapped = TEMPLATES["MIT-text"], "\n".join(textwrap.wrap(TEMPLATES["CC-BY-4.0-notice"], 30))
    texts = [
        "Copyright 2024 X. Licensed under CC BY 4.0. See LICENSE for details.",
        f"some text before it\n\n{wrapped}\nand more text that follows the notice",
        f"Copyright (c) 2020 Somebody\n\n{mit}\n\nint main() {{ return 0; }}",
        mit.replace("furnished", "given").replace("merge, publish, ", ""),
        " ".join(TEMPLATES["BSD-2-Clause-text"].split()),
        TEMPLATES["BSD-2-Clause-text"][:400], f"{mit}\nbetween\n{TEMPLATES['ISC-text']}", "MIT", "x y.\n" * 60,
        "All rights reserved. All rights reserved.\nAll rights\nreserved.", "all all all all", "",
        "prose without end " * 3000 + ". " + TEMPLATES["GPL-3.0-header"] + " and prose. " * 50,
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, None), (0, texts[0])]
    out = license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == len(rows) and [tuple(r)[1:] for r in out if r.doc_id == 100] == [(0, None, None, None, None)]
    for r in out:
        if r.doc_id < 100:
            assert tuple(r)[1:] == slow_scan(texts[r.doc_id]), r
    names = {r.doc_id: r.license_id for r in out}
    assert names[0] == "CC-BY-4.0" and names[1] == "CC-BY-4.0-notice" and names[2] == names[3] == "MIT-text"
    assert names[4] == "BSD-2-Clause-text" and names[5] is None and names[12] == "GPL-3.0-header"


def test_license_bags(spark):
    """A template of repeated bigrams: a unit has to repeat them as often."""
    one = {"echo": "a b a b a b a b"}
    texts = ["a b", "a b a b", "a b a b a b", "a b a b a b a b", "a b " * 5, "a b " * 9, "b a b a b a b a"]
    out = license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates=one).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == {i: slow_scan(t, one) for i, t in enumerate(texts)}
    with pytest.raises(ValueError):
        license_scan(spark.createDataFrame([], "doc_id long, text string"), templates={"short": "one"})


def test_mixing(docs, empty):
    plan = MixPlan({"lang": {"en": 3}}, 50, 2)
    out = mix_sources(docs, plan, F.lit(None).cast("string")).collect()
    for leaf in {(r.domain, r.lang, r.source) for r in out}:
        own = [r for r in out if (r.domain, r.lang, r.source) == leaf]
        assert sum(r.n_tokens for r in own) <= own[0].budget
    assert mix_sources(empty, plan, F.lit("d")).count() == 0


def test_classifier(spark, docs, empty, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = fit(table, labels)
    out = quality_votes(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert quality_votes(empty, model).count() == 0
    none = fit(table, labels.where("false"))
    assert {r.score for r in quality_votes(docs, none).collect()} == {0.5}
    good = quality_votes(table, model).join(labels, "doc_id").where("quality = 1")
    assert good.where("predicted = 1").count() >= 0.95 * good.count()


def test_classifier_on_rows_it_never_saw(spark, sf):
    """Recall, precision and the order of scores, on the held-out fold alone."""
    more = f"{os.path.dirname(sf)}/sf0.01"
    table, labels = (spark.read.parquet(f"{more}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_votes(table, fit(table, labels)).join(labels, "doc_id").collect()
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in rows)
    good, bad = ([r for r in rows if r.quality == q] for q in (1, 0))
    hits, false = (sum(r.predicted for r in part) for part in (good, bad))
    assert len(good) >= 20 and len(bad) >= 5
    assert hits >= 0.95 * len(good) and hits >= 0.95 * (hits + false) and false <= 0.2 * len(bad)
    above = sum((g.score > b.score) + (g.score == b.score) / 2 for g in good for b in bad)
    assert above >= 0.97 * len(good) * len(bad)


def test_votes_against_one_document_at_a_time(spark, sf):
    """Blocked products against plain cosines of each document with every sample row."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    model = fit(table, spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r.score for r in quality_votes(table, model).collect()}
    for r in table.limit(60).collect():
        counts = quality_knn._features([(r.text or "").encode()])
        v = model._latent(quality_knn._weighted(counts, model.idf))[0]
        near = sorted(((float(v @ known), label) for known, label in zip(model.known, model.labels)), reverse=True)
        weights = [(max(c, 0.0) ** quality_knn.SHARPNESS, label) for c, label in near[:quality_knn.NEIGHBOURS]]
        total = sum(w for w, _ in weights)
        words = float(counts[0, :-1].sum())
        trust = words / (words + quality_knn.SHORT)
        want = trust * sum(w * label for w, label in weights) / total + (1 - trust) * model.prior if total else model.prior
        assert abs(got[r.doc_id] - want) < 1e-3, r.doc_id


def test_sample_holds_an_id_once(spark, docs):
    rows = [(i % 7, f"text {i} of id {i % 7} with some words") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i % 7, i % 2) for i in range(14)], "doc_id long, quality int")
    assert 0 < len(fit(table, labels, limit=4).known) <= 4
    once = table.groupBy("doc_id").agg(F.min("text").alias("text"))
    assert np.allclose(fit(table, labels).known, fit(once, labels.distinct()).known)


def test_a_table_for_very_many_ids():
    ids = np.arange(300_000, dtype=np.uint32)
    table = rans.Table.of_counts(ids.astype(np.int64), np.ones(len(ids), np.int64))
    block = rans.Block(rans.encode_block([1], [len(ids)], ids, table))
    assert table.scale > rans.SCALE and (block.ids(table) == ids).all()
    with pytest.raises(ValueError):
        block.ids(rans.Table.of_counts(ids[:5].astype(np.int64), np.ones(5, np.int64)))


def slow_ids(text, end):
    model = tokens._Model(tokens.default_vocabulary()).tokenizer
    return np.array(model.encode(text.decode(), add_special_tokens=False).ids + [end], "<u4")


def test_pieces_of_words_encode_like_whole_texts():
    texts = ["", "a\n", "\na", " ", "a  b ", "x\n y <|endoftext|> it's don't  \n\n foo!! 12.5% ½ ² z", "a\x1c b", "'s 's",
             "¿que? ... ,, ", "don't. can't! o'.. it's!!", "中文 字. ЖЖ жж! ªº", "tab\t x  "]
    got = tokens.encode(texts, tokens.default_vocabulary())
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [slow_ids(t.encode(), 0)[:-1].tolist() for t in texts]


def library_ids(texts):
    """Whole texts by the library alone, with its tokenizer as loaded."""
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(tokens.default_vocabulary())
    return [model.encode(t, add_special_tokens=False).ids for t in texts]


def test_mixed_white_space_encodes_like_whole_texts():
    r = np.random.default_rng(6)
    parts = ["a", "word", "it's", "x.", "12", "漢", " ", " ", "\n", "\n", "\n\n", "\t", "\r", "\r\n", "\xa0", "\x1f", "\u2003", "  "]
    texts = ["a\tb\tc\n\n", "a\xa0b\xa0c\n\n\nd", "a\tb\n", "\ta \nb", *("".join(r.choice(parts, n)) for n in r.integers(1, 25, 5000))]
    got = tokens.encode(texts, tokens.default_vocabulary())
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library_ids(texts)


def test_added_tokens_keep_their_ids():
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b.", "one\ntwo <|endoftext|>\n\n<|endoftext|><|endoftext|> !", "<|endoftext|"]
    got = [np.frombuffer(g, "<u4").tolist() for g in tokens.encode(texts, tokens.default_vocabulary())]
    assert got[0] == [87, 220, 50256, 331] and got == library_ids(texts)


def test_new_words_go_to_the_library_together(monkeypatch):
    path, calls = tokens.default_vocabulary(), []
    model = tokens._Model(path)
    one_by_one = model.letters
    monkeypatch.setitem(tokens._models, path, model)
    monkeypatch.setattr(model, "letters", lambda lead, word: calls.append(word) or one_by_one(lead, word))
    r = np.random.default_rng(8)
    words = ["".join(r.choice(list("abcdeéöß"), r.integers(1, 12))) for _ in range(3000)]
    texts = [" ".join(w + r.choice(["", "", ",", "...", "!?"]) for w in words[k:k + 300]) for k in range(0, 3000, 300)]
    got = tokens.encode(texts, path)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == library_ids(texts)
    assert len(calls) <= len(texts) + 5  # the first word of each text; one by one it is nearly every word


def test_words_beside_marks_lines_and_control_characters(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 40)  # several generations
    monkeypatch.setattr(tokens, "_models", {})
    r = np.random.default_rng(9)
    words = ["a", "Word", "word,", "word,,", "12.5%,", "12.5%", "12.5", "\x01a", "\x00", "\x02.", "é!", "ж.", "漢,", "½:", "'s", "it's!", "...", ",", "%a%", "Ġx", "Ċ", "ª.", "ɐ.",
             *("".join(r.choice(list("abcdeé"), 5)) for _ in range(60))]
    texts = ["".join(r.choice(words) + r.choice([" ", " ", "\n"]) for _ in range(n)) + "z" for n in r.integers(0, 30, 1500)]
    for _ in range(2):
        got = [g for k in range(0, len(texts), 100) for g in tokens.encode(texts[k:k + 100], tokens.default_vocabulary())]
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == library_ids(texts)
    assert set(tokens._OTHER_SPACE) == {c for c in map(chr, range(0x110000)) if c.isspace()} - {" ", "\n"}


def test_coded_blocks(docs, empty):
    out = rans.coded_documents(docs, tokens.default_vocabulary(), 0).orderBy("start").collect()
    rows = sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in out] == [i for i, _ in rows]
    at = 0
    for r, (_, t) in zip(out, rows):
        assert r.start == at
        at += r.n_tokens
    assert sorted((r.n_tokens, r.ids_crc32) for r in out) == sorted(
        (len(x), zlib.crc32(x.tobytes())) for x in (slow_ids(t, 0) for _, t in rows))
    assert rans.coded_documents(empty, tokens.default_vocabulary(), 0).count() == 0


def test_block_checkpoints_and_checksums():
    r = np.random.default_rng(4)
    ids = np.minimum(r.geometric(0.01, 700_000), 3000).astype(np.uint32)
    table = rans.Table.of_counts(*np.unique(ids, return_counts=True))
    data = rans.encode_block([1, None], [300_000, 400_000], ids, table)
    block = rans.Block(data)
    assert block.doc_ids == [1, None] and (block.ids(table) == ids).all() and len(block.places)
    for k in range(1, len(block.places) + 1):
        assert (block.ids(table, k) == ids[k * rans.CHECKPOINT * rans.LANES:]).all()
    with pytest.raises(ValueError):
        rans.Block(data[:-1] + bytes([data[-1] ^ 1]))


def test_packing(docs, empty):
    out = packing.pack(docs, tokens.default_vocabulary(), 1).collect()
    want = sorted(len(slow_ids(t, 1)) for _, t in rows_of(docs))
    assert sorted(r.doc_tokens for r in out if r.start == 0) == want and sum(r.length for r in out) == sum(want)
    # The pieces of each document lie end to end, and their ids are the library's.
    pieces = {}
    for r in out:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    for i, t in rows_of(docs):
        ids = library_ids([t.decode()])[0] + [1]
        own = [(a, n, crc) for a, n, crc in pieces[i, len(ids)] if zlib.crc32(np.array(ids[a:a + n], "<u4").tobytes()) == crc]
        reached = 0
        for a, n in sorted({x[:2] for x in own}):
            assert a <= reached
            reached = max(reached, a + n)
        assert reached == len(ids)
    by = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by.get(r.sequence_id, 0)
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= 2048
    assert packing.pack(empty, tokens.default_vocabulary(), 1).count() == 0


def test_best_fill_is_the_closest_sum():
    r = np.random.default_rng(5)
    for _ in range(40):
        counts = {int(n): int(c) for n, c in zip(r.integers(1, 40, 5), r.integers(1, 4, 5))}
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1)}
        got = packing.best_fill(counts, 60)
        assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= 60)
        assert all(k <= counts[n] for n, k in got.items())
