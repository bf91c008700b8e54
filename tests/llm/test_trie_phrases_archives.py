"""Conversation trie, phrases and archives against brute force on edge cases."""

import base64
import gzip
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybar.llm import conversation_trie, phrases, warc
from daybar.session import scratch_path

TURNS = "conv_id long, turn long, role string, text string, name string, d long, part string, symbol string, depth string"


def turn(c, n, role, text):
    return (c, n, role, text, "x", 0, "x", "x", "x")


@pytest.fixture(scope="module")
def turns(spark, docs):
    """Shared beginnings, null and tied turns, repeated rows, a null id, negative ids, a conversation of 300 turns."""
    r = np.random.default_rng(7)
    rows = [turn(c, n, ("user", "assistant")[n % 2], f"text {r.integers(0, 2)} é😀"[:7 + n])
            for c in [*range(0, 40), 100, 105, 199, 250, -7, -100, -150] for n in range(r.integers(1, 9))]
    rows += [turn(300, n, "user", "again" if n % 3 else None) for n in range(300)]
    rows += [turn(301, n, "user", "again" if n % 3 else None) for n in range(290)]
    rows += [turn(41, None, None, None), turn(41, None, "user", ""), turn(41, 0, "user", "b"), turn(41, 0, "user", "a"),
             turn(42, 0, "user", "same"), turn(42, 0, "user", "same"), turn(None, 0, "user", "nobody"), turn(400, 0, "12:a", "b"),
             turn(500, 0, "12:", "ab")]
    return spark.createDataFrame(rows, TURNS).repartition(4)


def slow_trie(seqs):
    nodes = defaultdict(lambda: {"members": [], "ends": []})
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])]["members"].append(c)
        nodes[tuple(s)]["ends"].append(c)
    for p, n in nodes.items():
        n |= {"kids": 0, "leaves": 0, "saved": 0}
    for p in nodes:
        if p:
            nodes[p[:-1]]["kids"] += 1
    for p, n in nodes.items():
        own = (len(n["members"]) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            nodes[p[:d]]["leaves"] += n["kids"] == 0
            nodes[p[:d]]["saved"] += own
    hash_of = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((min(n["members"]), len(p), min(nodes[p[:-1]]["members"]) if p else None, len(n["members"]), n["kids"],
                    n["leaves"], n["saved"], hash_of(n["ends"])) for p, n in nodes.items()), key=str)


def in_order(turns):
    own = defaultdict(list)
    for r in turns.where("conv_id is not null").collect():
        role, text = r.role or "", r.text or ""
        digest = hashlib.sha256(bytes([0]) + f"{len(role.encode())}:{role}{text}".encode()).digest()
        own[r.conv_id].append((r.turn is not None, r.turn or 0, digest, (role, text)))
    return {c: [t[-1] for t in sorted(x, key=lambda t: t[:3])] for c, x in own.items()}


@pytest.mark.parametrize("ends, span", [(4096, 64), (3, 2)])
def test_conversation_trie(turns, monkeypatch, ends, span):
    monkeypatch.setattr(conversation_trie, "ENDS_IN_ROW", ends)
    monkeypatch.setattr(conversation_trie, "SPAN", span)
    own = in_order(turns)
    rebuilt = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + s[h:]
    got = conversation_trie.prefix_trie(*conversation_trie.branched_sequences(turns)).drop("name", "parent")
    assert sorted(map(tuple, got.collect()), key=str) == slow_trie(rebuilt)
    if span == 64:
        got = conversation_trie.prefix_trie(*conversation_trie.sequences(turns)).drop("name", "parent")
        assert sorted(map(tuple, got.collect()), key=str) == slow_trie(own)


def test_conversation_trie_of_nothing(turns):
    for rows in (turns.where("false"), turns.where("conv_id is null")):
        assert conversation_trie.prefix_trie(*conversation_trie.branched_sequences(rows)).count() == 0
    one = conversation_trie.branched_sequences(turns.where("conv_id = 105 and turn = 0"))  # its first turns belong to an absent one
    assert [tuple(r)[:7] for r in conversation_trie.prefix_trie(*one).collect()] in (
        [(105, 0, None, 1, 0, 1, 0)], [(105, 0, None, 1, 1, 1, 0), (105, 1, 105, 1, 0, 1, 0)])


def test_a_conversation_over_several_ranges(spark, turns):
    big = turns.withColumn("conv_id", F.lit(7).cast("long"))
    seqs, lengths = conversation_trie.sequences(big.unionByName(big))
    n = 2 * turns.count()
    assert sorted(r.d for r in seqs.collect()) == list(range(1, n + 1)) and lengths.first()["length"] == n


def slow_phrases(rows, top, width=3, least=10):
    out = []
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for n in range(1, width + 1):
                for i in range(len(w) - n + 1):
                    counts[lang or "und"][tuple(w[i:i + n])] += 1
    for lang, f in counts.items():
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and b >= least and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in f.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


PHRASE_ROWS = [
    *[("en", "The Quick brown fox, the quick dog; a b\tc. New York City is New York")] * 11, ("en", None), ("en", ""), ("en", " ,.\n"),
    *[(None, "il y a il y a\x0bil y a")] * 9, *[("fr", "\xa0x y\xa0z \x1c x y\xa0z É é ß 漢 漢")] * 10, ("und", "il y a"),
    ("en", "new york " * 4000), ("de", "wort " + "w" * 5000 + " wort ende! "), *[("de", "der tag der tag, der tag und")] * 12,
]


# Bursts, spills in the middle of texts, new numberings, several partitions that are split again.
SMALL = phrases.Limits(burst=6, held=40, slice=64, word_bytes=200, part_bytes=20_000, merged=15)


@pytest.mark.parametrize("limits", [phrases.Limits(), SMALL])
def test_phrases(spark, docs, limits):
    table = spark.createDataFrame([(i, t, x, "x", 0) for i, (x, t) in enumerate(PHRASE_ROWS)],
                                  "part long, text string, lang string, words string, n long").repartition(3)
    for top, width in ((2000, 3), (2, 2)):
        got = phrases.collocations(table, top=top, max_words=width, limits=limits)
        assert sorted(map(tuple, got.collect())) == slow_phrases(PHRASE_ROWS, top, width)
    assert phrases.collocations(table.where("false")).count() == 0
    assert phrases.collocations(table.where("text is null")).count() == 0


def test_a_trie_bursts_at_words_and_spills_whole_subtrees():
    r = np.random.default_rng(8)
    trie, want = phrases.Trie(3, burst=20), Counter()
    for _ in range(20):
        keys = phrases.phrase_keys(np.minimum(r.geometric(0.2, 400), 40) - 1, 0, 3)
        trie.add(keys)
        want.update(keys.tolist())
    assert len(trie.containers) > 10 and max(c.n for c in trie.containers) <= 20 and trie.starts == sorted(trie.starts)
    assert {k: v for c in trie.containers for k, v in zip(*(x.tolist() for x in c.items()))} == want
    keys, counts = trie.spill(100)
    assert len(trie) <= 100 and len(keys) + len(trie) == len(want)
    assert all(want[k] == n for k, n in zip(keys.tolist(), counts.tolist()))


PAGES = [
    (1, "http://www.Example.org/a?b=1#frag", "<p>one</p>"), (2, "https://www.example.org:8443/a", "<p>one</p>"),
    (3, "http://www.example.org/a?b=1", "<p>two é😀</p>"), (9, None, "<p>one</p>"), (4, "", None), (5, "http://1.2.3.4/x y", ""),
    (6, "http://[::bad", "<p>one</p>"), (None, "http://n.org", "<p>two é😀</p>"), (None, "http://n.org", "only without ids"),
    (None, "http://n.org", "only without ids"), (7, "http://www.example.org/a?b=1", "twice"), (7, "http://www.example.org/a?b=1", "twice"),
    (8, "not a url\r\nX: y", "x" * 3_000_000), *[(100 + i, "http://hot.org/", f"page {i}") for i in range(50)],
]


FEW = warc.Limits(archive_bytes=2000, block_lines=3, part_captures=7, key_chars=9, read_bytes=900, read_gap=10)


@pytest.mark.parametrize("limits", [warc.Limits(), FEW])
def test_archives(spark, docs, limits):
    table = spark.createDataFrame([(*p, "x", 0, "x") for p in PAGES], "page_id long, url string, html string, row string, key long, file string").repartition(3)
    got = warc.archived_pages(spark, table, limits).collect()
    groups = defaultdict(list)
    for i, _, html in PAGES:
        groups[html or ""].append(i)
    want = []
    for html, ids in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        kept, *others = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        want += [(kept, len(data), digest, "response", None)] + [(i, len(data), digest, "revisit", kept) for i in others]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert warc.archived_pages(spark, table.where("false")).count() == 0


def test_archives_are_warc_files_and_the_index_finds_one_url(spark, docs):
    table = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    folder = scratch_path(spark, "test-warc")
    captures = warc.write_archives(table, folder)
    index = warc.build_index(captures, folder)
    asked = spark.createDataFrame([("http://www.example.org/a?b=1",), ("http://nobody.org/",), (None,)], "url string")
    found = warc.read_captures(warc.find_captures(index, folder, asked), folder).collect()
    assert sorted(str(r.page_id) for r in found) == ["1", "3", "4", "7", "7", "9"]
    system, path = warc._open(f"{folder}/archives")
    data = b"".join(gzip.decompress(system.open_input_file(f"{path}/{r.file}").read()) for r in captures.select("file").distinct().collect())
    assert data.count(b"WARC/1.1\r\n") == len(PAGES) + captures.select("file").distinct().count()
    assert b"\r\nX: y" not in data and data.count(b"WARC-Type: revisit\r\n") == 7


def test_url_keys():
    keys = {"http://www.Example.org:80/a?b#c": "org,example,www)/a?b", "https://a.b:8443": "b,a:8443)/", "http://1.2.3.4/x": "1.2.3.4)/x",
            None: "-", "": "-", "http://ex.org/é x": "org,ex)/%C3%A9%20x", "mailto": "mailto"}
    assert {u: warc.url_key(u) for u in keys} == keys
