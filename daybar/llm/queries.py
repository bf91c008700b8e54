"""Registered queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybar.llm.conversation_trie import branched_sequences, prefix_trie
from daybar.llm.license_scan import TEMPLATES, THRESHOLD, fitting_sizes, license_scan, template_bigrams
from daybar.llm.mixing import MixPlan, mix_sources
from daybar.llm.mph_dedup import exact_dedup
from daybar.llm.packing import pack
from daybar.llm.phrases import collocations
from daybar.llm.quality_knn import fit, quality_votes
from daybar.llm.quality_rules import RepetitionRules, repetition_rules
from daybar.llm.rans import coded_documents
from daybar.llm.simhash_bk import simhash_components
from daybar.llm.subtree_dedup import LENGTH as WINDOW_WORDS, dedup_words
from daybar.llm.suffix_dedup import LENGTH as STRING_BYTES, dedup_substrings
from daybar.llm.tables import documents, table
from daybar.llm.tokens import default_vocabulary
from daybar.llm.warc import archived_pages

# Parameters of the mixing query: src0 is the web crawl, the one-digit sources reference works, the others forums.
DOMAIN_SQL = "case when source = 'src0' then 'web' when length(source) = 4 then 'reference' when source is not null then 'forum' end"
MIX = MixPlan({"domain": {"web": 2, "reference": 3, "forum": 4}, "lang": {"en": 4, "de": 2, "fr": 2}}, 60, 2, "mix-1")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_votes(docs, fit(docs, table(spark, sf_dir, "labels")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(documents(spark, sf_dir))


def op6_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_documents(documents(spark, sf_dir), default_vocabulary(), end_id=0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), default_vocabulary(), end_id=1)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    # The lower half of the ids is the history, the upper half arrives.
    middle = docs.agg(((F.min("doc_id") + F.max("doc_id")) / 2).cast("long")).first()[0]
    return exact_dedup(docs, is_history=F.col("doc_id") <= F.lit(middle))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir), MIX, F.expr(DOMAIN_SQL))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*branched_sequences(table(spark, sf_dir, "conversations"))).drop("name", "parent")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark, table(spark, sf_dir, "pages"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_suffix_dedup, op3_quality_rules, op4_quality_classifier, op5_substring_dedup, op6_rans,
    op7_packing, op8_simhash, op9_exact_dedup, op10_mixing, op11_conversation_trie,
    op12_warc, op13_phrases)}


# ---------------------------------------------------------------- oracle SQL
_WORD = r"[^\x20\x09-\x0D]+"


def _license_sql() -> str:
    known = [(name, bag, sum(bag.values())) for name, bag in template_bigrams(TEMPLATES)]
    rows = ", ".join(f"('{name}', '{pair}', {m})" for name, bag, _ in known for pair, m in bag.items())
    sizes = [(name, n, fitting_sizes(n, THRESHOLD)) for name, _, n in known]
    bounds = ", ".join(f"('{name}', {n}, {fit[0]}, {fit[-1]})" for name, n, fit in sizes)
    return rf"""with recursive t(name, pair, m) as (values {rows}),
z(name, size, least, most) as (values {bounds}),
d as (select doc_id, row_number() over () as rid, translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low from documents),
l as (select rid, unnest(string_split(low, chr(10))) as u, generate_subscripts(string_split(low, chr(10)), 1) as line from d),
c as (select rid, line, string_split(regexp_replace(u, '([.;:!?])[ \t\r]+', '\1' || chr(10), 'g'), chr(10)) as cut from l),
g as (select rid, line, unnest(cut) as u, generate_subscripts(cut, 1) as part from c),
w as (select rid, line, part, list_filter(string_split(regexp_replace(u, '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') as ws
      from g),
s as (select rid, line, ws, row_number() over (partition by rid order by line, part) as seg,
             sum(len(ws)) over (partition by rid order by line, part) as upto from w where len(ws) > 0),
k as (select rid, unnest(ws) as w, upto - len(ws) + generate_subscripts(ws, 1) as pos from s),
p as (select a.rid, a.pos, a.w || ' ' || b.w as pair from k a join k b on a.rid = b.rid and b.pos = a.pos + 1),
h as (select p.rid, t.name, p.pos, t.pair, t.m from p join t using (pair)),
r as (select a.rid, a.seg as i, b.seg as j, a.upto - len(a.ws) + 1 as lo, b.upto as hi, z.name, z.size, a.line, b.line as last_line
      from (select distinct rid, name from h) x join z using (name) join s a on a.rid = x.rid
      join s b on b.rid = a.rid and b.seg between a.seg and a.seg + z.most
        and b.upto - (a.upto - len(a.ws)) - 1 between z.least and z.most),
o as (select r.rid, r.i, r.j, r.lo, r.hi, r.name, r.size, r.line, r.last_line, h.pair, least(count(*), any_value(h.m)) as shared
      from r join h on h.rid = r.rid and h.name = r.name and h.pos >= r.lo and h.pos < r.hi group by all),
q as (select rid, i, j, name, line, last_line, 2.0::double * sum(shared) / (hi - lo + size) as dice
      from o group by rid, i, j, lo, hi, name, size, line, last_line),
f as (select *, row_number() over (partition by rid order by i, dice desc, j, name) as nth,
             row_number() over (partition by rid order by dice desc, i, j, name) as best
      from q where dice >= {THRESHOLD}::double),
n(rid, nth, upto, seen) as (select rid, nth, j, 1 from f where nth = 1
      union all
      select n.rid, f.nth, f.j, n.seen + 1 from n join f on f.rid = n.rid
      where f.nth = (select min(e.nth) from f e where e.rid = n.rid and e.i > n.upto)),
v as (select rid, max(seen) as n_matches from n group by rid)
select d.doc_id, coalesce(v.n_matches, 0)::bigint as n_matches, f.name as license_id, f.dice,
       f.line::bigint as line, f.last_line::bigint as last_line
from d left join f on f.rid = d.rid and f.best = 1 left join v on v.rid = d.rid"""


def _rules_sql(rules: RepetitionRules = RepetitionRules()) -> str:
    grams, outer = [], []
    for n in sorted({rules.base_window, *(n for n, _ in rules.ngram_limits)}):
        over = f"over (partition by doc_id order by i rows between current row and {n - 1} following)"
        grams.append(f"case when count(*) {over} = {n} then string_agg(w, ' ') {over} end as g{n}")
    flags = [f"g{rules.base_window} is not null and count(*) over (partition by doc_id, g{rules.base_window}) > 1 as r"]
    back = lambda c, n: f"max({c}) over (partition by doc_id order by i rows between {n - 1} preceding and current row)"
    cover = [f"{back('r', rules.base_window)} as cr"]
    for n, _ in rules.ngram_limits:
        flags.append(f"g{n} is not null and row_number() over (partition by doc_id, g{n} order by i) > 1 as f{n}")
        cover.append(f"{back(f'f{n}', n)} as c{n}")
        outer.append(f"coalesce(sum(length(w)) filter (c{n}), 0)::bigint as dup_chars_{n}")
    verdict = " or ".join([f"100 * dup_line_chars > {rules.line_limit} * word_chars",
                           *(f"100 * dup_chars_{n} > {lim} * word_chars" for n, lim in rules.ngram_limits)])
    return rf"""with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, unnest(regexp_extract_all(t, '{_WORD}')) as w,
             generate_subscripts(regexp_extract_all(t, '{_WORD}'), 1) as i from d),
g as (select *, {', '.join(grams)} from w),
f as (select *, {', '.join(flags)} from g),
c as (select doc_id, w, {', '.join(cover)} from f),
m as (select doc_id, count(*) as n_words, sum(length(w))::bigint as word_chars,
             count(*) filter (cr) as n_repeat_words, {', '.join(outer)} from c group by doc_id),
l as (select doc_id, unnest(string_split(t, chr(10))) as l, generate_subscripts(string_split(t, chr(10)), 1) as i from d),
lf as (select doc_id, l, row_number() over (partition by doc_id, l order by i) > 1 as again from l where regexp_matches(l, '{_WORD}')),
lm as (select doc_id, count(*) filter (again) as n_dup_lines,
              coalesce(sum(length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g'))) filter (again), 0)::bigint as dup_line_chars
       from lf group by doc_id),
a as (select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
             coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(dup_line_chars, 0) as dup_line_chars,
             {', '.join(f'coalesce(dup_chars_{n}, 0) as dup_chars_{n}' for n, _ in rules.ngram_limits)}
      from d left join m using (doc_id) left join lm using (doc_id)),
b as (select *, n_words < {rules.min_words} or 100 * n_repeat_words > {rules.base_percent} * n_words as base_failed from a)
select *, not base_failed and not ({verdict}) as kept from b"""


# Bytes as pairs of hex digits, so that substrings never cut a character's bytes wrongly. Strings are compared by
# their MD5, and cut out of blocks of 500 bytes and the string that begins at the last one, not out of whole texts.
_BYTES_SQL = f"""with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
k as (select doc_id, o, substr(h, (2 * o + 1)::bigint, {2 * (500 + STRING_BYTES - 1)}) as k
      from (select doc_id, h, unnest(range(0, (strlen(h) // 2)::bigint, 500)) as o from d)),
p as (select doc_id, o + j as i, substr(k, (2 * j + 1)::bigint, 2) as b,
             case when strlen(k) >= 2 * (j + {STRING_BYTES}) then md5_number(substr(k, (2 * j + 1)::bigint, {2 * STRING_BYTES})) end as s
      from (select doc_id, o, k, unnest(range(0, least(500, strlen(k) // 2)::bigint)) as j from k)),
m as (select s, min(doc_id) as m from p where s is not null group by s having count(*) > 1),
r as (select p.doc_id, p.i, p.b, m.m < p.doc_id as r from p left join m on p.s = m.s),
c as (select doc_id, i, b, coalesce(max(case when r then i end) over (partition by doc_id order by i) > i - {STRING_BYTES}, false) as gone from r),
g as (select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as new from c),
a as (select doc_id, count(*) filter (gone) as n_removed, count(*) filter (new) as n_spans,
             sha256(unhex(coalesce(string_agg(b, '' order by i) filter (not gone), ''))) as kept_sha256 from g group by doc_id)
select d.doc_id, strlen(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       coalesce(kept_sha256, sha256('')) as kept_sha256 from d left join a using (doc_id)"""

_WORDS_SQL = rf"""with l as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as l from documents),
w as (select doc_id, unnest(l) as w, generate_subscripts(l, 1) as i from l),
g as (select doc_id, i, w, case when count(*) over n = {WINDOW_WORDS} then string_agg(w, ' ') over n end as g from w
      window n as (partition by doc_id order by i rows between current row and {WINDOW_WORDS - 1} following)),
f as (select doc_id, i, w, g is not null and min(doc_id) over (partition by g) < doc_id as f from g),
c as (select doc_id, i, w, max(f) over (partition by doc_id order by i rows between {WINDOW_WORDS - 1} preceding and current row) as gone
      from f),
a as (select doc_id, count(*) as n_words, count(*) filter (gone) as n_removed,
             sha256(coalesce(string_agg(w, ' ' order by i) filter (not gone), '')) as kept_sha256 from c group by doc_id)
select l.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed,
       coalesce(kept_sha256, sha256('')) as kept_sha256 from l left join a using (doc_id)"""

_DEDUP_SQL = r"""with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from d"""


def _mix_sql(plan: MixPlan = MIX) -> str:
    levels = ("domain", "lang", "source")

    def weight(level: str) -> str:
        given = " ".join(f"when '{v}' then {w}" for v, w in sorted(plan.weights.get(level, {}).items()))
        return f"(case {level} {given} else 1 end)" if given else "1"

    parts = []
    for k, level in enumerate(levels):
        parent = ", ".join(levels[:k])
        by = f"partition by {parent}" if parent else ""
        keys = ", ".join(levels[:k + 1])
        source = f"(select {keys}, sum(cap) as cap from base group by {keys})"
        given = f"join b{k - 1} using ({parent})" if k else "cross join whole"
        budget = "b.budget" if k else "whole.given"
        if k:
            given = f"join (select {parent}, budget as given from b{k - 1}) p using ({parent})"
            budget = "p.given"
        prior = f"over ({by} order by cap::double / w, {level} rows between unbounded preceding and 1 preceding)"
        parts.append(f"""n{k} as (select n.*, {weight(level)}::bigint as w, {budget} as given0 from {source} n {given}),
o{k} as (select *, least(given0, sum(cap) over ({by})) as given from n{k}),
q{k} as (select *, given - coalesce(sum(cap) {prior}, 0) as rest, sum(w) over ({by}) - coalesce(sum(w) {prior}, 0) as rest_w from o{k}),
f{k} as (select *, cap * rest_w <= w * rest as filled from q{k}),
g{k} as (select *, given - coalesce(sum(cap) filter (filled) over ({by}), 0) as remain, sum(w) filter (not filled) over ({by}) as remain_w from f{k}),
b{k} as (select {keys}, (case when filled then cap else (w * remain) // remain_w end)::bigint as budget from g{k})""")
    positive = " and ".join(f"{weight(level)} > 0" for level in levels)
    return rf"""with docs as (select doc_id, coalesce({DOMAIN_SQL}, 'unknown') as domain, coalesce(lang, 'unknown') as lang,
       coalesce(source, 'unknown') as source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as n_tokens from documents),
leaves as (select domain, lang, source, sum(n_tokens)::bigint as tokens from docs group by all),
base as (select *, tokens * {plan.max_epochs} as cap from leaves where {positive}),
whole as (select (sum(tokens) * {plan.percent}) // 100 as given from leaves),
{', '.join(parts)},
r as (select l.domain, l.lang, l.source, budget, budget // tokens as full_epochs, budget % tokens as rest
      from leaves l join b2 using (domain, lang, source) where tokens > 0),
k as (select docs.*, budget, full_epochs, rest, md5('{plan.seed}:' || (full_epochs + 1)::varchar || ':' || doc_id::varchar) as ok
      from docs join r using (domain, lang, source)),
s as (select *, sum(n_tokens) over (partition by domain, lang, source order by ok, doc_id, n_tokens
                                    rows between unbounded preceding and current row) as running from k),
e as (select *, full_epochs + (rest > 0 and running <= rest)::int as epochs from s)
select doc_id, domain, lang, source, n_tokens, unnest(range(1, (epochs + 1)::bigint)) as epoch, budget from e"""


# CRC-32 bit by bit: a value of the list is a byte to take in, or -1 for one shift.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::bigint], flatten(list_transform(
  range(1, strlen({0}) + 1), lambda i: list_concat([ascii(substr({0}, i, 1))::bigint], list_transform(range(8), lambda k: -1::bigint))))),
  lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end))"""

_TRIE_SQL = f"""with t as (select conv_id as c, turn, sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as s,
       length(coalesce(text, '')) as chars from conversations where conv_id is not null),
p as (select c, s, chars, row_number() over (partition by c order by turn nulls first, s) as pos from t),
z as (select c, count(*) as n, {_CRC.format('c::varchar')} % 6 as h, c - c % 100 as b from p group by c),
k as (select z.*, least(z.h, coalesce(o.n, 0)) as k from z left join z o on o.c = z.b),
q as (select k.c, pos - h + k as d, s, chars from p join k using (c) where pos > h
      union all select k.c, pos as d, s, chars from k join p on p.c = k.b where pos <= k.k),
w as (select c, d, chars, string_agg(s, ',') over (partition by c order by d) as key from q
      union all select c, 0, 0, '' from k),
l as (select c, max(d) as d from w group by c),
nodes as (select key, min(d) as depth, min(c) as conv_id, count(*) as n_convs, max(chars) as chars from w group by key),
kin as (select n.*, u.key as parent from nodes n left join w u on u.c = n.conv_id and u.d = n.depth - 1),
kids as (select parent, count(*) as n_children from kin where parent is not null group by parent),
own as (select kin.*, coalesce(n_children, 0) as n_children from kin left join kids on kids.parent = kin.key),
sums as (select a.key, count(*) filter (o.n_children = 0) as n_leaves, sum((o.n_convs - 1) * o.chars)::bigint as saved_tokens
         from own o join w a on a.c = o.conv_id and a.d <= o.depth group by a.key),
ends as (select key, sha256(string_agg(c::varchar, ',' order by c)) as ends_sha256 from w join l using (c, d) group by key)
select o.conv_id, o.depth, u.conv_id as parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens,
       coalesce(ends_sha256, sha256('')) as ends_sha256
from own o join sums using (key) left join ends using (key) left join nodes u on u.key = o.parent"""


# Base 32 of the hex digits of a SHA-1: five digits are four characters.
_WARC_SQL = """with d as (select page_id, encode(coalesce(html, '')) as p from pages),
h as (select page_id, octet_length(p) as payload_bytes, sha1(p) as x, p,
             row_number() over (partition by p order by page_id desc nulls last) as k,
             max(page_id) over (partition by p) as kept from d)
select page_id, payload_bytes::bigint as payload_bytes, array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(x, 5 * (i // 4) + 1, 5))::bigint >> (15 - 5 * (i % 4))) & 31) + 1)::bigint, 1)), '')
         as payload_digest,
       case when k = 1 then 'response' else 'revisit' end as record_type, case when k > 1 then kept end as refers_to from h"""

_PHRASE_SQL = r"""with p as (select lang, doc_id, unnest(pieces) as piece, generate_subscripts(pieces, 1) as j
           from (select coalesce(lang, 'und') as lang, row_number() over () as doc_id,
                 string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[.,;:!?\x0A-\x0D]') as pieces from documents)),
w as (select lang, doc_id, j, unnest(l) as w, generate_subscripts(l, 1) as i
      from (select lang, doc_id, j, regexp_extract_all(piece, '[^\x20\x09]+') as l from p)),
g as (select lang, w as w1, lead(w) over o as w2, lead(w, 2) over o as w3 from w
      window o as (partition by lang, doc_id, j order by i)),
f as (select lang, w1 as phrase, 1 as size, null as h1, null as r1, null as h2, null as r2, count(*) as f from g group by all
      union all select lang, w1 || ' ' || w2, 2, w1, w2, null, null, count(*) from g where w2 is not null group by all
      union all select lang, w1 || ' ' || w2 || ' ' || w3, 3, w1, w2 || ' ' || w3, w1 || ' ' || w2, w3, count(*)
                from g where w3 is not null group by all),
n as (select lang, count(*) as n from w group by lang),
c as (select lang, phrase, f as a, 1 as k, h1 as h, r1 as r from f where size > 1 and f >= 10
      union all select lang, phrase, f, 2, h2, r2 from f where size = 3 and f >= 10),
s as (select c.lang, c.phrase, a, k, x.f as l, y.f as r, ((1000000::hugeint * a * a) // (x.f::hugeint * y.f))::bigint as score
      from c join f x on x.lang = c.lang and x.phrase = c.h join f y on y.lang = c.lang and y.phrase = c.r),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, k) = 1),
u as (select lang, part, max(f) as longer from (select lang, f, unnest([h2, r1]) as part from f where size = 3 and f >= 10) group by all),
d as (select b.* from b left join u on u.lang = b.lang and u.part = b.phrase where longer is null or 100 * longer < 50 * a),
k as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from d)
select lang, rank, phrase, a, l, r, n, score from k join n using (lang) where rank <= 2000"""


SQL = {
    "op1_license_scan": _license_sql(),
    "op2_suffix_dedup": _BYTES_SQL,
    "op3_quality_rules": _rules_sql(),
    "op5_substring_dedup": _WORDS_SQL,
    "op9_exact_dedup": _DEDUP_SQL,
    "op10_mixing": _mix_sql(),
    "op11_conversation_trie": _TRIE_SQL,
    "op12_warc": _WARC_SQL,
    "op13_phrases": _PHRASE_SQL,
}
