"""Windows that repeat across documents: how texts are dealt out so that equal windows meet.

A window is ``length`` consecutive units (bytes or words) of one document.
Each window has an anchor: the least hash of the shorter grams inside it. Equal
windows have equal anchors, and neighbouring windows mostly share one, so a
text falls into runs of windows with one anchor.

1. Documents are gathered into chunks of a few megabytes and written once.
2. The anchors of each chunk are dealt by their hash into shards; an anchor
   that no other document has cannot be in a repeated window, and ends here.
3. For the others each run goes, as the string of its units, to the shard of
   its anchor. Equal strings of a chunk go once, with their least and greatest
   id. Runs of an anchor that very many chunks have are cut into single
   windows, dealt by the whole window, so that no shard has to hold them all.
4. A shard settles strings that are equal as wholes, and hands the rest to the
   operator's own method, which finds the classes of equal windows. The least
   id of each class goes back to the chunks that have a greater one.
5. A chunk marks the units of its documents that windows with smaller ids cover.

What moves are packed arrays, not a row for each window. The number of shards
follows the input, so a shard stays of one size. Entries reach their shard, and
its answers their chunk, in hops: a hop splits a row into at most ``fan``
others, and between hops the rows of neighbouring sources are joined into one of
the size of a chunk. So rows and their entries grow with the input, times the
number of hops, and never with chunks times shards.
Hashes of strings and anchors have 64 bits; strings of equal hash are compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybar.llm.tables import release, shards_for, written
from daybar.llm.text import as_bytes, mix, span_hashes

COMPARED_UNITS = 1 << 22  # units of strings compared at once
MOST_TASKS = 1 << 15      # of one exchange, as Spark's driver tracks each; a task holds one shard or chunk at a time
NO_ID = (1 << 63) - 1    # stands for a null id: after all others

_CHUNK_ROW = "chunk long, docs binary, lengths binary, nulls binary, data binary"
_HOP_ROW = "hop long, part long, data binary"


@dataclass(frozen=True)
class Sizes:
    """How much is handled at once. No result depends on these."""
    chunk: int = 6 << 20          # bytes of documents in a chunk
    span: int = 1 << 18           # windows looked at together
    longest_run: int = 1 << 12    # windows in one string
    shard_bytes: int = 24 << 20   # bytes of input for each shard
    hot_chunks: int = 64          # an anchor in more chunks is dealt by single windows
    batch_units: int = 1 << 19    # units of strings that a shard compares together (an anchor's strings stay together)
    fan: int = 1 << 11            # rows that one is split into at a hop: 49 GB need one hop, 100 TB two


@dataclass(frozen=True)
class Units:
    """What an operator compares: how texts become units, and how equal windows are found among strings of them."""
    length: int                                                    # units in a window
    gram: int                                                      # units in a gram
    split: Callable[[bytes, np.ndarray], tuple]                    # text, lengths -> units, begins, the operator's own
    grams: Callable[[np.ndarray], np.ndarray]                      # hashes of the grams at each place
    classes: Callable[[np.ndarray, np.ndarray], np.ndarray]        # units, window starts -> class of each
    sizes: Sizes = Sizes()


def _is_hash(kind: np.dtype) -> bool:
    """Unsigned 64-bit values are hashes: they only compress where a whole value comes again."""
    return kind.kind == "u" and kind.itemsize == 8


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed with the equal bytes of their integers side by side, hashes as they are; read by ``_unpack``
    with the same kinds."""
    raw = [np.array([len(a) for a in arrays], "<i8").tobytes()]
    for a in arrays:
        own = np.ascontiguousarray(a)
        raw.append(own.tobytes() if _is_hash(a.dtype) else own.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(raw))


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes, at, out = np.frombuffer(raw, "<i8", len(kinds)), 8 * len(kinds), []
    for kind, n in zip(kinds, sizes):
        wide = np.dtype(kind).itemsize
        if _is_hash(np.dtype(kind)):
            out.append(np.frombuffer(raw, kind, int(n), at))
        else:
            planes = np.frombuffer(raw, np.uint8, int(n) * wide, at).reshape(wide, int(n))
            out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += int(n) * wide
    return out


def _cuts(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values (none negative) begin, and the end."""
    return np.flatnonzero(np.diff(sorted_values, prepend=-1, append=-1)) if len(sorted_values) else np.zeros(1, np.int64)


@dataclass(frozen=True)
class Parcel:
    """Entries on their way: destination, source, values of some kinds; with ``units`` also as many units as the last value says."""
    kinds: tuple[str, ...]
    units: str | None = None

    def rows(self, hop: np.ndarray, part: int | np.ndarray, to: np.ndarray, frm: np.ndarray, values: tuple,
             units: np.ndarray | None = None, starts: np.ndarray | None = None) -> pd.DataFrame:
        """A row for each value of ``hop``, with its entries in their order; ``starts``: where their units lie."""
        order = np.argsort(hop, kind="stable")
        cuts, out = _cuts(hop[order]), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            at = order[a:b]
            arrays = [to[at].astype("<i8"), frm[at].astype("<i8"), *(v[at].astype(k) for v, k in zip(values, self.kinds))]
            if self.units:
                arrays.append(units[_ranges(starts[at], values[-1][at].astype(np.int64))])
            out.append((int(hop[at[0]]), int(part), _pack(*arrays)))
        return pd.DataFrame(out, columns=["hop", "part", "data"])

    def read(self, data) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray | None]:
        """Destination, source, values and units of the entries of some rows, one row after the other."""
        kinds = ("<i8", "<i8", *self.kinds, *((self.units,) if self.units else ()))
        to, frm, *values = (np.concatenate(x) for x in zip(*(_unpack(x, *kinds) for x in data)))
        return (to, frm, values[:-1], values[-1]) if self.units else (to, frm, values, None)


_ANCHORS = Parcel(("<i8", "u1"))                              # low 40 bits, whether two ids of the chunk have it
_FLAGS = Parcel(("u1", "u1"))                                 # met, hot
_RUNS = Parcel(("<u4", "<u4", "<u4", "<i8"))                  # string, start, windows, least id


def _strings(unit_kind: str) -> Parcel:
    """Index in the chunk, anchor, least and greatest id, length; and the units."""
    return Parcel(("<u4", "<u4", "<i8", "<i8", "<i8"), unit_kind)


@dataclass(frozen=True)
class Route:
    """The hops between ``chunks`` chunks and ``shards`` shards.

    Going to shards, a row after hop j holds entries for the shards that share all but the last digits (to the base
    ``fan``) of their number, from the chunks whose place shares all but the last j; coming back, the other way round.
    """
    chunks: int
    shards: int
    fan: int
    hops: int

    @staticmethod
    def between(chunks: int, shards: int, most: int) -> Route:
        hops = 1
        while most ** hops < shards:
            hops += 1
        fan = max(2, math.ceil(shards ** (1 / hops)))
        return Route(max(1, chunks), shards, fan + (fan ** hops < shards), hops)

    def place(self, chunk: np.ndarray) -> np.ndarray:
        return (mix(chunk.astype(np.uint64)) % np.uint64(self.chunks)).astype(np.int64)

    def to_shard(self, shard: np.ndarray, j: int = 0) -> np.ndarray:
        return shard // self.fan ** (self.hops - 1 - j)

    def to_chunk(self, chunk: np.ndarray, j: int = 0) -> np.ndarray:
        left = self.hops - 1 - j
        return self.place(chunk) // self.fan ** left if left else chunk

    def carried(self, rows: DataFrame, parcel: Parcel, towards: Callable[[np.ndarray, int], np.ndarray]) -> DataFrame:
        """Rows after their first hop -> after the last one."""
        def hop(j: int):
            def forward(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
                to, frm, values, units = parcel.read(frame["data"])
                starts = np.cumsum(values[-1]) - values[-1] if parcel.units else None
                return parcel.rows(towards(to, j), key[1], to, frm, values, units, starts)

            return forward

        for j in range(1, self.hops):
            rows = rows.withColumn("part", F.expr(f"part div {self.fan}")).repartition(self.tasks, "hop", "part") \
                .groupBy("hop", "part").applyInPandas(hop(j), _HOP_ROW)
        return rows

    @property
    def tasks(self) -> int:
        """So many tasks that few shards, or chunks, meet in one; in the largest, tasks take more of them one by one."""
        return min(max(self.chunks, 4 * self.shards), MOST_TASKS)


def chunk_rows(docs: DataFrame, id_col: str, text_col: str, limit: int = Sizes.chunk) -> DataFrame:
    def run(batches):
        part, n, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def chunk():
            row = [(part << 33) + n, np.array([NO_ID if i is None else i for i in ids], "<i8").tobytes(),
                   np.array(list(map(len, texts)), "<i8").tobytes(), np.packbits([i is None for i in ids]).tobytes(),
                   zstandard.ZstdCompressor(level=3).compress(b"".join(texts))]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["chunk", "docs", "lengths", "nulls", "data"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                if texts and size + len(t) > limit:
                    yield chunk()
                    n, ids, texts, size = n + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if texts:
            yield chunk()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, _CHUNK_ROW)


class Chunk:
    """A chunk's documents as units, and its runs of windows with one anchor."""

    def __init__(self, row, kind: Units):
        self.kind, self.docs = kind, np.frombuffer(row["docs"], "<i8")
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.nulls = np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=len(self.docs)).astype(bool)
        self.text = zstandard.ZstdDecompressor().decompress(row["data"])
        self.units, self.begins, self.own = kind.split(self.text, self.lengths)
        self._find_runs()

    def _find_runs(self) -> None:
        length, last = self.kind.length, len(self.units) - self.kind.length + 1
        wide = length - self.kind.gram + 1
        values, firsts, counts, owners = [], [], [], []
        for a in range(0, last, self.kind.sizes.span):
            b = min(a + self.kind.sizes.span, last)
            least, reach = self.kind.grams(self.units[a:b + length - 1]), 1
            while 2 * reach <= wide:
                least = np.minimum(least[:-reach], least[reach:])
                reach *= 2
            least = np.minimum(least[:b - a], least[wide - reach:wide - reach + b - a])
            d = int(np.searchsorted(self.begins, a, side="right")) - 1
            e = int(np.searchsorted(self.begins, b, side="left"))
            edges = np.clip(self.begins[d:e + 1], a, b)
            doc = np.repeat(np.arange(d, d + len(edges) - 1), np.diff(edges))
            at = np.arange(a, b)
            inside = at + length <= self.begins[doc + 1]
            new = np.ones(b - a, bool)
            new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
            new |= at % self.kind.sizes.longest_run == 0
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, b - a))
            # Windows past the end of their text come after all others of it: a run of them is left out, one never mixes.
            ends = np.minimum(size, np.maximum(0, self.begins[doc[begin] + 1] - length + 1 - at[begin]))
            keep = ends > 0
            values.append(least[begin[keep]])
            firsts.append(at[begin[keep]])
            counts.append(ends[keep])
            owners.append(doc[begin[keep]])
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.anchor = mix(join(values, np.uint64))
        self.first, self.count, self.owner = join(firsts, np.int64), join(counts, np.int64), join(owners, np.int64)
        self.id = self.docs[self.owner] if len(self.owner) else np.zeros(0, np.int64)

    def named(self) -> pd.Series:
        """The documents' ids, null where they have none."""
        return pd.Series(self.docs, dtype="Int64").mask(self.nulls)

    def anchors(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors by (shard, low bits): the shard and low bits of each, whether two ids here have it, and each run's."""
        distinct, of = np.unique(self.anchor, return_inverse=True)
        shard = ((distinct >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)
        distinct = (distinct & np.uint64((1 << 40) - 1)).astype(np.int64)
        order = np.lexsort([distinct, shard])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        of = rank[of]
        low, high = _least_most(of, self.id, len(order))
        return shard[order], distinct[order], low < high, of

    def strings(self, shards: int, met: np.ndarray, hot: np.ndarray, of: np.ndarray) -> tuple:
        """The distinct strings of the runs whose anchors are ``met``: see ``_deal``."""
        keep = met[of]
        first, count, doc, key, single = self.first[keep], self.count[keep], self.id[keep], self.anchor[keep], hot[of][keep]
        times = np.where(single, count, 1)
        at = np.repeat(np.arange(len(first)), times)
        step = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
        first, doc, key, single = first[at] + step, doc[at], key[at], single[at]
        count = np.where(single, 1, count[at])
        hashes = _distinct_hashes(self.units, first, count + self.kind.length - 1)
        key = np.where(single, mix(hashes), key)
        _, sample, of = np.unique(hashes, return_index=True, return_inverse=True)
        order = np.argsort(sample)  # distinct strings in the order of the text
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        sample, of = sample[order], rank[of]
        low, high = _least_most(of, doc, len(sample))
        shard = ((key[sample] >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)
        return first, doc, of, first[sample], count[sample], key[sample], low, high, shard


def _distinct_hashes(units: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each string, equal only where the strings are: those of one hash are compared unit by unit."""
    hashes = span_hashes(units, starts, starts + lengths)
    todo = np.arange(len(hashes))
    while len(todo):
        order = todo[np.argsort(hashes[todo], kind="stable")]
        head = np.ones(len(order), bool)
        head[1:] = hashes[order][1:] != hashes[order][:-1]
        first = order[np.flatnonzero(head)[np.cumsum(head) - 1]]  # the first string of each hash
        other = lengths[order] != lengths[first]
        alike = np.flatnonzero(~head & ~other)
        for at in np.array_split(alike, max(1, int(lengths[order[alike]].sum()) // COMPARED_UNITS + 1)):
            a, b, n = order[at], first[at], lengths[order[at]]
            unlike = units[_ranges(starts[a], n)] != units[_ranges(starts[b], n)]
            if unlike.any():
                other[at] = np.add.reduceat(unlike, np.cumsum(n) - n) > 0
        todo = np.sort(order[other])
        hashes[todo] = mix(hashes[todo] + np.uint64(1))
    return hashes


def _least_most(group: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.full(n, NO_ID, np.int64), np.full(n, -(1 << 63), np.int64)
    np.minimum.at(low, group, value)
    np.maximum.at(high, group, value)
    return low, high


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _anchor_rows(chunks: DataFrame, kind: Units, route: Route) -> DataFrame:
    def run(frames):
        for frame in frames:
            for _, row in frame.iterrows():
                shard, low, many, _ = Chunk(row, kind).anchors(route.shards)
                own = np.full(len(shard), row["chunk"], np.int64)
                yield _ANCHORS.rows(route.to_shard(shard), route.place(own[:1])[0] if len(own) else 0, shard, own, (low, many))

    return route.carried(chunks.mapInPandas(run, _HOP_ROW), _ANCHORS, route.to_shard)


def _met(route: Route, hot_chunks: int):
    """For the chunks of a shard, which of their anchors another document has, and which of them very many chunks have."""
    def met(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard, chunk, (value, many), _ = _ANCHORS.read(rows["data"])
        _, of, count = np.unique(value, return_inverse=True, return_counts=True)
        met = ((np.bincount(of, many) > 0) | (count > 1))[of]
        hot = (count > hot_chunks)[of]
        names, of = np.unique(chunk, return_inverse=True)
        told = (np.bincount(of, met, len(names)) > 0)[of]  # a chunk with none of them is not told
        return _FLAGS.rows(route.to_chunk(chunk[told]), key[0], chunk[told], shard[told], (met[told], hot[told]))

    return met


def _flags(shard: np.ndarray, rows) -> tuple[np.ndarray, np.ndarray]:
    """For the anchors of a chunk, by shard as ``Chunk.anchors`` gives them, what the shards told of them."""
    met, hot = np.zeros(len(shard), bool), np.zeros(len(shard), bool)
    if len(rows):
        _, told, (m, h), _ = _FLAGS.read(rows)
        order, at = np.argsort(told, kind="stable"), np.isin(shard, told)
        met[at], hot[at] = m[order], h[order]
    return met, hot


def _deal(kind: Units, route: Route, parcel: Parcel):
    def deal(chunk: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        if not len(chunk) or not len(flags):
            return pd.DataFrame([], columns=["hop", "part", "data"])
        c = Chunk(chunk.iloc[0], kind)
        shard, _, _, of = c.anchors(route.shards)
        _, _, _, first, count, key, low, high, to = c.strings(route.shards, *_flags(shard, flags["data"]), of)
        own = np.full(len(to), chunk["chunk"].iloc[0], np.int64)
        values = (np.arange(len(to)), key, low, high, count + kind.length - 1)
        return parcel.rows(route.to_shard(to), route.place(own[:1])[0] if len(own) else 0, to, own, values, c.units, first)

    return deal


def _window_classes(kind: Units, units: np.ndarray, starts: np.ndarray, counts: np.ndarray, low: np.ndarray) -> tuple:
    """Runs (string, start, windows, least id) of windows with one least id, for strings that lie in ``units``."""
    windows = _ranges(starts, counts)
    of = np.repeat(np.arange(len(starts)), counts)
    group = kind.classes(units, windows)
    least = np.full(int(group.max()) + 1, NO_ID, np.int64)
    np.minimum.at(least, group, low[of])
    least = least[group]
    new = np.ones(len(windows), bool)
    new[1:] = (least[1:] != least[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(new)
    return of[at], windows[at] - starts[of[at]], np.diff(np.append(at, len(windows))), least[at]


def _settle(kind: Units, route: Route, parcel: Parcel):
    def settle(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard, source, (index, anchor, low, high, length), units = parcel.read(rows["data"])
        count = length - kind.length + 1
        start = np.cumsum(length) - length
        hashes = _distinct_hashes(units, start, length)
        order = np.lexsort([hashes, anchor])
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        sample = order[new]
        least, _ = _least_most(of, low, len(sample))
        # Strings of one anchor lie together. A single one is equal as a whole wherever it is.
        cuts = np.flatnonzero(np.diff(anchor[sample].astype(np.int64), prepend=-1, append=-1))
        many = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
        alone = np.flatnonzero(~many)
        found = [(alone, np.zeros(len(alone), np.int64), count[sample[alone]], least[alone])]
        room = np.concatenate([[0], np.cumsum(np.where(many, length[sample], 0))])
        k = 0
        while k < len(cuts) - 1:
            j = max(k + 1, int(np.searchsorted(room[cuts], room[cuts[k]] + kind.sizes.batch_units, side="right")) - 1)
            some = np.flatnonzero(many[cuts[k]:cuts[j]]) + cuts[k]
            if len(some):
                at = sample[some]
                own = units[_ranges(start[at], length[at])]
                d, s, n, m = _window_classes(kind, own, np.cumsum(length[at]) - length[at], count[at], least[some])
                found.append((some[d], s, n, m))
            k = j
        d, s, n, m = (np.concatenate(x) for x in zip(*found))
        by = np.lexsort([s, d])
        d, s, n, m = d[by], s[by], n[by], m[by]
        first = np.searchsorted(d, np.arange(len(sample) + 1))
        times = np.diff(first)[of]
        member = np.repeat(np.arange(len(of)), times)
        run = _ranges(first[of], times)
        news = m[run] < high[member]  # else no document of the chunk has a greater id
        member, run = member[news], run[news]
        return _RUNS.rows(route.to_chunk(source[member]), key[0], source[member], shard[member],
                          (index[member], s[run], n[run], m[run]))

    return settle


def _mark(kind: Units, route: Route, measure: Callable[[Chunk, np.ndarray], pd.DataFrame]):
    def mark(chunk: pd.DataFrame, notes: pd.DataFrame) -> pd.DataFrame:
        c = Chunk(chunk.iloc[0], kind)
        edge = np.zeros(len(c.units) + 1, np.int32)
        flags, runs = notes["data"][~notes["settled"].astype(bool)], notes["data"][notes["settled"].astype(bool)]
        if len(runs):
            shard, _, _, of = c.anchors(route.shards)
            place, doc, of, *_ = c.strings(route.shards, *_flags(shard, flags), of)
            order = np.argsort(of, kind="stable")
            first = np.searchsorted(of[order], np.arange(int(of.max()) + 2))
            for raw in runs:
                index, start, count, least = (x.astype(np.int64) for x in _RUNS.read([raw])[2])
                times = first[index + 1] - first[index]
                at, run = order[_ranges(first[index], times)], np.repeat(np.arange(len(index)), times)
                hit = least[run] < doc[at]
                begin = (place[at] + start[run])[hit]
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + count[run][hit] + kind.length - 1, -1)
        return measure(c, np.cumsum(edge[:-1]) > 0)

    return mark


def repeated_windows(docs: DataFrame, kind: Units, unit_kind: str, measure: Callable[[Chunk, np.ndarray], pd.DataFrame],
                     schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``measure`` of every chunk, given which of its units lie in a window that a document with a smaller id has."""
    spark = docs.sparkSession
    chunks = written(chunk_rows(docs, id_col, text_col, kind.sizes.chunk), "chunks", "uncompressed")
    n = chunks.count()
    route = Route.between(n, shards_for(n * kind.sizes.chunk, kind.sizes.shard_bytes), kind.sizes.fan)
    parcel = _strings(unit_kind)
    by_chunk = chunks.repartition(route.tasks, "chunk").groupBy("chunk")

    def of_each(rows: DataFrame):
        return rows.repartition(route.tasks, "hop").groupBy("hop")

    met = of_each(_anchor_rows(chunks, kind, route)).applyInPandas(_met(route, kind.sizes.hot_chunks), _HOP_ROW)
    flags = written(route.carried(met, _FLAGS, route.to_chunk), "anchors", "uncompressed")
    release(spark)
    dealt = by_chunk.cogroup(of_each(flags)).applyInPandas(_deal(kind, route, parcel), _HOP_ROW)
    settled = of_each(route.carried(dealt, parcel, route.to_shard)).applyInPandas(_settle(kind, route, parcel), _HOP_ROW)
    runs = written(route.carried(settled, _RUNS, route.to_chunk), "runs", "uncompressed")
    release(spark)
    notes = flags.withColumn("settled", F.lit(False)).unionByName(runs.withColumn("settled", F.lit(True)))
    return by_chunk.cogroup(of_each(notes)).applyInPandas(_mark(kind, route, measure), schema)
