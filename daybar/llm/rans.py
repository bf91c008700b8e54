"""Token ids in entropy-coded blocks: a static range asymmetric numeral system.

Token counts of the whole corpus give one frequency table, shared by all
blocks. A block holds whole documents in ascending id order, some 500,000 ids
(a longer document is a block of its own), and is coded alone: ids go round
``LANES`` interleaved states (id i to lane i mod LANES), so numpy codes one id
of every lane at a time. A block carries its documents' ids and lengths, the
checksums of its ids and words, and at every ``CHECKPOINT`` steps the states
and the place in the words, from which decoding can start. Blocks are rows of
Parquet files that Spark writes and reads: (part, first, n_tokens, data).

Defined cases: a null text counts as empty, an empty one is just the end id;
rows without an id come first; repeated rows are coded each; a document of any
length is coded whole; an empty table gives no blocks; further columns are
ignored. A damaged block, or one of another
table, raises ValueError. A table can hold 2**29 different ids.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from daybar.llm import tokens
from daybar.llm.tables import release, written
from daybar.llm.text import as_bytes, chunked
from daybar.session import scratch_path

MAGIC = b"DBR1"
BLOCK_TOKENS = 1 << 19
LANES = 4096
TEXT_BYTES = 4 << 20  # texts encoded at once: their words are looked up once
CHECKPOINT = 64
SCALE = 18  # frequencies add up to 2**SCALE, or more where there are too many different ids for that
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sBBHIIIII")  # magic, scale, flags, lanes, tokens, documents, words, crc of ids, crc of words


class Table:
    """Frequencies that add up to 2**scale, at least 1 for every id that occurs."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.scale = int(self.freq.sum()).bit_length() - 1
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self._symbol: np.ndarray | None = None

    @classmethod
    def of_counts(cls, ids: np.ndarray, counts: np.ndarray) -> Table:
        scale = max(SCALE, len(ids).bit_length() + 1)
        freq = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
        if not len(ids):
            freq[0] = 1 << scale
            return cls(freq)
        order = np.lexsort([ids, -counts])  # most frequent first
        ids, counts = ids[order], counts[order]
        share = np.maximum(1, (counts.astype(np.float64) / counts.sum() * ((1 << scale) - len(ids))).astype(np.int64))
        share[0] += (1 << scale) - share.sum()  # never negative: shares are rounded down
        freq[ids] = share
        return cls(freq)

    @property
    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    def __getstate__(self):
        return {"freq": self.freq, "start": self.start, "scale": self.scale, "_symbol": None}


def encode_words(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the lanes' last states, and at each checkpoint the states and the place in the words."""
    steps = -(-len(ids) // LANES)
    at = ids.astype(np.intp)
    room, rest = np.uint64(63 - table.scale), np.uint64(1 << table.scale) - table.freq
    state = np.full(LANES, _LOW, np.uint64)
    words, marks, sizes = [], [], []
    for t in range(steps - 1, -1, -1):
        s = at[t * LANES:(t + 1) * LANES]
        x = state[:len(s)]
        f = table.freq.take(s)
        full = np.flatnonzero(x >= f << room)
        moved = x[full]
        words.append(moved.astype(np.uint32))
        x[full] = moved >> np.uint64(32)
        x += x // f * rest.take(s)
        x += table.start.take(s)
        if t and t % CHECKPOINT == 0:
            marks.append(state.copy())
            sizes.append(sum(map(len, words)))
            words = [np.concatenate(words[::-1])]
    out = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    places = len(out) - np.array(sizes[::-1], np.int64)
    return out, state, np.array(marks[::-1], np.uint64).reshape(-1, LANES), places


def decode_words(words: np.ndarray, state: np.ndarray, at: int, first: int, n: int, table: Table) -> np.ndarray:
    """Ids ``first`` (a multiple of LANES) up to n, from the states and the place in the words that hold there."""
    out = np.empty(n - first, np.uint32)
    state = state.copy()
    scale, mask = np.uint64(table.scale), np.uint64((1 << table.scale) - 1)
    for i in range(first, n, LANES):
        m = min(LANES, n - i)
        x = state[:m]
        slot = x & mask
        s = table.symbol.take(slot.view(np.int64))
        out[i - first:i - first + m] = s
        s = s.astype(np.intp)
        x >>= scale
        x *= table.freq.take(s)
        x += slot
        x -= table.start.take(s)
        low = np.flatnonzero(x < _LOW)
        x[low] = x[low] << np.uint64(32) | words[at:at + len(low)]
        at += len(low)
    return out


def encode_block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, table: Table) -> bytes:
    words, state, marks, places = encode_words(ids, table)
    raw = words.tobytes()
    head = _HEAD.pack(MAGIC, table.scale, 0, LANES, len(ids), len(doc_ids), len(words),
                      zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(raw))
    none = np.packbits([d is None for d in doc_ids])
    return b"".join([head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), none.tobytes(),
                     np.array(lengths, "<u4").tobytes(), state.astype("<u8").tobytes(),
                     struct.pack("<I", len(places)), places.astype("<i8").tobytes(), marks.astype("<u8").tobytes(), raw])


class Block:
    """A parsed block; ``ids(k)`` decodes from checkpoint k on (0: from its beginning)."""

    def __init__(self, data: bytes):
        magic, self.scale, _, lanes, self.n, docs, n_words, self.crc, crc_words = _HEAD.unpack_from(data)
        if magic != MAGIC or lanes != LANES:
            raise ValueError("not a block of this format")
        at = _HEAD.size

        def take(kind, n):
            nonlocal at
            x = np.frombuffer(data, kind, n, at)
            at += x.nbytes
            return x

        own = take("<i8", docs)
        none = np.unpackbits(take(np.uint8, -(-docs // 8)), count=docs).astype(bool)
        self.doc_ids = [None if z else int(d) for d, z in zip(own, none)]
        self.lengths = take("<u4", docs).astype(np.int64)
        self.state = take("<u8", LANES)
        n_marks = int(take("<u4", 1)[0])
        self.places, self.marks = take("<i8", n_marks), None
        self.marks = take("<u8", n_marks * LANES).reshape(-1, LANES)
        self.words = take("<u4", n_words)
        if zlib.crc32(self.words.tobytes()) != crc_words:
            raise ValueError("a block's words do not have their checksum")

    def ids(self, table: Table, checkpoint: int = 0) -> np.ndarray:
        if table.scale != self.scale:
            raise ValueError("not the table of this block")
        if checkpoint:
            k = checkpoint - 1
            return decode_words(self.words, self.marks[k], int(self.places[k]), checkpoint * CHECKPOINT * LANES, self.n, table)
        out = decode_words(self.words, self.state, 0, 0, self.n, table)
        if zlib.crc32(out.astype("<u4").tobytes()) != self.crc:
            raise ValueError("a block's ids do not have their checksum")
        return out


_TOKENS = "part int, row long, doc long, ids binary, counts binary"


def token_rows(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """Documents in ascending id order: part (ascending), row (in the part), doc, ids (with the end id).

    A last row of each part has only ``counts``: how often the part has each id, from 0 up.
    """
    tail = np.array([end_id], np.uint32).tobytes()

    def run(batches):
        part, row, total = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for a, b in chunked(texts, TEXT_BYTES):
                ids = [x + tail for x in tokens.encode([t.decode() for t in texts[a:b]], path)]
                own = np.bincount(np.frombuffer(b"".join(ids), np.uint32))
                total = np.pad(total, (0, max(0, len(own) - len(total))))
                total[:len(own)] += own
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * (b - a), pa.int32()), pa.array(range(row, row + b - a), pa.int64()),
                     batch.column(0).slice(a, b - a), pa.array([_narrow(x) for x in ids], pa.binary()), pa.nulls(b - a, pa.binary())],
                    names=["part", "row", "doc", "ids", "counts"])
                row += b - a
        if row:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([row], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                 pa.array([total.astype("<i8").tobytes()])], names=["part", "row", "doc", "ids", "counts"])

    ordered = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col)).repartitionByRange("doc") \
        .sortWithinPartitions("doc")
    return ordered.mapInArrow(run, _TOKENS)


def _narrow(ids: bytes) -> bytes:
    """Two bytes an id where they suffice: b'2' + ids, else b'4' + ids."""
    x = np.frombuffer(ids, np.uint32)
    return b"2" + x.astype("<u2").tobytes() if x.max() < 1 << 16 else b"4" + ids


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[:1] == b"2" else "<u4", offset=1).astype(np.uint32)


def corpus_table(rows: DataFrame) -> Table:
    """The shared table from the counts of all ids; one row per different id reaches the driver."""
    def count(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                own = np.frombuffer(data, "<i8")
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at])], names=["id", "n"])

    counts = rows.where("counts is not null").select("counts").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return Table.of_counts(counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))


def write_blocks(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write ``path``/blocks and ``path``/table."""
    spark = docs.sparkSession
    rows = written(token_rows(docs, id_col, text_col, vocabulary, end_id), "tokens", "zstd")
    release(spark)
    table = corpus_table(rows)
    spark.createDataFrame([(bytearray(table.freq.astype("<u4").tobytes()),)], "freq binary").coalesce(1) \
        .write.parquet(f"{path}/table")
    sent = spark.sparkContext.broadcast(table)

    def run(batches):
        part, first, docs, ids = -1, 0, [], []

        def block():
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(flat)], pa.int64()),
                 pa.array([encode_block(docs, list(map(len, ids)), flat, sent.value)], pa.binary())],
                names=["part", "first", "n_tokens", "data"])

        size = 0
        for batch in batches:
            for p, r, doc, data in zip(*(c.to_pylist() for c in batch.columns)):
                x = _wide(data)
                if ids and (p != part or r != first + len(ids) or size + len(x) > BLOCK_TOKENS):
                    yield block()
                    ids = []
                if not ids:
                    part, first, docs, size = p, r, [], 0
                docs.append(doc)
                ids.append(x)
                size += len(x)
        if ids:
            yield block()

    # Coded payloads do not shrink again.
    rows.where("counts is null").select("part", "row", "doc", "ids").mapInArrow(run, "part int, first long, n_tokens long, data binary") \
        .write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, Table]:
    freq = np.frombuffer(bytes(spark.read.parquet(f"{path}/table").first()[0]), "<u4")
    return spark.read.schema("part int, first long, n_tokens long, data binary").parquet(f"{path}/blocks"), Table(freq)


def decoded_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks, table = read_blocks(spark, path)
    sent = spark.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            for p, f, data in zip(*(c.to_pylist() for c in batch.columns)):
                b = Block(data)
                raw = b.ids(sent.value).astype("<u4").tobytes()
                ends = np.cumsum(b.lengths)
                starts = ends - b.lengths
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p] * n, pa.int32()), pa.array([f] * n, pa.int64()), pa.array(b.doc_ids, pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(b.lengths, pa.int64()),
                     pa.array([zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(starts, ends)], pa.int64())],
                    names=["part", "first", "doc_id", "within", "n_tokens", "ids_crc32"])

    docs = blocks.select("part", "first", "data").mapInArrow(
        run, "part int, first long, doc_id long, within long, n_tokens long, ids_crc32 long")
    # Offsets: the parts before (one row a part), then the blocks before in the part.
    own = blocks.select("part", "first", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = own.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("n_tokens").join(parts, "part")
    return docs.join(offsets, ["part", "first"]).select(
        "doc_id", (F.col("before_part") + F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def coded_documents(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write all documents as blocks in the shared folder, and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "rans")
    write_blocks(docs, path, vocabulary, end_id)
    return decoded_documents(spark, path)
