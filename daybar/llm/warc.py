"""WARC archives with a two-level capture index.

Writing: equal payloads are found by SHA-256; of each group the row with the
largest id is a ``response`` record and the others are ``revisit`` records that
refer to it. Tasks write archives of gzip members, one for each record, and a
row for each capture. An archive belongs to the set only if the rows that Spark
committed name it, so what a lost task left behind is never read.

Index: a capture's key is its URL with the host's labels reversed, then the
date. Lines ``key date {json}`` are sorted by ranges and written as blocks of
``block_lines`` lines, compressed each; a sparse directory holds the first key
and the place of each block. Both lie in as many parts as there are ranges (at
most ``max_parts``); the first and last keys of the parts, cut to ``key_chars``
characters, are all that is sent to every task.

Reading: keys go to the parts that may hold them, in order; a task
binary-searches the part's directory for the block, reads that range of the
part and binary-searches the lines. The captures found are read from the
archives by ranges, neighbours together, and their checksums are verified.

Files are written and read through ``pyarrow.fs`` under the folder in
``spark.checkpoint.dir``, which must be one that pyarrow can open.

Defined cases: a null payload is empty; null ids come before all others, and of
rows with one id and payload the last one is the response; a null or empty URL
has the key ``-``, one that cannot be taken apart is its own key; repeated rows
are captures of their own; a payload of any length is one record; an empty table
has no archive and no index; further columns are ignored. A record whose payload
does not have its digest raises ValueError.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybar.llm.tables import shards_for, written
from daybar.session import scratch_path

@dataclass(frozen=True)
class Limits:
    """How much a file, a block or a read holds. No result depends on these."""
    archive_bytes: int = 128 << 20  # an archive is closed beyond
    block_lines: int = 1024         # captures in one block of the index
    part_captures: int = 1 << 14    # captures in one part of the index
    max_parts: int = 8192           # parts; beyond, they hold more captures each
    key_chars: int = 256            # characters of a part's first and last key that every task gets
    read_bytes: int = 8 << 20       # ranges of an archive that are read together,
    read_gap: int = 64 << 10        # and the bytes between two of them


_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = "key string, row long, file string, offset long, length long"


def _open(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _plain(url: str | None) -> str:
    """The URL in printable ASCII, as a header and a key can hold it."""
    return quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")


def url_key(url: str | None) -> str:
    """``http://www.example.org:8080/a?b#c`` -> ``org,example,www:8080)/a?b``."""
    plain = _plain(url)
    try:
        parts = urlsplit(plain)
        host, port = parts.hostname, parts.port
    except ValueError:
        return plain
    if not host:
        return plain or "-"
    if not re.fullmatch(r"[\d.]+|.*:.*", host):  # addresses stay as they are
        host = ",".join(reversed(host.split(".")))
    return f"{host}{f':{port}' if port and port not in (80, 443) else ''}){parts.path or '/'}{f'?{parts.query}' if parts.query else ''}"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(archive: str, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{row}')}>"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def read_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if not lines[0].startswith("WARC/") or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return fields, rest[:n]


def _http_head(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


class _Archives:
    """The archives that one task writes."""

    def __init__(self, folder: str, limit: int):
        self.limit = limit
        self.system, self.folder = _open(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        self.n, self.file, self.at, self.out = 0, "", 0, None

    def put(self, member: bytes) -> tuple[str, int, int]:
        """(file, offset, length) of the record in the archives."""
        if self.out is not None and self.at > self.limit:
            self.close()
        if self.out is None:
            self.file, self.at, self.n = f"{self.name}-{self.n:04d}.warc.gz", 0, self.n + 1
            self.out = self.system.open_output_stream(f"{self.folder}/{self.file}", compression=None)
            self._write(warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                     ("WARC-Filename", self.file), ("Content-Type", "application/warc-fields")],
                                    b"format: WARC File Format 1.1\r\n"))
        return self.file, self._write(member), len(member)

    def _write(self, member: bytes) -> int:
        at = self.at
        self.out.write(member)
        self.at += len(member)
        return at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   date: str = "1970-01-01T00:00:00Z", limits: Limits = Limits()) -> DataFrame:
    """Write ``folder``/archives; the captures: key, row, file, offset, length."""
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = written(pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("page_id"),
                                F.col(url_col).cast("string").alias("url"), payload.alias("payload")), "payloads", "zstd")
    named = written(rows.select("row", "page_id", "url", F.unhex(F.sha2("payload", 256)).alias("sha")), "named")
    groups = named.groupBy("sha").agg(F.max(F.struct("page_id", "row", "url")).alias("kept"), F.count(F.lit(1)).alias("n"))
    repeats = named.select("row", "sha").join(groups.where("n > 1").select("sha", "kept"), "sha").where("row <> kept.row")
    of = repeats.select("row", F.col("kept.row").alias("of_row"), F.col("kept.url").alias("of_url"))
    stamp, archive = re.sub(r"\D", "", date)[:14], f"{folder}/archives"

    def write(batches):
        archives = _Archives(archive, limits.archive_bytes)
        for batch in batches:
            out = []
            for row, page, url, data, of_row, of_url in zip(*(c.to_pylist() for c in batch.columns)):
                data = bytes(data)
                fields = [("WARC-Type", "response" if of_row is None else "revisit"), ("WARC-Record-ID", record_id(archive, row)),
                          ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{payload_digest(data)}"),
                          ("Content-Type", "application/http;msgtype=response")]
                fields += [("WARC-Target-URI", _plain(url))] if url else []
                fields += [("Page-Id", str(page))] if page is not None else []
                head = _http_head(len(data))
                if of_row is None:
                    member = warc_record(fields, head + data)
                else:
                    fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", record_id(archive, of_row)), ("WARC-Refers-To-Date", date)]
                    fields += [("WARC-Refers-To-Target-URI", _plain(of_url))] if of_url else []
                    member = warc_record(fields, head)
                out.append((f"{url_key(url)} {stamp}", row, *archives.put(member)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["key", "row", "file", "offset", "length"])
        archives.close()

    whole = rows.join(of, "row", "left").select("row", "page_id", "url", "payload", "of_row", "of_url")
    return written(whole.mapInArrow(write, _CAPTURE), "captures")


def build_index(captures: DataFrame, folder: str, limits: Limits = Limits()) -> DataFrame:
    """Write ``folder``/index; its parts: low, high (first and last key), file, directory, lines."""
    parts = min(limits.max_parts, shards_for(captures.count(), limits.part_captures))
    at = f"{folder}/index"

    def write(batches):
        system, path = _open(at)
        system.create_dir(path, recursive=True)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        low = high = None
        held, directory, place, n = [], [], 0, 0
        with system.open_output_stream(f"{path}/{name}.cdxj.gz", compression=None) as out:
            def block():
                nonlocal place
                data = gzip.compress("".join(held).encode(), 6, mtime=0)
                out.write(data)
                directory.append(f"{held[0].rsplit(' ', 2)[0]} {place} {len(data)}\n")
                place += len(data)
                held.clear()

            for batch in batches:
                for key, row, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                    low, high, n = low or key, key, n + 1
                    what = json.dumps({"row": row, "filename": file, "offset": offset, "length": length}, separators=(",", ":"))
                    held.append(f"{key} {what}\n")
                    if len(held) == limits.block_lines:
                        block()
            if held:
                block()
        with system.open_output_stream(f"{path}/{name}.idx") as out:
            out.write("".join(directory).encode())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (low, high, f"{name}.cdxj.gz", f"{name}.idx", n)],
                                             names=["low", "high", "file", "directory", "lines"])

    ordered = captures.repartitionByRange(parts, "key", "row").sortWithinPartitions("key", "row")
    return written(ordered.select(*captures.columns).mapInArrow(
        write, "low string, high string, file string, directory string, lines long"), "parts")


class IndexPart:
    """One part of the index: its directory in memory, its blocks read by ranges (the last one is kept)."""

    def __init__(self, folder: str, file: str, directory: str):
        self.system, path = _open(f"{folder}/index")
        with self.system.open_input_stream(f"{path}/{directory}") as f:
            entries = [line.rsplit(" ", 2) for line in f.read().decode().splitlines()]
        self.first = [e[0] for e in entries]
        self.places = [(int(e[1]), int(e[2])) for e in entries]
        self.file, self.held, self.keys, self.lines = self.system.open_input_file(f"{path}/{file}"), -1, [], []

    def _block(self, k: int) -> None:
        if self.held != k:
            offset, length = self.places[k]
            lines = zlib.decompress(self.file.read_at(length, offset), 31).decode().splitlines()
            split = [line.split(" ", 2) for line in lines]
            self.held, self.keys, self.lines = k, [x[0] for x in split], [x[2] for x in split]

    def find(self, key: str):
        """The captures of a key, as they stand in the index."""
        k = max(0, bisect_left(self.first, key) - 1)  # the block before may end with the key
        while k < len(self.first) and self.first[k] <= key:
            self._block(k)
            for i in range(bisect_left(self.keys, key), bisect_right(self.keys, key)):
                yield json.loads(self.lines[i])
            k += 1


def find_captures(parts: DataFrame, folder: str, urls: DataFrame, url_col: str = "url", limits: Limits = Limits()) -> DataFrame:
    """Every capture of the URLs in ``urls``: key, row, file, offset, length, each once."""
    spark = parts.sparkSession
    known = sorted(parts.select(F.substring("low", 1, limits.key_chars).alias("low"), F.substring("high", 1, limits.key_chars).alias("high"),
                                "file", "directory").toPandas().itertuples(index=False, name=None))
    cut = lambda key: key.split(" ")[0]  # noqa: E731  without the date
    sent = spark.sparkContext.broadcast(([cut(p[0]) for p in known], [cut(p[1]) for p in known], [p[2:] for p in known]))

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string())], names=["key"])

    def deal(batches):
        low, high, _ = sent.value
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                short = key[:limits.key_chars]
                out.extend((k, key) for k in range(bisect_left(high, short), bisect_right(low, short)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.string()))], names=["part", "key"])

    def search(batches):
        held, part = -1, None
        for batch in batches:
            out = []
            for k, key in zip(*(c.to_pylist() for c in batch.columns)):
                if k != held:
                    held, part = k, IndexPart(folder, *sent.value[2][k])
                for x in part.find(key):
                    out.append((key, x["row"], x["filename"], x["offset"], x["length"]))
                    if len(out) == 10_000:
                        yield _captures(out)
                        out = []
            if out:
                yield _captures(out)

    probes = urls.select(F.col(url_col).cast("string")).distinct().mapInArrow(keys, "key string").distinct()
    dealt = probes.mapInArrow(deal, "part int, key string").repartition(max(1, len(known)), "part")
    return dealt.sortWithinPartitions("part", "key").mapInArrow(search, _CAPTURE)


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["key", "row", "file", "offset", "length"])


def _runs(places: list[tuple[str, int, int]], limits: Limits):
    """Neighbouring ranges of one file that are read together: (file, offset, length, the ranges)."""
    run: list[tuple[str, int, int]] = []
    for place in places:
        if run and (place[0] != run[0][0] or place[1] - (run[-1][1] + run[-1][2]) > limits.read_gap
                    or place[1] + place[2] - run[0][1] > limits.read_bytes):
            yield run
            run = []
        run.append(place)
    if run:
        yield run


def read_captures(captures: DataFrame, folder: str, limits: Limits = Limits()) -> DataFrame:
    """The records: record_id, page_id, record_type, payload_bytes (null for a revisit), payload_digest, refers_to, payload."""
    schema = ("record_id string, page_id long, record_type string, payload_bytes long, payload_digest string, "
              "refers_to string, payload binary")

    def read(batches):
        system, path = _open(f"{folder}/archives")
        name, file = None, None
        for batch in batches:
            for run in _runs(list(zip(*(c.to_pylist() for c in batch.columns))), limits):
                if run[0][0] != name:
                    name = run[0][0]
                    file = system.open_input_file(f"{path}/{name}")
                first = run[0][1]
                data = file.read_at(run[-1][1] + run[-1][2] - first, first)
                yield _records([read_record(data[offset - first:offset - first + length]) for _, offset, length in run])

    span = F.expr(f"offset div {limits.read_bytes}")
    near = captures.select("file", "offset", "length").repartition("file", span).sortWithinPartitions("file", "offset")
    return near.mapInArrow(read, schema)


def _records(records: list[tuple[dict[str, str], bytes]]) -> pa.RecordBatch:
    out = []
    for fields, block in records:
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
        if payload is not None and payload_digest(payload) != digest:
            raise ValueError("a payload does not have its digest")
        page = fields.get("Page-Id")
        out.append((fields["WARC-Record-ID"], None if page is None else int(page), kind,
                    None if payload is None else len(payload), digest, fields.get("WARC-Refers-To"), payload))
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                      names=["record_id", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])


def archived_pages(spark: SparkSession, pages: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Archive all pages, index the captures, look every URL up and read what is found.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to.
    """
    folder = scratch_path(spark, "warc")
    index = build_index(write_archives(pages, folder, limits=limits), folder, limits)
    found = read_captures(find_captures(index, folder, pages, limits=limits), folder, limits)
    records = written(found.drop("payload"), "records")
    targets = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("of"), F.col("payload_bytes").alias("there"))
    revisits = records.where("record_type = 'revisit'").join(targets, "refers_to")
    return records.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(
        revisits.select("page_id", F.col("there").alias("payload_bytes"), "payload_digest", "record_type", F.col("of").alias("refers_to")))
