"""Object listing under a key prefix."""

from __future__ import annotations

import datetime as _dt
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybar.session import scratch_path, send_package
from daybar.sources.store import open_store, split_uri

LISTING_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("size", T.LongType(), False),
    T.StructField("modified", T.TimestampType(), False),
])

_GLOB_CHARS = "\\{}[]*?"


def escape_glob(text: str) -> str:
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in text)


def qualified(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` as it appears in scan file paths."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return str(fs.makeQualified(p).toString()).rstrip("/")


def qualified_path(spark: SparkSession, path: str) -> str:
    """Absolute path of ``path`` inside its file system, without scheme and authority."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return str(fs.makeQualified(p).toUri().getPath()).rstrip("/")


def _top_entries(spark: SparkSession, base_uri: str, prefix: str) -> list[tuple[str, bool, int, int]]:
    """(path, is a folder, size, modification time in ms) of what matches ``base/prefix*``: one level, not the tree."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base_uri)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{escape_glob(base_uri)}/{escape_glob(prefix)}*"))
    return [(str(s.getPath().toString()), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in found or ()]


def _stamp(ms: int) -> _dt.datetime:
    return _dt.datetime.fromtimestamp(ms / 1000, _dt.timezone.utc)


def _through_driver(spark: SparkSession, base_uri: str, tops: list) -> DataFrame:
    """The listing for a store that only Hadoop's clients open: key by key, in blocks that go to a scratch table."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base_uri)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def files():
        for path, *_ in tops:
            found = fs.listFiles(jvm.org.apache.hadoop.fs.Path(path), True)
            while found.hasNext():
                s = found.next()
                yield str(s.getPath().toString())[len(base_uri) + 1:], s.getLen(), _stamp(s.getModificationTime())

    rows = files()
    block = list(islice(rows, BLOCK))
    if len(block) < BLOCK:
        return spark.createDataFrame(block, LISTING_SCHEMA)
    out = scratch_path(spark, "listing")
    while block:
        spark.createDataFrame(block, LISTING_SCHEMA).coalesce(1).write.mode("append").parquet(out)
        block = list(islice(rows, BLOCK))
    return spark.read.parquet(out)


BLOCK = 50_000  # keys that the driver holds at a time where it lists


def list_objects(spark: SparkSession, base: str, prefix: str = "") -> DataFrame:
    """Every file whose key (path under ``base``) starts with ``prefix``: key, size, modified.

    A prefix, not a directory: nested and suffixed keys match. Zero-byte files
    and names that Spark's own scans hide (``_x``, ``.x``) are listed too; only
    the checksum files that Hadoop keeps beside local files are not keys. The
    driver looks at the entries that match ``base/prefix*`` only, and tasks list
    what lies below them, a folder each. Where pyarrow has no client for the
    store the driver passes the keys on. An unknown prefix gives an empty frame.
    """
    base_uri = qualified(spark, base)
    tops = _top_entries(spark, base_uri, prefix)
    folders = [t[0] for t in tops if t[1]]
    if folders and open_store(base_uri) is None:
        return _through_driver(spark, base_uri, tops)
    files = spark.createDataFrame([(p[len(base_uri) + 1:], size, _stamp(ms)) for p, folder, size, ms in tops if not folder], LISTING_SCHEMA)
    if not folders:
        return files
    send_package(spark)
    local = split_uri(base_uri)[0] == "file"

    def below(batches):
        from pyarrow import fs
        import pyarrow as pa
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, path = open_store(folder)
                start = folder[len(base_uri) + 1:]
                found = [f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File]
                found = [f for f in found if not (local and f.base_name.startswith(".") and f.base_name.endswith(".crc"))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{start}/{f.path[len(path) + 1:]}" for f in found], pa.string()), pa.array([f.size for f in found], pa.int64()),
                     pa.array([f.mtime for f in found], pa.timestamp("us", "UTC"))], names=["key", "size", "modified"])

    tasks = min(len(folders), MAX_LISTING_TASKS)
    listed = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(tasks).mapInArrow(below, LISTING_SCHEMA)
    return files.unionAll(listed)


MAX_LISTING_TASKS = 1024
