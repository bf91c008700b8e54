"""CSV scans that bind columns by header name, like the reference's reader."""

from __future__ import annotations

import csv as _csv
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybar.config import SourceColumns
from daybar.functions.nulls import is_missing, na_token_to_null, na_tokens_to_null
from daybar.session import send_package
from daybar.sources.store import open_store

HEAD_BYTES = 1 << 16  # read at once from a file whose header is wanted


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def tick_schema(src: SourceColumns = SourceColumns()) -> T.StructType:
    """Typed schema of the selected source columns."""
    def typ(c):
        if c in src.double_columns:
            return T.DoubleType()
        if c in src.long_columns:
            return T.LongType()
        return T.StringType()
    return T.StructType([T.StructField(c, typ(c), True) for c in src.columns])


def empty_ticks(spark: SparkSession, src: SourceColumns = SourceColumns()) -> DataFrame:
    """Typed empty frame: the lazy report over it is an empty report."""
    return spark.createDataFrame([], tick_schema(src))


def _reader(spark: SparkSession, sep: str, encoding: str, recursive: bool, strict: bool, multi_line: bool):
    r = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
         .option("quote", '"').option("escape", '"').option("mode", "FAILFAST"))
    if multi_line:
        r = r.option("multiLine", True)
    if strict:
        r = r.option("enforceSchema", False)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r


def read_csv(spark: SparkSession, paths: str | list[str], *, sep: str = ",", encoding: str = "utf-8",
             recursive: bool = False, strict: bool = True, na_tokens: bool = True,
             header: tuple[str, ...] | list[str] | None = None, multi_line: bool = False,
             tree: str | None = None) -> DataFrame | None:
    """All columns as strings; ``None`` when no file matches.

    The header of one file names the columns (no type inference). With
    ``strict`` every other file must carry the same header in the same order
    (``enforceSchema=False``): Spark would otherwise bind later files by
    position and silently shift values between columns. ``na_tokens`` turns
    the reference reader's missing-value tokens into null; callers that drop
    missing rows anyway pass False and test :func:`is_missing` themselves.
    A known ``header`` replaces the inference pass (files are checked against it).
    Quotes inside quoted fields are doubled. ``multi_line`` allows newlines in
    quoted fields; such files cannot be split, so it is off by default.
    ``tree`` is the root from which folders ``name=value`` become columns.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return None
    try:
        r = _reader(spark, sep, encoding, recursive, strict, multi_line)
        if tree:
            r = r.option("basePath", tree)
        if header:
            r = r.schema(string_schema(header))
        df = r.csv(paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    if not df.columns:
        return None
    return na_tokens_to_null(df) if na_tokens else df


def header_census(spark: SparkSession, paths: str | list[str], *, sep: str = ",", encoding: str = "utf-8",
                  recursive: bool = False, tree: str | None = None) -> list[tuple[tuple[str, ...], list[str]]]:
    """The distinct headers of the files, each with its files; files without a header line are left out.

    Spark lists the files; tasks read the first line of each, nothing else.
    The driver gets one row a file, which the scan over them holds anyway.
    Where pyarrow has no client for the store, one scan of the text finds the lines.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    r = spark.read.format("binaryFile")
    r = r.option("recursiveFileLookup", True) if recursive else r
    r = r.option("basePath", tree) if tree else r
    try:
        files = r.load(paths).where("length > 0").select("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise
    if open_store(paths[0]) is None:
        text = spark.read.option("recursiveFileLookup", recursive).text(paths)
        first = text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
                            "value", F.monotonically_increasing_id().alias("nth")).where("at = 0")
        lines = first.groupBy("path").agg(F.min_by("value", "nth").alias("line"))
    else:
        send_package(spark)

        def first_lines(batches):
            import pyarrow as pa
            for batch in batches:
                names, out = batch.column(0).to_pylist(), []
                for name in names:
                    system, path = open_store(name)
                    with system.open_input_stream(path) as f:
                        head = b""
                        while b"\n" not in head.replace(b"\r", b"\n"):
                            more = f.read(HEAD_BYTES)
                            if not more:
                                break
                            head += more
                    out.append(head.replace(b"\r", b"\n").split(b"\n")[0].decode(encoding))
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(out)], names=["path", "line"])

        lines = files.mapInArrow(first_lines, "path string, line string")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, line in sorted(map(tuple, lines.where("line <> ''").toLocalIterator())):
        by_header.setdefault(tuple(next(_csv.reader([line.removeprefix("\ufeff")], delimiter=sep))), []).append(path)
    return sorted(by_header.items())


def read_csv_by_name(spark: SparkSession, paths: str | list[str], columns, *, sep: str = ",", encoding: str = "utf-8",
                     recursive: bool = False, tree: str | None = None) -> DataFrame | None:
    """``columns`` as text from files whose headers may differ in order and in further columns; ``None`` without files.

    One scan for each distinct header, however many files and days there are;
    a header that lacks one of the columns raises KeyError.
    """
    census = header_census(spark, paths, sep=sep, encoding=encoding, recursive=recursive, tree=tree)
    if not census:
        return None
    frames = []
    for header, files in census:
        # With one header the paths stay as they were given: a glob is shorter than its files.
        own = read_csv(spark, paths if len(census) == 1 else files, sep=sep, encoding=encoding, na_tokens=False,
                       recursive=recursive and len(census) == 1, header=header, tree=tree)
        lacking = [c for c in columns if c not in own.columns]
        if lacking:
            raise KeyError(f"{len(files)} file(s), {files[0]} among them, lack the columns {lacking}")
        frames.append(own.select(*[F.col(f"`{c}`") for c in columns]))
    return union_by_name(frames)


def cast_ticks(df: DataFrame, src: SourceColumns = SourceColumns(), *, drop_missing: bool = False) -> DataFrame:
    """Select the configured columns by name and cast them (ANSI: bad text raises).

    String input may still hold NA tokens. ``drop_missing`` removes every row
    with a missing value in the selected columns *before* casting, testing the
    raw text, so each cast runs once per row; otherwise NA tokens become null.
    """
    schema = tick_schema(src)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise KeyError(f"source is missing columns {missing}")
    types = dict(df.dtypes)
    raw = {f.name: types[f.name] == "string" for f in schema.fields}

    def present(name: str):
        c = F.col(f"`{name}`")
        if raw[name]:
            return ~is_missing(c)
        if types[name] in ("double", "float"):
            return c.isNotNull() & ~F.isnan(c)
        return c.isNotNull()

    if drop_missing:
        keep = reduce(lambda a, b: a & b, [present(f.name) for f in schema.fields])
        df = df.where(keep)
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    return df.select(*[
        (na_token_to_null(F.col(f"`{f.name}`")) if raw[f.name] else F.col(f"`{f.name}`"))
        .cast(f.dataType).alias(f.name) for f in schema.fields])


def union_by_name(frames: list[DataFrame]) -> DataFrame | None:
    """Vertical union matching columns by name; absent columns become null."""
    frames = [f for f in frames if f is not None]
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
