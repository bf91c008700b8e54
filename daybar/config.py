"""Column mapping and job settings (every name is configurable)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must match the reference job's defaults.
DEFAULT_SOURCE_COLUMNS = (
    "ISIN", "Mnemonic", "Date", "Time", "StartPrice",
    "EndPrice", "MinPrice", "MaxPrice", "TradedVolume",
)
LEDGER_DAY_COL = "source_file_date"
LEDGER_PROCESSED_COL = "datetime_of_processing"
LEDGER_DAY_FORMAT = "yyyy-MM-dd"
TARGET_KEY_TIME_FORMAT = "yyyyMMdd_HHmmss"
NOTHING_TO_DO_CUTOFF = "2200-01-01"
SUPPORTED_FORMATS = ("csv", "parquet")


@dataclass(frozen=True)
class SourceColumns:
    """Names of the tick columns in the source files."""

    columns: tuple[str, ...] = DEFAULT_SOURCE_COLUMNS
    date: str = "Date"
    isin: str = "ISIN"
    time: str = "Time"
    start_price: str = "StartPrice"
    min_price: str = "MinPrice"
    max_price: str = "MaxPrice"
    traded_volume: str = "TradedVolume"
    double_columns: tuple[str, ...] = ("StartPrice", "EndPrice", "MinPrice", "MaxPrice")
    long_columns: tuple[str, ...] = ("TradedVolume",)
    # How ticks of one day are ordered for the opening/closing price:
    # "text"   any text, compared as text (struct key, sort aggregation);
    # "clock"  zero-padded HH[:MM[:SS[.ffffff]]] text, compared as microseconds;
    # unique_clock  clock text that the source declares unique per (ISIN, Date): hash
    #          aggregation over a long; of equal times either price may be taken;
    # other    a SQL expression giving a long in the text's order.
    time_order: str = "text"
    # Full header of the source files, in file order, when known: the scan then
    # needs no header-inference pass, and every file is still checked against it.
    file_columns: tuple[str, ...] | None = None


@dataclass(frozen=True)
class ReportColumns:
    """Names of the computed report columns.

    The key columns of the report keep the source names (ISIN, Date).
    """

    opening_price: str = "opening_price_eur"
    closing_price: str = "closing_price_eur"
    minimum_price: str = "minimum_price_eur"
    maximum_price: str = "maximum_price_eur"
    daily_traded_volume: str = "daily_traded_volume"
    change_prev: str = "change_prev_closing_%"


@dataclass(frozen=True)
class JobConfig:
    """Everything one run of the daily report job needs."""

    source_path: str
    target_prefix: str
    ledger_path: str
    first_date: str
    source: SourceColumns = field(default_factory=SourceColumns)
    report: ReportColumns = field(default_factory=ReportColumns)
    target_format: str = "parquet"
    target_time_format: str = TARGET_KEY_TIME_FORMAT
    source_layout: str = "prefix"  # "prefix": <day>/<file>.csv, "hive": <col>=<day>/...
    source_format: str = "csv"
    csv_sep: str = ","
    csv_encoding: str = "utf-8"
    change_on: str = "open"
    lookback_days: int = 1
    # Publish rows ordered by (ISIN, Date), as the reference's report is; the
    # sort runs on day-grain rows (one range exchange), never on ticks.
    sorted_output: bool = True
    # A table with one row per instrument-day over all reports (see sinks.current); None keeps none.
    current_path: str | None = None


def _spark_time_format(py_format: str) -> str:
    """``%Y%m%d_%H%M%S``-style pattern to Spark's ``yyyyMMdd_HHmmss``."""
    out = py_format
    for a, b in (("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd"), ("%H", "HH"), ("%M", "mm"), ("%S", "ss")):
        out = out.replace(a, b)
    return out


def job_config_from_mapping(cfg: dict, *, source_root: str | None = None,
                            target_root: str | None = None) -> JobConfig:
    """Build a :class:`JobConfig` from the reference job's YAML layout.

    Sections ``source`` (``src_*``), ``target`` (``trg_*``), ``meta``
    (``meta_key``) and ``s3`` (buckets). Optional source keys: ``src_file_columns``
    (the files' full header), ``src_layout`` (prefix | hive), ``src_format``
    (csv | parquet), ``src_sep``, ``src_encoding``, ``src_time_order`` (see
    ``SourceColumns.time_order``); optional target key: ``trg_current_key`` (the
    current table). Paths are the buckets as ``s3a://``
    roots unless ``source_root`` / ``target_root`` are given; credentials and
    endpoints belong in the Hadoop configuration, not here. The declared but
    unused ``trg_col_isin`` / ``trg_col_date`` are accepted and ignored: the
    report keeps the source key names.
    """
    src, trg, meta, s3 = cfg["source"], cfg["target"], cfg.get("meta", {}), cfg.get("s3", {})
    source_root = (source_root or f"s3a://{s3['src_bucket']}").rstrip("/")
    target_root = (target_root or f"s3a://{s3['trg_bucket']}").rstrip("/")
    columns = tuple(src["src_columns"])
    source = SourceColumns(
        columns=columns, date=src["src_col_date"], isin=src["src_col_isin"], time=src["src_col_time"],
        start_price=src["src_col_start_price"], min_price=src["src_col_min_price"],
        max_price=src["src_col_max_price"], traded_volume=src["src_col_traded_vol"],
        double_columns=tuple(c for c in columns if c in DEFAULT_SOURCE_COLUMNS[4:8]
                             or c in (src["src_col_start_price"], src["src_col_min_price"],
                                      src["src_col_max_price"])),
        long_columns=(src["src_col_traded_vol"],),
        file_columns=tuple(src["src_file_columns"]) if src.get("src_file_columns") else None,
        time_order=src.get("src_time_order", "text"),
    )
    report = ReportColumns(
        opening_price=trg["trg_col_op_price"], closing_price=trg["trg_col_clos_price"],
        minimum_price=trg["trg_col_min_price"], maximum_price=trg["trg_col_max_price"],
        daily_traded_volume=trg["trg_col_dail_trade_vol"], change_prev=trg["trg_col_ch_prev_clos"],
    )
    return JobConfig(
        source_path=source_root, target_prefix=f"{target_root}/{trg['trg_key']}",
        ledger_path=f"{target_root}/{meta['meta_key']}", first_date=str(src["src_first_extract_date"]),
        source=source, report=report, target_format=trg["trg_format"],
        target_time_format=_spark_time_format(trg.get("trg_key_date_format", "%Y%m%d_%H%M%S")),
        source_layout=src.get("src_layout", "prefix"), source_format=src.get("src_format", "csv"),
        csv_sep=src.get("src_sep", ","), csv_encoding=src.get("src_encoding", "utf-8"),
        current_path=f"{target_root}/{trg['trg_current_key']}" if trg.get("trg_current_key") else None,
    )
