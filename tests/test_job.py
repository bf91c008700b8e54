import datetime as dt
import os

import pytest

from daybar.config import JobConfig
from daybar.plans import read_ledger, run
from tests.fixtures import F1, F2, write_tick_csvs

TODAY = dt.date.today()


def n(k):
    return (TODAY - dt.timedelta(days=k)).isoformat()


@pytest.fixture()
def relative_tree(tmp_dir):
    # F1 with its five dates moved to today-5 ... today-1.
    shift = {"2021-04-15": n(5), "2021-04-16": n(4), "2021-04-17": n(3), "2021-04-18": n(2), "2021-04-19": n(1)}
    rows = [r[:2] + (shift[r[2]],) + r[3:] for r in F1]
    write_tick_csvs(f"{tmp_dir}/src", rows)
    return tmp_dir


def _cfg(base, fmt="parquet"):
    return JobConfig(source_path=f"{base}/src", target_prefix=f"{base}/trg/report1/daily_report1_",
                     ledger_path=f"{base}/trg/meta/ledger", first_date=n(3), target_format=fmt)


def test_whole_job_then_noop(spark, relative_tree):
    cfg = _cfg(relative_tree)
    res = run(spark, cfg, TODAY, now=dt.datetime(2030, 1, 1, 0, 0, 1))
    out = spark.read.parquet(res.target).orderBy("Date").collect()
    assert [tuple(r)[2:] for r in out] == [r[2:] for r in F2]
    assert [r["Date"] for r in out] == [n(3), n(2), n(1)]
    led = sorted(r[0] for r in read_ledger(spark, cfg.ledger_path).collect())
    assert led == [n(3), n(2), n(1), n(0)]  # today recorded though it has no file
    again = run(spark, cfg, TODAY, now=dt.datetime(2030, 1, 1, 0, 0, 2))
    assert again.target is None and again.recorded == () and again.plan.cutoff == "2200-01-01"
    assert len(os.listdir(f"{relative_tree}/trg/report1")) == 1


def test_gap_reprocesses_later_days(spark, relative_tree):
    cfg = _cfg(relative_tree, fmt="csv")
    run(spark, cfg, TODAY, now=dt.datetime(2030, 1, 1, 0, 0, 1))
    # Forget day n(2): the next run resumes there with one day of lookback.
    led_dir = cfg.ledger_path
    for name in os.listdir(led_dir):
        p = os.path.join(led_dir, name)
        if name.endswith(".csv"):
            lines = [ln for ln in open(p) if not ln.startswith(n(2))]
            open(p, "w").writelines(lines)
            crc = os.path.join(led_dir, f".{name}.crc")  # edited by hand: checksum is stale
            if os.path.exists(crc):
                os.remove(crc)
    res = run(spark, cfg, TODAY, now=dt.datetime(2030, 1, 1, 0, 0, 2))
    assert res.plan.cutoff == n(2) and res.plan.days == (n(3), n(2), n(1), n(0))
    back = spark.read.option("header", True).csv(res.target)
    assert sorted(r["Date"] for r in back.collect()) == [n(2), n(1)]
    led = sorted(r[0] for r in read_ledger(spark, cfg.ledger_path).collect())
    assert led == sorted([n(3), n(1), n(0), n(2), n(1), n(0)])  # repeats, no dedupe


CONFIG_YAML = """
s3:
  access_key: 'KEY_VAR'
  secret_key: 'SECRET_VAR'
  src_endpoint_url: 'https://example.invalid'
  src_bucket: 'src-bucket'
  trg_endpoint_url: 'https://example.invalid'
  trg_bucket: 'trg-bucket'
source:
  src_first_extract_date: '{first}'
  src_columns: ['ISIN', 'Mnemonic', 'Date', 'Time', 'StartPrice', 'EndPrice', 'MinPrice', 'MaxPrice', 'TradedVolume']
  src_col_date: 'Date'
  src_col_isin: 'ISIN'
  src_col_time: 'Time'
  src_col_min_price: 'MinPrice'
  src_col_start_price: 'StartPrice'
  src_col_max_price: 'MaxPrice'
  src_col_traded_vol: 'TradedVolume'
target:
  trg_key: 'report1/daily_report1_'
  trg_key_date_format: '%Y%m%d_%H%M%S'
  trg_format: 'parquet'
  trg_col_isin: 'isin'
  trg_col_date: 'date'
  trg_col_op_price: 'opening_price_eur'
  trg_col_clos_price: 'closing_price_eur'
  trg_col_min_price: 'minimum_price_eur'
  trg_col_max_price: 'maximum_price_eur'
  trg_col_dail_trade_vol: 'daily_traded_volume'
  trg_col_ch_prev_clos: 'change_prev_closing_%'
meta:
  meta_key: 'meta/report1/report1_meta_file.csv'
"""


def test_reference_style_config(spark, relative_tree):
    import yaml

    from daybar.config import job_config_from_mapping
    raw = yaml.safe_load(CONFIG_YAML.format(first=n(3)))
    assert job_config_from_mapping(raw).source_path == "s3a://src-bucket"
    cfg = job_config_from_mapping(raw, source_root=f"{relative_tree}/src", target_root=f"{relative_tree}/trg")
    assert cfg.target_time_format == "yyyyMMdd_HHmmss" and cfg.source.double_columns[0] == "StartPrice"
    res = run(spark, cfg, TODAY, now=dt.datetime(2030, 1, 1, 0, 0, 1))
    assert res.target.endswith("report1/daily_report1_20300101_000001.parquet")
    out = spark.read.parquet(res.target).orderBy("Date").collect()
    assert [tuple(r)[2:] for r in out] == [r[2:] for r in F2]


@pytest.mark.parametrize("layout,fmt", [("hive", "parquet"), ("prefix", "parquet"), ("hive", "csv")])
def test_job_over_other_layouts(spark, tmp_dir, layout, fmt):
    from tests.fixtures import TICK_DDL
    shift = {"2021-04-15": n(5), "2021-04-16": n(4), "2021-04-17": n(3), "2021-04-18": n(2), "2021-04-19": n(1)}
    rows = [r[:2] + (shift[r[2]],) + r[3:] for r in F1]
    from daybar.sources import write_day_tree
    days = write_day_tree(spark.createDataFrame(rows, TICK_DDL), f"{tmp_dir}/src", layout=layout, fmt=fmt)
    assert days == sorted(shift.values())
    cfg = JobConfig(source_path=f"{tmp_dir}/src", target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/trg/ledger",
                    first_date=n(3), source_layout=layout, source_format=fmt)
    res = run(spark, cfg, TODAY, now=dt.datetime(2030, 1, 1, 0, 0, 1))
    out = spark.read.parquet(res.target).orderBy("Date").collect()
    assert [tuple(r)[2:] for r in out] == [r[2:] for r in F2]


def test_cli_runs_the_job(spark, relative_tree):
    from daybar.plans.cli import main
    cfg_path = f"{relative_tree}/config.yml"
    with open(cfg_path, "w") as fh:
        fh.write(CONFIG_YAML.format(first=n(3)))
    main([cfg_path, "--as-of", TODAY.isoformat(), "--source-root", f"{relative_tree}/src",
          "--target-root", f"{relative_tree}/trg"])
    written = os.listdir(f"{relative_tree}/trg/report1")
    assert len(written) == 1 and written[0].startswith("daily_report1_")
    led = sorted(r[0] for r in read_ledger(spark, f"{relative_tree}/trg/meta/report1/report1_meta_file.csv").collect())
    assert led == [n(3), n(2), n(1), n(0)]


def test_published_report_is_ordered_like_the_reference(spark, tmp_dir):
    import pandas as pd

    from tests.fixtures import TICK_DDL
    from daybar.sources import write_day_tree
    # several instruments, written in scrambled order
    rows = []
    for i, isin in enumerate(["C9", "A1", "B5"]):
        for k in (3, 1, 2, 4):
            rows.append((isin, "X", n(k), "09:00", 10.0 + i + k, 1.0, 9.0, 20.0, 10 * k))
    write_day_tree(spark.createDataFrame(rows, TICK_DDL).repartition(3), f"{tmp_dir}/src")
    cfg = JobConfig(source_path=f"{tmp_dir}/src", target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/led",
                    first_date=n(3))
    res = run(spark, cfg, TODAY, now=dt.datetime(2030, 1, 1, 0, 0, 1))
    got = pd.read_parquet(res.target)
    keys = list(zip(got["ISIN"], got["Date"]))
    assert keys == sorted(keys) and len(keys) == 9


def test_na_mnemonic_in_csv_drops_the_tick(spark, tmp_dir):
    # 'NA' is a missing-value token for the reference's reader: the tick is dropped.
    rows = [r[:2] + (n(2),) + r[3:] for r in F1[2:4]]
    bad = ("AT0000A0E9W5", "NA", n(2), "06:00", 1.0, 1.0, 1.0, 99.0, 5)
    write_tick_csvs(f"{tmp_dir}/src", rows + [bad], names=[f"{n(2)}/a.csv", f"{n(2)}/b.csv", f"{n(2)}/c.csv"])
    cfg = JobConfig(source_path=f"{tmp_dir}/src", target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/led",
                    first_date=n(2))
    res = run(spark, cfg, TODAY, now=dt.datetime(2030, 1, 1, 0, 0, 1))
    (row,) = spark.read.parquet(res.target).collect()
    assert (row["opening_price_eur"], row["maximum_price_eur"], row["daily_traded_volume"]) == (20.21, 21.34, 1088)


def test_config_mapping_optional_source_keys():
    import yaml

    from daybar.config import job_config_from_mapping
    raw = yaml.safe_load(CONFIG_YAML.format(first="2021-04-17"))
    assert job_config_from_mapping(raw).source_layout == "prefix"
    raw["source"].update(src_layout="hive", src_format="parquet", src_sep=";", src_encoding="ISO-8859-1",
                         src_file_columns=["ISIN", "Date"])
    cfg = job_config_from_mapping(raw)
    assert (cfg.source_layout, cfg.source_format, cfg.csv_sep, cfg.csv_encoding) == ("hive", "parquet", ";", "ISO-8859-1")
    assert cfg.source.file_columns == ("ISIN", "Date")


def test_cli_stream_mode(spark, relative_tree):
    from daybar.plans.cli import main
    cfg_path = f"{relative_tree}/config.yml"
    with open(cfg_path, "w") as fh:
        fh.write(CONFIG_YAML.format(first=n(3)))
    args = [cfg_path, "--source-root", f"{relative_tree}/src", "--target-root", f"{relative_tree}/trg",
            "--stream", "--checkpoint", f"{relative_tree}/ck"]
    main(args)
    written = [d for d in os.listdir(f"{relative_tree}/trg/report1") if d.startswith("daily_report1_batch_")]
    assert len(written) == 1
    out = spark.read.parquet(f"{relative_tree}/trg/report1/{written[0]}").orderBy("Date").collect()
    assert [tuple(r)[2:] for r in out] == [r[2:] for r in F2]
    main(args)  # nothing new: no second report
    assert len([d for d in os.listdir(f"{relative_tree}/trg/report1") if d.startswith("daily_report1_batch_")]) == 1
