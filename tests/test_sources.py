import os

import pytest
from pyspark.errors import AnalysisException

from daybar.sources import header_census, list_objects, read_csv, read_days, read_since, union_by_name
from tests.fixtures import F1, TICK_COLUMNS, write_tick_csvs


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def f1_tree(tmp_dir):
    write_tick_csvs(tmp_dir, F1)
    return tmp_dir


def test_extract_planned_days_skips_missing_day(spark, f1_tree):
    days = ["2021-04-16", "2021-04-17", "2021-04-18", "2021-04-19", "2021-04-20"]
    df = read_days(spark, f1_tree, days)
    assert df.columns == TICK_COLUMNS
    assert _sorted(df) == sorted(F1[1:])


def test_extract_no_days_and_no_files(spark, f1_tree):
    assert read_days(spark, f1_tree, []).count() == 0
    empty = read_days(spark, f1_tree, ["2200-01-02"])
    assert empty.columns == TICK_COLUMNS and empty.count() == 0


def test_read_since_prunes_by_key_date(spark, f1_tree):
    os.makedirs(os.path.join(f1_tree, "notaday"))
    write_tick_csvs(f1_tree, [F1[0]], names=["notaday/x.csv"])
    assert _sorted(read_since(spark, f1_tree, "2021-04-18")) == sorted(F1[4:])


def test_listing_prefix_hit_and_miss(spark, f1_tree):
    keys = sorted(r["key"] for r in list_objects(spark, f1_tree, "2021-04-17").collect())
    assert keys == ["2021-04-17/2021-04-17_BINS_XETR13.csv", "2021-04-17/2021-04-17_BINS_XETR14.csv"]
    assert list_objects(spark, f1_tree, "2030-").count() == 0
    assert list_objects(spark, f1_tree).count() == len(F1)


def test_listing_keeps_empty_and_hidden_files(spark, tmp_dir, monkeypatch):
    names = ["a.csv", "_b.csv", ".c.csv", "zero.csv", "_meta/x.csv", "d/e/f.csv"]
    for name in names:
        p = os.path.join(tmp_dir, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        open(p, "w").write("" if name == "zero.csv" else "x\n")
    sizes = {n: 0 if n == "zero.csv" else 2 for n in names}
    assert {r["key"]: r["size"] for r in list_objects(spark, tmp_dir).collect()} == sizes
    assert [r["key"] for r in list_objects(spark, tmp_dir, "_").orderBy("key").collect()] == ["_b.csv", "_meta/x.csv"]
    monkeypatch.setattr("daybar.sources.listing.BLOCK", 2)  # several blocks, where only the driver can list
    monkeypatch.setattr("daybar.sources.listing.open_store", lambda uri: None)
    assert {r["key"]: r["size"] for r in list_objects(spark, tmp_dir).collect()} == sizes


def test_hive_scan_lists_only_the_planned_folders(spark, tmp_dir):
    from daybar.sources import write_day_tree
    from tests.fixtures import TICK_DDL
    base = os.path.join(tmp_dir, "tree")
    write_day_tree(spark.createDataFrame(F1, TICK_DDL), base, layout="hive")
    df = read_days(spark, base, ["2021-04-16", "2021-04-18", "2030-01-01"], layout="hive")
    assert {f.rsplit("/", 2)[1] for f in df.inputFiles()} == {"Date=2021-04-16", "Date=2021-04-18"}
    assert _sorted(df) == sorted(r for r in F1 if r[2] in ("2021-04-16", "2021-04-18"))
    assert read_days(spark, base, ["2030-01-01"], layout="hive").count() == 0


def test_csv_read_binds_header(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    open(p, "w").write("col1,col2\nval1,val2\n")
    df = read_csv(spark, p)
    assert df.columns == ["col1", "col2"] and [tuple(r) for r in df.collect()] == [("val1", "val2")]


def test_na_tokens_become_null(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.csv")
    open(p, "w").write("a,b\nNA,x\nnull,N/A\n,#N/A\nok,NaN\n")
    assert _sorted(read_csv(spark, p).fillna("-")) == sorted([("-", "x"), ("-", "-"), ("-", "-"), ("ok", "-")])


def test_columns_are_found_by_name_in_each_file(spark, tmp_dir):
    # Reordered within one day too, with a further column, quotes, a byte order mark and a carriage return.
    swapped = TICK_COLUMNS[1:2] + TICK_COLUMNS[:1] + TICK_COLUMNS[2:]
    write_tick_csvs(tmp_dir, [F1[1]])
    write_tick_csvs(tmp_dir, [(F1[2][1], F1[2][0]) + F1[2][2:]], names=["2021-04-17/x.csv"], columns=swapped)
    write_tick_csvs(tmp_dir, [F1[3] + ("more",)], names=["2021-04-17/y.csv"], columns=[*TICK_COLUMNS, "Extra"])
    write_tick_csvs(tmp_dir, [F1[4]], names=["2021-04-18/z.csv"])
    with open(os.path.join(tmp_dir, "2021-04-18", "q.csv"), "w", newline="") as f:
        f.write("\ufeff" + ",".join(f'"{c}"' for c in TICK_COLUMNS[::-1]) + "\r\n" + ",".join(map(str, F1[5][::-1])) + "\r\n")
    days = ["2021-04-16", "2021-04-17", "2021-04-18"]
    got = read_days(spark, tmp_dir, days)
    assert got.columns == TICK_COLUMNS and _sorted(got) == sorted(F1[1:6])
    assert _sorted(read_since(spark, tmp_dir, "2021-04-17")) == sorted(F1[2:6])
    census = header_census(spark, f"{tmp_dir}/*", recursive=True)
    assert [len(files) for _, files in census] and sum(len(files) for _, files in census) == 5 and len(census) == 4


def test_a_file_without_a_needed_column_is_named(spark, tmp_dir):
    write_tick_csvs(tmp_dir, [F1[1]])
    write_tick_csvs(tmp_dir, [F1[2][1:]], names=["2021-04-17/x.csv"], columns=TICK_COLUMNS[1:])
    with pytest.raises(KeyError, match="x.csv.*ISIN"):
        read_days(spark, tmp_dir, ["2021-04-16", "2021-04-17"])


def test_header_census_without_a_client_for_the_store(spark, tmp_dir, monkeypatch):
    write_tick_csvs(tmp_dir, F1[1:3])
    write_tick_csvs(tmp_dir, [F1[3] + ("more",)], names=["2021-04-17/y.csv"], columns=[*TICK_COLUMNS, "Extra"])
    want = header_census(spark, f"{tmp_dir}/*", recursive=True)
    monkeypatch.setattr("daybar.sources.csv.open_store", lambda uri: None)
    assert [(h, len(f)) for h, f in header_census(spark, f"{tmp_dir}/*", recursive=True)] == [(h, len(f)) for h, f in want]
    assert _sorted(read_days(spark, tmp_dir, ["2021-04-16", "2021-04-17"])) == sorted(F1[1:4])


def test_hive_layout_by_name(spark, tmp_dir):
    columns = [c for c in TICK_COLUMNS if c != "Date"]
    for day, order, rows in (("2021-04-16", columns, [F1[1]]), ("2021-04-17", columns[::-1], F1[2:4])):
        own = [dict(zip(TICK_COLUMNS, r)) for r in rows]
        write_tick_csvs(tmp_dir, [tuple(r[c] for c in order) for r in own][:1], names=[f"Date={day}/a.csv"], columns=order)
    assert _sorted(read_days(spark, tmp_dir, ["2021-04-16", "2021-04-17"], layout="hive")) == sorted(F1[1:3])
    assert _sorted(read_since(spark, tmp_dir, "2021-04-17", layout="hive")) == sorted(F1[2:3])


def test_header_only_and_zero_byte_files_are_empty(spark, tmp_dir):
    write_tick_csvs(tmp_dir, [F1[1]])
    os.makedirs(os.path.join(tmp_dir, "2021-04-17"))
    open(os.path.join(tmp_dir, "2021-04-17", "h.csv"), "w").write(",".join(TICK_COLUMNS) + "\n")
    os.makedirs(os.path.join(tmp_dir, "2021-04-18"))
    open(os.path.join(tmp_dir, "2021-04-18", "z.csv"), "w").close()
    assert _sorted(read_days(spark, tmp_dir, ["2021-04-16", "2021-04-17", "2021-04-18"])) == [F1[1]]
    assert read_days(spark, tmp_dir, ["2021-04-18"]).count() == 0


def test_garbage_number_raises(spark, tmp_dir):
    row = F1[1][:4] + ("abc",) + F1[1][5:]
    write_tick_csvs(tmp_dir, [row])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        read_days(spark, tmp_dir, ["2021-04-16"]).collect()


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([("1", "2")], "x string, y string")
    b = spark.createDataFrame([("3",)], "y string")
    assert _sorted(union_by_name([a, b]).fillna("-")) == [("-", "3"), ("1", "2")]


def test_missing_column_raises(spark, tmp_dir):
    p = os.path.join(tmp_dir, "2021-04-16")
    os.makedirs(p)
    open(os.path.join(p, "a.csv"), "w").write("ISIN,Date\nX,2021-04-16\n")
    with pytest.raises((KeyError, AnalysisException)):
        read_days(spark, tmp_dir, ["2021-04-16"])


def test_drop_missing_on_typed_parquet_drops_nan(spark, tmp_dir):
    from daybar.sources import write_day_tree
    from tests.fixtures import TICK_DDL
    rows = list(F1[1:3]) + [F1[3][:5] + (float("nan"),) + F1[3][6:], F1[4][:4] + (None,) + F1[4][5:]]
    write_day_tree(spark.createDataFrame(rows, TICK_DDL), f"{tmp_dir}/t", layout="prefix", fmt="parquet")
    got = read_days(spark, f"{tmp_dir}/t", ["2021-04-16", "2021-04-17", "2021-04-18"], fmt="parquet",
                    drop_missing=True)
    assert _sorted(got) == sorted(F1[1:3])


def test_known_header_skips_inference_and_still_checks_files(spark, f1_tree, tmp_dir):
    from daybar.config import SourceColumns
    src = SourceColumns(file_columns=tuple(TICK_COLUMNS))
    days = ["2021-04-16", "2021-04-17", "2021-04-18", "2021-04-19"]
    assert _sorted(read_days(spark, f1_tree, days, src, drop_missing=True)) == sorted(F1[1:])
    # a file whose header differs from the declared one fails loudly
    swapped = TICK_COLUMNS[1:2] + TICK_COLUMNS[:1] + TICK_COLUMNS[2:]
    write_tick_csvs(f1_tree, [(F1[5][1], F1[5][0]) + F1[5][2:]], names=["2021-04-18/z.csv"], columns=swapped)
    with pytest.raises(Exception, match="(?i)header|schema|CSV"):
        read_days(spark, f1_tree, days, src).collect()


def test_read_since_hive_layout(spark, tmp_dir):
    from daybar.sources import write_day_tree
    from tests.fixtures import TICK_DDL
    write_day_tree(spark.createDataFrame(F1, TICK_DDL), f"{tmp_dir}/h", layout="hive")
    got = read_since(spark, f"{tmp_dir}/h", "2021-04-18", layout="hive")
    assert _sorted(got) == sorted(F1[4:])


def test_listing_and_scan_with_space_in_base(spark, tmp_dir):
    base = os.path.join(tmp_dir, "my bucket")
    write_tick_csvs(base, F1[1:3])
    keys = sorted(r["key"] for r in list_objects(spark, base, "2021-04").collect())
    assert keys == ["2021-04-16/2021-04-16_BINS_XETR15.csv", "2021-04-17/2021-04-17_BINS_XETR13.csv"]
    assert _sorted(read_days(spark, base, ["2021-04-16", "2021-04-17"])) == sorted(F1[1:3])
    assert _sorted(read_since(spark, base, "2021-04-17")) == [F1[2]]


def test_row_with_wrong_field_count_raises(spark, tmp_dir):
    # FAILFAST: a truncated or overlong row is an error, never silently reshaped.
    p = os.path.join(tmp_dir, "2021-04-16")
    os.makedirs(p)
    with open(os.path.join(p, "a.csv"), "w") as fh:
        fh.write(",".join(TICK_COLUMNS) + "\n")
        fh.write("AT0000A0E9W5,SANT,2021-04-16,15:00,18.27,21.19\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|MALFORMED"):
        read_days(spark, tmp_dir, ["2021-04-16"]).collect()


def test_listing_prefix_with_glob_characters(spark, tmp_dir):
    for name in ("x[1]/a.csv", "x1/b.csv", "y{a,b}/c.csv"):
        p = os.path.join(tmp_dir, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        open(p, "w").write("c\n1\n")
    assert [r["key"] for r in list_objects(spark, tmp_dir, "x[1]").collect()] == ["x[1]/a.csv"]
    assert [r["key"] for r in list_objects(spark, tmp_dir, "y{a,b}").collect()] == ["y{a,b}/c.csv"]
