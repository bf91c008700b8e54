import os

import pytest

from daybar.errors import WrongFormatError
from daybar.sinks import publish, target_name
from daybar.sources import list_objects


def test_empty_frame_writes_nothing(spark, tmp_dir):
    df = spark.createDataFrame([], "col1 string, col2 string")
    assert publish(df, f"{tmp_dir}/out.parquet", "parquet") is None
    assert list_objects(spark, tmp_dir).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip(spark, tmp_dir, fmt):
    df = spark.createDataFrame([("A", "B"), ("C", "D")], "col1 string, col2 string")
    path = publish(df, f"{tmp_dir}/t.{fmt}", fmt)
    assert path and os.path.isdir(path)
    back = spark.read.format(fmt).options(**({"header": True} if fmt == "csv" else {})).load(path)
    assert sorted(tuple(r) for r in back.collect()) == [("A", "B"), ("C", "D")]
    assert not [n for n in os.listdir(tmp_dir) if n.startswith("_staging")]


def test_wrong_format_raises(spark, tmp_dir):
    df = spark.createDataFrame([("A", "B")], "col1 string, col2 string")
    with pytest.raises(WrongFormatError):
        publish(df, f"{tmp_dir}/t.x", "wrong_format")


def test_target_name():
    import datetime as dt
    assert target_name("report1/r_", "parquet", dt.datetime(2021, 4, 17, 8, 5, 3)) == "report1/r_20210417_080503.parquet"


def test_publish_never_overwrites(spark, tmp_dir):
    df = spark.createDataFrame([("A", "B")], "col1 string, col2 string")
    path = publish(df, f"{tmp_dir}/t.parquet", "parquet")
    with pytest.raises(FileExistsError):
        publish(df, path, "parquet")
    assert sorted(os.listdir(path)) == sorted(n for n in os.listdir(path))  # unchanged, nothing nested
    assert not [n for n in os.listdir(path) if n.startswith("_staging")]


def test_foreign_staging_folders_stay(spark, tmp_dir):
    old = os.path.join(tmp_dir, "_staging-other-run")
    os.makedirs(old)
    os.utime(old, (0, 0))
    publish(spark.createDataFrame([("A", "B")], "col1 string, col2 string"), f"{tmp_dir}/t.parquet", "parquet")
    assert os.path.exists(old)


def test_other_readers_read_our_csv(spark, tmp_dir):
    import glob

    import pandas as pd
    rows = [(" lead", 'x "q" y', "a,b"), ("t ", '"', "line\nbreak")]
    path = publish(spark.createDataFrame(rows, "a string, b string, c string").coalesce(1), f"{tmp_dir}/t.csv", "csv")
    got = pd.read_csv(glob.glob(f"{path}/part-*")[0])
    assert list(got.itertuples(index=False, name=None)) == rows
