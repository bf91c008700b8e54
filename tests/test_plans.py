import datetime as dt
import os

import pytest

from daybar.errors import LedgerSchemaError
from daybar.plans import append_ledger, day_ranges, plan_days, plan_days_keyed, read_ledger

TODAY = dt.date(2021, 4, 20)


def n(k):
    return (TODAY - dt.timedelta(days=k)).isoformat()


def _ledger(spark, tmp_dir, days, header="source_file_date,datetime_of_processing"):
    p = os.path.join(tmp_dir, "ledger")
    os.makedirs(p)
    with open(os.path.join(p, "part-0.csv"), "w") as fh:
        fh.write(header + "\n")
        for d in days:
            fh.write(f"{d},{TODAY} 10:00:00\n")
    return p


def test_append_creates_ledger(spark, tmp_dir):
    p = f"{tmp_dir}/ledger"
    assert append_ledger(spark, p, ["2021-04-16", "2021-04-17"], TODAY)
    rows = sorted(tuple(r) for r in read_ledger(spark, p).collect())
    assert rows == [("2021-04-16", "2021-04-20"), ("2021-04-17", "2021-04-20")]


def test_append_nothing_writes_nothing(spark, tmp_dir):
    p = f"{tmp_dir}/ledger"
    assert append_ledger(spark, p, [], TODAY)
    assert not os.path.exists(p) and read_ledger(spark, p) is None


def test_append_keeps_old_rows(spark, tmp_dir):
    p = _ledger(spark, tmp_dir, ["2021-04-12", "2021-04-13"])
    append_ledger(spark, p, ["2021-04-16", "2021-04-17"], TODAY)
    days = sorted(r[0] for r in read_ledger(spark, p).collect())
    assert days == ["2021-04-12", "2021-04-13", "2021-04-16", "2021-04-17"]
    # old rows first, then the new ones (the reference's concat order)
    in_order = [r[0] for r in read_ledger(spark, p, ordered=True).collect()]
    assert in_order == ["2021-04-12", "2021-04-13", "2021-04-16", "2021-04-17"]


@pytest.mark.parametrize("header", ["wrong_column,datetime_of_processing",
                                    "source_date,datetime_of_processing"])
def test_wrong_ledger_columns_raise(spark, tmp_dir, header):
    p = _ledger(spark, tmp_dir, ["2021-04-12"], header=header)
    with pytest.raises(LedgerSchemaError):
        append_ledger(spark, p, ["2021-04-16"], TODAY)
    with pytest.raises(LedgerSchemaError):
        read_ledger(spark, p)


def test_plan_without_ledger(spark):
    plan = plan_days(spark, None, n(2), TODAY)
    assert plan.cutoff == n(2) and list(plan.days) == [n(3), n(2), n(1), n(0)]


@pytest.mark.parametrize("first,cutoff,days", [
    (1, 1, [2, 1, 0]),
    (4, 2, [3, 2, 1, 0]),
    (7, 7, [8, 7, 6, 5, 4, 3, 2, 1, 0]),
])
def test_plan_with_ledger(spark, tmp_dir, first, cutoff, days):
    led = read_ledger(spark, _ledger(spark, tmp_dir, [n(3), n(4)]))
    plan = plan_days(spark, led, n(first), TODAY)
    assert plan.cutoff == n(cutoff) and list(plan.days) == [n(k) for k in days]


def test_plan_nothing_to_do(spark, tmp_dir):
    led = read_ledger(spark, _ledger(spark, tmp_dir, [n(0), n(1)]))
    plan = plan_days(spark, led, n(0), TODAY)
    assert plan.cutoff == "2200-01-01" and plan.days == ()


def test_plan_first_date_in_future(spark, tmp_dir):
    assert plan_days(spark, None, n(-5), TODAY).days == ()
    led = read_ledger(spark, _ledger(spark, tmp_dir, [n(3)]))
    assert plan_days(spark, led, n(-5), TODAY).cutoff == "2200-01-01"


def test_plan_timestamps_in_ledger_are_days(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ledger")
    os.makedirs(p)
    open(os.path.join(p, "a.csv"), "w").write(
        f"datetime_of_processing,source_file_date\nx,{n(1)} 12:33:23\nx,{n(0)}\n")
    assert plan_days(spark, read_ledger(spark, p), n(1), TODAY).days == ()


def test_keyed_plan(spark):
    keys = spark.createDataFrame([("A",), ("B",), ("C",)], "ISIN string")
    led = spark.createDataFrame([("A", n(1), "x"), ("A", n(0), "x"), ("B", n(2), "x"), ("B", n(1), "x"), ("C", n(2), "x"),
                                 ("C", n(1), "x"), ("C", n(0), "x")],
                                "ISIN string, source_file_date string, datetime_of_processing string")
    out = sorted(tuple(r) for r in plan_days_keyed(keys, led, n(2), TODAY).collect())
    assert out == sorted([("A", n(3), n(2)), ("A", n(2), n(2)), ("A", n(1), n(2)), ("A", n(0), n(2)),
                          ("B", n(1), n(0)), ("B", n(0), n(0))])


def test_keyed_plan_folds_the_ledger_to_ranges(spark, capsys):
    days = [8, 7, 6, 4, 3, 1]
    led = spark.createDataFrame([("A", n(k), "x") for k in days + [6, 7]] + [("B", n(k), "x") for k in range(10)] + [("C", None, "x")],
                                "ISIN string, source_file_date string, datetime_of_processing string")
    ranges = sorted((r["ISIN"], str(r["first"]), str(r["last"])) for r in day_ranges(led, ("ISIN",)).collect())
    assert ranges == [("A", n(8), n(6)), ("A", n(4), n(3)), ("A", n(1), n(1)), ("B", n(9), n(0))]
    keys = spark.createDataFrame([("A",), ("B",), ("C",)], "ISIN string")
    for first in range(10):
        cut = {}
        for key, done in (("A", set(days)), ("B", set(range(10))), ("C", set())):
            gap = [k for k in range(first, -1, -1) if k not in done]
            cut.update({key: gap[0]} if gap else {})
        out = plan_days_keyed(keys, led, n(first), TODAY)
        want = [(key, n(k), n(m)) for key, m in cut.items() for k in range(m + 1, -1, -1)]
        assert sorted(map(tuple, out.collect())) == sorted(want)
    assert plan_days_keyed(keys, None, n(1), TODAY).count() == 9


def test_single_file_ledger_is_imported_not_appended(spark, tmp_dir):
    from daybar.errors import LedgerLayoutError
    from daybar.plans import import_ledger
    legacy = os.path.join(tmp_dir, "meta_file.csv")
    open(legacy, "w").write(f"source_file_date,datetime_of_processing\n{n(3)},{TODAY} 10:00:00\n{n(2)},{TODAY}\n")
    assert sorted(r[0] for r in read_ledger(spark, legacy).collect()) == [n(3), n(2)]
    with pytest.raises(LedgerLayoutError):
        append_ledger(spark, legacy, [n(1)], TODAY)
    folder = f"{tmp_dir}/ledger"
    assert import_ledger(spark, legacy, folder) == 2
    append_ledger(spark, folder, [n(1)], TODAY)
    assert sorted(r[0] for r in read_ledger(spark, folder).collect()) == [n(3), n(2), n(1)]
    plan = plan_days(spark, read_ledger(spark, folder), n(3), TODAY)
    assert plan.cutoff == n(0) and plan.days == (n(1), n(0))
