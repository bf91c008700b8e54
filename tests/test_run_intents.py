"""Run intents, the current table and the ledger's day forms."""

import datetime as dt
import os
from dataclasses import replace

import pytest

import daybar.plans.job as job
from daybar.config import JobConfig
from daybar.errors import LedgerSchemaError, RunIntentError
from daybar.plans import append_ledger, day_ranges, open_intent, plan_days, read_ledger, recover_intent, run
from daybar.plans.intents import close_intent, plan_intent, take_intent
from daybar.sinks import read_current, update_current
from tests.fixtures import F1, write_tick_csvs

AS_OF = "2021-04-19"


def at(second):
    return dt.datetime(2030, 1, 1, 0, 0, second)


@pytest.fixture()
def cfg(tmp_dir):
    write_tick_csvs(f"{tmp_dir}/src", F1)
    return JobConfig(source_path=f"{tmp_dir}/src", target_prefix=f"{tmp_dir}/trg/r_", ledger_path=f"{tmp_dir}/meta/ledger",
                     first_date="2021-04-17", current_path=f"{tmp_dir}/current")


def reports(cfg):
    folder = os.path.dirname(cfg.target_prefix)
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def recorded(spark, cfg):
    ledger = read_ledger(spark, cfg.ledger_path)
    return sorted(r[0] for r in ledger.collect()) if ledger is not None else []


def test_a_finished_run_leaves_no_intent(spark, cfg):
    run(spark, cfg, AS_OF, now=at(1))
    assert open_intent(spark, cfg.ledger_path) is None
    assert run(spark, cfg, AS_OF, now=at(2)).target is None and open_intent(spark, cfg.ledger_path) is None


def test_two_runs_at_once(spark, cfg, monkeypatch):
    inside = []

    def publish(*args):
        with pytest.raises(RunIntentError, match="2021-04-17"):
            run(spark, cfg, AS_OF, now=at(2))  # a second run while the first one publishes
        inside.append(True)
        return real(*args)

    real = job.publish
    monkeypatch.setattr(job, "publish", publish)
    run(spark, cfg, AS_OF, now=at(1))
    assert inside and len(reports(cfg)) == 1 and recorded(spark, cfg) == ["2021-04-17", "2021-04-18", "2021-04-19"]


def test_a_run_that_dies_between_report_and_ledger(spark, cfg, monkeypatch):
    def die(*_, **__):
        raise SystemExit  # as a killed driver would: nothing behind it runs

    monkeypatch.setattr(job, "append_ledger", die)
    with pytest.raises(SystemExit):
        run(spark, cfg, AS_OF, now=at(1))
    monkeypatch.undo()
    first = reports(cfg)
    assert len(first) == 1 and recorded(spark, cfg) == []
    with pytest.raises(RunIntentError, match="r_20300101_000001"):
        run(spark, cfg, AS_OF, now=at(2))
    assert reports(cfg) == first
    again = run(spark, cfg, AS_OF, now=at(3), recover=True)
    assert again.target is None and reports(cfg) == first  # recorded, not published again
    assert recorded(spark, cfg) == ["2021-04-17", "2021-04-18", "2021-04-19"]
    assert open_intent(spark, cfg.ledger_path) is None and read_current(spark, cfg.current_path).count() == 3


def test_a_run_that_dies_before_its_report(spark, cfg, monkeypatch):
    monkeypatch.setattr(job, "publish", lambda *_: (_ for _ in ()).throw(SystemExit()))
    with pytest.raises(SystemExit):
        run(spark, cfg, AS_OF, now=at(1))
    monkeypatch.undo()
    assert open_intent(spark, cfg.ledger_path).cutoff == "2021-04-17"
    assert run(spark, cfg, AS_OF, now=at(2), recover=True).target and len(reports(cfg)) == 1


def test_a_run_that_fails_gives_its_intent_back(spark, cfg, monkeypatch):
    monkeypatch.setattr(job, "publish", lambda *_: (_ for _ in ()).throw(ValueError("no")))
    with pytest.raises(ValueError):
        run(spark, cfg, AS_OF, now=at(1))
    monkeypatch.undo()
    assert open_intent(spark, cfg.ledger_path) is None and run(spark, cfg, AS_OF, now=at(2)).target


def test_recovery_by_what_is_there(spark, cfg):
    path, target = cfg.ledger_path, f"{os.path.dirname(cfg.target_prefix)}/r"
    assert recover_intent(spark, path) is None
    take_intent(spark, path, AS_OF)
    assert recover_intent(spark, path) == "dropped"  # died before it planned
    for want in ("recorded", "closed"):  # its report is there; the ledger lacks its cutoff day, then has it
        mine = take_intent(spark, path, AS_OF)
        plan_intent(spark, path, mine, "2021-04-18", ["2021-04-18", "2021-04-19"], target)
        os.makedirs(target, exist_ok=True)
        assert recover_intent(spark, path) == want and recorded(spark, cfg) == ["2021-04-18", "2021-04-19"]
    close_intent(spark, path)  # closing what is closed does nothing


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_current_table_over_overlapping_reports(spark, cfg, fmt):
    cfg = replace(cfg, target_format=fmt)
    one = run(spark, cfg, AS_OF, now=at(1))
    before = read_current(spark, cfg.current_path).drop("report_day").collect()
    # A ledger of its own lacks the last two days: they are reported again, and a late file changes one of them.
    late = [("AT0000A0E9W5", "SANT", "2021-04-19", "10:00", 30.0, 30.0, 30.0, 30.0, 1)]
    write_tick_csvs(cfg.source_path, late, names=["2021-04-19/late.csv"])
    two = run(spark, replace(cfg, ledger_path=f"{cfg.ledger_path}2", first_date="2021-04-18"), AS_OF, now=at(2))
    assert one.target != two.target and len(before) == 3
    now = {r["Date"]: r for r in read_current(spark, cfg.current_path).collect()}
    assert sorted(now) == ["2021-04-17", "2021-04-18", "2021-04-19"]
    assert now["2021-04-19"]["closing_price_eur"] == 30.0 and now["2021-04-17"]["daily_traded_volume"] == 1088
    update_current(job._published(spark, cfg, two.target), cfg.current_path)  # once more changes nothing
    assert {r["Date"]: r for r in read_current(spark, cfg.current_path).collect()} == now
    assert read_current(spark, f"{cfg.current_path}-none") is None


def ledger_of(spark, days):
    return spark.createDataFrame([(d, "2021-04-19") for d in days],
                                 "source_file_date string, datetime_of_processing string")


def test_ledger_days_in_several_forms(spark):
    days = ["2021/04/15", "20210416", "2021-4-17", "2021-04-18 12:33", "2021.04.19T01:02:03.5Z", " 2021-04-20 ", None]
    (r,) = day_ranges(ledger_of(spark, days)).collect()
    assert (str(r["first"]), str(r["last"])) == ("2021-04-15", "2021-04-20")
    assert plan_days(spark, ledger_of(spark, days), "2021-04-15", "2021-04-21").cutoff == "2021-04-21"


@pytest.mark.parametrize("bad", ["2021-13-01", "12:33;23", "yesterday", "2021-04/15", "15.04.2021", "2021-04-15 noon", "202104155"])
def test_unreadable_ledger_days_raise_one_typed_error(spark, bad):
    with pytest.raises(LedgerSchemaError, match="2 ledger row") as e:
        plan_days(spark, ledger_of(spark, ["2021-04-15", bad, bad]), "2021-04-15", AS_OF)
    assert bad in str(e.value)


def test_unreadable_ledger_stops_the_job_before_it_publishes(spark, cfg):
    append_ledger(spark, cfg.ledger_path, ["soon"], AS_OF)
    with pytest.raises(LedgerSchemaError):
        run(spark, cfg, AS_OF, now=at(1))
    assert reports(cfg) == [] and open_intent(spark, cfg.ledger_path) is None
