"""plan_days / plan_days_keyed against a brute-force model of the planning rules."""

import datetime as dt
import random

import pytest

from daybar.plans import plan_days, plan_days_keyed

AS_OF = dt.date(2021, 4, 20)
LEDGER_DDL = "source_file_date string, datetime_of_processing string"


def model(ledger_days, first, as_of, lookback=1):
    """(cutoff, days) by the rules: calendar first-L … as_of; first missing day ≥ first; read from it − L."""
    start = first - dt.timedelta(days=lookback)
    cal = [start + dt.timedelta(days=i) for i in range((as_of - start).days + 1)]
    if ledger_days is None:
        return first.isoformat(), tuple(d.isoformat() for d in cal)
    missing = [d for d in cal if d >= first and d not in ledger_days]
    if not missing:
        return "2200-01-01", ()
    m = min(missing)
    return m.isoformat(), tuple(d.isoformat() for d in cal if d >= m - dt.timedelta(days=lookback))


@pytest.mark.parametrize("seed", range(8))
def test_plan_days_matches_model(spark, seed):
    rnd = random.Random(seed)
    first = AS_OF - dt.timedelta(days=rnd.randint(-2, 12))
    if seed == 0:
        ledger = None
    else:
        ledger = {AS_OF - dt.timedelta(days=rnd.randint(-3, 15)) for _ in range(rnd.randint(0, 14))}
    lookback = 1 if seed % 3 else 2
    df = None if ledger is None else spark.createDataFrame(
        [(d.isoformat(), "x") for d in sorted(ledger)] or [], LEDGER_DDL)
    plan = plan_days(spark, df, first.isoformat(), AS_OF, lookback_days=lookback)
    assert (plan.cutoff, plan.days) == model(ledger, first, AS_OF, lookback)


@pytest.mark.parametrize("seed", range(3))
def test_keyed_plan_matches_model_per_key(spark, seed):
    rnd = random.Random(100 + seed)
    first = AS_OF - dt.timedelta(days=6)
    keys = [f"K{i}" for i in range(7)]
    ledger = {k: {AS_OF - dt.timedelta(days=rnd.randint(0, 9)) for _ in range(rnd.randint(0, 9))} for k in keys}
    rows = [(k, d.isoformat(), "x") for k in keys for d in sorted(ledger[k])]
    led = spark.createDataFrame(rows, "ISIN string, " + LEDGER_DDL)
    keys_df = spark.createDataFrame([(k,) for k in keys], "ISIN string")
    got = {}
    for r in plan_days_keyed(keys_df, led, first.isoformat(), AS_OF).collect():
        got.setdefault(r["ISIN"], [r["cutoff"], []])[1].append(r["day"])
    want = {}
    for k in keys:
        cutoff, days = model(ledger[k], first, AS_OF)
        if days:
            want[k] = [cutoff, list(days)]
    assert {k: [c, sorted(d)] for k, (c, d) in got.items()} == want
