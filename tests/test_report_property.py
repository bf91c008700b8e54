"""daily_report against a brute-force Python model on random ticks."""

import math
import random

import pytest

from daybar.config import SourceColumns
from daybar.operators import daily_report
from tests.fixtures import TICK_DDL


def _rint2(x):
    # numpy-style: round half to even on the scaled double
    if x is None or math.isinf(x) or math.isnan(x):
        return x
    return round(x * 100.0) / 100.0


def brute_force(rows, cutoff):
    good = [r for r in rows if all(v is not None and not (isinstance(v, float) and math.isnan(v)) for v in r)]
    days = {}
    for r in good:
        days.setdefault((r[0], r[2]), []).append(r)
    bars = {}
    for key, ticks in days.items():
        ordered = sorted(ticks, key=lambda r: (r[3], r[4]))
        bars[key] = (ordered[0][4], ordered[-1][4], min(r[6] for r in ticks), max(r[7] for r in ticks),
                     sum(r[8] for r in ticks))
    out = []
    for isin in sorted({k[0] for k in bars}):
        prev = None
        for day in sorted(d for (i, d) in bars if i == isin):
            o, c, lo, hi, vol = bars[(isin, day)]
            if prev is None:
                chg = None
            elif prev == 0:
                chg = math.inf if o > 0 else (-math.inf if o < 0 else None)
            else:
                chg = (o - prev) / prev * 100
            prev = o
            if day >= cutoff:
                out.append((isin, day, _rint2(o), _rint2(c), _rint2(lo), _rint2(hi), vol, _rint2(chg)))
    return sorted(out)


def random_ticks(seed, n):
    rnd = random.Random(seed)
    isins = ["A", "B", "C"]
    days = ["2021-04-15", "2021-04-16", "2021-04-17", "2021-04-19"]
    times = ["08:00", "08:01", "09:30", "17:29"]
    prices = [0.0, 0.125, 1.005, 2.675, 10.0, 10.5, -3.0, 99.99]
    rows = []
    for _ in range(n):
        p = rnd.choice(prices)
        row = [rnd.choice(isins), rnd.choice(["X", "NA"]), rnd.choice(days), rnd.choice(times),
               p, rnd.choice(prices), rnd.choice(prices), rnd.choice(prices), rnd.randint(0, 1000)]
        if rnd.random() < 0.05:
            row[rnd.randrange(9)] = None
        if rnd.random() < 0.03:
            row[5] = float("nan")
        rows.append(tuple(row))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_matches_brute_force(spark, seed):
    rows = random_ticks(seed, 60 + 20 * seed)
    df = spark.createDataFrame(rows, TICK_DDL).repartition(1 + seed % 4)
    order = "text" if seed % 2 == 0 else "clock"
    got = sorted(tuple(r) for r in daily_report(df, SourceColumns(time_order=order), cutoff="2021-04-16").collect())
    assert got == brute_force(rows, "2021-04-16")
