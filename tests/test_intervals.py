import datetime as dt
import random
from decimal import Decimal

import pytest

from orderloom.operators.intervals import interval_join


def brute(points, intervals):
    return sorted((p[0], i[0]) for p in points for i in intervals
                  if p[1] == i[1] and None not in (p[2], i[2]) and i[2] <= p[2] and (i[3] is None or p[2] < i[3]))


@pytest.mark.parametrize("kind, value", [
    ("timestamp_ntz", lambda n: dt.datetime(1970, 1, 1) + dt.timedelta(seconds=n * 977)),
    ("date", lambda n: dt.date(1970, 1, 1) + dt.timedelta(days=n)),
    ("decimal(12,2)", lambda n: Decimal(n) / 4), ("bigint", lambda n: n * n * (1 if n > 0 else -1)), ("double", lambda n: n / 3)])
def test_pairs_equal_brute_force(spark, kind, value):
    """Widths from nothing to everything, open and empty intervals, borders on points, negative values, nulls and repeats."""
    rng = random.Random(kind)
    points = [(i, rng.randrange(2), value(rng.randint(-400, 400))) for i in range(120)] + [(500, 0, None), (501, 1, value(0)), (502, 1, value(0))]
    intervals = []
    for i in range(90):
        low = rng.randint(-400, 400)
        high = low + rng.choice([0, 1, 2, 7, 30, 200, 900])
        intervals.append((i, rng.randrange(2), value(low), rng.choice([None, value(high), value(high), value(high)])))
    intervals += [(600, 0, None, value(5)), (601, 0, value(9), value(3)), intervals[0]]
    p = spark.createDataFrame(points, f"p int, k int, at {kind}")
    i = spark.createDataFrame(intervals, f"i int, k int, low {kind}, high {kind}")
    got = interval_join(p, i, "at", "low", "high", ["k"])
    assert got.columns == ["p", "k", "at", "i", "low", "high"]
    assert sorted((r.p, r.i) for r in got.collect()) == brute(points, intervals)
    assert interval_join(p.limit(0), i, "at", "low", "high", ["k"]).count() == interval_join(p, i.limit(0), "at", "low", "high", ["k"]).count() == 0


def test_price_tiers_from_a_table(spark):
    """A lookup of ranges can be a table of any size: no chain of cases, no nested loop."""
    tiers = [(Decimal(n) * 10, Decimal(n + 1) * 10, f"tier {n}") for n in range(300)]
    prices = [(i, Decimal(i * 37 % 3100) + Decimal("0.50")) for i in range(500)]
    got = interval_join(spark.createDataFrame(prices, "id int, price decimal(10,2)"),
                        spark.createDataFrame(tiers, "low decimal(10,2), high decimal(10,2), label string"), "price", "low", "high")
    assert {r.id: r.label for r in got.collect()} == {i: f"tier {int(p // 10)}" for i, p in prices if p < 3000}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
