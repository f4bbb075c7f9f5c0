import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import labels as L
from orderloom.operators import metrics, snapshot
from tests.conftest import CALENDAR, by


def point_in_time(history, start, end):
    """One row per order and visible day."""
    days = F.sequence("from_day", F.date_sub("to_day", 1))
    return (snapshot.status_intervals(history, start, end)
            .select("*", F.explode(days).alias("metric_date"))
            .withColumn("enters", F.col("enters") & (F.col("metric_date") == F.col("from_day")))
            .drop("from_day", "to_day"))


def naive_state(history, start, end):
    """The snapshot in its plain form: one row per order and day, distinct counts, exact percentile."""
    rows = point_in_time(history, start, end)

    def orders(test):
        return F.count_distinct(F.when(test, F.col("order_id")))

    status = F.col("order_status")
    paid = F.when(status.isin("completed", "refunded"), F.col("order_amount"))
    return rows.groupBy(F.col("metric_date").alias("day")).agg(
        F.count_distinct("order_id").alias("total_orders"), orders(status == "completed").alias("completed_orders"),
        orders(status == "pending").alias("pending_orders"),
        F.sum(F.coalesce(paid, F.lit(0))).cast("decimal(20,2)").alias("total_revenue"),
        F.round(F.percentile(paid, 0.5), 3).alias("median"), F.min(paid).alias("low"), F.max(paid).alias("high"),
        F.count_distinct("customer_key").alias("unique_customers"),
        F.count_distinct(F.when(status == "completed", F.col("customer_key"))).alias("done_customers"),
        F.sum("total_line_items").alias("lines"), orders(F.col("order_timing") == "Weekend").alias("weekend_orders"),
        orders(F.col("enters")).alias("daily_status_changes"),
        orders(F.col("enters") & (status == "completed")).alias("daily_completions"))


def comparable_state(state):
    return state.select(
        "day", "total_orders", "completed_orders", "pending_orders", "total_revenue",
        F.round(F.col("median_value").cast("double"), 3).alias("median"), F.col("min_value").cast("decimal(10,2)").alias("low"),
        F.col("max_value").cast("decimal(10,2)").alias("high"), "unique_customers",
        F.col("customers_with_completed_orders").alias("done_customers"), F.col("total_line_items").alias("lines"),
        "weekend_orders", "daily_status_changes", "daily_completions")


@pytest.fixture(scope="module")
def random_history(spark):
    """Histories with gaps, same-day changes, open ends, unknown customers and repeated amounts."""
    draw, rows = random.Random(5), []
    for order in range(120):
        moment = dt.datetime(2023, 12, 20) + dt.timedelta(hours=draw.randrange(24 * 120))
        customer = None if order % 11 == 0 else f"c{draw.randrange(9) if order % 3 else 0}"
        amount = Decimal(draw.choice([0, 5, 5, 9999999, 12345, draw.randrange(200000)])) / 100
        steps = draw.choice([["pending"], ["pending", "completed"], ["pending", "completed", "refunded"],
                             ["pending", "cancelled"]])
        times = [moment]
        for _ in steps[1:]:
            times.append(times[-1] + dt.timedelta(hours=draw.choice([1, 5, 30, 500])))
        for i, status in enumerate(steps):
            rows.append((f"o{order}", customer, status, amount, order % 4, order % 7, order % 3, "Small Order",
                         draw.choice(L.VARIETIES), draw.choice(L.TIMINGS), "Night", times[i],
                         times[i + 1] if i + 1 < len(times) else None))
    return spark.createDataFrame(rows, """order_id string, customer_key string, order_status string,
        order_amount decimal(10,2), total_line_items bigint, total_quantity bigint, unique_products_count bigint,
        order_size_category string, product_variety string, order_timing string, order_time_of_day string,
        status_effective_date timestamp_ntz, status_end_date timestamp_ntz""")


@pytest.mark.parametrize("bits", [2, 9])
def test_sweep_equals_exploded_form(random_history, monkeypatch, bits):
    monkeypatch.setattr(snapshot, "STEP_BITS", bits)
    monkeypatch.setattr(snapshot, "RUNG_BITS", bits)
    got = comparable_state(snapshot.daily_order_state(random_history, *CALENDAR))
    want = naive_state(random_history, *CALENDAR).withColumn("low", F.col("low").cast("decimal(10,2)"))
    assert got.count() == want.count() == 91
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_value_ladder_counts_every_level_from_one_scan(spark, monkeypatch):
    """Each rung equals a count of its own, negative values included; the intervals are read by one plan only."""
    draw = random.Random(3)
    rows = [(draw.choice([-300, 0, 7, draw.randrange(-500, 5000)]), draw.randrange(4), draw.choice([1, -1])) for _ in range(400)]
    lowest, shifts = min(r[0] for r in rows), [(13, 8), (8, 3), (3, 0)]
    leaf = spark.createDataFrame(rows, "cents bigint, day int, step bigint")
    got = {(r.rung, r.bucket, r.child, r.day): r.step for r in snapshot.value_ladder(leaf, lowest, shifts).collect()}
    want = {}
    for rung, (parent, child) in enumerate(shifts):
        for cents, day, step in rows:
            at = (rung, cents - lowest >> parent, cents - lowest >> child, day)
            want[at] = want.get(at, 0) + step
    assert got == {at: step for at, step in want.items() if step}
    scans, write = [], snapshot.pinned
    monkeypatch.setattr(snapshot, "pinned", lambda df, **by: scans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, **by))
    intervals = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 3), Decimal("1.50")),
                                       (dt.date(2024, 1, 2), dt.date(2024, 1, 9), Decimal("4.00"))],
                                      "from_day date, to_day date, order_amount decimal(10,2)")
    sizes = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "day date, n bigint")
    days = by(snapshot.interval_statistics(intervals, sizes, dt.date(2024, 2, 1)), "day")
    assert [days[d]["median_value"] for d in sorted(days)] == [Decimal("1.5"), Decimal("2.75")]
    assert sum("order_amount" in plan for plan in scans) == 1


def test_status_population_equals_exploded_form(random_history):
    got = snapshot.daily_status_population(random_history, *CALENDAR)
    want = point_in_time(random_history, *CALENDAR).groupBy("metric_date", "order_status").agg(
        F.count("*").alias("orders"), F.sum("order_amount").cast("decimal(20,2)").alias("amount"))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_daily_statistics(spark):
    rows = spark.createDataFrame(
        [(1, Decimal(v)) for v in ("5.00", "1.00", "7.00", "7.00")] + [(2, Decimal("3.33"))] * 3 + [(3, None)],
        "d int, v decimal(10,2)")
    got = by(snapshot.daily_statistics(rows, "d", "v"), "day")
    assert sorted(got) == [1, 2]
    assert (got[1]["median_value"], got[1]["min_value"], got[1]["max_value"]) == (6, 1, 7)
    assert got[2]["median_value"] == Decimal("3.33")


def test_daily_orders(warehouse):
    rows = by(warehouse.metric_daily_orders, "order_date")
    assert dt.date(2024, 1, 9) not in rows and max(rows) == dt.date(2024, 3, 31)
    day = rows[dt.date(2024, 2, 29)]
    # C was pending and completed on this day: only the completed state shows
    assert (day["total_orders"], day["completed_orders"], day["pending_orders"]) == (3, 1, 1)
    assert day["daily_status_changes"] == 1 and day["daily_completions"] == 1
    assert day["completion_rate_pct"] == Decimal("33.33") and day["items_added_orders"] == 0
    assert rows[dt.date(2024, 1, 11)]["total_orders"] == 1 and rows[dt.date(2024, 1, 12)]["completed_orders"] == 1
    assert rows[dt.date(2024, 1, 10)]["avg_order_value"] is None
    assert rows[dt.date(2024, 1, 12)]["median_order_value"] == Decimal("199.99")
    assert rows[dt.date(2024, 1, 10)]["total_orders_change_1d"] == 0
    assert rows[dt.date(2024, 1, 13)]["total_orders_change_1d"] == 1
    # the same cancelled and pending time: the second never shows, the cancelled one does
    assert rows[dt.date(2024, 3, 2)]["cancelled_orders"] == 1
    assert day["day_name"] == "Thursday "


def test_transitions_add_up_to_visible_history(warehouse):
    changes = warehouse.metric_daily_orders.agg(F.sum("daily_status_changes")).first()[0]
    intervals = snapshot.status_intervals(warehouse.fact_orders_scd2, *CALENDAR)
    assert changes == intervals.where("enters").count()


def test_daily_customers(warehouse):
    rows = by(warehouse.metric_daily_customers, "metric_date")
    # a signup without orders and orders without a signup are both there
    assert (rows[dt.date(2024, 1, 15)]["new_customers_acquired"], rows[dt.date(2024, 1, 15)]["active_customers"]) == (1, 0)
    assert (rows[dt.date(2024, 1, 10)]["new_customers_acquired"], rows[dt.date(2024, 1, 10)]["active_customers"]) == (0, 1)
    assert rows[dt.date(2021, 1, 3)]["weekend_signup_pct"] == 100
    assert dt.date(2024, 3, 5) not in rows  # the only order of that day has an unknown customer
    january = rows[dt.date(2024, 1, 15)]
    assert january["mtd_total_active_customers"] == 2 and january["prev_day_active_customers"] == 1
    assert january["avg_active_customers_7d"] == Decimal("0.5")  # four rows so far, gaps are skipped


def test_daily_products(warehouse):
    rows = by(warehouse.metric_daily_products, "metric_date")
    day = rows[dt.date(2024, 1, 10)]
    assert (day["total_line_items"], day["unique_products_sold"]) == (2, 2)
    assert day["median_unit_price"] == Decimal("99.995") and day["refunded_product_revenue"] == Decimal("199.99")
    assert (day["clothing_products_sold"], day["accessories_revenue"]) == (1, Decimal("150.00"))
    assert day["premium_luxury_items_pct"] == 50
    assert rows[dt.date(2024, 2, 29)]["prev_day_revenue"] == Decimal("199.99")


def test_long_table(warehouse):
    tall = warehouse.daily_metrics
    wide = warehouse.metric_daily_orders
    assert tall.where("metric_value is null").count() == 0
    one = tall.where("metric_name = 'completion_rate_pct' and metric_date = date'2024-02-29'").collect()
    assert len(one) == 1 and one[0].metric_value == Decimal("33.33") and one[0].dimension_type == "rate_type"
    # avg_order_value is missing on days without paid orders
    assert tall.where("metric_name = 'avg_order_value'").count() == wide.where("avg_order_value is not null").count()
    keys = ["date_key", "metric_name", "dimension_type", "dimension_value"]
    assert tall.groupBy(*keys).count().where("count > 1").count() == 0


def test_month_to_date_restarts(spark):
    base = spark.createDataFrame([(dt.date(2024, 1, 31), "2024-01", 5), (dt.date(2024, 2, 1), "2024-02", 2),
                                  (dt.date(2024, 2, 9), "2024-02", 3)], "metric_date date, year_month string, v int")
    got = [r[0] for r in base.select(metrics.month_to_date("v")).collect()]
    assert sorted(got) == [2, 5, 5]
