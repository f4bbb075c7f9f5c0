from decimal import Decimal

from tests.conftest import by
from pyspark.sql import functions as F

from orderloom.operators import lifecycle


def test_orders(warehouse):
    rows = by(warehouse.fact_orders, "order_id")
    assert sorted(rows) == ["A", "B", "C", "D", "E", "G"]  # F has no customer id
    assert rows["A"]["order_status"] == "refunded" and rows["D"]["order_status"] == "cancelled"
    empty = rows["B"]
    assert (empty["total_line_items"], empty["calculated_total_amount"], empty["avg_unit_price"]) == (0, 0, None)
    assert (empty["order_size_category"], empty["product_variety"]) == ("Small Order", "All Unique")
    assert empty["avg_amount_per_line"] == 0
    assert rows["E"]["customer_key"] is None
    assert (rows["A"]["order_timing"], rows["A"]["order_time_of_day"]) == ("Weekday", "Morning")
    assert (rows["B"]["order_timing"], rows["B"]["order_time_of_day"]) == ("Weekend", "Night")
    assert rows["A"]["avg_amount_per_line"] == Decimal("99.995")
    assert rows["A"]["order_date_key"] == 20240110


def test_lines(warehouse):
    rows = by(warehouse.fact_order_line, "order_line_id")
    assert sorted(rows) == [1, 2, 3, 4, 6]  # unknown customer (5) and unknown product (7) drop out
    assert rows[3]["line_importance"] == "Single Line Order"
    assert rows[2]["line_importance"] == "Dominant Line" and rows[1]["line_importance"] == "Minor Line"
    free = rows[6]
    assert free["line_percentage_of_order"] == 0 and free["line_importance"] == "Minor Line"
    assert free["additional_quantity_value"] == Decimal("100.00") and free["quantity_category_detailed"] == "Small Batch"
    assert (rows[1]["refunded_amount"], rows[1]["recognized_revenue"]) == (Decimal("49.99"), 0)
    shares = warehouse.fact_order_line.where("order_id = 'A'").agg(F.sum("line_percentage_of_order")).first()[0]
    assert abs(shares - 100) < Decimal("0.000001")


def test_history(warehouse):
    rows = by(warehouse.fact_orders_scd2, "order_id", "status_change_sequence")
    first, second, third = (rows["A", n] for n in (1, 2, 3))
    assert first["status_end_date"] == second["status_effective_date"]
    assert second["status_end_date"] == third["status_effective_date"] and third["status_end_date"] is None
    assert first["status_duration_hours"] == 48 and third["status_duration_hours"] is None
    assert [r["status_lifecycle_stage"] for r in (first, second, third)] == ["Initial", "Historical", "Current"]
    assert second["hours_to_completion"] == 48 and first["hours_to_completion"] is None
    assert rows["B", 1]["status_lifecycle_stage"] == "Initial" and rows["B", 1]["is_current_status"]
    assert rows["D", 2]["hours_to_cancellation"] == 0
    # completed in its only row: no waiting time
    assert rows["G", 1]["hours_to_completion"] is None
    assert second["status_change_timing"] == "Weekday" and third["status_change_timing"] == "Weekend"


def test_history_invariants(warehouse):
    history = warehouse.fact_orders_scd2
    current = history.where("is_current_status").groupBy("order_id").count()
    assert current.where("count != 1").count() == 0
    assert history.where(F.col("status_end_date").isNull() != F.col("is_current_status")).count() == 0
    assert history.select("order_key").distinct().count() == history.count()


def test_lifecycle_reports(warehouse):
    history = warehouse.fact_orders_scd2
    journeys = by(lifecycle.status_journey(history, "pending", "refunded"), "order_id")
    assert journeys == {"A": {"order_id": "A", "total_status_changes": 3,
                              "status_journey": "pending → completed → refunded"}}
    assert lifecycle.status_journey(history).count() == 0
    assert by(lifecycle.completion_by_size(history), "order_size_category")["Small Order"]["avg_hours_to_completion"] == 27
    speeds = by(lifecycle.completion_speed(history), "completion_speed")
    assert {k: v["order_count"] for k, v in speeds.items()} == {"Fast (≤24h)": 1, "Medium (24-72h)": 1}
    dwell = by(lifecycle.status_dwell(history), "order_status")
    assert dwell["pending"]["total_status_instances"] == 3 and dwell["completed"]["avg_duration_hours"] == 192
    assert lifecycle.order_history(history, "A").count() == 3
    assert lifecycle.current_snapshot(history).count() == 6
