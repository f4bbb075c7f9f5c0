import datetime as dt
import random

from tests.conftest import AS_OF, by
from pyspark.sql import functions as F

from orderloom.operators.dimensions import dim_date


def test_customers(warehouse):
    rows = by(warehouse.stg_customers, "id")
    assert [rows[i]["region"] for i in (1, 2, 3)] == ["north america", "europe", "other"]
    assert [rows[i]["signup_day_of_week"] for i in (1, 2, 3)] == [0, 1, 2]
    assert rows[3]["customer_tenure_days"] == 40


def test_order_sequence_and_ties(warehouse):
    rows = by(warehouse.stg_orders, "record_id")
    assert [rows[i]["status_sequence"] for i in (1, 2, 3)] == [1, 2, 3]
    assert [rows[i]["is_current_status"] for i in (1, 2, 3)] == [False, False, True]
    assert rows[7]["status_sequence"] == 1 and rows[8]["is_current_status"]
    per_order = warehouse.stg_orders.where("is_current_status").groupBy("order_id").count()
    assert per_order.where("count != 1").count() == 0 and per_order.count() == 7


def test_items(warehouse):
    rows = by(warehouse.stg_order_items, "id")
    assert [rows[i]["item_sequence"] for i in (1, 2)] == [1, 2]
    assert [rows[i]["price_tier"] for i in (1, 2, 3, 5, 6)] == ["Budget", "Premium", "Luxury", "Premium", "Mid-Range"]
    assert rows[6]["quantity_category"] == "Multiple Items"
    assert [rows[i]["line_value_tier"] for i in (1, 2, 3)] == ["Low Value Line", "Medium Value Line",
                                                               "Premium Value Line"]


def test_products(warehouse):
    rows = by(warehouse.stg_products, "id")
    first = rows[1]
    assert (first["seasonality"], first["collection_type"]) == ("Spring/Summer", "Premium")
    assert first["is_premium_line"] and first["is_classic_line"] and not first["is_limited_edition"]
    assert (rows[2]["seasonality"], rows[2]["collection_type"]) == ("Fall/Winter", "Limited Edition")
    assert (rows[3]["category_group"], rows[3]["category_sort_order"]) == ("Other", 6)
    assert (rows[3]["seasonality"], rows[3]["detailed_price_tier"]) == ("Year-Round", "Ultra-Premium")


def test_customer_dimension(warehouse):
    rows = by(warehouse.dim_customer, "customer_id")
    # only a Monday signup counts as weekend
    assert [rows[i]["signup_timing"] for i in (1, 2, 3)] == ["Weekday", "Weekend", "Weekday"]
    assert [rows[i]["customer_segment"] for i in (1, 2, 3)] == ["Premium Loyal", "New Customer", "New Customer"]
    assert [rows[i]["region_code"] for i in (1, 2, 3)] == ["NA", "EU", "Other"]
    assert [rows[i]["churn_risk_segment"] for i in (1, 2, 3)] == ["Low Risk", "Medium Risk", "Medium Risk"]


def test_product_bands(warehouse):
    rows = by(warehouse.dim_product, "product_id")
    assert [rows[i]["price_decile"] for i in (1, 2, 4, 3)] == [1, 2, 3, 4]
    assert [rows[i]["price_quartile"] for i in (1, 2, 4, 3)] == [1, 2, 3, 4]
    assert rows[3]["overall_price_position"] == "Top 25%"
    assert all(r["price_rank_in_category"] == 1 and r["category_position"] == "Category Budget" for r in rows.values())


def test_calendar(spark):
    rows = by(dim_date(spark, AS_OF, dt.date(2020, 12, 25), dt.date(2025, 1, 1)), "calendar_date")
    leap = rows[dt.date(2024, 2, 29)]
    assert leap["is_last_day_of_month"] and leap["year_quarter"] == "2024-11" and leap["month_name"] == "February "
    assert leap["day_name"] == "Thursday " and leap["day_short_name"] == "Thu" and leap["month_short_name"] == "Feb"
    quarter = rows[dt.date(2024, 3, 31)]
    assert quarter["is_last_day_of_quarter"] and quarter["relative_period"] == "Today" and quarter["is_weekend"]
    year = rows[dt.date(2024, 12, 31)]
    assert year["is_last_day_of_year"] and year["is_last_day_of_quarter"] and year["day_of_year"] == 366
    new_year = rows[dt.date(2021, 1, 1)]
    assert new_year["week_of_year"] == 53 and new_year["is_first_day_of_year"] and new_year["is_first_day_of_quarter"]
    periods = {d: rows[d]["relative_period"] for d in rows}
    assert [periods[AS_OF - dt.timedelta(days=n)] for n in (1, 2, 7, 8, 30)] == [
        "Yesterday", "Last 7 Days", "Last 7 Days", "Last 30 Days", "Last 30 Days"]
    assert periods[dt.date(2024, 2, 10)] == "Last Month" and periods[dt.date(2024, 1, 10)] == "This Year"
    assert periods[dt.date(2023, 5, 1)] == "Last Year" and periods[dt.date(2022, 5, 1)] == "Other"


def test_default_calendar_size(spark):
    days = dim_date(spark, AS_OF)
    assert days.count() == 2921 and days.agg(F.max("calendar_date")).first()[0] == dt.date(2027, 12, 30)
