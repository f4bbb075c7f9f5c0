"""Daily metrics: orders (point in time), customers, products, and the long metric table.

Base tables have one row per calendar day.  Windows over days therefore see a few
thousand rows whatever the size of the facts, and run in one task on purpose.
Frames count rows, not dates: days without a row are skipped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.functions import labels as L
from orderloom.functions.columns import (AVERAGE, MONEY, RATE, count_if, date_key, dow0, mean_over, moment,
                                         padded_day_name, pct, ratio, rounded_mean_over, sum_if, weekend_label,
                                         year_month, zero)
from orderloom.operators.snapshot import daily_statistics

WEEK = (-6, 0)


def _slug(label: str) -> str:
    return label.lower().replace("-", "")


def _divide(total: str, count: str):
    n = F.col(count)
    return (F.col(total).cast(AVERAGE) / F.when(n > 0, n)).cast(AVERAGE)


def month_to_date(value: str):
    window = W.partitionBy("year_month").orderBy("metric_date").rowsBetween(W.unboundedPreceding, 0)
    return F.sum(value).over(window)


# --- orders -------------------------------------------------------------------------

def daily_order_base(state: DataFrame) -> DataFrame:
    """Calendar parts and ratios on top of ``daily_order_state``: what a day's row has without the rows around it."""
    day = F.col("day")
    return state.select(
        date_key(day).alias("date_key"), day.alias("order_date"), F.year(day).alias("year"),
        F.month(day).alias("month"), F.quarter(day).alias("quarter"), dow0(day).alias("day_of_week"),
        year_month(day).alias("year_month"), padded_day_name(day).alias("day_name"),
        weekend_label(day).alias("day_type"),
        "total_orders", "completed_orders", "pending_orders", "cancelled_orders", "refunded_orders",
        "items_added_orders", "total_revenue", "completed_revenue",
        zero(MONEY).alias("pending_revenue"), zero(MONEY).alias("cancelled_revenue"), "refunded_revenue",
        _divide("total_revenue", "paid_orders").alias("avg_order_value"),
        F.col("median_value").alias("median_order_value"), F.col("min_value").alias("min_order_value"),
        F.col("max_value").alias("max_order_value"),
        "unique_customers", "customers_with_completed_orders",
        "total_line_items", "total_quantity_sold", "total_unique_products_ordered",
        _divide("total_line_items", "total_orders").alias("avg_line_items_per_order"),
        _divide("total_quantity_sold", "total_orders").alias("avg_quantity_per_order"),
        "single_item_orders", "small_orders", "medium_orders", "large_orders",
        "all_unique_product_orders", "single_product_orders", "mixed_product_orders",
        "weekend_orders", "weekday_orders", "morning_orders", "afternoon_orders", "evening_orders", "night_orders",
        "daily_status_changes", "daily_completions", "daily_cancellations", "daily_items_added",
        pct("completed_orders", "total_orders").alias("completion_rate_pct"),
        pct("cancelled_orders", "total_orders").alias("cancellation_rate_pct"),
        pct("refunded_orders", "total_orders").alias("refund_rate_pct"),
        pct("items_added_orders", "total_orders").alias("items_added_rate_pct"),
        pct("refunded_revenue", "completed_revenue").alias("revenue_refund_rate_pct"),
        # customers per order, in spite of the name
        ratio("unique_customers", "total_orders").alias("orders_per_customer_ratio"),
        pct("weekend_orders", "total_orders").alias("weekend_order_pct"),
        pct("daily_status_changes", "total_orders").alias("daily_activity_rate_pct"),
        pct("daily_completions", "daily_status_changes").alias("completion_conversion_rate_pct"),
        pct("daily_cancellations", "daily_status_changes").alias("cancellation_conversion_rate_pct"))


def metric_daily_orders(base: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """7-row averages and changes on top of ``daily_order_base``."""
    by_day = W.orderBy("order_date")
    week = by_day.rowsBetween(*WEEK)
    averages = {"avg_7d_status_changes": "daily_status_changes", "avg_7d_activity_rate_pct": "daily_activity_rate_pct",
                **{f"avg_7d_{c}": c for c in ("total_orders", "completed_orders", "total_revenue",
                                              "completed_revenue", "completion_rate_pct", "cancellation_rate_pct")}}
    changes = {"total_orders_change_1d": "total_orders", "completed_orders_change_1d": "completed_orders",
               "total_revenue_change_1d": "total_revenue", "completion_rate_change_1d": "completion_rate_pct",
               "status_changes_change_1d": "daily_status_changes"}
    return base.withColumns({
        **{name: rounded_mean_over(c, week) for name, c in averages.items()},
        **{name: F.coalesce(F.col(c) - F.lag(c).over(by_day), F.lit(0)) for name, c in changes.items()},
        "metrics_updated_at": moment(loaded_at)})


# --- customers ----------------------------------------------------------------------

SEGMENT_COLUMNS = dict(zip(["premium_loyal_customers", "core_customers", "growing_customers", "new_customers"],
                           L.CUSTOMER_SEGMENTS))
REGION_SLUGS = {"na": "North America", "eu": "Europe", "apac": "Asia Pacific"}


def daily_customer_activity(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with orders, per order day.

    Orders are first summed per customer and day; counting customers is then a plain
    sum of flags instead of a dozen distinct counts.
    """
    status = F.col("order_status")
    per_customer = orders.where(F.col("customer_key").isNotNull()).groupBy(
        F.to_date("order_date").alias("metric_date"), "customer_key").agg(
        F.max((status == L.COMPLETED).cast("int")).alias("completed"),
        F.max((status == L.CANCELLED).cast("int")).alias("cancelled"),
        F.sum("order_amount").alias("amount"), F.count("order_amount").alias("amounts"),
        F.max("order_amount").alias("highest"), F.sum("total_line_items").alias("lines"),
        F.sum("total_quantity").alias("quantity"), F.count(F.lit(1)).alias("orders"))
    known = customers.select("customer_key", "customer_segment", "region")
    segment, region = F.col("customer_segment"), F.col("region")
    days = per_customer.join(known, "customer_key").groupBy("metric_date").agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.sum("completed").alias("customers_with_completed_orders"),
        F.sum("cancelled").alias("customers_with_cancelled_orders"),
        F.sum("amount").cast(MONEY).alias("total_customer_spend"), F.sum("amounts").alias("_amounts"),
        F.max("highest").alias("highest_customer_spend"),
        F.sum("lines").alias("_lines"), F.sum("quantity").alias("_quantity"),
        F.sum("orders").alias("total_orders_by_customers"),
        *[count_if(segment == label).alias(name) for name, label in SEGMENT_COLUMNS.items()],
        *[count_if(region == label).alias(f"{slug}_customers") for slug, label in REGION_SLUGS.items()],
        count_if(region == "Other").alias("other_region_customers"))
    return days.select(
        "metric_date", date_key("metric_date").alias("date_key"), F.year("metric_date").alias("metric_year"),
        F.month("metric_date").alias("metric_month"), year_month("metric_date").alias("year_month"),
        "active_customers", "customers_with_completed_orders", "customers_with_cancelled_orders",
        "total_customer_spend", _divide("total_customer_spend", "_amounts").alias("avg_spend_per_customer"),
        "highest_customer_spend",
        _divide("_lines", "total_orders_by_customers").alias("avg_items_per_customer"),
        _divide("_quantity", "total_orders_by_customers").alias("avg_quantity_per_customer"),
        "total_orders_by_customers", *SEGMENT_COLUMNS, *[f"{s}_customers" for s in REGION_SLUGS],
        "other_region_customers")


def daily_customer_acquisition(customers: DataFrame) -> DataFrame:
    region, signup = F.col("region"), F.col("signup_date")
    weekend = dow0(signup).isin(0, 6)
    return customers.groupBy(signup.alias("metric_date")).agg(
        F.count(F.lit(1)).alias("new_customers_acquired"),
        *[count_if(region == label).alias(f"new_{slug}_customers") for slug, label in REGION_SLUGS.items()],
        count_if(region == "Other").alias("new_other_customers"),
        count_if(weekend).alias("weekend_signups"), count_if(~weekend).alias("weekday_signups"),
    ).withColumn("date_key", date_key("metric_date"))


def daily_customer_base(activity: DataFrame, acquisition: DataFrame) -> DataFrame:
    """Full outer join of activity and acquisition on the day; missing measures are 0."""
    calendar = ["metric_date", "date_key", "metric_year", "metric_month", "year_month"]
    left = activity.drop(*[c for c in calendar if c != "metric_date"])
    right = acquisition.drop("date_key")
    measures = [f for f in left.schema.fields + right.schema.fields if f.name != "metric_date"]
    joined = left.join(right, "metric_date", "full").where(F.col("metric_date").isNotNull())
    return joined.select(
        "metric_date", date_key("metric_date").alias("date_key"), F.year("metric_date").alias("metric_year"),
        F.month("metric_date").alias("metric_month"), year_month("metric_date").alias("year_month"),
        *[F.coalesce(f.name, F.lit(0).cast(f.dataType)).alias(f.name) for f in measures])


def metric_daily_customers(base: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    by_day = W.orderBy("metric_date")
    week = by_day.rowsBetween(*WEEK)
    return base.withColumns({
        "completion_rate_by_customers_pct": pct("customers_with_completed_orders", "active_customers"),
        "avg_orders_per_active_customer": ratio("total_orders_by_customers", "active_customers"),
        "weekend_signup_pct": pct("weekend_signups", "new_customers_acquired"),
        "mtd_new_customers": month_to_date("new_customers_acquired"),
        "mtd_total_active_customers": month_to_date("active_customers"),
        "avg_active_customers_7d": mean_over("active_customers", week),
        "avg_new_customers_7d": mean_over("new_customers_acquired", week),
        "avg_customer_spend_7d": mean_over("total_customer_spend", week),
        "prev_day_active_customers": F.lag("active_customers").over(by_day),
        "prev_day_new_customers": F.lag("new_customers_acquired").over(by_day),
        "metrics_updated_at": moment(loaded_at)})


# --- products -----------------------------------------------------------------------

def daily_product_base(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Product sales per order day, before ratios and windows.

    Lines are summed per product and day first: the product join and the distinct
    product counts then work on that much smaller frame.
    """
    status, line = F.col("order_status"), F.col("line_total")
    day = F.to_date("order_date")
    sold = lines.groupBy(day.alias("metric_date"), "product_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"), F.sum(line).alias("revenue"),
        sum_if(status == L.COMPLETED, line).alias("completed"), sum_if(status == L.REFUNDED, line).alias("refunded"),
        F.sum("unit_price").alias("prices"), F.min("unit_price").alias("low"), F.max("unit_price").alias("high"),
        *[count_if(F.col("quantity_category") == q).alias(f"q{i}") for i, q in enumerate(L.QUANTITY_CATEGORIES)],
        *[count_if(F.col("line_importance") == v).alias(f"i{i}") for i, v in enumerate(L.LINE_IMPORTANCES)])
    known = products.select("product_key", "category_group", "price_tier")
    group, tier = F.col("category_group"), F.col("price_tier")

    def money(expr, name):
        return expr.cast(MONEY).alias(name)

    def revenue_of(condition, name):
        return money(F.coalesce(F.sum(F.when(condition, F.col("revenue"))), zero(MONEY)), name)

    days = sold.join(known, "product_key").groupBy("metric_date").agg(
        F.count(F.lit(1)).alias("unique_products_sold"), F.sum("lines").alias("total_line_items"),
        F.sum("quantity").alias("total_quantity_sold"), money(F.sum("revenue"), "total_product_revenue"),
        money(F.sum("completed"), "completed_product_revenue"), money(F.sum("refunded"), "refunded_product_revenue"),
        money(F.sum("prices"), "_prices"), F.min("low").alias("min_unit_price"), F.max("high").alias("max_unit_price"),
        *[count_if(group == g).alias(f"{_slug(g)}_products_sold") for g in L.CATEGORY_GROUPS],
        *[revenue_of(group == g, f"{_slug(g)}_revenue") for g in L.CATEGORY_GROUPS],
        *[F.coalesce(F.sum(F.when(tier == t, F.col("lines"))), F.lit(0)).alias(f"{_slug(t)}_items_sold")
          for t in L.PRICE_TIERS],
        *[revenue_of(tier == t, f"{_slug(t)}_revenue") for t in L.PRICE_TIERS],
        *[F.sum(f"q{i}").alias(n) for i, n in enumerate(["single_item_lines", "pair_lines", "multiple_item_lines"])],
        *[F.sum(f"i{i}").alias(n)
          for i, n in enumerate(["single_line_orders", "dominant_lines", "major_lines", "minor_lines"])])
    prices = daily_statistics(lines.withColumn("_day", day), "_day", "unit_price")
    medians = prices.select(F.col("day").alias("metric_date"), F.col("median_value").alias("median_unit_price"))
    averages = {"avg_unit_price": _divide("_prices", "total_line_items"),
                "avg_line_total": _divide("total_product_revenue", "total_line_items")}
    return days.withColumns(averages).drop("_prices").join(medians, "metric_date", "left").select(
        "metric_date", date_key("metric_date").alias("date_key"), F.year("metric_date").alias("metric_year"),
        F.month("metric_date").alias("metric_month"), year_month("metric_date").alias("year_month"),
        *[c for c in days.columns if c not in ("metric_date", "_prices")], *averages, "median_unit_price")


def metric_daily_products(base: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    by_day = W.orderBy("metric_date")
    week = by_day.rowsBetween(*WEEK)
    revenue, items = "total_product_revenue", "total_line_items"
    return base.withColumns({
        "product_variety_pct": pct("unique_products_sold", items),
        "revenue_completion_rate_pct": pct("completed_product_revenue", revenue),
        "revenue_refund_rate_pct": pct("refunded_product_revenue", "completed_product_revenue"),
        "avg_quantity_per_line": ratio("total_quantity_sold", items),
        **{f"{g}_revenue_pct": pct(f"{g}_revenue", revenue) for g in ("clothing", "accessories", "footwear")},
        "premium_luxury_items_pct": pct(F.col("premium_items_sold") + F.col("luxury_items_sold"), items),
        "premium_luxury_revenue_pct": pct(F.col("premium_revenue") + F.col("luxury_revenue"), revenue),
        "mtd_product_revenue": month_to_date(revenue).cast(MONEY),
        "mtd_quantity_sold": month_to_date("total_quantity_sold"),
        "avg_product_revenue_7d": mean_over(revenue, week),
        "avg_unique_products_7d": mean_over("unique_products_sold", week),
        "avg_quantity_sold_7d": mean_over("total_quantity_sold", week),
        "prev_day_revenue": F.lag(revenue).over(by_day),
        "prev_day_unique_products": F.lag("unique_products_sold").over(by_day),
        "prev_day_quantity": F.lag("total_quantity_sold").over(by_day),
        # "week over week" looks seven rows back, not seven days
        "wow_revenue": F.lag(revenue, 7).over(by_day),
        "wow_unique_products": F.lag("unique_products_sold", 7).over(by_day),
        "metrics_updated_at": moment(loaded_at)})


# --- long table ---------------------------------------------------------------------

def daily_metrics(orders: DataFrame, products: DataFrame, customers: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """One row per day and metric; null values are left out."""
    catalogue = L.metric_catalogue()
    frames = {"orders": orders.withColumnRenamed("order_date", "metric_date"),
              "products": products, "customers": customers}
    tall = None
    for domain, frame in frames.items():
        names = [metric for d, metric, _, _ in catalogue if d == domain]
        values = frame.select("date_key", "metric_date", "year_month",
                              *[F.col(n).cast(AVERAGE).alias(n) for n in names])
        one = (values.unpivot(["date_key", "metric_date", "year_month"], names, "metric_name", "metric_value")
               .withColumn("metric_domain", F.lit(domain)))
        tall = one if tall is None else tall.unionByName(one)
    # fixed list of 50 metrics
    kinds = F.broadcast(orders.sparkSession.createDataFrame(
        catalogue, "metric_domain string, metric_name string, dimension_type string, dimension_value string"))
    return tall.where(F.col("metric_value").isNotNull()).join(kinds, ["metric_domain", "metric_name"]).select(
        "date_key", "metric_date", F.year("metric_date").alias("year"), F.month("metric_date").alias("month"),
        F.quarter("metric_date").alias("quarter"), "year_month", "metric_domain", "metric_name", "metric_value",
        "dimension_type", "dimension_value", moment(loaded_at).alias("created_at"))
