"""Facts: orders, order lines and the status history (type 2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.functions import labels as L
from orderloom.functions.columns import (AVERAGE, MONEY, by_rules, date_key, day_part, dow0, hours_between, is_true,
                                         ladder, mean, moment, surrogate_key, weekend_label, zero)
from orderloom.operators.ranking import sequence_rows


def latest_order_status(raw_orders: DataFrame) -> DataFrame:
    """Current row of each order.

    Filtering on row number 1 lets Spark keep one row per order in every map task
    before the exchange, so even an order with very many rows stays cheap.
    """
    newest = W.partitionBy("order_id").orderBy(F.desc_nulls_first("created_at"), F.desc_nulls_first("record_id"))
    return raw_orders.withColumn("_place", F.row_number().over(newest)).where("_place = 1").drop("_place")


def order_items_agg(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("total_line_items"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total").cast(MONEY).alias("calculated_total_amount"),
        mean("unit_price").alias("avg_unit_price"),
        F.min("unit_price").alias("min_unit_price"),
        F.max("unit_price").alias("max_unit_price"),
        F.count_distinct("product_id").alias("unique_products_count"))


def with_item_totals(orders: DataFrame, item_totals: DataFrame) -> DataFrame:
    """Left join on the order id; counts and sums of orders without items are 0, prices stay null."""
    def or_zero(name, kind="bigint"):
        return F.coalesce(name, F.lit(0).cast(kind)).alias(name)

    return orders.join(item_totals, "order_id", "left").select(
        *[orders[c] for c in orders.columns],
        or_zero("total_line_items"), or_zero("total_quantity"), or_zero("calculated_total_amount", MONEY),
        "avg_unit_price", "min_unit_price", "max_unit_price", or_zero("unique_products_count"))


def _light_key(members: DataFrame, member: str) -> list[Column]:
    """A member's key for rows on their way: keys are texts of 32 digits made from the id, so where that holds the id is enough."""
    made = members[f"{member}_key"].eqNullSafe(surrogate_key(f"{member}_id"))
    return [made.alias(f"_{member}_made"), F.when(~made, members[f"{member}_key"]).alias(f"_{member}_given")]


def _whole_key(member: str) -> Column:
    """The key again; null where the member is unknown."""
    return F.when(F.col(f"_{member}_made"), surrogate_key(f"{member}_id")).otherwise(F.col(f"_{member}_given")).alias(f"{member}_key")


def with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Look up the customer's light key (null if unknown); rows without a customer id are dropped first."""
    keys = customers.select(F.col("customer_id").alias("_customer"), *_light_key(customers, "customer"))
    return (orders.where(F.col("customer_id").isNotNull())
            .join(keys, F.col("customer_id") == F.col("_customer"), "left").drop("_customer"))


def _order_columns() -> dict:
    lines, placed = F.col("total_line_items"), F.col("order_date")
    distinct = F.col("unique_products_count")

    def per(whole: str):
        count = F.col(whole)
        share = (F.col("total_amount").cast(AVERAGE) / F.when(count > 0, count)).cast(AVERAGE)
        return F.when(count > 0, share).otherwise(zero(AVERAGE))

    return {
        "order_amount": F.col("total_amount"),
        "order_status": F.col("status"),
        "order_date_key": date_key(placed),
        "order_size_category": by_rules(L.ORDER_SIZE_RULES, "Large Order"),
        "product_variety": (F.when(distinct == lines, "All Unique").when(distinct == 1, "Single Product")
                            .otherwise("Mixed Products")),
        **{f"is_{status}": is_true(F.col("status") == status) for status in L.SOURCE_STATUSES},
        "order_year": F.year(placed), "order_month": F.month(placed), "order_quarter": F.quarter(placed),
        "order_day_of_week": dow0(placed), "order_hour": F.hour(placed),
        "order_timing": weekend_label(placed), "order_time_of_day": day_part(F.hour(placed)),
        "avg_amount_per_line": per("total_line_items"), "avg_amount_per_item": per("total_quantity"),
    }


_MEASURES = ["order_amount", "calculated_total_amount", "total_line_items", "total_quantity",
             "unique_products_count", "avg_unit_price", "min_unit_price", "max_unit_price"]
_FLAGS = [f"is_{status}" for status in L.SOURCE_STATUSES]
_ORDER_TIME = ["order_year", "order_month", "order_quarter", "order_day_of_week", "order_hour",
               "order_timing", "order_time_of_day"]
_PER_UNIT = ["avg_amount_per_line", "avg_amount_per_item"]


def _stamps(loaded_at: dt.datetime):
    stamp = moment(loaded_at)
    return [stamp.alias("fact_created_at"), stamp.alias("fact_updated_at")]


Step = Callable[[DataFrame], DataFrame]


def _as_they_are(rows: DataFrame) -> DataFrame:
    return rows


def fact_orders(raw_orders: DataFrame, item_totals: DataFrame, customers: DataFrame,
                loaded_at: dt.datetime, deal: Step = _as_they_are) -> DataFrame:
    """One row per order.  The order-id exchange of the latest-status step also serves the item join.

    ``deal`` may spread the rows in another way, for those who store them: it sees them before the many columns that follow from others.
    """
    rows = deal(with_customer(with_item_totals(latest_order_status(raw_orders), item_totals), customers))
    return rows.withColumns(_order_columns()).select(
        surrogate_key("order_id").alias("order_key"), "order_id", _whole_key("customer"), "order_date_key",
        *_MEASURES, "order_size_category", "product_variety", "order_status", "order_date",
        F.col("created_at").alias("status_updated_at"), *_FLAGS, *_ORDER_TIME, *_PER_UNIT, *_stamps(loaded_at))


def fact_orders_scd2(raw_orders: DataFrame, item_totals: DataFrame, customers: DataFrame, loaded_at: dt.datetime,
                     deal: Step = _as_they_are) -> DataFrame:
    """One row per status change with its validity interval ``[effective, end)``; ``deal`` as for the orders."""
    history = sequence_rows(raw_orders, "order_id", ["created_at", "record_id"], "status_change_sequence",
                            upcoming=("created_at", "status_end_date"), last_flag="is_current_status")
    rows = deal(with_customer(with_item_totals(history, item_totals), customers))
    start, sequence, status = F.col("created_at"), F.col("status_change_sequence"), F.col("status")

    def hours_until(wanted: str):
        return F.when((status == wanted) & (sequence > 1), hours_between("order_date", start))

    return rows.withColumns(_order_columns()).select(
        surrogate_key("order_id", "status_change_sequence").alias("order_key"), "order_id",
        "status_change_sequence", _whole_key("customer"), "order_date_key",
        date_key(start).alias("status_effective_date_key"), "order_status",
        start.alias("status_effective_date"), "status_end_date", "is_current_status",
        hours_between(start, "status_end_date").alias("status_duration_hours"),
        *_MEASURES, "order_size_category", "product_variety", "order_date", *_FLAGS,
        is_true(status == L.ITEMS_ADDED).alias("is_items_added"), *_ORDER_TIME,
        F.year(start).alias("status_change_year"), F.month(start).alias("status_change_month"),
        F.hour(start).alias("status_change_hour"), weekend_label(start).alias("status_change_timing"),
        *_PER_UNIT,
        F.when(sequence == 1, "Initial").when(F.col("is_current_status"), "Current").otherwise("Historical")
        .alias("status_lifecycle_stage"),
        hours_until(L.COMPLETED).alias("hours_to_completion"),
        hours_until(L.CANCELLED).alias("hours_to_cancellation"), *_stamps(loaded_at))


def fact_order_line(items: DataFrame, raw_orders: DataFrame, customers: DataFrame, products: DataFrame,
                    loaded_at: dt.datetime, priced: Step = _as_they_are, deal: Step = _as_they_are) -> DataFrame:
    """One row per item of an order whose customer and product are known.

    The customer key is joined at order grain, before the much larger item rows.  ``priced`` adds the row-local columns of items
    that come without them; that happens after the joins, which then carry narrow rows.  ``deal`` as for the orders.
    """
    buyers = customers.select("customer_id", *_light_key(customers, "customer"))
    orders = (latest_order_status(raw_orders).join(buyers, "customer_id")
              .select("order_id", "customer_id", "_customer_made", "_customer_given", "order_date",
                      F.col("status").alias("order_status"), F.col("total_amount").alias("order_total_amount")))
    goods = products.select("product_id", *_light_key(products, "product"))
    rows = priced(deal(items.join(orders, "order_id").join(goods, "product_id")))

    quantity, price = F.col("quantity"), F.col("unit_price")
    line, whole, placed = F.col("line_total"), F.col("order_total_amount"), F.col("order_date")
    status = F.col("order_status")
    share = (line.cast(AVERAGE) * 100 / F.when(whole > 0, whole)).cast(AVERAGE)

    def when_status(*wanted: str):
        return F.when(status.isin(*wanted), line).otherwise(zero(MONEY))

    return rows.select(
        surrogate_key("id").alias("order_line_key"), F.col("id").alias("order_line_id"),
        surrogate_key("order_id").alias("order_key"), _whole_key("customer"), _whole_key("product"),
        date_key(placed).alias("order_date_key"), "order_id", "product_id", "customer_id",
        "quantity", "unit_price", "line_total", "item_sequence", "quantity_category",
        F.col("price_tier").alias("line_price_tier"), "line_value_tier",
        F.when(quantity > 1, (price * (quantity - 1).cast("decimal(10,0)")).cast(MONEY)).otherwise(zero(MONEY))
        .alias("additional_quantity_value"),
        is_true(F.col("item_sequence") == 1).alias("is_first_line_item"),
        "order_date", "order_status", "order_total_amount",
        F.when(whole > 0, share).otherwise(zero(AVERAGE)).alias("line_percentage_of_order"),
        # shares are compared by multiplication, so an order total of 0 cannot divide
        F.when(line == whole, "Single Line Order").when((whole > 0) & (line * 2 >= whole), "Dominant Line")
        .when((whole > 0) & (line * 4 >= whole), "Major Line").otherwise("Minor Line").alias("line_importance"),
        F.when(quantity == 1, "Single Item").when(quantity == 2, "Pair").when(quantity.between(3, 5), "Small Batch")
        .otherwise("Large Batch").alias("quantity_category_detailed"),
        ladder(price, L.UNIT_PRICE_CATEGORY, L.UNIT_PRICE_CATEGORY_TOP, "<").alias("unit_price_category"),
        F.year(placed).alias("order_year"), F.month(placed).alias("order_month"),
        F.quarter(placed).alias("order_quarter"), dow0(placed).alias("order_day_of_week"),
        *[is_true(status == s).alias(f"is_from_{s}_order") for s in L.SOURCE_STATUSES],
        when_status(L.COMPLETED).alias("recognized_revenue"),
        when_status(L.REFUNDED).alias("refunded_amount"),
        when_status(L.COMPLETED, L.REFUNDED).alias("historical_revenue"),
        F.col("created_at").alias("line_created_at"), *_stamps(loaded_at))


# Keys of the facts and the columns of the same row that they are made from.
_MADE_FROM = {
    "fact_orders": {"order_key": ["order_id"]},
    "fact_orders_scd2": {"order_key": ["order_id", "status_change_sequence"]},
    "fact_order_line": {"order_line_key": ["order_line_id"], "order_key": ["order_id"], "customer_key": ["customer_id"],
                        "product_key": ["product_id"]},
}


def made_keys(name: str, columns: list[str]) -> dict[str, Column]:
    """Keys of a fact that follow from its ids, for those who move rows and can make them again."""
    return {key: surrogate_key(*ids) for key, ids in _MADE_FROM.get(name, {}).items() if {key, *ids} <= set(columns)}
