"""Reports over the status history, each in the order in which it is shown."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import labels as L
from orderloom.functions.columns import MONEY, ladder, mean, moment
from orderloom.operators.intervals import interval_join

ARROW = " → "


def current_snapshot(history: DataFrame) -> DataFrame:
    return history.where("is_current_status").select(
        "order_id", "order_status", "status_effective_date", "order_amount", "total_line_items").orderBy("order_id")


def order_history(history: DataFrame, order_id: str | None = None) -> DataFrame:
    """Status rows of one order, or of all orders."""
    rows = history if order_id is None else history.where(F.col("order_id") == order_id)
    return rows.select("order_id", "status_change_sequence", "order_status", "status_effective_date",
                       "status_end_date", "status_duration_hours", "status_lifecycle_stage").orderBy(
        "order_id", "status_change_sequence")


def _completions(history: DataFrame) -> DataFrame:
    return history.where((F.col("order_status") == L.COMPLETED) & F.col("hours_to_completion").isNotNull())


def completion_by_size(history: DataFrame) -> DataFrame:
    hours = "hours_to_completion"
    return _completions(history).groupBy("order_size_category").agg(
        F.count(F.lit(1)).alias("completed_orders"), mean(hours).alias("avg_hours_to_completion"),
        F.min(hours).alias("min_hours_to_completion"), F.max(hours).alias("max_hours_to_completion")).orderBy(
        "avg_hours_to_completion", "order_size_category")


def status_dwell(history: DataFrame) -> DataFrame:
    return history.where(F.col("status_end_date").isNotNull()).groupBy("order_status").agg(
        F.count_distinct("order_id").alias("unique_orders"), F.count(F.lit(1)).alias("total_status_instances"),
        mean("status_duration_hours").alias("avg_duration_hours")).orderBy(
        F.desc("unique_orders"), "order_status")


def daily_changes(history: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    since = moment(as_of - dt.timedelta(days=days))
    return (history.where(F.col("status_effective_date") >= since)
            .groupBy(F.to_date("status_effective_date").alias("change_date"), "order_status")
            .agg(F.count(F.lit(1)).alias("status_changes"),
                 F.count_distinct("order_id").alias("unique_orders_affected"))
            .orderBy(F.desc("change_date"), F.desc("status_changes"), "order_status"))


def status_journey(history: DataFrame, first: str = L.ITEMS_ADDED, then: str = L.CANCELLED) -> DataFrame:
    """Status path of the orders in which ``then`` follows ``first``.

    The condition is decided from two numbers per order, so only matching orders
    have their path text put together.
    """
    seq, status = F.col("status_change_sequence"), F.col("order_status")
    matching = (history.groupBy("order_id")
                .agg(F.min(F.when(status.contains(first), seq)).alias("_first"),
                     F.max(F.when(status.contains(then), seq)).alias("_then"))
                .where("_first < _then").select("order_id"))
    steps = F.array_sort(F.collect_list(F.struct(seq, status)))
    return (history.join(matching, "order_id", "left_semi").groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("total_status_changes"),
                 F.array_join(F.transform(steps, lambda s: s["order_status"]), ARROW).alias("status_journey"))
            .orderBy("order_id"))


def completion_speed(history: DataFrame) -> DataFrame:
    speed = ladder("hours_to_completion", L.COMPLETION_SPEED, L.COMPLETION_SPEED_REST, "<=")
    return _completions(history).groupBy(speed.alias("completion_speed")).agg(
        F.count(F.lit(1)).alias("order_count"), mean("order_amount").alias("avg_order_value"),
        F.sum("order_amount").alias("total_revenue"), F.min("hours_to_completion").alias("_fastest")).orderBy(
        "_fastest").drop("_fastest")


def open_at_items(history: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per order item, the other orders of its customer that were open when it was added, and what they were worth.

    Customer and time meet in one interval join, so a customer with very many orders is spread over the bins of time.
    """
    owner = orders.groupBy("order_id").agg(F.min("customer_id").alias("customer_id"))      # one customer per order
    added = items.select("id", F.col("order_id").alias("own_order"), F.col("created_at").alias("added_at")).join(
        owner.withColumnRenamed("order_id", "own_order"), "own_order")
    open_now = history.where(F.col("order_status").isin(L.PENDING, L.ITEMS_ADDED)).join(owner, "order_id").select(
        "customer_id", "order_id", "order_amount", "status_effective_date", "status_end_date")
    met = interval_join(added, open_now, "added_at", "status_effective_date", "status_end_date", ["customer_id"], bits=4)
    return met.where(F.col("order_id") != F.col("own_order")).groupBy("id").agg(
        F.first("own_order").alias("order_id"), F.count(F.lit(1)).alias("open_orders"),
        F.sum("order_amount").cast(MONEY).alias("open_amount"), F.min("status_effective_date").alias("open_since"))
