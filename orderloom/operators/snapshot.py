"""State of all orders on every calendar day, from their validity intervals.

An order that stays in one status for years is in the snapshot of each of those
days.  Writing out one row per order and day would multiply the history by the
length of the calendar, so the measures are swept instead: an interval adds its
amounts on its first day and takes them away on the day after its last; running
totals over the days give each day's state.  Only rows bounded by the calendar
(days, customer-days, value-bucket-days) are ever grouped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.functions import labels as L
from orderloom.functions.columns import AVERAGE, MONEY, moment
from orderloom.operators.dimensions import date_spine
from orderloom.session import pinned

RUNNING = (W.unboundedPreceding, W.currentRow)
PAID = (L.COMPLETED, L.REFUNDED)

STEP_BITS = 9  # an amount is searched at most this many bits at a time
RUNG_BITS = 5  # the same where counts of all steps are stored beforehand


def status_intervals(history: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """History rows visible on some day of ``[start, end)``, as ``from_day`` .. ``to_day`` (exclusive).

    A status is visible from its effective day up to the day before its end day; one
    that starts and ends on the same day is never visible.
    """
    begins, ends = F.to_date("status_effective_date"), F.to_date("status_end_date")
    from_day = F.greatest(begins, F.lit(start))
    to_day = F.least(F.coalesce(ends, F.lit(end)), F.lit(end))
    window_end = moment(end)
    window_start = moment(start)
    visible = (F.col("status_effective_date") < window_end) & (
        F.col("status_end_date").isNull() | (F.col("status_end_date") >= window_start))
    return history.where(visible).select(
        "order_id", "customer_key", "order_status", "order_amount", "total_line_items", "total_quantity",
        "unique_products_count", "order_size_category", "product_variety", "order_timing", "order_time_of_day",
        from_day.alias("from_day"), to_day.alias("to_day"), (begins == from_day).alias("enters"),
    ).where("from_day < to_day")


def _marks(intervals: DataFrame, end: dt.date, *columns) -> DataFrame:
    """Two rows per interval: +1 on its first day, -1 on the day after its last."""
    edges = F.array(F.struct(F.col("from_day").alias("day"), F.lit(1).alias("sign")),
                    F.struct(F.col("to_day").alias("day"), F.lit(-1).alias("sign")))
    return intervals.select(*columns, F.inline(edges)).where(F.col("day") < F.lit(end))


def _additive() -> dict:
    """Measures that add up over orders: name -> (condition or None, value or None)."""
    status = F.col("order_status")
    out = {"total_orders": (None, None)}
    for name in L.SOURCE_STATUSES:
        out[f"{name}_orders"] = (status == name, None)
    out["items_added_orders"] = (status == L.ITEMS_ADDED, None)
    out["paid_orders"] = (status.isin(*PAID) & F.col("order_amount").isNotNull(), None)
    out["total_revenue"] = (status.isin(*PAID), "order_amount")
    out["completed_revenue"] = (status == L.COMPLETED, "order_amount")
    out["refunded_revenue"] = (status == L.REFUNDED, "order_amount")
    out["total_line_items"] = (None, "total_line_items")
    out["total_quantity_sold"] = (None, "total_quantity")
    out["total_unique_products_ordered"] = (None, "unique_products_count")
    for name, label in zip(["single_item_orders", "small_orders", "medium_orders", "large_orders"], L.ORDER_SIZES):
        out[name] = (F.col("order_size_category") == label, None)
    for name, label in zip(["all_unique_product_orders", "single_product_orders", "mixed_product_orders"],
                           L.VARIETIES):
        out[name] = (F.col("product_variety") == label, None)
    for label in L.TIMINGS:
        out[f"{label.lower()}_orders"] = (F.col("order_timing") == label, None)
    for label in [name for name, _, _ in L.DAY_PARTS] + [L.DAY_PART_REST]:
        out[f"{label.lower()}_orders"] = (F.col("order_time_of_day") == label, None)
    return out


def _entries() -> dict:
    """Orders whose status begins on the day itself."""
    status = F.col("order_status")
    return {"daily_status_changes": F.lit(True), "daily_completions": status == L.COMPLETED,
            "daily_cancellations": status == L.CANCELLED, "daily_items_added": status == L.ITEMS_ADDED}


def _running(days: DataFrame, names) -> DataFrame:
    """Running totals; one row per calendar day, so one task is enough."""
    window = W.orderBy("day").rowsBetween(*RUNNING)
    return days.withColumns({n: F.coalesce(F.sum(n).over(window), F.lit(0)) for n in names})


def _customer_steps(intervals: DataFrame, end: dt.date) -> DataFrame:
    """Per day, by how much the number of customers with an open order changes.

    Marks are first summed per customer and day, so a customer's window holds at
    most one row per calendar day however many orders the customer has.
    """
    completed = (F.col("order_status") == L.COMPLETED).cast("int")
    marks = _marks(intervals.where(F.col("customer_key").isNotNull()), end, "customer_key", completed.alias("done"))
    marks = marks.groupBy("customer_key", "day").agg(
        F.sum("sign").alias("any_step"), F.sum(F.col("sign") * F.col("done")).alias("done_step"))
    across = W.partitionBy("customer_key").orderBy("day")
    held = marks.withColumns({
        "any": (F.sum("any_step").over(across.rowsBetween(*RUNNING)) > 0).cast("int"),
        "done": (F.sum("done_step").over(across.rowsBetween(*RUNNING)) > 0).cast("int")})
    turned = held.select("day", (F.col("any") - F.lag("any", 1, 0).over(across)).alias("any"),
                         (F.col("done") - F.lag("done", 1, 0).over(across)).alias("done"))
    return turned.groupBy("day").agg(F.sum("any").alias("unique_customers"),
                                     F.sum("done").alias("customers_with_completed_orders"))


def _pick(counts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Replace each searched bucket by its child that holds the wanted rank."""
    inside = W.partitionBy("day", "bucket").orderBy("child").rowsBetween(*RUNNING)
    spans = counts.withColumn("upto", F.sum("held").over(inside)).withColumn("below", F.col("upto") - F.col("held"))
    return (chosen.join(spans, ["day", "bucket"])
            .where((F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("upto")))
            .select("day", "which", F.col("child").alias("bucket"), (F.col("rank") - F.col("below")).alias("rank")))


def _wanted_ranks(sizes: DataFrame) -> DataFrame:
    """Ranks of minimum, lower and upper median and maximum among ``n`` rows of a day."""
    n = F.col("n")
    ranks = {"min": F.lit(1).cast("bigint"), "lower": F.floor((n + 1) / 2), "upper": F.floor(n / 2) + 1, "max": n}
    wanted = F.array(*[F.struct(F.lit(k).alias("which"), r.cast("bigint").alias("rank")) for k, r in ranks.items()])
    return sizes.where("n > 0").select("day", F.lit(0).cast("bigint").alias("bucket"), F.inline(wanted))


def _statistics(chosen: DataFrame, lowest: int) -> DataFrame:
    value = ((F.col("bucket") + F.lit(lowest)).cast("decimal(20,0)") / 100).cast(MONEY)

    def at(which):
        return F.max(F.when(F.col("which") == which, value))

    return chosen.groupBy("day").agg(
        at("min").alias("min_value"), at("max").alias("max_value"),
        ((at("lower") + at("upper")) / 2).cast(AVERAGE).alias("median_value"))


def _cents(amount: str):
    return (F.col(amount).cast(MONEY) * 100).cast("bigint")


def _search_plan(values: DataFrame, step_bits: int) -> tuple[int, list[tuple[int, int]]]:
    """Lowest value, and the (parent, child) bit shifts that cover the range of ``cents``."""
    low, high = values.agg(F.min("cents"), F.max("cents")).first()
    bits = max(1, ((high or 0) - (low or 0)).bit_length())
    steps = -(-bits // step_bits)
    edges = [bits * i // steps for i in range(steps, -1, -1)]
    return low or 0, list(zip(edges, edges[1:]))


def value_ladder(leaf: DataFrame, lowest: int, shifts: list[tuple[int, int]]) -> DataFrame:
    """Counts of ``cents, day, step`` in the value buckets of every search step, stored by ``rung``.

    A bucket of rung ``i`` joins the values that agree above the ``i``-th child shift.  All rungs come from one scan; the map
    tasks sum before the shuffle, so a coarse rung costs at most its buckets times the calendar per task.
    """
    value = F.col("cents") - F.lit(lowest)
    rungs = F.array(*[F.struct(F.lit(i).alias("rung"), F.shiftright(value, child).alias("child"),
                               F.shiftright(value, parent).alias("bucket")) for i, (parent, child) in enumerate(shifts)])
    return pinned(leaf.select("day", "step", F.inline(rungs))
                  .groupBy("rung", "bucket", "child", "day").agg(F.sum("step").alias("step"))
                  .where("step <> 0"), by="rung")


def interval_statistics(intervals: DataFrame, sizes: DataFrame, end: dt.date) -> DataFrame:
    """Exact min, median and max of ``order_amount`` over the orders held on each day.

    The intervals are read once: their marks are stored as net steps per value and day, and from those come the counts of
    all dyadic value buckets.  The value with a wanted rank is then found a few bits at a time: only the
    children of buckets that hold a wanted rank on some day are summed, and only on
    those days.  No task sees more than a bucket's children times the calendar.
    """
    marks = _marks(intervals.select("from_day", "to_day", _cents("order_amount").alias("cents")), end, "cents")
    leaf = pinned(marks.groupBy("cents", "day").agg(F.sum("sign").alias("step")).where("step <> 0"))
    lowest, shifts = _search_plan(leaf, RUNG_BITS)
    ladder, chosen = value_ladder(leaf, lowest, shifts), pinned(_wanted_ranks(sizes))
    for rung in range(len(shifts)):
        # at most four buckets per calendar day
        open_buckets = F.broadcast(chosen.select("bucket").distinct())
        steps = ladder.where(F.col("rung") == rung).drop("rung").join(open_buckets, "bucket", "left_semi")
        places = (chosen.select("day", "bucket").distinct()
                  .join(steps.select("bucket", "child").distinct(), "bucket"))
        grid = (steps.withColumn("asked", F.lit(False))
                .unionByName(places.withColumns({"step": F.lit(0).cast("bigint"), "asked": F.lit(True)}))
                .groupBy("bucket", "child", "day")
                .agg(F.sum("step").alias("step"), F.bool_or("asked").alias("asked")))
        across = W.partitionBy("bucket", "child").orderBy("day").rowsBetween(*RUNNING)
        counts = grid.withColumn("held", F.sum("step").over(across)).where("asked and held > 0")
        # at most four rows per day; stored so that the plan does not grow with each step
        chosen = pinned(_pick(counts.select("day", "bucket", "child", "held"), chosen))
    return _statistics(chosen, lowest)


def daily_statistics(rows: DataFrame, day: str, amount: str) -> DataFrame:
    """Exact min, median and max of ``amount`` per day, by the same search over plain rows."""
    values = pinned(rows.where(F.col(amount).isNotNull())
                    .groupBy(F.col(day).alias("day"), _cents(amount).alias("cents")).agg(F.count(F.lit(1)).alias("held")))
    lowest, steps_down = _search_plan(values, STEP_BITS)
    offset = F.col("cents") - F.lit(lowest)
    chosen = pinned(_wanted_ranks(values.groupBy("day").agg(F.sum("held").alias("n"))))
    for high, low in steps_down:
        parent, child = F.shiftright(offset, high), F.shiftright(offset, low)
        counts = values.groupBy("day", parent.alias("bucket"), child.alias("child")).agg(F.sum("held").alias("held"))
        wanted = chosen.select("day", "bucket").distinct()
        chosen = pinned(_pick(counts.join(wanted, ["day", "bucket"], "left_semi"), chosen))
    return _statistics(chosen, lowest)


def daily_order_state(history: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Point-in-time order measures, one row per day of ``[start, end)`` that has any order."""
    # narrow and read by several passes; the checkpoint also cuts the lineage of the history
    intervals = pinned(status_intervals(history, start, end))
    measures, entries = _additive(), _entries()
    sign = F.col("sign")

    def signed(condition, value):
        amount = sign if value is None else sign * F.coalesce(F.col(value), F.lit(0))
        return F.sum(amount if condition is None else F.when(condition, amount))

    aggregates = [signed(c, v).alias(name) for name, (c, v) in measures.items()]
    aggregates += [F.count(F.when((sign == 1) & F.col("enters") & c, F.lit(1))).alias(n) for n, c in entries.items()]
    columns = [c for c in intervals.columns if c not in ("from_day", "to_day", "order_id", "customer_key")]
    changes = _marks(intervals, end, *columns).groupBy("day").agg(*aggregates)
    spine = date_spine(history.sparkSession, start, end).withColumnRenamed("calendar_date", "day")
    customers = ["unique_customers", "customers_with_completed_orders"]
    days = spine.join(changes, "day", "left").join(_customer_steps(intervals, end), "day", "left")
    days = pinned(_running(days, [*measures, *customers]).where("total_orders > 0"))

    paid = intervals.where(F.col("order_status").isin(*PAID))
    statistics = interval_statistics(paid.where(F.col("order_amount").isNotNull()),
                                     days.select("day", F.col("paid_orders").alias("n")), end)
    money = {n: F.col(n).cast(MONEY) for n, (_, v) in measures.items() if v == "order_amount"}
    return (days.join(statistics, "day", "left").withColumns(money)
            .withColumns({n: F.coalesce(n, F.lit(0)) for n in entries}))


def daily_status_population(history: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Orders and amount per day and status, by the same sweep."""
    changes = (_marks(status_intervals(history, start, end), end, "order_status", "order_amount")
               .groupBy("order_status", "day")
               .agg(F.sum("sign").alias("orders"), F.sum(F.col("sign") * F.col("order_amount")).alias("amount")))
    calendar = F.sequence(F.lit(start), F.lit(end - dt.timedelta(days=1)))
    grid = changes.select("order_status").distinct().select("order_status", F.explode(calendar).alias("day"))
    window = W.partitionBy("order_status").orderBy("day").rowsBetween(*RUNNING)
    return (grid.join(changes, ["order_status", "day"], "left")
            .withColumns({"orders": F.sum("orders").over(window),
                          "amount": F.sum("amount").over(window).cast(MONEY)})
            .where("orders > 0").select(F.col("day").alias("metric_date"), "order_status", "orders", "amount"))
