"""Totals over the whole history of a customer or product, kept up to date from the rows that change.

Sums follow a change by adding what came and taking away what went.  Distinct counts, extremes and the most frequent value do not, so
the values themselves are kept: one row per key, kind and member with the number of rows that hold it.  A member that appears or
vanishes moves the count by one.  An extreme is looked up again only where the member that held it has vanished, and a favourite
only where its members moved; nothing reads the facts of a key again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import labels as L
from orderloom.functions.columns import AVERAGE, MONEY, days_between, dow0, surrogate_key
from orderloom.session import pinned

EXACT = "decimal(26,8)"     # leaves sums and sums of sums all of their decimal places
ROWS = "rows_held"
MEMBER = ["kind", "member"]


@dataclass(frozen=True)
class Lifetime:
    """``rows`` gives per fact row the key, the summed columns and ``_members``; ``finish`` makes the table from the state."""

    key: list[str]
    fact: str
    rows: Callable[[DataFrame, DataFrame], DataFrame]
    sums: list[str]
    finish: Callable[[DataFrame], DataFrame]
    counted: list[str] = field(default_factory=list)
    extremes: dict[str, str] = field(default_factory=dict)     # kind -> type of its members
    favourites: list[str] = field(default_factory=list)        # most rows, then the lower name


def _members(**kinds: Column) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("string").alias("member")) for k, v in kinds.items()]).alias("_members")


def _is(kind: str) -> Column:
    return F.col("kind") == kind


def member_counts(life: Lifetime, rows: DataFrame) -> DataFrame:
    """``key, kind, member, n``."""
    return (rows.select(*life.key, F.inline("_members")).where(F.col("member").isNotNull())
            .groupBy(*life.key, *MEMBER).agg(F.count(F.lit(1)).alias("n")))


def _from_members(life: Lifetime, pairs: DataFrame) -> DataFrame:
    """Counts, extremes and favourites per key."""
    out = [F.count_if(_is(k)).alias(f"n_{k}") for k in life.counted]
    for kind, typ in life.extremes.items():
        value = F.when(_is(kind), F.col("member").cast(typ))
        out += [F.min(value).alias(f"low_{kind}"), F.max(value).alias(f"high_{kind}")]
    out += [F.min(F.when(_is(k), F.struct((-F.col("n")).alias("order"), "member")))["member"].alias(f"top_{k}") for k in life.favourites]
    return pairs.groupBy(*life.key).agg(*out)


def first_state(life: Lifetime, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The state of all keys from all rows and their stored ``member_counts``."""
    sums = rows.groupBy(*life.key).agg(F.count(F.lit(1)).alias(ROWS), *[F.sum(c).alias(c) for c in life.sums])
    return sums.join(_from_members(life, pairs), life.key)


def changed_members(life: Lifetime, delta: DataFrame, pairs: DataFrame) -> DataFrame:
    """``key, kind, member, n, was`` of the members whose number of rows changes; ``delta`` weighs rows that went -1."""
    moved = (delta.select(*life.key, "_weight", F.inline("_members")).where(F.col("member").isNotNull())
             .groupBy(*life.key, *MEMBER).agg(F.sum("_weight").alias("_step")).where("_step != 0"))
    was = F.coalesce("n", F.lit(0))
    return moved.join(pairs.select(*life.key, *MEMBER, "n"), [*life.key, *MEMBER], "left").select(
        *life.key, *MEMBER, (was + F.col("_step")).alias("n"), was.alias("was"))


def changed_state(life: Lifetime, delta: DataFrame, members: DataFrame, pairs: DataFrame, state: DataFrame) -> DataFrame:
    """The new state of the keys of ``delta``; ``members`` are its stored ``changed_members``, ``pairs`` and ``state`` are the old ones."""
    def weighed(name: str) -> Column:
        return F.when(F.col("_weight") < 0, -F.col(name)).otherwise(F.col(name))

    steps = delta.groupBy(*life.key).agg(F.sum("_weight").alias(f"d_{ROWS}"), *[
        F.sum(weighed(c)).alias(f"d_{c}") for c in life.sums])
    came, went = (F.col("n") > 0) & (F.col("was") == 0), (F.col("n") == 0) & (F.col("was") > 0)
    moved = [(F.count_if(_is(k) & came) - F.count_if(_is(k) & went)).alias(f"d_{k}") for k in life.counted]
    for kind, typ in life.extremes.items():
        value = F.col("member").cast(typ)
        for what, test in (("new", came), ("gone", went)):
            moved += [F.min(F.when(_is(kind) & test, value)).alias(f"{what}_low_{kind}"),
                      F.max(F.when(_is(kind) & test, value)).alias(f"{what}_high_{kind}")]
    moved += [F.bool_or(_is(k)).alias(f"moved_{k}") for k in life.favourites] or [F.lit(False).alias("moved_none")]
    met = pinned(steps.join(members.groupBy(*life.key).agg(*moved), life.key, "left").join(state, life.key, "left"))
    lost = F.lit(False)
    for kind in life.extremes:
        lost = (lost | F.coalesce(F.col(f"gone_low_{kind}") <= F.col(f"low_{kind}"), F.lit(False))
                | F.coalesce(F.col(f"gone_high_{kind}") >= F.col(f"high_{kind}"), F.lit(False)))
    for kind in life.favourites:
        lost = lost | F.coalesce(f"moved_{kind}", F.lit(False))
    look = met.where(lost).select(*life.key)
    held = pairs.select(*life.key, *MEMBER, "n").join(look, life.key, "left_semi").join(members, [*life.key, *MEMBER], "left_anti")
    held = held.unionByName(members.where("n > 0").drop("was").join(look, life.key, "left_semi"))
    found = _from_members(life, held)
    found = found.select(*life.key, F.lit(True).alias("_found"), *[
        F.col(c).alias(f"_{c}") for c in found.columns if c not in life.key and not c.startswith("n_")])

    def after(name: str) -> Column:
        kind = dict(state.dtypes)[name]
        return (F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"d_{name.removeprefix('n_')}"), F.lit(0))).cast(kind).alias(name)

    out = [after(ROWS), *[after(c) for c in life.sums], *[after(f"n_{k}") for k in life.counted]]
    for kind in life.extremes:
        for side, pick in (("low", F.least), ("high", F.greatest)):
            name = f"{side}_{kind}"
            out.append(F.when(F.col("_found"), F.col(f"_{name}")).otherwise(pick(name, f"new_{name}")).alias(name))
    out += [F.when(F.col("_found"), F.col(f"_top_{k}")).otherwise(F.col(f"top_{k}")).alias(f"top_{k}") for k in life.favourites]
    # A key that only the look-up knows has lost or gained members; without any left its row goes, by its number of rows.
    return met.withColumn("_lost", lost).join(found, life.key, "left").withColumn(
        "_found", F.coalesce("_found", "_lost")).select(*life.key, *out)


# --- the three totals ---------------------------------------------------------------

def _money(value) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0)).cast(EXACT)


def _one(test: Column) -> Column:
    return F.coalesce(test.cast("bigint"), F.lit(0).cast("bigint"))


def _known(value: str) -> Column:
    return F.col(value).isNotNull().cast("bigint")


def _per(total: str, count: str) -> Column:
    return (F.col(total).cast(AVERAGE) / F.nullif(F.col(count), F.lit(0))).cast(AVERAGE)


_IMPORTANCES = dict(zip(["single_line_orders", "dominant_lines", "major_lines", "minor_lines"], L.LINE_IMPORTANCES))
_SOLD = {"total_revenue": None, "completed_revenue": L.COMPLETED, "refunded_revenue": L.REFUNDED, "cancelled_revenue": L.CANCELLED}
_AVERAGED = {"avg_line_value": "line_total", "avg_selling_price": "unit_price", "avg_quantity_per_line": "quantity",
             "avg_order_contribution_pct": "line_percentage_of_order", "avg_position_in_order": "item_sequence"}


def _sales_rows(lines: DataFrame, _: DataFrame) -> DataFrame:
    status = F.col("order_status")
    sums = {name: _money("line_total" if s is None else F.when(status == s, F.col("line_total"))) for name, s in _SOLD.items()}
    sums |= {f"s_{c}": _money(c) for c in _AVERAGED.values()} | {f"k_{c}": _known(c) for c in _AVERAGED.values()}
    sums |= {name: _one(F.col("line_importance") == label) for name, label in _IMPORTANCES.items()}
    sums["times_first_in_order"] = _one(F.col("is_first_line_item"))
    # Ids stand for their keys, which are texts of 32 digits made from them.
    return lines.select("product_id", *[v.alias(n) for n, v in sums.items()],
                        _members(order=F.col("order_id"), customer=F.col("customer_id"), day=F.col("order_date_key"), time=F.col("order_date")))


def _sales(state: DataFrame) -> DataFrame:
    return state.select(
        surrogate_key("product_id").alias("product_key"), "product_id", F.col(ROWS).alias("total_order_lines"),
        *[F.nullif(F.col(f"n_{k}"), F.lit(0)).alias(n) for k, n in
          (("order", "unique_orders"), ("customer", "unique_customers"), ("day", "selling_days"))],
        F.col("s_quantity").cast("bigint").alias("total_quantity_sold"), *_SOLD, *_IMPORTANCES, "times_first_in_order",
        *[_per(f"s_{c}", f"k_{c}").alias(n) for n, c in _AVERAGED.items()],
        F.col("low_time").alias("first_sale_date"), F.col("high_time").alias("last_sale_date"))


def _purchase_rows(orders: DataFrame, _: DataFrame) -> DataFrame:
    placed, done = F.col("order_date"), F.col("order_status") == L.COMPLETED
    dow, month = dow0(placed), F.month(placed)
    sums = {"completed": _one(done), "amount": _money("order_amount"), "amounts": _known("order_amount"),
            "completed_amount": _money(F.when(done, F.col("order_amount"))), "items": _one(F.col("total_line_items")),
            "weekend": _one(dow.isin(0, 6)), "weekday": _one(dow.between(1, 5)),
            **{f"{name.lower()}_orders": _one(month.isin(*months)) for name, months in L.SEASONS}}
    return orders.where(F.col("customer_key").isNotNull()).select(
        "customer_key", *[v.alias(n) for n, v in sums.items()],
        _members(month=F.trunc(F.to_date(placed), "month"), time=placed, amount=F.col("order_amount")))


def _purchases(state: DataFrame) -> DataFrame:
    return state.select(
        "customer_key", F.col(ROWS).alias("total_orders"), F.col("completed").alias("completed_orders"),
        F.col("n_month").alias("active_months"), F.col("low_time").alias("first_purchase_date"),
        F.col("high_time").alias("last_purchase_date"), days_between("low_time", "high_time").alias("customer_lifespan_days"),
        F.when(F.col("amounts") > 0, F.col("amount")).alias("total_spent"), F.col("completed_amount").alias("total_completed_spent"),
        _per("amount", "amounts").alias("avg_order_value"), F.col("low_amount").alias("min_order_value"),
        F.col("high_amount").alias("max_order_value"), F.col("items").alias("total_items_purchased"),
        _per("items", ROWS).alias("avg_items_per_order"), F.col("weekend").alias("weekend_orders"),
        F.col("weekday").alias("weekday_orders"), *[f"{name.lower()}_orders" for name, _ in L.SEASONS])


def _preference_rows(lines: DataFrame, products: DataFrame) -> DataFrame:
    known = products.select("product_key", "category", "category_group", "price_tier", "is_limited_edition")
    importance = F.col("line_importance")
    sums = {"prices": _money("unit_price"), "quantity": _one(F.col("quantity")), "single": _one(importance == "Single Line Order"),
            "dominant": _one(importance == "Dominant Line"), "premium": _one(F.col("price_tier").isin("Premium", "Luxury")),
            "limited": _one(F.col("is_limited_edition"))}
    category = F.concat_ws("\x1f", "category_group", "category")
    return lines.where(F.col("order_status") == L.COMPLETED).join(known, "product_key").select(
        "customer_key", *[v.alias(n) for n, v in sums.items()],
        _members(product=F.col("product_id"), category=F.when(F.col("category").isNotNull(), category), group=F.col("category_group"),
                 price=F.col("unit_price")))


def _preferences(state: DataFrame) -> DataFrame:
    return state.select(
        "customer_key", F.col("n_product").alias("unique_products_purchased"), F.col("n_category").alias("unique_categories_purchased"),
        F.col("n_group").alias("unique_category_groups_purchased"), _per("prices", ROWS).alias("avg_price_preference"),
        F.col("low_price").alias("min_price_purchased"), F.col("high_price").alias("max_price_purchased"),
        F.col("top_group").alias("preferred_category_group"), F.col("premium").alias("premium_purchases"),
        F.col("limited").alias("limited_edition_purchases"), F.col("quantity").alias("total_quantity_purchased"),
        _per("quantity", ROWS).alias("avg_quantity_per_line"), F.col("single").alias("single_line_orders"),
        F.col("dominant").alias("dominant_line_purchases"))


LIFETIMES = {
    "product_sales": Lifetime(
        ["product_id"], "fact_order_line", _sales_rows,
        [*_SOLD, *[f"{p}_{c}" for c in _AVERAGED.values() for p in "sk"], *_IMPORTANCES, "times_first_in_order"], _sales,
        ["order", "customer", "day"], {"time": "timestamp_ntz"}),
    "customer_purchases": Lifetime(
        ["customer_key"], "fact_orders", _purchase_rows,
        ["completed", "amount", "amounts", "completed_amount", "items", "weekend", "weekday",
         *[f"{name.lower()}_orders" for name, _ in L.SEASONS]], _purchases,
        ["month"], {"time": "timestamp_ntz", "amount": MONEY}),
    "customer_preferences": Lifetime(
        ["customer_key"], "fact_order_line", _preference_rows, ["prices", "quantity", "single", "dominant", "premium", "limited"],
        _preferences, ["product", "category", "group"], {"price": MONEY}, ["group"]),
}
