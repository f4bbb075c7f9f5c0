"""Analyses: business health dashboard, order trends, customer behaviour, product performance."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.functions import labels as L
from orderloom.functions.columns import (AVERAGE, MONEY, by_rules, count_if, days_between, dow0, ladder, mean,
                                         mean_over, moment, name_of, ntile_of, pct, ratio, season, sum_if, weekend_label,
                                         year_month, zero)
from orderloom.operators.ranking import rank_rows
from orderloom.session import pinned


# --- dashboard ----------------------------------------------------------------------

# daily table -> {dashboard column: daily column}
_CUSTOMER_SIDE = {
    "active_customers": "active_customers", "new_customers_acquired": "new_customers_acquired",
    "total_customer_spend": "total_customer_spend", "avg_spend_per_customer": "avg_spend_per_customer",
    "customer_completion_rate_pct": "completion_rate_by_customers_pct",
    "avg_orders_per_active_customer": "avg_orders_per_active_customer",
    "premium_loyal_customers": "premium_loyal_customers", "core_customers": "core_customers",
    "growing_customers": "growing_customers", "new_customers_active": "new_customers",
    "avg_active_customers_7d": "avg_active_customers_7d", "avg_new_customers_7d": "avg_new_customers_7d",
}
_ORDER_SIDE = {
    **{c: c for c in ("total_orders", "completed_orders", "cancelled_orders", "refunded_orders", "total_revenue",
                      "completed_revenue", "avg_order_value", "avg_line_items_per_order", "weekend_order_pct")},
    "order_completion_rate_pct": "completion_rate_pct", "order_cancellation_rate_pct": "cancellation_rate_pct",
    "order_refund_rate_pct": "refund_rate_pct", "ordering_customers": "unique_customers",
    "avg_orders_7d": "avg_7d_total_orders", "avg_revenue_7d": "avg_7d_total_revenue",
}
_PRODUCT_SIDE = {c: c for c in (
    "unique_products_sold", "total_quantity_sold", "total_product_revenue", "avg_unit_price", "product_variety_pct",
    "premium_luxury_revenue_pct", "clothing_revenue_pct", "accessories_revenue_pct", "footwear_revenue_pct",
    "avg_product_revenue_7d", "avg_unique_products_7d")}


def combined_metrics(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """The three daily tables side by side, one row per day any of them has; gaps become 0."""
    sides = [(customers, "metric_date", _CUSTOMER_SIDE), (orders, "order_date", _ORDER_SIDE),
             (products, "metric_date", _PRODUCT_SIDE)]
    frames = [frame.select(F.col(day).alias("metric_date"), *[F.col(src).alias(out) for out, src in names.items()])
              for frame, day, names in sides]
    joined = reduce(lambda left, right: left.join(right, "metric_date", "full"), frames)
    fields = {f.name: f.dataType for frame in frames for f in frame.schema.fields if f.name != "metric_date"}
    return joined.where(F.col("metric_date").isNotNull()).select(
        "metric_date", *[F.coalesce(n, F.lit(0).cast(kind)).alias(n) for n, kind in fields.items()])


def business_indicators(combined: DataFrame) -> DataFrame:
    active, ordering = F.col("active_customers"), F.col("ordering_customers")
    total, completed = F.col("total_revenue"), F.col("completed_revenue")

    def growth(value: str, average: str):
        return pct(F.col(value).cast(AVERAGE) - F.col(average), average, AVERAGE)

    return combined.withColumns({
        "customer_acquisition_rate_pct": pct("new_customers_acquired", active),
        "revenue_per_active_customer": ratio(total, active),
        "completed_revenue_per_ordering_customer": ratio(completed, ordering),
        "products_per_order_ratio": ratio("unique_products_sold", "total_orders"),
        "avg_quantity_per_product": ratio("total_quantity_sold", "unique_products_sold"),
        "customer_order_conversion_pct": pct(ordering, active),
        "premium_core_customer_pct": pct(F.col("premium_loyal_customers") + F.col("core_customers"), active),
        "items_per_order_value_ratio": ratio("avg_order_value", "avg_unit_price", kind=AVERAGE),
        # what was completed less everything that was not, over the total
        "net_revenue_success_pct": pct(completed - (total - completed), total),
        "overall_fulfillment_rate_pct": pct("completed_orders", "total_orders"),
        "customer_growth_vs_7d_avg_pct": growth("active_customers", "avg_active_customers_7d"),
        "revenue_growth_vs_7d_avg_pct": growth("total_revenue", "avg_revenue_7d"),
        "order_growth_vs_7d_avg_pct": growth("total_orders", "avg_orders_7d")})


def health_scores(indicators: DataFrame) -> DataFrame:
    def score(parts):
        points = reduce(lambda a, b: a + b, [ladder(c, steps, rest, op) for c, op, steps, rest in parts])
        return F.least(F.lit(L.SCORE_CAP), F.greatest(F.lit(0), points))

    scored = indicators.withColumns({name: score(parts) for name, parts in L.SCORES.items()})
    overall = reduce(lambda a, b: a + b, [F.col(name) for name in L.SCORES])
    return scored.withColumn("business_health_score", overall).withColumns({
        "business_health_grade": ladder("business_health_score", L.HEALTH_GRADE, L.HEALTH_GRADE_REST),
        "primary_alert": by_rules(L.ALERT_RULES),
        "primary_opportunity": by_rules(L.OPPORTUNITY_RULES)})


DASHBOARD_COLUMNS = """
metric_date date_key year_month metric_year metric_month
active_customers new_customers_acquired total_orders completed_orders total_revenue completed_revenue
avg_order_value unique_products_sold
customer_acquisition_rate_pct customer_completion_rate_pct revenue_per_active_customer
avg_orders_per_active_customer premium_core_customer_pct customer_order_conversion_pct
order_completion_rate_pct order_cancellation_rate_pct order_refund_rate_pct overall_fulfillment_rate_pct
products_per_order_ratio product_variety_pct premium_luxury_revenue_pct weekend_order_pct
net_revenue_success_pct completed_revenue_per_ordering_customer avg_unit_price
clothing_revenue_pct accessories_revenue_pct footwear_revenue_pct
customer_growth_vs_7d_avg_pct revenue_growth_vs_7d_avg_pct order_growth_vs_7d_avg_pct
avg_active_customers_7d avg_revenue_7d avg_orders_7d
customer_health_score order_health_score revenue_health_score growth_health_score
business_health_score business_health_grade primary_alert primary_opportunity
""".split()


def metrics_dashboard(orders: DataFrame, customers: DataFrame, products: DataFrame,
                      loaded_at: dt.datetime) -> DataFrame:
    day = F.col("metric_date")
    scored = health_scores(business_indicators(combined_metrics(orders, customers, products)))
    dated = scored.withColumns({
        "date_key": F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day), "year_month": year_month(day),
        "metric_year": F.year(day), "metric_month": F.month(day)})
    return dated.select(*DASHBOARD_COLUMNS, moment(loaded_at).alias("analysis_updated_at"))


# --- order trends -------------------------------------------------------------------

def order_trend_base(orders: DataFrame) -> DataFrame:
    """Orders per order day by their current status.

    Summed per customer and day first, so counting customers needs no distinct.
    """
    per_customer = orders.groupBy(F.to_date("order_date").alias("trend_date"), "customer_key").agg(
        F.count(F.lit(1)).alias("orders"), count_if(F.col("order_status") == L.COMPLETED).alias("completed"),
        F.sum("order_amount").alias("amount"), F.count("order_amount").alias("amounts"),
        sum_if(F.col("order_status") == L.COMPLETED, "order_amount").alias("completed_amount"),
        F.sum("total_line_items").alias("lines"))
    days = per_customer.groupBy("trend_date").agg(
        F.sum("orders").alias("total_orders"), F.sum("completed").alias("completed_orders"),
        F.sum("amount").cast(MONEY).alias("total_revenue"),
        F.sum("completed_amount").cast(MONEY).alias("completed_revenue"),
        (F.sum("amount").cast(AVERAGE) / F.nullif(F.sum("amounts"), F.lit(0))).cast(AVERAGE).alias("avg_order_value"),
        F.count("customer_key").alias("unique_customers"), F.sum("lines").alias("total_line_items"))
    return days.withColumns({
        "avg_items_per_order": (F.col("total_line_items").cast(AVERAGE) / F.col("total_orders")).cast(AVERAGE),
        "completion_rate_pct": pct("completed_orders", "total_orders")})


def order_trends_daily(base: DataFrame) -> DataFrame:
    day = F.col("trend_date")
    by_day = W.orderBy("trend_date")
    week, month = by_day.rowsBetween(-6, 0), by_day.rowsBetween(-29, 0)
    back = {"day": 1, "week": 7, "month": 30}
    shifted = base.withColumns({
        "trend_year": F.year(day), "trend_month": F.month(day), "trend_quarter": F.quarter(day),
        "day_of_week": dow0(day), "year_month": year_month(day),
        "year_quarter": F.concat(F.year(day), F.lit("-"), F.quarter(day)),
        "orders_7d_avg": mean_over("total_orders", week), "revenue_7d_avg": mean_over("completed_revenue", week),
        "orders_30d_avg": mean_over("total_orders", month), "revenue_30d_avg": mean_over("completed_revenue", month),
        **{f"prev_{unit}_orders": F.lag("total_orders", n).over(by_day) for unit, n in back.items()},
        **{f"prev_{unit}_revenue": F.lag("completed_revenue", n).over(by_day) for unit, n in back.items()}})

    def growth(unit: str):
        before = F.col(f"prev_{unit}_orders")
        return pct(F.col("total_orders") - before, before)

    special = F.lit(None)
    for number, first, last, label in reversed(L.SPECIAL_PERIODS):
        inside = (F.month(day) == number) & F.dayofmonth(day).between(first, last)
        special = F.when(inside, label).otherwise(special)

    def against(value: str, average: str, names):
        above, near, below = names
        mean_value = F.col(average)
        return (F.when(F.col(value) * 10 >= mean_value * 12, above)
                .when(F.col(value) * 10 >= mean_value * 8, near).otherwise(below))

    return shifted.withColumns({
        "daily_growth_pct": growth("day"), "weekly_growth_pct": growth("week"), "monthly_growth_pct": growth("month"),
        "season": season(F.month(day)), "day_name": name_of(dow0(day), L.DAY_NAMES), "day_type": weekend_label(day),
        "special_period": F.coalesce(special, F.lit(L.SPECIAL_PERIOD_REST)),
        "performance_vs_7d": against("total_orders", "orders_7d_avg", L.VS_7D_LABELS),
        "revenue_performance": against("completed_revenue", "revenue_30d_avg", L.VS_30D_LABELS),
        "volume_tier": ladder("total_orders", L.VOLUME_TIER, L.VOLUME_TIER_REST),
    }).withColumn("daily_trend_pattern", ladder("daily_growth_pct", L.DAILY_TREND, L.DAILY_TREND_REST))


def order_trends_monthly(daily: DataFrame) -> DataFrame:
    months = daily.groupBy(F.col("year_month").alias("trend_period")).agg(
        F.sum("total_orders").alias("period_orders"), F.sum("completed_revenue").cast(MONEY).alias("period_revenue"),
        mean("avg_order_value").alias("period_avg_order_value"),
        F.sum("unique_customers").alias("period_unique_customers"),
        mean("completion_rate_pct").alias("period_completion_rate"))
    before = F.lag("period_orders").over(W.orderBy("trend_period"))
    return months.withColumn("prev_period_orders", before).withColumn(
        "period_growth_pct", pct(F.col("period_orders") - F.col("prev_period_orders"), "prev_period_orders"))


def order_trends(daily: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Daily and monthly rows in one table, keyed by ``(period_type, trend_period)``."""
    by_day = daily.select(
        "trend_date", F.lit("Daily").alias("period_type"), F.col("trend_date").cast("string").alias("trend_period"),
        F.col("total_orders").alias("period_orders"), F.col("completed_revenue").alias("period_revenue"),
        F.col("avg_order_value").alias("period_avg_order_value"),
        F.col("unique_customers").alias("period_unique_customers"),
        F.col("completion_rate_pct").cast(AVERAGE).alias("period_completion_rate"),
        F.col("daily_growth_pct").alias("period_growth_pct"), "season", "day_name", "day_type", "special_period",
        "performance_vs_7d", "revenue_performance", "daily_trend_pattern", "volume_tier",
        F.col("season").alias("seasonality_pattern"))
    by_month = order_trends_monthly(daily).drop("prev_period_orders").withColumns({
        "period_type": F.lit("Monthly"), "seasonality_pattern": F.lit("Monthly")})
    return by_day.unionByName(by_month, allowMissingColumns=True).withColumn(
        "analysis_updated_at", moment(loaded_at))


# --- customer behaviour -------------------------------------------------------------

def customer_purchases(orders: DataFrame) -> DataFrame:
    """Order history per customer, free of "today"; ``active_months`` via a month level first."""
    placed, amount = F.col("order_date"), F.col("order_amount")
    done = F.col("order_status") == L.COMPLETED
    dow = dow0(placed)
    monthly = orders.where(F.col("customer_key").isNotNull()).groupBy(
        "customer_key", F.trunc(F.to_date(placed), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), count_if(done).alias("completed"),
        F.min(placed).alias("first_at"), F.max(placed).alias("last_at"),
        F.sum(amount).alias("amount"), F.count(amount).alias("amounts"), sum_if(done, amount).alias("completed_amount"),
        F.min(amount).alias("low"), F.max(amount).alias("high"), F.sum("total_line_items").alias("items"),
        count_if(dow.isin(0, 6)).alias("weekend"), count_if(dow.between(1, 5)).alias("weekday"))
    in_season = {name: F.month("month").isin(*months) for name, months in L.SEASONS}
    return monthly.groupBy("customer_key").agg(
        F.sum("orders").alias("total_orders"), F.sum("completed").alias("completed_orders"),
        F.count(F.lit(1)).alias("active_months"),
        F.min("first_at").alias("first_purchase_date"), F.max("last_at").alias("last_purchase_date"),
        days_between(F.min("first_at"), F.max("last_at")).alias("customer_lifespan_days"),
        F.sum("amount").cast(MONEY).alias("total_spent"),
        F.sum("completed_amount").cast(MONEY).alias("total_completed_spent"),
        (F.sum("amount").cast(AVERAGE) / F.nullif(F.sum("amounts"), F.lit(0))).cast(AVERAGE).alias("avg_order_value"),
        F.min("low").alias("min_order_value"), F.max("high").alias("max_order_value"),
        F.sum("items").alias("total_items_purchased"),
        (F.sum("items").cast(AVERAGE) / F.sum("orders")).cast(AVERAGE).alias("avg_items_per_order"),
        F.sum("weekend").alias("weekend_orders"), F.sum("weekday").alias("weekday_orders"),
        *[F.coalesce(F.sum(F.when(hit, F.col("orders"))), F.lit(0)).alias(f"{name.lower()}_orders")
          for name, hit in in_season.items()])


def with_recency(purchases: DataFrame, as_of: dt.date) -> DataFrame:
    after = purchases.columns.index("customer_lifespan_days") + 1
    days = days_between("last_purchase_date", moment(as_of)).alias("days_since_last_purchase")
    return purchases.select(*purchases.columns[:after], days, *purchases.columns[after:])


def product_preferences(lines: DataFrame, products: DataFrame) -> DataFrame:
    """What each customer buys, from lines of completed orders.

    Levels: (customer, product) -> (customer, category) -> (customer, group) ->
    customer.  Each level pre-aggregates the next, so distinct counts are row counts
    and the favourite group needs no list of values.
    """
    done = lines.where(F.col("order_status") == L.COMPLETED)
    per_product = done.groupBy("customer_key", "product_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("unit_price").alias("prices"),
        F.min("unit_price").alias("low"), F.max("unit_price").alias("high"), F.sum("quantity").alias("quantity"),
        count_if(F.col("line_importance") == "Single Line Order").alias("single"),
        count_if(F.col("line_importance") == "Dominant Line").alias("dominant"))
    known = products.select("product_key", "category", "category_group", "price_tier", "is_limited_edition")
    carried = {"lines": F.sum, "prices": F.sum, "low": F.min, "high": F.max, "quantity": F.sum,
               "single": F.sum, "dominant": F.sum, "premium": F.sum, "limited": F.sum, "products": F.sum}

    def roll_up(frame: DataFrame, *keys: str, **extra) -> DataFrame:
        return frame.groupBy(*keys).agg(*[how(c).alias(c) for c, how in carried.items()],
                                        *[e.alias(n) for n, e in extra.items()])

    rich = per_product.join(known, "product_key").withColumns({
        "premium": F.when(F.col("price_tier").isin("Premium", "Luxury"), F.col("lines")).otherwise(0),
        "limited": F.when(F.col("is_limited_edition"), F.col("lines")).otherwise(0),
        "products": F.lit(1).cast("bigint")})
    by_category = roll_up(rich, "customer_key", "category_group", "category")
    by_group = roll_up(by_category, "customer_key", "category_group", categories=F.count("category"))
    favourite = F.min(F.struct((-F.col("lines")).alias("order"), F.col("category_group").alias("name")))["name"]
    return roll_up(by_group, "customer_key", groups=F.count("category_group"), all_categories=F.sum("categories"),
                   favourite=favourite).select(
        "customer_key", F.col("products").alias("unique_products_purchased"),
        F.col("all_categories").alias("unique_categories_purchased"),
        F.col("groups").alias("unique_category_groups_purchased"),
        (F.col("prices").cast(AVERAGE) / F.col("lines")).cast(AVERAGE).alias("avg_price_preference"),
        F.col("low").alias("min_price_purchased"), F.col("high").alias("max_price_purchased"),
        F.col("favourite").alias("preferred_category_group"),
        F.col("premium").alias("premium_purchases"), F.col("limited").alias("limited_edition_purchases"),
        F.col("quantity").alias("total_quantity_purchased"),
        (F.col("quantity").cast(AVERAGE) / F.col("lines")).cast(AVERAGE).alias("avg_quantity_per_line"),
        F.col("single").alias("single_line_orders"), F.col("dominant").alias("dominant_line_purchases"))


_PREFERENCES = ["unique_products_purchased", "unique_categories_purchased", "unique_category_groups_purchased",
                "avg_price_preference", "preferred_category_group", "premium_purchases",
                "limited_edition_purchases", "total_quantity_purchased", "avg_quantity_per_line",
                "single_line_orders", "dominant_line_purchases"]


def customer_behavior(purchases: DataFrame, preferences: DataFrame, customers: DataFrame,
                      as_of: dt.date, loaded_at: dt.datetime) -> DataFrame:
    bought = with_recency(purchases, as_of)
    liked = preferences.select("customer_key", *_PREFERENCES)
    people = customers.select("customer_key", "customer_id", "customer_name", "region", "tenure_segment",
                              F.col("customer_segment").alias("demographic_segment"))
    rows = bought.join(people, "customer_key").join(liked, "customer_key", "left")
    total, life = F.col("total_orders"), F.col("customer_lifespan_days")
    explored = F.col("unique_products_purchased")
    rated = rows.withColumns({
        # orders per 30 days; all orders count when first and last fall on one day
        "purchase_frequency_monthly": F.when(life > 0, ratio(total, life, 30)).otherwise(total.cast(MONEY)),
        # null, not 0, for customers without completed lines
        "product_exploration_ratio": ratio(explored, total),
        "weekend_preference_pct": pct("weekend_orders", total),
        "premium_preference_pct": pct("premium_purchases", explored)})
    best = F.greatest(*[F.col(f"{s}_orders") for s in L.SEASON_TIE_ORDER])
    favourite = F.coalesce(*[F.when(F.col(f"{s}_orders") == best, f"{s.title()} Shopper") for s in L.SEASON_TIE_ORDER],
                           F.lit("Year-Round Shopper"))
    classed = rated.withColumns({
        "behavioral_segment": by_rules(L.BEHAVIORAL_RULES, L.BEHAVIORAL_REST),
        "purchase_pattern": ladder("product_exploration_ratio", L.PURCHASE_PATTERN, L.PURCHASE_PATTERN_REST),
        "engagement_level": by_rules(L.ENGAGEMENT_RULES, L.ENGAGEMENT_REST),
        "value_tier": ladder("total_completed_spent", L.VALUE_TIER, L.VALUE_TIER_REST),
        "timing_preference": ladder("weekend_preference_pct", L.TIMING_PREFERENCE, L.TIMING_PREFERENCE_REST),
        "price_sensitivity": ladder("premium_preference_pct", L.PRICE_SENSITIVITY, L.PRICE_SENSITIVITY_REST),
        "seasonal_preference": favourite})
    return classed.withColumns({
        "marketing_persona": by_rules(L.PERSONA_RULES, L.PERSONA_REST),
        "churn_risk": by_rules(L.CHURN_RULES, L.CHURN_REST)}).select(
        "customer_key", "customer_id", *[c for c in bought.columns if c != "customer_key"], *_PREFERENCES,
        "purchase_frequency_monthly", "product_exploration_ratio", "weekend_preference_pct",
        "premium_preference_pct", "behavioral_segment", "purchase_pattern", "engagement_level", "value_tier",
        "timing_preference", "price_sensitivity", "seasonal_preference", "customer_name", "region",
        "tenure_segment", "demographic_segment", "marketing_persona", "churn_risk",
        moment(loaded_at).alias("analysis_updated_at"))


# --- product performance ------------------------------------------------------------

def product_sales(lines: DataFrame) -> DataFrame:
    """Sales per product.

    Sums combine in the map tasks.  The three distinct counts each come from their
    own pair of columns, which shuffles three narrow pair sets instead of every line
    four times.  Lines that have the ids are counted by them: a key is the text of 32 digits made from its id.
    """
    key = ["product_key", "product_id"]
    status, line, importance = F.col("order_status"), F.col("line_total"), F.col("line_importance")
    sums = lines.groupBy(*key).agg(
        F.count(F.lit(1)).alias("total_order_lines"), F.sum("quantity").alias("total_quantity_sold"),
        F.sum(line).cast(MONEY).alias("total_revenue"),
        *[sum_if(status == s, line).cast(MONEY).alias(f"{s}_revenue") for s in (L.COMPLETED, L.REFUNDED, L.CANCELLED)],
        mean(line).alias("avg_line_value"), mean("unit_price").alias("avg_selling_price"),
        mean("quantity").alias("avg_quantity_per_line"),
        mean("line_percentage_of_order").alias("avg_order_contribution_pct"),
        *[count_if(importance == label).alias(name) for name, label in
          zip(["single_line_orders", "dominant_lines", "major_lines", "minor_lines"], L.LINE_IMPORTANCES)],
        F.min("order_date").alias("first_sale_date"), F.max("order_date").alias("last_sale_date"),
        count_if(F.col("is_first_line_item")).alias("times_first_in_order"),
        mean("item_sequence").alias("avg_position_in_order"))

    by_id = {"order_id", "customer_id"} <= set(lines.columns)
    product, counted = ("product_id", ("order_id", "customer_id")) if by_id else ("product_key", ("order_key", "customer_key"))

    def distinct(column: str, name: str) -> DataFrame:
        pairs = lines.select(product, column).where(F.col(column).isNotNull()).distinct()
        return pairs.groupBy(product).agg(F.count(F.lit(1)).alias(name))

    out = sums
    for column, name in zip((*counted, "order_date_key"), ("unique_orders", "unique_customers", "selling_days")):
        out = out.join(distinct(column, name), product, "left")
    return out.select(
        *key, "total_order_lines", "unique_orders", "unique_customers", "total_quantity_sold", "total_revenue",
        "completed_revenue", "refunded_revenue", "cancelled_revenue", "avg_line_value", "avg_selling_price",
        "avg_quantity_per_line", "avg_order_contribution_pct", "single_line_orders", "dominant_lines",
        "major_lines", "minor_lines", "first_sale_date", "last_sale_date", "selling_days",
        "times_first_in_order", "avg_position_in_order")


_PRODUCT_DETAILS = ["product_name", "category", "category_group", "catalog_price", "price_tier",
                    "detailed_price_tier", "price_decile", "price_quartile", "category_position", "is_active",
                    "is_limited_edition", "is_premium_line", "is_classic_line", "product_created_at"]


def product_details(sales: DataFrame, products: DataFrame, as_of: dt.date) -> DataFrame:
    named = {"price": "catalog_price", "created_at": "product_created_at"}
    details = products.select("product_key", *[F.col(src).alias(out) for src, out in named.items()],
                              *[c for c in _PRODUCT_DETAILS if c not in named.values()])
    age = F.datediff(F.lit(as_of), F.to_date("product_created_at"))
    per_day = (F.col("completed_revenue").cast(AVERAGE) / F.when(age > 0, age)).cast(AVERAGE)
    return sales.join(details, "product_key").select(
        *sales.columns, *_PRODUCT_DETAILS,
        pct("refunded_revenue", "completed_revenue").alias("refund_rate_pct"),
        pct("completed_revenue", "total_revenue").alias("completion_rate_pct"),
        pct("avg_selling_price", "catalog_price", AVERAGE).alias("price_realization_pct"),
        age.alias("days_since_launch"),
        F.when(age > 0, per_day).otherwise(zero(AVERAGE)).alias("revenue_per_day_since_launch"))


def product_rankings(detailed: DataFrame) -> DataFrame:
    """Ranks and bands from three range passes: by revenue, by volume and by reach.

    ``detailed`` is read once per pass and once for the result; hand in a stored frame.
    """
    key = "product_id"
    revenue = rank_rows(detailed, key, "completed_revenue", ["category_group", "price_tier"])
    volume = rank_rows(detailed, key, "total_quantity_sold", ["category_group"])
    reach = rank_rows(detailed, key, "unique_customers", ["category_group"])

    def down(scope: str = ""):
        # rank from the top, ties in reverse order of the key
        return (F.col(f"n{scope}") - F.col(f"pos{scope}") + 1).cast("int")

    group, tier = "_in_category_group", "_in_price_tier"
    ranked = [
        revenue.select(key, down().alias("revenue_rank_overall"), down(group).alias("revenue_rank_in_category"),
                       down(tier).alias("revenue_rank_in_price_tier"),
                       ntile_of("pos", "n", 10).alias("revenue_decile"),
                       ntile_of("pos", "n", 4).alias("revenue_quartile")),
        volume.select(key, down().alias("volume_rank_overall"), down(group).alias("volume_rank_in_category"),
                      ntile_of("pos", "n", 10).alias("volume_decile")),
        reach.select(key, down().alias("customer_reach_rank"), down(group).alias("customer_reach_rank_in_category"),
                     ntile_of("pos", "n", 4).alias("customer_reach_quartile")),
    ]
    return reduce(lambda left, right: left.join(right, key), ranked, detailed)


def product_performance(sales: DataFrame, products: DataFrame, as_of: dt.date, loaded_at: dt.datetime) -> DataFrame:
    # one row per sold product; stored because three ranking passes and the result read it
    detailed = pinned(product_details(sales, products, as_of))
    ranked = product_rankings(detailed)
    behavior = None
    for name, tenths, label in L.PURCHASE_BEHAVIOR:
        hit = F.col(name) * 10 >= F.col("total_order_lines") * tenths
        behavior = F.when(hit, label) if behavior is None else behavior.when(hit, label)
    return ranked.withColumns({
        "performance_tier": by_rules(L.PERFORMANCE_RULES, L.PERFORMANCE_REST),
        "revenue_contribution_tier": by_rules(L.CONTRIBUTION_RULES, L.LOWEST_QUARTER),
        "customer_penetration_tier": ladder("customer_reach_quartile", L.PENETRATION, L.PENETRATION_REST),
        "lifecycle_stage": ladder("days_since_launch", L.LIFECYCLE, L.LIFECYCLE_REST, "<="),
        "pricing_strategy": ladder("price_realization_pct", L.PRICING_STRATEGY, L.PRICING_STRATEGY_REST),
        "purchase_behavior": behavior.otherwise(L.PURCHASE_BEHAVIOR_REST),
        "analysis_updated_at": moment(loaded_at)})
