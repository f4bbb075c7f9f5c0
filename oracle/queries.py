"""Expected results of the registered queries, as DuckDB SQL."""

from __future__ import annotations

from oracle.sql import AS_OF, block, columns, compose, date_key, early_blocks, ladder, quote, rdiv
from oracle import values as L
from oracle.suite import SUITE

ORACLE: dict[str, str] = {}


def table(name: str, source: str, spec: str) -> None:
    """A query that shows one block; ``source`` may add a WHERE clause."""
    ORACLE[name] = compose(f"SELECT {columns(spec)} FROM {source}", source.split()[0])


# --- whole tables (i whole number, m cents or hundredths, a units of 1e-8) ----------

table("raw_customers", "s_customers", """
    id:i name email country signup_date created_at
""")

table("raw_products", "goods", """
    id:i name category price:m created_at
""")

table("raw_orders", "log", """
    record_id:i order_id customer_id:i order_date status total_amount:m created_at
""")

table("raw_order_items", "lines", """
    id:i order_id product_id:i quantity:i unit_price:m created_at
""")

table("stg_customers", "s_customers", """
    id:i name email signup_date country created_at signup_year:i signup_month:i signup_day_of_week:i
    customer_tenure_days:i region
""")

table("stg_products", "s_products", """
    id:i name category price:m created_at product_year:i product_month:i price_tier detailed_price_tier
    category_group category_sort_order:i seasonality collection_type name_length:i is_limited_edition
    is_premium_line is_classic_line is_active is_discontinued
""")

table("stg_orders", "s_orders", """
    record_id:i order_id customer_id:i order_date status total_amount:m created_at status_sequence:i
    is_current_status created_year:i created_month:i created_day_of_week:i
""")

table("stg_order_items", "s_items", """
    id:i order_id product_id:i quantity:i unit_price:m line_total:m created_at created_year:i created_month:i
    created_day:i created_day_of_week:i created_hour:i price_tier quantity_category line_value_tier
    item_sequence:i
""")

block("d_date_orders", "d_date log", """
SELECT d.*, coalesce(placed, 0) AS orders_placed, coalesce(changed, 0) AS status_changes
FROM d_date d
LEFT JOIN (SELECT CAST(order_date AS DATE) AS day, count(DISTINCT order_id) AS placed FROM log GROUP BY 1) p ON p.day = calendar_date
LEFT JOIN (SELECT CAST(created_at AS DATE) AS day, count(*) AS changed FROM log GROUP BY 1) c ON c.day = calendar_date""")
table("dim_date", "d_date_orders", """
    date_key:i calendar_date year:i quarter:i month:i day:i day_of_week:i day_of_year:i week_of_year:i year_text
    year_month year_quarter month_name month_short_name day_name day_short_name is_weekday is_weekend
    is_first_day_of_month is_last_day_of_month is_first_day_of_quarter is_last_day_of_quarter
    is_first_day_of_year is_last_day_of_year relative_period season orders_placed:i status_changes:i
""")

table("dim_customer", "d_customer", """
    customer_key customer_id:i customer_name email signup_date country region region_code created_at
    customer_tenure_days:i tenure_segment tenure_quartile:i signup_year:i signup_month:i signup_day_of_week:i
    signup_timing signup_season customer_segment is_current_customer churn_risk_segment
""")

table("dim_product", "d_product", """
    product_key product_id:i product_name category price:m created_at product_year:i product_month:i price_tier
    detailed_price_tier category_group category_sort_order:i seasonality collection_type name_length:i
    is_limited_edition is_premium_line is_classic_line is_active is_discontinued dim_version:i price_decile:i
    price_quartile:i price_rank_in_category:i category_position overall_price_position
""")

table("product_price_bands", "d_product", """
    product_id:i price_decile:i price_quartile:i price_rank_in_category:i category_position
    overall_price_position
""")

table("order_items_agg", "item_totals", """
    order_id total_line_items:i total_quantity:i calculated_total_amount:m avg_unit_price:a min_unit_price:m
    max_unit_price:m unique_products_count:i
""")

table("latest_order_status", "s_orders WHERE is_current_status", """
    record_id:i order_id customer_id:i order_date status total_amount:m created_at
""")

table("fact_orders", "f_orders", """
    order_key order_id customer_key order_date_key:i order_amount:m calculated_total_amount:m total_line_items:i
    total_quantity:i unique_products_count:i avg_unit_price:a min_unit_price:m max_unit_price:m
    order_size_category product_variety order_status order_date status_updated_at is_pending is_completed
    is_cancelled is_refunded order_year:i order_month:i order_quarter:i order_day_of_week:i order_hour:i
    order_timing order_time_of_day avg_amount_per_line:a avg_amount_per_item:a
""")

table("fact_order_line", "f_lines", """
    order_line_key order_line_id:i order_key customer_key product_key order_date_key:i order_id product_id:i
    customer_id:i quantity:i unit_price:m line_total:m item_sequence:i quantity_category line_price_tier
    line_value_tier additional_quantity_value:m is_first_line_item order_date order_status order_total_amount:m
    line_percentage_of_order:a line_importance quantity_category_detailed unit_price_category order_year:i
    order_month:i order_quarter:i order_day_of_week:i is_from_pending_order is_from_completed_order
    is_from_cancelled_order is_from_refunded_order recognized_revenue:m refunded_amount:m historical_revenue:m
    line_created_at
""")

table("fact_orders_scd2", "f_history", """
    order_key order_id status_change_sequence:i customer_key order_date_key:i status_effective_date_key:i
    order_status status_effective_date status_end_date is_current_status status_duration_hours:a order_amount:m
    calculated_total_amount:m total_line_items:i total_quantity:i unique_products_count:i avg_unit_price:a
    min_unit_price:m max_unit_price:m order_size_category product_variety order_date is_pending is_completed
    is_cancelled is_refunded is_items_added order_year:i order_month:i order_quarter:i order_day_of_week:i
    order_hour:i order_timing order_time_of_day status_change_year:i status_change_month:i status_change_hour:i
    status_change_timing avg_amount_per_line:a avg_amount_per_item:a status_lifecycle_stage
    hours_to_completion:a hours_to_cancellation:a
""")

table("scd2_current_snapshot", "f_history WHERE is_current_status", """
    order_id order_status status_effective_date order_amount:m total_line_items:i
""")

table("scd2_order_history", "f_history", """
    order_id status_change_sequence:i order_status status_effective_date status_end_date status_duration_hours:a
    status_lifecycle_stage
""")

table("metric_daily_orders", "m_orders", """
    date_key:i order_date year:i month:i quarter:i day_of_week:i year_month day_name day_type total_orders:i
    completed_orders:i pending_orders:i cancelled_orders:i refunded_orders:i items_added_orders:i
    total_revenue:m completed_revenue:m pending_revenue:m cancelled_revenue:m refunded_revenue:m
    avg_order_value:a median_order_value:m min_order_value:m max_order_value:m unique_customers:i
    customers_with_completed_orders:i total_line_items:i total_quantity_sold:i total_unique_products_ordered:i
    avg_line_items_per_order:a avg_quantity_per_order:a single_item_orders:i small_orders:i medium_orders:i
    large_orders:i all_unique_product_orders:i single_product_orders:i mixed_product_orders:i weekend_orders:i
    weekday_orders:i morning_orders:i afternoon_orders:i evening_orders:i night_orders:i daily_status_changes:i
    daily_completions:i daily_cancellations:i daily_items_added:i completion_rate_pct:m cancellation_rate_pct:m
    refund_rate_pct:m items_added_rate_pct:m revenue_refund_rate_pct:m orders_per_customer_ratio:m
    weekend_order_pct:m daily_activity_rate_pct:m completion_conversion_rate_pct:m
    cancellation_conversion_rate_pct:m avg_7d_status_changes:m avg_7d_activity_rate_pct:m avg_7d_total_orders:m
    avg_7d_completed_orders:m avg_7d_total_revenue:m avg_7d_completed_revenue:m avg_7d_completion_rate_pct:m
    avg_7d_cancellation_rate_pct:m total_orders_change_1d:i completed_orders_change_1d:i
    total_revenue_change_1d:m completion_rate_change_1d:m status_changes_change_1d:i
""")

table("daily_customer_acquisition", "acquisition", """
    metric_date new_customers_acquired:i new_na_customers:i new_eu_customers:i new_apac_customers:i
    new_other_customers:i weekend_signups:i weekday_signups:i date_key:i
""")

table("metric_daily_customers", "m_customers", """
    metric_date date_key:i metric_year:i metric_month:i year_month active_customers:i
    customers_with_completed_orders:i customers_with_cancelled_orders:i total_customer_spend:m
    avg_spend_per_customer:a highest_customer_spend:m avg_items_per_customer:a avg_quantity_per_customer:a
    total_orders_by_customers:i premium_loyal_customers:i core_customers:i growing_customers:i new_customers:i
    na_customers:i eu_customers:i apac_customers:i other_region_customers:i new_customers_acquired:i
    new_na_customers:i new_eu_customers:i new_apac_customers:i new_other_customers:i weekend_signups:i
    weekday_signups:i completion_rate_by_customers_pct:m avg_orders_per_active_customer:m weekend_signup_pct:m
    mtd_new_customers:i mtd_total_active_customers:i avg_active_customers_7d:a avg_new_customers_7d:a
    avg_customer_spend_7d:a prev_day_active_customers:i prev_day_new_customers:i
""")

table("metric_daily_products", "m_products", """
    metric_date date_key:i metric_year:i metric_month:i year_month unique_products_sold:i total_line_items:i
    total_quantity_sold:i total_product_revenue:m completed_product_revenue:m refunded_product_revenue:m
    min_unit_price:m max_unit_price:m clothing_products_sold:i accessories_products_sold:i
    footwear_products_sold:i intimates_products_sold:i activewear_products_sold:i clothing_revenue:m
    accessories_revenue:m footwear_revenue:m intimates_revenue:m activewear_revenue:m budget_items_sold:i
    midrange_items_sold:i premium_items_sold:i luxury_items_sold:i budget_revenue:m midrange_revenue:m
    premium_revenue:m luxury_revenue:m single_item_lines:i pair_lines:i multiple_item_lines:i
    single_line_orders:i dominant_lines:i major_lines:i minor_lines:i avg_unit_price:a avg_line_total:a
    median_unit_price:m product_variety_pct:m revenue_completion_rate_pct:m revenue_refund_rate_pct:m
    avg_quantity_per_line:m clothing_revenue_pct:m accessories_revenue_pct:m footwear_revenue_pct:m
    premium_luxury_items_pct:m premium_luxury_revenue_pct:m mtd_product_revenue:m mtd_quantity_sold:i
    avg_product_revenue_7d:a avg_unique_products_7d:a avg_quantity_sold_7d:a prev_day_revenue:m
    prev_day_unique_products:i prev_day_quantity:i wow_revenue:m wow_unique_products:i
""")

table("metrics_dashboard", "board", """
    metric_date date_key:i year_month metric_year:i metric_month:i active_customers:i new_customers_acquired:i
    total_orders:i completed_orders:i total_revenue:m completed_revenue:m avg_order_value:a
    unique_products_sold:i customer_acquisition_rate_pct:m customer_completion_rate_pct:m
    revenue_per_active_customer:m avg_orders_per_active_customer:m premium_core_customer_pct:m
    customer_order_conversion_pct:m order_completion_rate_pct:m order_cancellation_rate_pct:m
    order_refund_rate_pct:m overall_fulfillment_rate_pct:m products_per_order_ratio:m product_variety_pct:m
    premium_luxury_revenue_pct:m weekend_order_pct:m net_revenue_success_pct:m
    completed_revenue_per_ordering_customer:m avg_unit_price:a clothing_revenue_pct:m accessories_revenue_pct:m
    footwear_revenue_pct:m customer_growth_vs_7d_avg_pct:m revenue_growth_vs_7d_avg_pct:m
    order_growth_vs_7d_avg_pct:m avg_active_customers_7d:a avg_revenue_7d:m avg_orders_7d:m
    customer_health_score:i order_health_score:i revenue_health_score:i growth_health_score:i
    business_health_score:i business_health_grade primary_alert primary_opportunity
""")

table("order_trends_daily", "trend_days", """
    trend_date total_orders:i completed_orders:i total_revenue:m completed_revenue:m avg_order_value:a
    unique_customers:i total_line_items:i avg_items_per_order:a completion_rate_pct:m trend_year:i trend_month:i
    trend_quarter:i day_of_week:i year_month year_quarter orders_7d_avg:a revenue_7d_avg:a orders_30d_avg:a
    revenue_30d_avg:a prev_day_orders:i prev_week_orders:i prev_month_orders:i prev_day_revenue:m
    prev_week_revenue:m prev_month_revenue:m daily_growth_pct:m weekly_growth_pct:m monthly_growth_pct:m season
    day_name day_type special_period performance_vs_7d revenue_performance volume_tier daily_trend_pattern
""")

table("order_trends_monthly", "trend_months", """
    trend_period period_orders:i period_revenue:m period_avg_order_value:a period_unique_customers:i
    period_completion_rate:a prev_period_orders:i period_growth_pct:m
""")

table("order_trends", "trends", """
    trend_date period_type trend_period period_orders:i period_revenue:m period_avg_order_value:a
    period_unique_customers:i period_completion_rate:a period_growth_pct:m season day_name day_type
    special_period performance_vs_7d revenue_performance daily_trend_pattern volume_tier seasonality_pattern
""")

table("customer_purchase_behavior", "bought", """
    customer_key total_orders:i completed_orders:i active_months:i first_purchase_date last_purchase_date
    customer_lifespan_days:i days_since_last_purchase:i total_spent:m total_completed_spent:m avg_order_value:a
    min_order_value:m max_order_value:m total_items_purchased:i avg_items_per_order:a weekend_orders:i
    weekday_orders:i winter_orders:i spring_orders:i summer_orders:i fall_orders:i
""")

table("customer_behavior", "behavior", """
    customer_key customer_id:i total_orders:i completed_orders:i active_months:i first_purchase_date
    last_purchase_date customer_lifespan_days:i days_since_last_purchase:i total_spent:m total_completed_spent:m
    avg_order_value:a min_order_value:m max_order_value:m total_items_purchased:i avg_items_per_order:a
    weekend_orders:i weekday_orders:i winter_orders:i spring_orders:i summer_orders:i fall_orders:i
    unique_products_purchased:i unique_categories_purchased:i unique_category_groups_purchased:i
    avg_price_preference:a preferred_category_group premium_purchases:i limited_edition_purchases:i
    total_quantity_purchased:i avg_quantity_per_line:a single_line_orders:i dominant_line_purchases:i
    purchase_frequency_monthly:m product_exploration_ratio:m weekend_preference_pct:m premium_preference_pct:m
    behavioral_segment purchase_pattern engagement_level value_tier timing_preference price_sensitivity
    seasonal_preference customer_name region tenure_segment demographic_segment marketing_persona churn_risk
""")

table("product_sales", "sales", """
    product_key product_id:i total_order_lines:i unique_orders:i unique_customers:i total_quantity_sold:i
    total_revenue:m completed_revenue:m refunded_revenue:m cancelled_revenue:m avg_line_value:a
    avg_selling_price:a avg_quantity_per_line:a avg_order_contribution_pct:a single_line_orders:i
    dominant_lines:i major_lines:i minor_lines:i first_sale_date last_sale_date selling_days:i
    times_first_in_order:i avg_position_in_order:a
""")

table("product_performance", "performance", """
    product_id:i product_key total_order_lines:i unique_orders:i unique_customers:i total_quantity_sold:i
    total_revenue:m completed_revenue:m refunded_revenue:m cancelled_revenue:m avg_line_value:a
    avg_selling_price:a avg_quantity_per_line:a avg_order_contribution_pct:a single_line_orders:i
    dominant_lines:i major_lines:i minor_lines:i first_sale_date last_sale_date selling_days:i
    times_first_in_order:i avg_position_in_order:a product_name category category_group catalog_price:m
    price_tier detailed_price_tier price_decile:i price_quartile:i category_position is_active
    is_limited_edition is_premium_line is_classic_line product_created_at refund_rate_pct:m
    completion_rate_pct:m price_realization_pct:m days_since_launch:i revenue_per_day_since_launch:a
    revenue_rank_overall:i revenue_rank_in_category:i revenue_rank_in_price_tier:i revenue_decile:i
    revenue_quartile:i volume_rank_overall:i volume_rank_in_category:i volume_decile:i customer_reach_rank:i
    customer_reach_rank_in_category:i customer_reach_quartile:i performance_tier revenue_contribution_tier
    customer_penetration_tier lifecycle_stage pricing_strategy purchase_behavior
""")

# --- daily tables whose calendar columns are derived here ---------------------------

ORACLE["daily_customer_activity"] = compose(
    f"SELECT {date_key('metric_date')} AS date_key, year(metric_date) AS metric_year, month(metric_date) AS metric_month, "
    "strftime(metric_date, '%Y-%m') AS year_month, " + columns("""
    metric_date active_customers:i customers_with_completed_orders:i customers_with_cancelled_orders:i
    total_customer_spend:m avg_spend_per_customer:a highest_customer_spend:m avg_items_per_customer:a
    avg_quantity_per_customer:a total_orders_by_customers:i premium_loyal_customers:i core_customers:i
    growing_customers:i new_customers:i na_customers:i eu_customers:i apac_customers:i other_region_customers:i
    """) + " FROM activity", "activity")
ORACLE["daily_metrics"] = compose(
    "SELECT CAST(date_key AS BIGINT) AS date_key, metric_date, year(metric_date) AS year, month(metric_date) AS month, "
    "quarter(metric_date) AS quarter, year_month, metric_domain, metric_name, metric_value, dimension_type, "
    "dimension_value FROM long_metrics", "long_metrics")
ORACLE["customer_product_preferences"] = compose(
    "SELECT " + columns("""customer_key unique_products_purchased:i unique_categories_purchased:i
    unique_category_groups_purchased:i avg_price_preference:a preferred_category_group premium_purchases:i
    limited_edition_purchases:i total_quantity_purchased:i avg_quantity_per_line:a single_line_orders:i
    dominant_line_purchases:i min_price_purchased:m max_price_purchased:m""") + """
    FROM liked JOIN (SELECT customer_key, min(unit_price) AS min_price_purchased, max(unit_price) AS max_price_purchased
                     FROM f_lines WHERE order_status = 'completed' GROUP BY 1) USING (customer_key)""", "liked", "f_lines")

# --- reports over the status history ------------------------------------------------

_DONE = "f_history WHERE order_status = 'completed' AND hours_to_completion IS NOT NULL"
ORACLE["scd2_completion_by_size"] = compose(f"""
SELECT order_size_category, count(*) AS completed_orders,
       CAST({rdiv('sum(hours_to_completion)', 'count(*)')} AS DOUBLE) / 1e8 AS avg_hours_to_completion,
       CAST(min(hours_to_completion) AS DOUBLE) / 1e8 AS min_hours_to_completion,
       CAST(max(hours_to_completion) AS DOUBLE) / 1e8 AS max_hours_to_completion
FROM {_DONE} GROUP BY 1""", "f_history")
ORACLE["scd2_status_dwell"] = compose(f"""
SELECT order_status, count(DISTINCT order_id) AS unique_orders, count(*) AS total_status_instances,
       CAST({rdiv('sum(status_duration_hours)', 'count(*)')} AS DOUBLE) / 1e8 AS avg_duration_hours
FROM f_history WHERE status_end_date IS NOT NULL GROUP BY 1""", "f_history")
ORACLE["scd2_daily_changes"] = compose(f"""
SELECT CAST(status_effective_date AS DATE) AS change_date, order_status, count(*) AS status_changes,
       count(DISTINCT order_id) AS unique_orders_affected
FROM f_history WHERE status_effective_date >= {AS_OF} - INTERVAL 30 DAY GROUP BY ALL""", "f_history")
_JOURNEY = """
SELECT order_id, count(*) AS total_status_changes,
       string_agg(order_status, ' → ' ORDER BY status_change_sequence) AS status_journey
FROM f_history GROUP BY order_id HAVING status_journey LIKE '{}'"""
ORACLE["scd2_status_journey"] = compose(_JOURNEY.format("%pending%cancelled%"), "f_history")
ORACLE["scd2_items_added_then_cancelled"] = compose(_JOURNEY.format("%items added%cancelled%"), "f_history")
ORACLE["scd2_completion_speed"] = compose(f"""
SELECT {ladder('hours_to_completion', L.COMPLETION_SPEED, L.COMPLETION_SPEED_REST, '<=', 10**8)} AS completion_speed,
       count(*) AS order_count, CAST({rdiv('sum(order_amount) * 1000000', 'count(*)')} AS DOUBLE) / 1e8 AS avg_order_value,
       CAST(sum(order_amount) AS DOUBLE) / 100 AS total_revenue
FROM {_DONE} GROUP BY 1""", "f_history")
ORACLE["daily_status_population"] = compose("""
SELECT day AS metric_date, order_status, count(*) AS orders, CAST(sum(order_amount) AS DOUBLE) / 100 AS amount
FROM held GROUP BY ALL""", "held")

ORACLE["orders_open_at_item_events"] = compose("""
SELECT i.id, min(i.order_id) AS order_id, count(*) AS open_orders, CAST(sum(h.order_amount) AS DOUBLE) / 100 AS open_amount,
       min(h.status_effective_date) AS open_since
FROM lines i JOIN (SELECT DISTINCT order_id, customer_id FROM log) o USING (order_id)
JOIN f_history h ON h.customer_id = o.customer_id AND h.order_id <> i.order_id AND h.order_status IN ('pending', 'items added')
 AND h.status_effective_date <= i.created_at AND (h.status_end_date IS NULL OR h.status_end_date > i.created_at)
GROUP BY i.id""", "lines", "log", "f_history")

# --- two loads give what one load gives ---------------------------------------------

ORACLE["incremental_merge_orders"] = ORACLE["raw_orders"]
ORACLE["scd2_incremental"] = ORACLE["fact_orders_scd2_bucketed"] = ORACLE["fact_orders_scd2"]
for _name in ("metric_daily_orders", "metric_daily_customers", "metric_daily_products", "daily_metrics", "customer_behavior",
              "product_sales"):
    ORACLE[f"{_name}_incremental"] = ORACLE[_name]

# What the second load changes in the long table: all rows against those of the blocks over what was there at the first.
_FIRST_LOAD = "TIMESTAMP '2000-07-01'"
_EARLY = early_blocks("long_metrics", _FIRST_LOAD, "DATE '2000-07-01'")
_LONG = ("date_key", "metric_domain", "metric_name", "dimension_type", "dimension_value")
ORACLE["daily_metrics_changes"] = compose(f"""
SELECT CAST(date_key AS BIGINT) AS date_key, metric_date, year(metric_date) AS year, month(metric_date) AS month,
       quarter(metric_date) AS quarter, year_month, metric_domain, metric_name, metric_value, dimension_type, dimension_value, change
FROM (SELECT n.*, CASE WHEN o.date_key IS NULL THEN 'insert' ELSE 'update' END AS change
      FROM long_metrics n LEFT JOIN {_EARLY} o USING ({', '.join(_LONG)})
      WHERE o.date_key IS NULL OR n.metric_value <> o.metric_value
      UNION ALL
      SELECT o.*, 'delete' FROM {_EARLY} o ANTI JOIN long_metrics n USING ({', '.join(_LONG)}))""", "long_metrics", _EARLY)

# --- source tables ------------------------------------------------------------------

_COUNTED = {"source_customers": "people", "source_products": "goods", "source_orders": "log",
            "source_order_items": "lines"}
ORACLE["table_stats"] = compose(" UNION ALL ".join(
    f"SELECT {quote(t)} AS table_name, count(*) AS row_count FROM {b}" for t, b in _COUNTED.items()), *_COUNTED.values())

# --- quality report: every check in the plainest form -------------------------------

_STAMP = f"CAST({AS_OF} AS TIMESTAMP)"
block("q_source_orders", "log", "SELECT *, order_id AS id FROM log")
block("q_dim_customer", "d_customer", f"SELECT *, {_STAMP} AS created_at_dim, {_STAMP} AS updated_at_dim FROM d_customer")
block("q_dim_product", "d_product", f"SELECT *, {_STAMP} AS dim_created_at, {_STAMP} AS dim_updated_at FROM d_product")
_QUALITY_BLOCK = {
    "source_customers": "s_customers", "source_products": "goods", "source_orders": "q_source_orders",
    "source_order_items": "lines", "raw_customers": "s_customers", "raw_products": "goods", "raw_orders": "log",
    "raw_order_items": "lines", "stg_customers": "s_customers", "stg_products": "s_products", "stg_orders": "s_orders",
    "stg_order_items": "s_items", "dim_date": "d_date", "dim_product": "q_dim_product",
    "dim_customer": "q_dim_customer", "fact_orders": "f_orders", "fact_order_line": "f_lines",
    "fact_orders_scd2": "f_history", "daily_metrics": "long_metrics", "analysis_metrics_dashboard": "board",
    "analysis_customer_behavior": "behavior", "analysis_order_trends": "trends",
    "analysis_product_performance": "performance",
}
_ALL_COLUMNS = {
    "dim_date": """date_key calendar_date year quarter month day day_of_week day_of_year week_of_year year_text
        year_month year_quarter month_name month_short_name day_name day_short_name is_weekday is_weekend
        is_first_day_of_month is_last_day_of_month is_first_day_of_quarter is_last_day_of_quarter is_first_day_of_year
        is_last_day_of_year relative_period season""".split(),
    "dim_customer": """customer_key customer_id customer_name email signup_date country region region_code created_at
        customer_tenure_days tenure_segment tenure_quartile signup_year signup_month signup_day_of_week signup_timing
        signup_season customer_segment is_current_customer churn_risk_segment created_at_dim updated_at_dim""".split(),
}


def _quality() -> str:
    def line(t, test, column, failures):
        return (f"SELECT {quote(t)} AS table_name, {quote(test)} AS test, {quote(column)} AS column_name, "
                f"CAST(({failures}) AS BIGINT) AS failures")

    parts = []
    for t, e in SUITE.items():
        b = _QUALITY_BLOCK[t]
        rows = f"SELECT count(*) FROM {b} WHERE "

        def repeats(key):
            return f"SELECT count(*) FROM (SELECT {key} FROM {b} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"

        parts += [line(t, "not_null", c, rows + f"{c} IS NULL") for c in e.required_columns(_ALL_COLUMNS.get(t, []))]
        parts += [line(t, "accepted_values", c, rows + f"{c} NOT IN ({', '.join(map(quote, v))})")
                  for c, v in e.accepted.items()]
        for c, (low, high, inclusive) in e.ranges.items():
            bad = [f"{c} {'<' if inclusive else '<='} {low}"] if low is not None else []
            bad += [f"{c} {'>' if inclusive else '>='} {high}"] if high is not None else []
            parts.append(line(t, "accepted_range", c, rows + f"({' OR '.join(bad)})"))
        parts += [line(t, "unique", c, repeats(c)) for c in e.unique.split()]
        parts += [line(t, "unique", "-".join(g), repeats(f"concat_ws('-', {', '.join(g)})")) for g in e.unique_text]
        parts += [line(t, "unique_combination", "-".join(g), repeats(f"({', '.join(g)})")) for g in e.unique_together]
        parts += [line(t, "relationships", c, f"SELECT count(*) FROM {b} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                       f"(SELECT 1 FROM {_QUALITY_BLOCK[parent]} y WHERE y.{f} = x.{c})")
                  for c, (parent, f) in e.references.items()]
    return "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


_USED = list(dict.fromkeys(_QUALITY_BLOCK.values()))
ORACLE["dq_report"] = compose(_quality(), *_USED)
_GATED = ["raw_customers", "raw_products", "raw_orders", "raw_order_items", "dim_date", "dim_customer", "dim_product", "fact_orders",
          "fact_order_line", "fact_orders_scd2"]
ORACLE["dq_gate"] = compose(f"SELECT * FROM ({_quality()}) WHERE table_name IN ({', '.join(map(quote, _GATED))})", *_USED)
