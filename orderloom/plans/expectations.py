"""The declared data-quality suite, table by table."""

from __future__ import annotations

from orderloom.functions import labels as L
from orderloom.operators.quality import Expectations as E

POSITIVE, NOT_NEGATIVE, AT_LEAST_ONE = (0, None, False), (0, None, True), (1, None, True)
QUARTERS, MONTHS, WEEKDAYS = (1, 4, True), (1, 12, True), (0, 6, True)
SEASONS = [name for name, _ in L.SEASONS]
GROUPS = L.CATEGORY_GROUPS + [L.DEFAULT_CATEGORY_GROUP]
CATALOGUE = L.metric_catalogue()


def _once(values) -> list[str]:
    return list(dict.fromkeys(values))


SUITE = {
    "source_customers": E("id email name signup_date country created_at", "id email"),
    "source_products": E("id name category price created_at", "id", ranges={"price": POSITIVE}),
    "source_orders": E("record_id id customer_id order_date status total_amount created_at", "record_id",
                       accepted={"status": L.HISTORY_STATUSES}, ranges={"total_amount": NOT_NEGATIVE},
                       references={"customer_id": ("source_customers", "id")}),
    "source_order_items": E("id order_id product_id quantity unit_price created_at", "id",
                            ranges={"quantity": AT_LEAST_ONE, "unit_price": POSITIVE},
                            references={"order_id": ("source_orders", "id"), "product_id": ("source_products", "id")}),
    "raw_customers": E("id email name signup_date country", "id email"),
    "raw_products": E("id name category price", "id", ranges={"price": POSITIVE}),
    "raw_orders": E("record_id order_id customer_id status", "record_id", accepted={"status": L.HISTORY_STATUSES},
                    references={"customer_id": ("raw_customers", "id")}),
    "raw_order_items": E("id order_id product_id quantity unit_price", "id",
                         ranges={"quantity": AT_LEAST_ONE, "unit_price": POSITIVE},
                         references={"product_id": ("raw_products", "id")}),
    "stg_customers": E("id email name signup_date country region", "id email", accepted={
        "region": ["north america", "europe", "asia pacific", "south america", "africa", "other"]}),
    "stg_products": E("id name category price price_tier category_group", "id",
                      accepted={"price_tier": L.PRICE_TIERS, "category_group": GROUPS}, ranges={"price": POSITIVE}),
    "stg_orders": E("record_id order_id customer_id status is_current_status", "record_id",
                    accepted={"status": L.HISTORY_STATUSES}, references={"customer_id": ("stg_customers", "id")}),
    "stg_order_items": E("id order_id product_id quantity unit_price line_total", "id",
                         ranges={"quantity": AT_LEAST_ONE, "unit_price": POSITIVE, "line_total": POSITIVE},
                         references={"product_id": ("stg_products", "id")}),
    "dim_date": E("*", "date_key calendar_date", accepted={"season": SEASONS},
                  ranges={"quarter": QUARTERS, "month": MONTHS, "day": (1, 31, True), "day_of_week": WEEKDAYS,
                          "day_of_year": (1, 366, True)}),
    "dim_product": E(
        "product_key product_id product_name category price created_at product_year product_month category_group "
        "category_sort_order seasonality collection_type name_length is_limited_edition is_premium_line "
        "is_classic_line is_active is_discontinued price_tier detailed_price_tier price_decile price_quartile "
        "category_position overall_price_position dim_created_at dim_updated_at dim_version",
        "product_key product_id",
        accepted={"category_group": GROUPS, "price_tier": L.PRICE_TIERS,
                  "detailed_price_tier": L.PRICE_TIERS + ["Ultra-Premium"],
                  "category_position": [*L.CATEGORY_POSITIONS.values(), L.CATEGORY_POSITION_REST],
                  "overall_price_position": [label for _, label in L.PRICE_POSITION_RULES] + [L.LOWEST_QUARTER]},
        ranges={"price": POSITIVE, "price_decile": (1, 10, True), "price_quartile": QUARTERS}),
    "dim_customer": E("*", "customer_key customer_id email",
                      accepted={"region": [name for _, name, _ in L.REGION_NAMES] + ["Other"],
                                "signup_season": SEASONS,
                                "tenure_segment": [label for _, label in L.TENURE_SEGMENT] + [L.TENURE_SEGMENT_REST],
                                "customer_segment": L.CUSTOMER_SEGMENTS,
                                "churn_risk_segment": [label for _, label in L.CHURN_BY_TENURE] + ["Low Risk"]},
                      ranges={"customer_tenure_days": (-365, 10000, True), "signup_month": MONTHS,
                              "signup_day_of_week": WEEKDAYS, "tenure_quartile": QUARTERS}),
    "fact_orders": E(
        "order_key order_id customer_key order_date_key order_amount total_line_items total_quantity "
        "unique_products_count order_status order_size_category product_variety order_timing order_time_of_day "
        "is_completed order_date", "order_key order_id",
        accepted={"order_status": L.SOURCE_STATUSES, "order_size_category": L.ORDER_SIZES,
                  "product_variety": L.VARIETIES, "order_timing": L.TIMINGS,
                  "order_time_of_day": [name for name, _, _ in L.DAY_PARTS] + [L.DAY_PART_REST]},
        ranges=dict.fromkeys(["order_amount", "total_line_items", "total_quantity", "unique_products_count"],
                             NOT_NEGATIVE),
        references={"customer_key": ("dim_customer", "customer_key"), "order_date_key": ("dim_date", "date_key")}),
    "fact_order_line": E(
        "order_line_key order_line_id order_key customer_key product_key order_date_key order_id product_id "
        "customer_id quantity unit_price line_total item_sequence quantity_category line_price_tier line_value_tier "
        "line_percentage_of_order line_importance order_status recognized_revenue is_first_line_item order_date",
        "order_line_key order_line_id",
        accepted={"quantity_category": L.QUANTITY_CATEGORIES, "line_price_tier": L.PRICE_TIERS,
                  "line_value_tier": [label for _, label in L.LINE_VALUE_TIER] + [L.LINE_VALUE_TIER_TOP],
                  "line_importance": L.LINE_IMPORTANCES, "order_status": L.SOURCE_STATUSES},
        ranges={"quantity": AT_LEAST_ONE, "unit_price": POSITIVE, "line_total": POSITIVE,
                "item_sequence": AT_LEAST_ONE, "recognized_revenue": NOT_NEGATIVE},
        references={"order_key": ("fact_orders", "order_key"), "customer_key": ("dim_customer", "customer_key"),
                    "product_key": ("dim_product", "product_key"), "order_date_key": ("dim_date", "date_key")}),
    "fact_orders_scd2": E(
        "order_key order_id status_change_sequence customer_key order_date_key status_effective_date_key "
        "order_status is_current_status status_effective_date status_lifecycle_stage order_amount", "order_key",
        unique_together=[["order_id", "status_change_sequence"]],
        accepted={"order_status": L.HISTORY_STATUSES, "status_lifecycle_stage": ["Initial", "Historical", "Current"]},
        ranges={"status_change_sequence": (1, 10, True), "order_amount": NOT_NEGATIVE,
                "status_duration_hours": NOT_NEGATIVE},
        references={"customer_key": ("dim_customer", "customer_key"), "order_date_key": ("dim_date", "date_key"),
                    "status_effective_date_key": ("dim_date", "date_key")}),
    "daily_metrics": E("date_key metric_date metric_domain metric_name metric_value dimension_type dimension_value",
                       unique_text=[["date_key", "metric_name", "dimension_type", "dimension_value"]],
                       accepted={"metric_domain": ["orders", "products", "customers"],
                                 "metric_name": _once(m for _, m, _, _ in CATALOGUE),
                                 "dimension_type": _once(t for _, _, t, _ in CATALOGUE)}),
    "analysis_metrics_dashboard": E("metric_date", "metric_date"),
    "analysis_customer_behavior": E(
        "customer_key behavioral_segment purchase_pattern engagement_level marketing_persona churn_risk",
        "customer_key",
        accepted={"behavioral_segment": [label for _, label in L.BEHAVIORAL_RULES] + [L.BEHAVIORAL_REST],
                  "purchase_pattern": [label for _, label in L.PURCHASE_PATTERN] + [L.PURCHASE_PATTERN_REST],
                  "engagement_level": [label for _, label in L.ENGAGEMENT_RULES] + [L.ENGAGEMENT_REST],
                  "marketing_persona": [label for _, label in L.PERSONA_RULES] + [L.PERSONA_REST],
                  "churn_risk": [label for _, label in L.CHURN_RULES] + [L.CHURN_REST]}),
    "analysis_order_trends": E("period_type trend_period period_orders seasonality_pattern",
                               accepted={"period_type": ["Daily", "Monthly"],
                                         "volume_tier": [label for _, label in L.VOLUME_TIER] + [L.VOLUME_TIER_REST],
                                         "seasonality_pattern": SEASONS + ["Monthly"]},
                               ranges={"period_orders": NOT_NEGATIVE}),
    "analysis_product_performance": E("product_key product_id", "product_key"),
}
