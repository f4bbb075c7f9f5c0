"""The expected data-quality suite: per table what must hold, written out apart from the suite under test."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Checks:
    required: str = ""
    unique: str = ""
    unique_together: list[list[str]] = field(default_factory=list)
    unique_text: list[list[str]] = field(default_factory=list)
    accepted: dict[str, list[str]] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    def required_columns(self, everything: list[str]) -> list[str]:
        return everything if self.required == "*" else self.required.split()


SUITE = {
    "source_customers": Checks(
        required="id email name signup_date country created_at",
        unique="id email"),
    "source_products": Checks(
        required="id name category price created_at",
        unique="id",
        ranges={"price": (0, None, False)}),
    "source_orders": Checks(
        required="record_id id customer_id order_date status total_amount created_at",
        unique="record_id",
        accepted={"status": ["pending", "completed", "cancelled", "refunded", "items added"]},
        ranges={"total_amount": (0, None, True)},
        references={"customer_id": ("source_customers", "id")}),
    "source_order_items": Checks(
        required="id order_id product_id quantity unit_price created_at",
        unique="id",
        ranges={"quantity": (1, None, True), "unit_price": (0, None, False)},
        references={"order_id": ("source_orders", "id"), "product_id": ("source_products", "id")}),
    "raw_customers": Checks(
        required="id email name signup_date country",
        unique="id email"),
    "raw_products": Checks(
        required="id name category price",
        unique="id",
        ranges={"price": (0, None, False)}),
    "raw_orders": Checks(
        required="record_id order_id customer_id status",
        unique="record_id",
        accepted={"status": ["pending", "completed", "cancelled", "refunded", "items added"]},
        references={"customer_id": ("raw_customers", "id")}),
    "raw_order_items": Checks(
        required="id order_id product_id quantity unit_price",
        unique="id",
        ranges={"quantity": (1, None, True), "unit_price": (0, None, False)},
        references={"product_id": ("raw_products", "id")}),
    "stg_customers": Checks(
        required="id email name signup_date country region",
        unique="id email",
        accepted={"region": ["north america", "europe", "asia pacific", "south america", "africa", "other"]}),
    "stg_products": Checks(
        required="id name category price price_tier category_group",
        unique="id",
        accepted={"price_tier": ["Budget", "Mid-Range", "Premium", "Luxury"],
                  "category_group": ["Clothing", "Accessories", "Footwear", "Intimates", "Activewear", "Other"]},
        ranges={"price": (0, None, False)}),
    "stg_orders": Checks(
        required="record_id order_id customer_id status is_current_status",
        unique="record_id",
        accepted={"status": ["pending", "completed", "cancelled", "refunded", "items added"]},
        references={"customer_id": ("stg_customers", "id")}),
    "stg_order_items": Checks(
        required="id order_id product_id quantity unit_price line_total",
        unique="id",
        ranges={"quantity": (1, None, True), "unit_price": (0, None, False), "line_total": (0, None, False)},
        references={"product_id": ("stg_products", "id")}),
    "dim_date": Checks(
        required="*",
        unique="date_key calendar_date",
        accepted={"season": ["Winter", "Spring", "Summer", "Fall"]},
        ranges={"quarter": (1, 4, True),
                "month": (1, 12, True),
                "day": (1, 31, True),
                "day_of_week": (0, 6, True),
                "day_of_year": (1, 366, True)}),
    "dim_product": Checks(
        required=("product_key product_id product_name category price created_at product_year product_month "
                  "category_group category_sort_order seasonality collection_type name_length is_limited_edition "
                  "is_premium_line is_classic_line is_active is_discontinued price_tier detailed_price_tier "
                  "price_decile price_quartile category_position overall_price_position dim_created_at "
                  "dim_updated_at dim_version"),
        unique="product_key product_id",
        accepted={"category_group": ["Clothing", "Accessories", "Footwear", "Intimates", "Activewear", "Other"],
                  "price_tier": ["Budget", "Mid-Range", "Premium", "Luxury"],
                  "detailed_price_tier": ["Budget", "Mid-Range", "Premium", "Luxury", "Ultra-Premium"],
                  "category_position": ["Category Premium", "Category Budget", "Category Mid-Market"],
                  "overall_price_position": ["Top 10%", "Top 25%", "Above Median", "Below Median", "Bottom 25%"]},
        ranges={"price": (0, None, False), "price_decile": (1, 10, True), "price_quartile": (1, 4, True)}),
    "dim_customer": Checks(
        required="*",
        unique="customer_key customer_id email",
        accepted={"region": ["North America", "Europe", "Asia Pacific", "Other"],
                  "signup_season": ["Winter", "Spring", "Summer", "Fall"],
                  "tenure_segment": ["Loyal (2+ years)", "Established (1-2 years)", "Regular (6-12 months)",
                                     "Growing (3-6 months)", "New (1-3 months)", "Fresh (< 1 month)"],
                  "customer_segment": ["Premium Loyal", "Core Customer", "Growing Customer", "New Customer"],
                  "churn_risk_segment": ["High Risk", "Medium Risk", "Low Risk"]},
        ranges={"customer_tenure_days": (-365, 10000, True),
                "signup_month": (1, 12, True),
                "signup_day_of_week": (0, 6, True),
                "tenure_quartile": (1, 4, True)}),
    "fact_orders": Checks(
        required=("order_key order_id customer_key order_date_key order_amount total_line_items total_quantity "
                  "unique_products_count order_status order_size_category product_variety order_timing "
                  "order_time_of_day is_completed order_date"),
        unique="order_key order_id",
        accepted={"order_status": ["pending", "completed", "cancelled", "refunded"],
                  "order_size_category": ["Single Item", "Small Order", "Medium Order", "Large Order"],
                  "product_variety": ["All Unique", "Single Product", "Mixed Products"],
                  "order_timing": ["Weekend", "Weekday"],
                  "order_time_of_day": ["Morning", "Afternoon", "Evening", "Night"]},
        ranges={"order_amount": (0, None, True),
                "total_line_items": (0, None, True),
                "total_quantity": (0, None, True),
                "unique_products_count": (0, None, True)},
        references={"customer_key": ("dim_customer", "customer_key"), "order_date_key": ("dim_date", "date_key")}),
    "fact_order_line": Checks(
        required=("order_line_key order_line_id order_key customer_key product_key order_date_key order_id "
                  "product_id customer_id quantity unit_price line_total item_sequence quantity_category "
                  "line_price_tier line_value_tier line_percentage_of_order line_importance order_status "
                  "recognized_revenue is_first_line_item order_date"),
        unique="order_line_key order_line_id",
        accepted={"quantity_category": ["Single Item", "Pair", "Multiple Items"],
                  "line_price_tier": ["Budget", "Mid-Range", "Premium", "Luxury"],
                  "line_value_tier": ["Low Value Line", "Medium Value Line", "High Value Line",
                                      "Premium Value Line"],
                  "line_importance": ["Single Line Order", "Dominant Line", "Major Line", "Minor Line"],
                  "order_status": ["pending", "completed", "cancelled", "refunded"]},
        ranges={"quantity": (1, None, True),
                "unit_price": (0, None, False),
                "line_total": (0, None, False),
                "item_sequence": (1, None, True),
                "recognized_revenue": (0, None, True)},
        references={"order_key": ("fact_orders", "order_key"),
                    "customer_key": ("dim_customer", "customer_key"),
                    "product_key": ("dim_product", "product_key"),
                    "order_date_key": ("dim_date", "date_key")}),
    "fact_orders_scd2": Checks(
        required=("order_key order_id status_change_sequence customer_key order_date_key status_effective_date_key "
                  "order_status is_current_status status_effective_date status_lifecycle_stage order_amount"),
        unique="order_key",
        unique_together=[["order_id", "status_change_sequence"]],
        accepted={"order_status": ["pending", "items added", "completed", "cancelled", "refunded"],
                  "status_lifecycle_stage": ["Initial", "Historical", "Current"]},
        ranges={"status_change_sequence": (1, 10, True),
                "order_amount": (0, None, True),
                "status_duration_hours": (0, None, True)},
        references={"customer_key": ("dim_customer", "customer_key"),
                    "order_date_key": ("dim_date", "date_key"),
                    "status_effective_date_key": ("dim_date", "date_key")}),
    "daily_metrics": Checks(
        required="date_key metric_date metric_domain metric_name metric_value dimension_type dimension_value",
        unique_text=[["date_key", "metric_name", "dimension_type", "dimension_value"]],
        accepted={"metric_domain": ["orders", "products", "customers"],
                  "metric_name": ["total_orders", "completed_orders", "cancelled_orders", "pending_orders",
                                  "refunded_orders", "items_added_orders", "total_revenue", "completed_revenue",
                                  "refunded_revenue", "avg_order_value", "unique_customers",
                                  "customers_with_completed_orders", "completion_rate_pct",
                                  "cancellation_rate_pct", "single_item_orders", "small_orders", "medium_orders",
                                  "large_orders", "weekend_orders", "weekday_orders", "morning_orders",
                                  "afternoon_orders", "evening_orders", "night_orders", "unique_products_sold",
                                  "total_line_items", "total_quantity_sold", "total_product_revenue",
                                  "clothing_revenue", "accessories_revenue", "footwear_revenue",
                                  "intimates_revenue", "activewear_revenue", "clothing_products_sold",
                                  "accessories_products_sold", "footwear_products_sold", "intimates_products_sold",
                                  "activewear_products_sold", "active_customers", "new_customers",
                                  "premium_loyal_customers", "core_customers", "growing_customers",
                                  "total_customer_spend", "avg_spend_per_customer", "highest_customer_spend",
                                  "na_customers", "eu_customers", "apac_customers"],
                  "dimension_type": ["base", "status", "revenue_type", "customer_type", "rate_type", "order_size",
                                     "timing", "time_of_day", "product_type", "category", "customer_activity",
                                     "customer_segment", "spend_type", "region"]}),
    "analysis_metrics_dashboard": Checks(
        required="metric_date",
        unique="metric_date"),
    "analysis_customer_behavior": Checks(
        required="customer_key behavioral_segment purchase_pattern engagement_level marketing_persona churn_risk",
        unique="customer_key",
        accepted={"behavioral_segment": ["VIP Active", "High Value Active", "Regular Active", "Moderate Active",
                                         "Low Active", "One-Time Customer", "Inactive"],
                  "purchase_pattern": ["Explorer", "Variety Seeker", "Moderate Repeater", "Brand Loyal",
                                       "Highly Loyal"],
                  "engagement_level": ["Highly Engaged", "Engaged", "Moderately Engaged", "Low Engagement",
                                       "Single Purchase"],
                  "marketing_persona": ["Premium Enthusiast", "Engaged Explorer", "Loyal Regular",
                                        "Active Browser", "Sleeping Giant", "High-Value Trial", "Trial Customer",
                                        "Win-Back Target", "Standard Customer"],
                  "churn_risk": ["Low Risk", "Medium Risk", "High Risk", "Lost Customer"]}),
    "analysis_order_trends": Checks(
        required="period_type trend_period period_orders seasonality_pattern",
        accepted={"period_type": ["Daily", "Monthly"],
                  "volume_tier": ["Very High Volume", "High Volume", "Medium Volume", "Low Volume",
                                  "Very Low Volume"],
                  "seasonality_pattern": ["Winter", "Spring", "Summer", "Fall", "Monthly"]},
        ranges={"period_orders": (0, None, True)}),
    "analysis_product_performance": Checks(
        required="product_key product_id",
        unique="product_key"),
}
