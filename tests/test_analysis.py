import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderloom.functions import labels as L
from orderloom.functions.columns import by_rules
from orderloom.operators import analysis
from tests.conftest import by


def test_dashboard_invariants(warehouse):
    board = warehouse.analysis_metrics_dashboard
    assert len(board.columns) == 48
    parts = list(L.SCORES)
    total = sum((F.col(p) for p in parts), F.lit(0))
    assert board.where(F.col("business_health_score") != total).count() == 0
    for part in parts:
        assert board.where(~F.col(part).between(0, 25)).count() == 0
    assert board.count() == board.select("metric_date").distinct().count()
    grades = by(board.groupBy("business_health_grade").agg(F.min("business_health_score").alias("low"),
                                                          F.max("business_health_score").alias("high")),
                "business_health_grade")
    bounds = dict((label, low) for low, label in L.HEALTH_GRADE)
    assert all(r["low"] >= bounds.get(g, 0) for g, r in grades.items())


def test_scores_and_alerts(spark):
    row = dict(active_customers=2, new_customers_acquired=1, ordering_customers=2, total_revenue=Decimal("100.00"),
               completed_revenue=Decimal("80.00"), unique_products_sold=1, total_orders=4, total_quantity_sold=3,
               premium_loyal_customers=1, core_customers=0, avg_order_value=Decimal("25"), avg_unit_price=Decimal("10"),
               completed_orders=3, avg_active_customers_7d=Decimal("1.5"), avg_revenue_7d=Decimal("200"),
               avg_orders_7d=Decimal("4"), customer_completion_rate_pct=Decimal("90"),
               order_cancellation_rate_pct=Decimal("25.00"), premium_luxury_revenue_pct=Decimal("14.99"),
               product_variety_pct=Decimal("60"), weekend_order_pct=Decimal("20"))
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()])
    got = analysis.health_scores(analysis.business_indicators(frame)).first().asDict()
    assert got["customer_acquisition_rate_pct"] == 50 and got["net_revenue_success_pct"] == 60
    assert got["customer_growth_vs_7d_avg_pct"] == Decimal("33.33") and got["revenue_growth_vs_7d_avg_pct"] == -50
    assert got["customer_health_score"] == 10 + 8 + 7 and got["order_health_score"] == 6 + 1 + 0
    assert got["revenue_health_score"] == 0 + 2 + 1 and got["growth_health_score"] == 10 + 0 + 3
    assert got["business_health_score"] == 48 and got["business_health_grade"] == "C Poor"
    assert got["primary_alert"] == "REVENUE_DECLINE" and got["primary_opportunity"] == "UPSELL_OPPORTUNITY"


def test_trends(warehouse):
    daily = by(warehouse.order_trends_daily, "trend_date")
    assert daily[dt.date(2024, 1, 13)]["prev_day_orders"] == 1 and daily[dt.date(2024, 1, 13)]["daily_growth_pct"] == 0
    assert daily[dt.date(2024, 2, 29)]["special_period"] == "Regular Period"
    assert daily[dt.date(2024, 3, 5)]["unique_customers"] == 0  # the customer is unknown
    both = by(warehouse.analysis_order_trends, "period_type", "trend_period")
    march = both["Monthly", "2024-03"]
    assert march["period_orders"] == 3 and march["period_growth_pct"] == 200 and march["season"] is None
    assert march["seasonality_pattern"] == "Monthly" and both["Daily", "2024-03-09"]["seasonality_pattern"] == "Spring"
    assert len(warehouse.analysis_order_trends.columns) == 19


def test_special_periods(spark):
    days = ["2024-12-19", "2024-12-20", "2024-11-20", "2024-02-10", "2024-02-20", "2024-02-21"]
    base = spark.createDataFrame([(dt.date.fromisoformat(d), 10 * (i + 1), Decimal(5)) for i, d in enumerate(days)],
                                 "trend_date date, total_orders bigint, completed_revenue decimal(20,2)")
    got = by(analysis.order_trends_daily(base), "trend_date")
    assert [got[dt.date.fromisoformat(d)]["special_period"] for d in days] == [
        "Regular Period", "Holiday Season", "Black Friday Period", "Valentines Period", "Valentines Period",
        "Regular Period"]


def test_customer_behavior(warehouse):
    rows = by(warehouse.analysis_customer_behavior, "customer_id")
    ann, ben, cid = rows[1], rows[2], rows[3]
    assert (ann["total_orders"], ann["completed_orders"], ann["active_months"]) == (2, 0, 2)
    assert ann["customer_lifespan_days"] == 52 and ann["days_since_last_purchase"] == 28
    assert ann["purchase_frequency_monthly"] == Decimal("1.15")
    # no completed lines: no ratio, lowest classes
    assert ann["product_exploration_ratio"] is None and ann["purchase_pattern"] == "Highly Loyal"
    assert ann["premium_preference_pct"] == 0 and ann["unique_products_purchased"] is None
    assert ann["seasonal_preference"] == "Winter Shopper"  # one winter, one spring order
    assert ann["behavioral_segment"] == "High Value Active" and ann["marketing_persona"] == "Standard Customer"
    assert ben["preferred_category_group"] == "Other" and ben["value_tier"] == "Silver"
    assert cid["purchase_frequency_monthly"] == 1 and cid["customer_lifespan_days"] == 0


def test_favourite_group_ties_go_to_the_lower_name(spark):
    lines = spark.createDataFrame(
        [("c", "p1", "completed", Decimal(1), 1, "Minor Line"), ("c", "p2", "completed", Decimal(1), 1, "Minor Line"),
         ("c", "p1", "pending", Decimal(1), 1, "Minor Line")],
        "customer_key string, product_key string, order_status string, unit_price decimal(10,2), quantity int, "
        "line_importance string")
    products = spark.createDataFrame(
        [("p1", "Shoes", "Footwear", "Premium", False), ("p2", "Dresses", "Clothing", "Budget", True)],
        "product_key string, category string, category_group string, price_tier string, is_limited_edition boolean")
    got = analysis.product_preferences(lines, products).first()
    assert got.preferred_category_group == "Clothing" and got.unique_category_groups_purchased == 2
    assert (got.premium_purchases, got.limited_edition_purchases) == (1, 1)


def test_persona_rules(spark):
    frame = spark.createDataFrame(
        [("VIP Active", Decimal(30), Decimal("0.1"), "Explorer", Decimal(0), Decimal(0)),
         ("VIP Active", Decimal(0), Decimal("0.6"), "Explorer", Decimal(0), Decimal(0)),
         ("Low Active", Decimal(0), None, "Explorer", Decimal(500), Decimal(0)),
         ("One-Time Customer", Decimal(0), None, "Explorer", Decimal(0), Decimal(99)),
         ("Inactive", Decimal(0), None, "Explorer", Decimal(299), Decimal(0))],
        "behavioral_segment string, premium_preference_pct decimal(20,2), product_exploration_ratio decimal(20,2), "
        "purchase_pattern string, total_completed_spent decimal(20,2), avg_order_value decimal(20,2)")
    got = [r[0] for r in frame.select(by_rules(L.PERSONA_RULES, L.PERSONA_REST)).collect()]
    assert got == ["Premium Enthusiast", "Engaged Explorer", "Sleeping Giant", "Trial Customer", "Standard Customer"]


def test_product_performance(warehouse):
    rows = by(warehouse.analysis_product_performance, "product_id")
    assert sorted(rows) == [1, 2, 3]
    assert [rows[i]["completed_revenue"] for i in (1, 2, 3)] == [Decimal("150.00"), 0, Decimal("500.00")]
    assert [rows[i]["revenue_rank_overall"] for i in (3, 1, 2)] == [1, 2, 3]
    assert rows[3]["performance_tier"] == "Good Performer" and rows[3]["lifecycle_stage"] == "New Launch"
    assert rows[1]["price_realization_pct"] == Decimal("100.01") and rows[1]["pricing_strategy"] == "Full Price"
    assert rows[3]["revenue_per_day_since_launch"] == Decimal("23.80952381")
    assert rows[2]["selling_days"] == 2 and rows[2]["unique_orders"] == 2 and rows[2]["unique_customers"] == 1
    assert rows[2]["purchase_behavior"] == "Standalone Purchase"
