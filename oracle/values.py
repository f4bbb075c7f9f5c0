"""Values that the expected results rest on, written out here so that a change on the Spark side shows."""

from __future__ import annotations

import datetime as dt

# --- fixed values: labels and thresholds
SOURCE_STATUSES = ["pending", "completed", "cancelled", "refunded"]
CATEGORY_GROUPS = ["Clothing", "Accessories", "Footwear", "Intimates", "Activewear"]
PRICE_TIERS = ["Budget", "Mid-Range", "Premium", "Luxury"]
LIMITED_WORDS = ["limited", "exclusive"]
PREMIUM_WORDS = ["premium", "signature"]
CLASSIC_WORDS = ["classic", "essential"]
DETAILED_PRICE_TIER = [(500, "Ultra-Premium"), (400, "Luxury"), (150, "Premium"), (50, "Mid-Range")]
LINE_VALUE_TIER = [(50, "Low Value Line"), (200, "Medium Value Line"), (500, "High Value Line")]
LINE_VALUE_TIER_TOP = "Premium Value Line"
SEASONS = [("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)), ("Fall", (9, 10, 11))]
REGION_NAMES = [("north america", "North America", "NA"), ("europe", "Europe", "EU"), ("asia pacific", "Asia Pacific", "APAC")]
TENURE_SEGMENT = [(730, "Loyal (2+ years)"), (365, "Established (1-2 years)"), (180, "Regular (6-12 months)"),
                  (90, "Growing (3-6 months)"), (30, "New (1-3 months)")]
TENURE_SEGMENT_REST = "Fresh (< 1 month)"
TENURE_QUARTILE = [(547, 4), (365, 3), (182, 2)]
CHURN_BY_TENURE = [(30, "High Risk"), (90, "Medium Risk")]
CUSTOMER_SEGMENTS = ["Premium Loyal", "Core Customer", "Growing Customer", "New Customer"]
PRICE_POSITION_RULES = [([("price_decile", ">=", 9)], "Top 10%"), ([("price_quartile", "=", 4)], "Top 25%"),
                        ([("price_quartile", ">=", 3)], "Above Median"), ([("price_quartile", "=", 2)], "Below Median")]
ORDER_SIZES = ["Single Item", "Small Order", "Medium Order", "Large Order"]
ORDER_SIZE_RULES = [([("total_line_items", "=", 1)], "Single Item"), ([("total_line_items", "<=", 3)], "Small Order"),
                    ([("total_line_items", "<=", 5)], "Medium Order")]
VARIETIES = ["All Unique", "Single Product", "Mixed Products"]
TIMINGS = ["Weekend", "Weekday"]
DAY_PARTS = [("Morning", 6, 11), ("Afternoon", 12, 17), ("Evening", 18, 22)]
LINE_IMPORTANCES = ["Single Line Order", "Dominant Line", "Major Line", "Minor Line"]
UNIT_PRICE_CATEGORY = [(50, "Budget Line"), (150, "Mid-Range Line"), (400, "Premium Line")]
UNIT_PRICE_CATEGORY_TOP = "Luxury Line"
QUANTITY_CATEGORIES = ["Single Item", "Pair", "Multiple Items"]
COMPLETION_SPEED = [(24, "Fast (≤24h)"), (72, "Medium (24-72h)")]
COMPLETION_SPEED_REST = "Slow (>72h)"
SCORES = {"customer_health_score": [("customer_acquisition_rate_pct", ">=", [(10, 10), (5, 7), (2, 5), (1, 3)], 1),
                                    ("customer_completion_rate_pct", ">=", [(90, 8), (80, 6), (70, 4), (60, 2)], 0),
                                    ("premium_core_customer_pct", ">=", [(40, 7), (30, 5), (20, 3), (10, 1)], 0)],
          "order_health_score": [("overall_fulfillment_rate_pct", ">=", [(95, 10), (85, 8), (75, 6), (65, 4), (50, 2)],
                                  0),
                                 ("avg_order_value", ">=", [(150, 8), (100, 6), (75, 4), (50, 2)], 1),
                                 ("order_cancellation_rate_pct", "<=", [(5, 7), (10, 5), (15, 3), (20, 1)], 0)],
          "revenue_health_score": [("net_revenue_success_pct", ">=", [(95, 10), (90, 8), (85, 6), (80, 4), (75, 2)], 0),
                                   ("revenue_per_active_customer", ">=", [(200, 8), (150, 6), (100, 4), (50, 2)], 1),
                                   ("premium_luxury_revenue_pct", ">=", [(30, 7), (20, 5), (15, 3), (10, 1)], 0)],
          "growth_health_score": [("customer_growth_vs_7d_avg_pct", ">=", [(10, 10), (5, 8), (0, 6), (-5, 4), (-10, 2)],
                                   0),
                                  ("revenue_growth_vs_7d_avg_pct", ">=", [(10, 8), (5, 6), (0, 4), (-5, 2)], 0),
                                  ("order_growth_vs_7d_avg_pct", ">=", [(10, 7), (5, 5), (0, 3), (-5, 1)], 0)]}
HEALTH_GRADE = [(90, "A+ Excellent"), (80, "A Good"), (70, "B+ Above Average"), (60, "B Average"), (50, "C+ Below Average"),
                (40, "C Poor")]
HEALTH_GRADE_REST = "D Critical"
ALERT_RULES = [([("order_cancellation_rate_pct", ">", 25)], "HIGH_CANCELLATION"),
               ([("customer_acquisition_rate_pct", "<", 1)], "LOW_ACQUISITION"),
               ([("overall_fulfillment_rate_pct", "<", 70)], "LOW_FULFILLMENT"),
               ([("revenue_growth_vs_7d_avg_pct", "<", -15)], "REVENUE_DECLINE"),
               ([("customer_growth_vs_7d_avg_pct", "<", -15)], "CUSTOMER_DECLINE")]
OPPORTUNITY_RULES = [([("premium_luxury_revenue_pct", "<", 15), ("avg_order_value", "<", 100)], "UPSELL_OPPORTUNITY"),
                     ([("customer_order_conversion_pct", "<", 80)], "CONVERSION_OPPORTUNITY"),
                     ([("product_variety_pct", "<", 50)], "CROSS_SELL_OPPORTUNITY"),
                     ([("weekend_order_pct", "<", 25)], "WEEKEND_GROWTH_OPPORTUNITY")]
BEHAVIORAL_RULES = [([("days_since_last_purchase", "<=", 30), ("purchase_frequency_monthly", ">=", 2),
                      ("avg_order_value", ">=", 150)],
                     "VIP Active"),
                    ([("days_since_last_purchase", "<=", 60), ("purchase_frequency_monthly", ">=", 1),
                      ("avg_order_value", ">=", 100)],
                     "High Value Active"),
                    ([("days_since_last_purchase", "<=", 90), ("total_orders", ">=", 5)], "Regular Active"),
                    ([("days_since_last_purchase", "<=", 180), ("total_orders", ">=", 3)], "Moderate Active"),
                    ([("days_since_last_purchase", "<=", 365), ("total_orders", ">=", 2)], "Low Active"),
                    ([("total_orders", "=", 1)], "One-Time Customer")]
BEHAVIORAL_REST = "Inactive"
PURCHASE_PATTERN = [(0.8, "Explorer"), (0.5, "Variety Seeker"), (0.3, "Moderate Repeater"), (0.2, "Brand Loyal")]
PURCHASE_PATTERN_REST = "Highly Loyal"
ENGAGEMENT_RULES = [([("active_months", ">=", 12), ("purchase_frequency_monthly", ">=", 1)], "Highly Engaged"),
                    ([("active_months", ">=", 6), ("purchase_frequency_monthly", ">=", 0.5)], "Engaged"),
                    ([("active_months", ">=", 3), ("purchase_frequency_monthly", ">=", 0.25)], "Moderately Engaged"),
                    ([("active_months", ">=", 1)], "Low Engagement")]
ENGAGEMENT_REST = "Single Purchase"
VALUE_TIER = [(2000, "Platinum"), (1000, "Gold"), (500, "Silver"), (100, "Bronze")]
VALUE_TIER_REST = "Entry"
TIMING_PREFERENCE = [(60, "Weekend Shopper"), (40, "Mixed Shopper")]
TIMING_PREFERENCE_REST = "Weekday Shopper"
PRICE_SENSITIVITY = [(50, "Premium Buyer"), (25, "Occasional Premium"), (10, "Budget Conscious")]
PRICE_SENSITIVITY_REST = "Value Seeker"
SEASON_TIE_ORDER = ["fall", "winter", "spring", "summer"]
PERSONA_RULES = [([("behavioral_segment", "in", ("VIP Active", "High Value Active")), ("premium_preference_pct", ">=", 30)],
                  "Premium Enthusiast"),
                 ([("behavioral_segment", "in", ("VIP Active", "High Value Active")), ("product_exploration_ratio", ">=", 0.6)],
                  "Engaged Explorer"),
                 ([("behavioral_segment", "=", "Regular Active"), ("purchase_pattern", "=", "Brand Loyal")], "Loyal Regular"),
                 ([("behavioral_segment", "=", "Regular Active"), ("purchase_pattern", "in", ("Explorer", "Variety Seeker"))],
                  "Active Browser"),
                 ([("behavioral_segment", "in", ("Moderate Active", "Low Active")), ("total_completed_spent", ">=", 500)],
                  "Sleeping Giant"),
                 ([("behavioral_segment", "=", "One-Time Customer"), ("avg_order_value", ">=", 100)], "High-Value Trial"),
                 ([("behavioral_segment", "=", "One-Time Customer")], "Trial Customer"),
                 ([("behavioral_segment", "=", "Inactive"), ("total_completed_spent", ">=", 300)], "Win-Back Target")]
PERSONA_REST = "Standard Customer"
CHURN_RULES = [([("days_since_last_purchase", "<=", 60)], "Low Risk"),
               ([("days_since_last_purchase", "<=", 120), ("total_orders", ">=", 3)], "Medium Risk"),
               ([("days_since_last_purchase", "<=", 180), ("total_completed_spent", ">=", 200)], "High Risk")]
CHURN_REST = "Lost Customer"
SPECIAL_PERIODS = [(12, 20, 31, "Holiday Season"), (11, 20, 30, "Black Friday Period"), (2, 10, 20, "Valentines Period")]
VS_7D_LABELS = ("Above 7d Average", "Near 7d Average", "Below 7d Average")
VS_30D_LABELS = ("High Revenue Day", "Average Revenue Day", "Low Revenue Day")
DAILY_TREND = [(10, "Strong Growth"), (5, "Moderate Growth"), (-5, "Stable"), (-15, "Moderate Decline")]
DAILY_TREND_REST = "Strong Decline"
VOLUME_TIER = [(200, "Very High Volume"), (150, "High Volume"), (100, "Medium Volume"), (50, "Low Volume")]
VOLUME_TIER_REST = "Very Low Volume"
PERFORMANCE_RULES = [([("revenue_quartile", "=", 4), ("customer_reach_quartile", "=", 4)], "Star Performer"),
                     ([("revenue_quartile", "=", 4)], "High Revenue"), ([("customer_reach_quartile", "=", 4)], "Wide Appeal"),
                     ([("revenue_quartile", ">=", 3)], "Good Performer"),
                     ([("customer_reach_quartile", ">=", 3)], "Good Performer"),
                     ([("revenue_quartile", "=", 2)], "Average Performer")]
PERFORMANCE_REST = "Low Performer"
CONTRIBUTION_RULES = [([("revenue_decile", ">=", 9)], "Top 10%"), ([("revenue_quartile", "=", 4)], "Top 25%"),
                      ([("revenue_quartile", ">=", 3)], "Above Average"), ([("revenue_quartile", "=", 2)], "Below Average")]
LOWEST_QUARTER = "Bottom 25%"
PENETRATION = [(4, "High Penetration"), (3, "Medium Penetration"), (2, "Low Penetration")]
PENETRATION_REST = "Very Low Penetration"
LIFECYCLE = [(30, "New Launch"), (90, "Early Stage"), (180, "Growth Stage"), (365, "Mature Stage")]
LIFECYCLE_REST = "Established"
PRICING_STRATEGY = [(95, "Full Price"), (85, "Minimal Discount"), (75, "Moderate Discount"), (60, "Heavy Discount")]
PRICING_STRATEGY_REST = "Deep Discount"
PURCHASE_BEHAVIOR = [("single_line_orders", 5, "Standalone Purchase"), ("dominant_lines", 3, "Primary Item"),
                     ("major_lines", 3, "Complementary Item")]

# --- fixed values: lookups
GROUP_OF_CATEGORY = [("Dresses", "Clothing"), ("Tops & Blouses", "Clothing"), ("Sweaters & Knitwear", "Clothing"),
                     ("Jackets & Coats", "Clothing"), ("Pants & Trousers", "Clothing"), ("Skirts", "Clothing"),
                     ("Jeans & Denim", "Clothing"), ("Handbags & Purses", "Accessories"), ("Jewelry & Watches", "Accessories"),
                     ("Scarves & Wraps", "Accessories"), ("Belts & Accessories", "Accessories"),
                     ("Sunglasses & Eyewear", "Accessories"), ("Hats & Hair Accessories", "Accessories"),
                     ("Tech Accessories", "Accessories"), ("Shoes & Footwear", "Footwear"), ("Lingerie & Intimates", "Intimates"),
                     ("Sleepwear & Loungewear", "Intimates"), ("Swimwear & Beachwear", "Intimates"),
                     ("Activewear & Athleisure", "Activewear")]
PRICE_TIER_RANGES = [("0", "49.99", "Budget"), ("50", "149.99", "Mid-Range"), ("150", "399.99", "Premium"),
                     ("400", "999999", "Luxury")]
SEASON_KEYWORDS = [("spring", "Spring/Summer"), ("summer", "Spring/Summer"), ("fall", "Fall/Winter"), ("winter", "Fall/Winter"),
                   ("holiday", "Fall/Winter")]
COLLECTION_KEYWORDS = [("limited edition", "Limited Edition"), ("premium", "Premium"), ("signature", "Premium"),
                       ("classic", "Classic")]

# --- fixed values: how the test tables become sources
AS_OF = dt.date(2001, 9, 1)
SIGNUP_START = dt.date(1999, 9, 1)
PRODUCT_CREATED = dt.datetime(1994, 12, 1, 0, 0)
NAME_SUFFIXES = ["spring", "summer", "fall", "winter", "holiday", "limited edition", "premium", "classic"]
CATEGORIES = ["Dresses", "Tops & Blouses", "Sweaters & Knitwear", "Jackets & Coats", "Pants & Trousers", "Skirts",
              "Jeans & Denim", "Activewear & Athleisure", "Lingerie & Intimates", "Sleepwear & Loungewear",
              "Swimwear & Beachwear", "Handbags & Purses", "Jewelry & Watches", "Scarves & Wraps", "Belts & Accessories",
              "Shoes & Footwear", "Sunglasses & Eyewear", "Hats & Hair Accessories", "Tech Accessories",
              "Gift Cards & Sets"]
REGION_OF = {"AMERICA": "north america", "EUROPE": "europe", "ASIA": "asia pacific", "AFRICA": "africa"}

# --- fixed values: long metric catalogue (domain, metric, dimension type, dimension value)
METRICS = [("orders", "total_orders", "base", "all"), ("orders", "completed_orders", "status", "completed"),
           ("orders", "cancelled_orders", "status", "cancelled"), ("orders", "pending_orders", "status", "pending"),
           ("orders", "refunded_orders", "status", "refunded"), ("orders", "items_added_orders", "status", "items_added"),
           ("orders", "total_revenue", "revenue_type", "total"),
           ("orders", "completed_revenue", "revenue_type", "completed"),
           ("orders", "refunded_revenue", "revenue_type", "refunded"),
           ("orders", "avg_order_value", "revenue_type", "average"),
           ("orders", "unique_customers", "customer_type", "all"),
           ("orders", "customers_with_completed_orders", "customer_type", "active"),
           ("orders", "completion_rate_pct", "rate_type", "completion"),
           ("orders", "cancellation_rate_pct", "rate_type", "cancellation"),
           ("orders", "single_item_orders", "order_size", "single_item"),
           ("orders", "small_orders", "order_size", "small"), ("orders", "medium_orders", "order_size", "medium"),
           ("orders", "large_orders", "order_size", "large"), ("orders", "weekend_orders", "timing", "weekend"),
           ("orders", "weekday_orders", "timing", "weekday"), ("orders", "morning_orders", "time_of_day", "morning"),
           ("orders", "afternoon_orders", "time_of_day", "afternoon"),
           ("orders", "evening_orders", "time_of_day", "evening"), ("orders", "night_orders", "time_of_day", "night"),
           ("products", "unique_products_sold", "product_type", "all"),
           ("products", "total_line_items", "product_type", "all"),
           ("products", "total_quantity_sold", "product_type", "all"),
           ("products", "total_product_revenue", "product_type", "all"),
           ("products", "clothing_revenue", "category", "clothing"),
           ("products", "accessories_revenue", "category", "accessories"),
           ("products", "footwear_revenue", "category", "footwear"),
           ("products", "intimates_revenue", "category", "intimates"),
           ("products", "activewear_revenue", "category", "activewear"),
           ("products", "clothing_products_sold", "category", "clothing"),
           ("products", "accessories_products_sold", "category", "accessories"),
           ("products", "footwear_products_sold", "category", "footwear"),
           ("products", "intimates_products_sold", "category", "intimates"),
           ("products", "activewear_products_sold", "category", "activewear"),
           ("customers", "active_customers", "customer_activity", "active"),
           ("customers", "customers_with_completed_orders", "customer_activity", "completed_orders"),
           ("customers", "new_customers", "customer_segment", "new_customer"),
           ("customers", "premium_loyal_customers", "customer_segment", "premium_loyal"),
           ("customers", "core_customers", "customer_segment", "core_customer"),
           ("customers", "growing_customers", "customer_segment", "growing_customer"),
           ("customers", "total_customer_spend", "spend_type", "total"),
           ("customers", "avg_spend_per_customer", "spend_type", "average"),
           ("customers", "highest_customer_spend", "spend_type", "maximum"),
           ("customers", "na_customers", "region", "north_america"), ("customers", "eu_customers", "region", "europe"),
           ("customers", "apac_customers", "region", "asia_pacific")]
