"""Staging: cleaned, enriched views of the four raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import labels as L
from orderloom.functions.columns import (dow0, first_keyword, first_range, has_any_word, ladder)
from orderloom.operators.ranking import sequence_rows
from orderloom.sources.lookups import Lookups, pairs_frame

ITEM_COLUMNS = ["id", "order_id", "product_id", "quantity", "unit_price", "created_at"]


def stg_customers(raw: DataFrame, lookups: Lookups, as_of: dt.date) -> DataFrame:
    regions = pairs_frame(raw.sparkSession, lookups.country_region, "_country", "_region")
    return raw.join(regions, F.lower("country") == F.col("_country"), "left").select(
        "id", "name", "email", "signup_date", "country", "created_at",
        F.year("signup_date").alias("signup_year"),
        F.month("signup_date").alias("signup_month"),
        dow0("signup_date").alias("signup_day_of_week"),
        F.datediff(F.lit(as_of), "signup_date").alias("customer_tenure_days"),
        F.coalesce("_region", F.lit(L.DEFAULT_REGION)).alias("region"))


def stg_orders(raw: DataFrame) -> DataFrame:
    """Number the status rows of each order and mark the current one; ties go by record id."""
    return sequence_rows(raw, "order_id", ["created_at", "record_id"], "status_sequence",
                         last_flag="is_current_status").select(
        "record_id", "order_id", "customer_id", "order_date", "status", "total_amount", "created_at",
        "status_sequence", "is_current_status",
        F.year("created_at").alias("created_year"),
        F.month("created_at").alias("created_month"),
        dow0("created_at").alias("created_day_of_week"))


def numbered_items(raw: DataFrame) -> DataFrame:
    """Items with their place in the order."""
    return sequence_rows(raw, "order_id", ["created_at", "id"], "item_sequence")


def priced_items(raw: DataFrame, lookups: Lookups) -> DataFrame:
    """Row-local item columns: totals, time parts and tiers (no shuffle).  Columns that the items have beside their own stay."""
    quantity = F.col("quantity")
    total = (quantity.cast("decimal(10,0)") * F.col("unit_price")).cast("decimal(20,2)")
    return raw.withColumn("line_total", total).select(
        "id", "order_id", "product_id", "quantity", "unit_price", "line_total", "created_at",
        F.year("created_at").alias("created_year"),
        F.month("created_at").alias("created_month"),
        F.dayofmonth("created_at").alias("created_day"),
        dow0("created_at").alias("created_day_of_week"),
        F.hour("created_at").alias("created_hour"),
        first_range(F.col("unit_price"), lookups.price_tiers, L.DEFAULT_PRICE_TIER).alias("price_tier"),
        F.when(quantity == 1, "Single Item").when(quantity == 2, "Pair")
        .when(quantity >= 3, "Multiple Items").alias("quantity_category"),
        ladder("line_total", L.LINE_VALUE_TIER, L.LINE_VALUE_TIER_TOP, "<").alias("line_value_tier"),
        *[c for c in raw.columns if c not in ITEM_COLUMNS])


def stg_order_items(raw: DataFrame, lookups: Lookups) -> DataFrame:
    """The narrow rows are numbered, so that derived columns take no part in the exchange."""
    return priced_items(numbered_items(raw), lookups)


def stg_products(raw: DataFrame, lookups: Lookups) -> DataFrame:
    groups = pairs_frame(raw.sparkSession, lookups.category_group, "_category", "_group")
    group = F.coalesce("_group", F.lit(L.DEFAULT_CATEGORY_GROUP))
    name = F.lower("name")
    rank = {label: place for place, label in enumerate(L.CATEGORY_GROUPS, start=1)}
    return raw.join(groups, F.col("category") == F.col("_category"), "left").select(
        "id", "name", "category", "price", "created_at",
        F.year("created_at").alias("product_year"),
        F.month("created_at").alias("product_month"),
        first_range(F.col("price"), lookups.price_tiers, L.DEFAULT_PRICE_TIER).alias("price_tier"),
        ladder("price", L.DETAILED_PRICE_TIER, "Budget").alias("detailed_price_tier"),
        group.alias("category_group"),
        ladder(group, rank.items(), len(rank) + 1, "=").alias("category_sort_order"),
        first_keyword(name, lookups.season_keywords, L.DEFAULT_SEASONALITY).alias("seasonality"),
        first_keyword(name, lookups.collection_keywords, L.DEFAULT_COLLECTION).alias("collection_type"),
        F.length("name").alias("name_length"),
        has_any_word(name, L.LIMITED_WORDS).alias("is_limited_edition"),
        has_any_word(name, L.PREMIUM_WORDS).alias("is_premium_line"),
        has_any_word(name, L.CLASSIC_WORDS).alias("is_classic_line"),
        F.lit(True).alias("is_active"),
        F.lit(False).alias("is_discontinued"))
