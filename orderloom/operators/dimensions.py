"""Dimensions: calendar, customers, products."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import labels as L
from orderloom.functions.columns import (by_rules, date_key, dow0, is_true, ladder, moment, name_of, ntile_of,
                                         padded_day_name, season, surrogate_key, year_month)
from orderloom.operators.ranking import rank_rows

DEFAULT_CALENDAR = (dt.date(2020, 1, 1), dt.date(2027, 12, 31))  # end exclusive


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, ``end`` exclusive."""
    last = end - dt.timedelta(days=1)
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(last))).alias("calendar_date"))


def relative_period(day, as_of: dt.date):
    today = F.lit(as_of)
    age = F.datediff(today, day)
    months = (F.year(today) * 12 + F.month(today)) - (F.year(day) * 12 + F.month(day))
    years = F.year(today) - F.year(day)
    return (F.when(age == 0, "Today").when(age == 1, "Yesterday")
            .when(age.between(1, 7), "Last 7 Days").when(age.between(1, 30), "Last 30 Days")
            .when(months == 0, "This Month").when(months == 1, "Last Month")
            .when(years == 0, "This Year").when(years == 1, "Last Year").otherwise("Other"))


def dim_date(spark: SparkSession, as_of: dt.date, start: dt.date = DEFAULT_CALENDAR[0],
             end: dt.date = DEFAULT_CALENDAR[1]) -> DataFrame:
    day = F.col("calendar_date")
    dow, month, quarter = dow0(day), F.month(day), F.quarter(day)
    full_month, full_day = name_of(month - 1, L.MONTH_NAMES), name_of(dow, L.DAY_NAMES)
    month_end = day == F.last_day(day)
    first_of_month = F.dayofmonth(day) == 1
    return date_spine(spark, start, end).select(
        date_key(day).alias("date_key"), "calendar_date",
        F.year(day).alias("year"), quarter.alias("quarter"), month.alias("month"),
        F.dayofmonth(day).alias("day"), dow.alias("day_of_week"), F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.year(day).cast("string").alias("year_text"),
        year_month(day).alias("year_month"),
        # the quarter digit appears twice: that is what consumers of this column expect
        F.concat(F.year(day), F.lit("-"), quarter, quarter).alias("year_quarter"),
        F.rpad(full_month, L.NAME_WIDTH, " ").alias("month_name"),
        F.substring(full_month, 1, 3).alias("month_short_name"),
        F.rpad(full_day, L.NAME_WIDTH, " ").alias("day_name"),
        F.substring(full_day, 1, 3).alias("day_short_name"),
        dow.between(1, 5).alias("is_weekday"), dow.isin(0, 6).alias("is_weekend"),
        first_of_month.alias("is_first_day_of_month"), month_end.alias("is_last_day_of_month"),
        (first_of_month & (month % 3 == 1)).alias("is_first_day_of_quarter"),
        (month_end & (month % 3 == 0)).alias("is_last_day_of_quarter"),
        (F.dayofyear(day) == 1).alias("is_first_day_of_year"),
        (month_end & (month == 12)).alias("is_last_day_of_year"),
        relative_period(day, as_of).alias("relative_period"),
        season(month).alias("season"))


def days_with_orders(days: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """The calendar with the orders placed and the status rows written on each day."""
    placed = (raw_orders.groupBy("order_id").agg(F.min(F.to_date("order_date")).alias("calendar_date"))
              .groupBy("calendar_date").agg(F.count(F.lit(1)).alias("orders_placed")))
    changed = raw_orders.groupBy(F.to_date("created_at").alias("calendar_date")).agg(F.count(F.lit(1)).alias("status_changes"))
    return (days.join(placed, "calendar_date", "left").join(changed, "calendar_date", "left")
            .fillna(0, ["orders_placed", "status_changes"]))


def dim_customer(staged: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Customer attributes; every column is row-local, so a full rebuild is one scan."""
    tenure, region = F.col("customer_tenure_days"), F.col("region")
    # region labels go through the raw lower-case region once
    named = ladder(region, [(raw, name) for raw, name, _ in L.REGION_NAMES], "Other", "=")
    code = ladder(region, [(raw, short) for raw, _, short in L.REGION_NAMES], "Other", "=")
    quartile = ladder(tenure, L.TENURE_QUARTILE, 1)
    loyal, core, growing, new = L.CUSTOMER_SEGMENTS
    segment = (F.when((quartile == 4) & named.isin("North America", "Europe"), loyal)
               .when(quartile >= 3, core).when(quartile == 2, growing).otherwise(new))
    return staged.select(
        surrogate_key("id").alias("customer_key"), F.col("id").alias("customer_id"),
        F.col("name").alias("customer_name"), "email", "signup_date", "country",
        named.alias("region"), code.alias("region_code"), "created_at",
        "customer_tenure_days", ladder(tenure, L.TENURE_SEGMENT, L.TENURE_SEGMENT_REST).alias("tenure_segment"),
        quartile.alias("tenure_quartile"), "signup_year", "signup_month", "signup_day_of_week",
        F.when(F.col("signup_day_of_week").isin(*L.SIGNUP_WEEKEND_DOW), "Weekend").otherwise("Weekday")
        .alias("signup_timing"),
        season(F.col("signup_month")).alias("signup_season"),
        segment.alias("customer_segment"),
        is_true(tenure >= 0).alias("is_current_customer"),
        ladder(tenure, L.CHURN_BY_TENURE, "Low Risk", "<").alias("churn_risk_segment"),
        moment(loaded_at).alias("created_at_dim"),
        moment(loaded_at).alias("updated_at_dim"))


def product_price_bands(staged: DataFrame) -> DataFrame:
    """Price deciles, quartiles and in-category positions from one range pass over prices.

    Ascending ties go by product id; the descending rank in the category is the exact
    reverse, so both come from the same order.
    """
    ranks = rank_rows(staged.select(F.col("id").alias("product_id"), "price", "category"),
                      "product_id", "price", ["category"])
    in_category = ntile_of("pos_in_category", "n_in_category", 4)
    positions = ladder(in_category, L.CATEGORY_POSITIONS.items(), L.CATEGORY_POSITION_REST, "=")
    return (ranks.select(
        "product_id",
        ntile_of("pos", "n", 10).alias("price_decile"), ntile_of("pos", "n", 4).alias("price_quartile"),
        (F.col("n_in_category") - F.col("pos_in_category") + 1).cast("int").alias("price_rank_in_category"),
        positions.alias("category_position"))
        .withColumn("overall_price_position", by_rules(L.PRICE_POSITION_RULES, L.LOWEST_QUARTER)))


def product_attributes(staged: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """The row-local columns of the product dimension: keys and attributes without price bands."""
    stamp = moment(loaded_at)
    return staged.select(
        surrogate_key("id").alias("product_key"), F.col("id").alias("product_id"),
        F.col("name").alias("product_name"), *[c for c in staged.columns if c not in ("id", "name")],
        stamp.alias("dim_created_at"), stamp.alias("dim_updated_at"), F.lit(1).alias("dim_version"))


def dim_product(staged: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    base = product_attributes(staged, loaded_at)
    return base.join(product_price_bands(staged), "product_id").select(
        *base.columns, "price_decile", "price_quartile", "price_rank_in_category",
        "category_position", "overall_price_position")
