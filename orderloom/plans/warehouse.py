"""The whole warehouse as lazy DataFrames over one set of sources."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import analysis, dimensions, facts, metrics, snapshot, staging
from orderloom.sources.tables import RAW_TABLES, Sources, raw_table


class Warehouse:
    """Tables are attributes, derived on first use.

    Most are lazy.  Those that number or rank rows store their range partitions when they are first read, and
    the daily snapshot finds its medians then.

    ``as_of`` stands for "today" everywhere and ``calendar`` is the date spine, end
    exclusive; by default it covers all status dates.  ``pin`` puts a stored table in the place of a derived one, so that
    everything built on it reads the storage.
    """

    def __init__(self, sources: Sources, as_of: dt.date, calendar: tuple[dt.date, dt.date] | None = None,
                 loaded_at: dt.datetime | None = None):
        self.sources, self.as_of = sources, as_of
        if calendar:
            self.calendar = calendar
        self.loaded_at = loaded_at or dt.datetime.combine(as_of, dt.time())
        self.lookups = sources.lookups
        self.deal = lambda rows: rows     # how the narrow rows of a fact are spread before its other columns are added

    def pin(self, name: str, table: DataFrame) -> None:
        self.__dict__[name] = table

    @property
    def spark(self) -> SparkSession:
        return self.sources.orders.sparkSession

    @cached_property
    def calendar(self) -> tuple[dt.date, dt.date]:
        """First day and the day after the last one of all status rows."""
        day = F.to_date("created_at")
        first, last = self.sources.orders.agg(F.min(day), F.max(day)).first()
        if first is None:
            return self.as_of, self.as_of + dt.timedelta(days=1)
        return first, last + dt.timedelta(days=1)

    # --- raw and staging ------------------------------------------------------------

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        named = self.sources.named()
        return {name: raw_table(named[source], name) for name, (source, _, _) in RAW_TABLES.items()}

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["raw_customers"], self.lookups, self.as_of)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["raw_products"], self.lookups)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["raw_orders"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["raw_order_items"], self.lookups)

    # --- dimensions -----------------------------------------------------------------

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, self.as_of, *self.calendar)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(self.stg_customers, self.loaded_at)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.stg_products, self.loaded_at)

    @cached_property
    def product_links(self) -> DataFrame:
        """The part of the product dimension that facts and metrics join; needs no ranking pass."""
        return dimensions.product_attributes(self.stg_products, self.loaded_at)

    # --- facts ----------------------------------------------------------------------

    @cached_property
    def items_by_order(self) -> DataFrame:
        """Raw items, dealt by order id if they are read from storage: the narrow rows then meet in one exchange."""
        return self.raw["raw_order_items"]

    @cached_property
    def order_items_agg(self) -> DataFrame:
        return facts.order_items_agg(staging.priced_items(self.items_by_order, self.lookups))

    @cached_property
    def fact_orders(self) -> DataFrame:
        return facts.fact_orders(self.raw["raw_orders"], self.order_items_agg, self.dim_customer, self.loaded_at, self.deal)

    @cached_property
    def fact_order_line(self) -> DataFrame:
        return facts.fact_order_line(staging.numbered_items(self.raw["raw_order_items"]), self.raw["raw_orders"], self.dim_customer,
                                     self.product_links, self.loaded_at, lambda items: staging.priced_items(items, self.lookups), self.deal)

    @cached_property
    def fact_orders_scd2(self) -> DataFrame:
        return facts.fact_orders_scd2(self.raw["raw_orders"], self.order_items_agg, self.dim_customer,
                                      self.loaded_at, self.deal)

    # --- daily bases and metrics ----------------------------------------------------

    @cached_property
    def daily_order_state(self) -> DataFrame:
        return snapshot.daily_order_state(self.fact_orders_scd2, *self.calendar)

    @cached_property
    def daily_order_base(self) -> DataFrame:
        return metrics.daily_order_base(self.daily_order_state)

    @cached_property
    def daily_customer_activity(self) -> DataFrame:
        return metrics.daily_customer_activity(self.fact_orders, self.dim_customer)

    @cached_property
    def daily_customer_base(self) -> DataFrame:
        return metrics.daily_customer_base(self.daily_customer_activity,
                                           metrics.daily_customer_acquisition(self.dim_customer))

    @cached_property
    def daily_product_base(self) -> DataFrame:
        return metrics.daily_product_base(self.fact_order_line, self.product_links)

    @cached_property
    def order_trend_base(self) -> DataFrame:
        return analysis.order_trend_base(self.fact_orders)

    @cached_property
    def metric_daily_orders(self) -> DataFrame:
        return metrics.metric_daily_orders(self.daily_order_base, self.loaded_at)

    @cached_property
    def metric_daily_customers(self) -> DataFrame:
        return metrics.metric_daily_customers(self.daily_customer_base, self.loaded_at)

    @cached_property
    def metric_daily_products(self) -> DataFrame:
        return metrics.metric_daily_products(self.daily_product_base, self.loaded_at)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return metrics.daily_metrics(self.metric_daily_orders, self.metric_daily_products,
                                     self.metric_daily_customers, self.loaded_at)

    # --- analyses -------------------------------------------------------------------

    @cached_property
    def analysis_metrics_dashboard(self) -> DataFrame:
        return analysis.metrics_dashboard(self.metric_daily_orders, self.metric_daily_customers,
                                          self.metric_daily_products, self.loaded_at)

    @cached_property
    def order_trends_daily(self) -> DataFrame:
        return analysis.order_trends_daily(self.order_trend_base)

    @cached_property
    def analysis_order_trends(self) -> DataFrame:
        return analysis.order_trends(self.order_trends_daily, self.loaded_at)

    @cached_property
    def customer_purchases(self) -> DataFrame:
        return analysis.customer_purchases(self.fact_orders)

    @cached_property
    def customer_preferences(self) -> DataFrame:
        return analysis.product_preferences(self.fact_order_line, self.product_links)

    @cached_property
    def analysis_customer_behavior(self) -> DataFrame:
        return analysis.customer_behavior(self.customer_purchases, self.customer_preferences, self.dim_customer,
                                          self.as_of, self.loaded_at)

    @cached_property
    def product_sales(self) -> DataFrame:
        return analysis.product_sales(self.fact_order_line)

    @cached_property
    def analysis_product_performance(self) -> DataFrame:
        return analysis.product_performance(self.product_sales, self.dim_product, self.as_of, self.loaded_at)
