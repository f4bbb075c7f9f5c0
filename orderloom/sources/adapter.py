"""Derive the four source tables from TPC-H-like Parquet files.

Every row of customer, part, orders and lineitem is used.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.functions import labels as L
from orderloom.functions.columns import moment
from orderloom.sources.lookups import Lookups
from orderloom.sources.tables import Sources

AS_OF = dt.date(2001, 9, 1)

SIGNUP_START = dt.date(1999, 9, 1)
PRODUCT_CREATED = dt.datetime(1994, 12, 1)
LINES_BYTES = 4 << 20     # of the file of lines, about 220,000 rows
NAME_SUFFIXES = ["spring", "summer", "fall", "winter", "holiday", "limited edition", "premium", "classic"]
# The product categories, in order.
CATEGORIES = [
    "Dresses", "Tops & Blouses", "Sweaters & Knitwear", "Jackets & Coats", "Pants & Trousers", "Skirts",
    "Jeans & Denim", "Activewear & Athleisure", "Lingerie & Intimates", "Sleepwear & Loungewear",
    "Swimwear & Beachwear", "Handbags & Purses", "Jewelry & Watches", "Scarves & Wraps", "Belts & Accessories",
    "Shoes & Footwear", "Sunglasses & Eyewear", "Hats & Hair Accessories", "Tech Accessories", "Gift Cards & Sets",
]
# Declared, so that opening a table needs no job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double",
}
REGION_OF = {"AMERICA": "north america", "EUROPE": "europe", "ASIA": "asia pacific", "AFRICA": "africa"}


def _pick(index, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _days(start, days):
    return start + F.make_dt_interval(days.cast("int"))


def _by_order(lines: DataFrame, folder: str) -> DataFrame:
    """Lines dealt by order id, in tasks of about ``LINES_BYTES`` of the file, whatever the session's number of shuffle partitions."""
    spark = lines.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/lineitem.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    tasks = -(-size // LINES_BYTES)
    # Adaptive execution would join small partitions up to a size in bytes, which many of these narrow rows fit; not below one per core.
    if tasks <= spark.sparkContext.defaultParallelism:
        return lines.repartition("order_id")
    return lines.repartition(max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "order_id")


def star_schema_sources(spark: SparkSession, folder: str, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> Sources:
    """The four source tables.  ``keep`` may store the priced lines for those who read orders and items several times."""
    def read(name: str) -> DataFrame:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    nation, region = read("nation"), read("region")
    customer, part = read("customer"), read("part")
    orders, lineitem = read("orders"), read("lineitem")

    region_name = F.create_map(*[F.lit(part) for pair in REGION_OF.items() for part in pair])[F.col("r_name")]
    country_region = (nation.join(region, nation.n_regionkey == region.r_regionkey)
                      .select(F.lower("n_name").alias("country"), region_name.alias("region")).dropna())

    signup = F.date_add(F.lit(SIGNUP_START), ((F.col("c_custkey") * 7) % 730).cast("int"))
    customers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        signup.alias("signup_date"),
        signup.cast("timestamp_ntz").alias("created_at"))

    key = F.col("p_partkey")
    price = ((F.col("p_retailprice").cast("decimal(10,2)") - 899) * 6).cast("decimal(10,2)")
    products = part.select(
        key.alias("id"),
        F.concat(F.col("p_name"), F.lit(" "), _pick(key % 8, NAME_SUFFIXES),
                 F.when(key % 5 == 0, " signature").otherwise("")).alias("name"),
        _pick(key % 20, CATEGORIES).alias("category"),
        price.alias("price"),
        moment(PRODUCT_CREATED).alias("created_at"))

    ordered_at = F.col("o_orderdate") + F.make_dt_interval(
        hours=(F.col("o_orderkey") % 24).cast("int"))
    discount = 1 - F.col("l_discount").cast("decimal(10,2)")
    # Orders and items are known by the text of the order key from here on.  One exchange by it serves the numbers, the totals and the
    # join with orders, and also every later step per order, which would otherwise shuffle the same rows by the text again.
    lines = keep(
        _by_order(lineitem.withColumn("order_id", F.col("l_orderkey").cast("string")).drop("l_orderkey"), folder)
        .withColumn("nth", F.row_number().over(W.partitionBy("order_id", "l_linenumber").orderBy(
            "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")))
        # lines of unknown products and orders stay, so that the checks see them
        .join(part.select("p_partkey", price.alias("list_price")), F.col("l_partkey") == F.col("p_partkey"), "left")
        .select("order_id", "l_partkey", "l_linenumber",
                # lines of an order may share a number: their place among those makes the id unique
                (F.col("order_id").cast("bigint") * 1_000_000 + F.col("l_linenumber") * 1000 + F.col("nth")).alias("id"),
                (1 + F.col("l_quantity").cast("int") % 6).alias("quantity"),
                F.round(F.col("list_price") * discount, 2).cast("decimal(10,2)").alias("unit_price")))
    placed_at = orders.select(F.col("o_orderkey").cast("string").alias("order_id"), ordered_at.alias("order_date"))
    order_items = lines.join(placed_at, "order_id", "left").select(
        "id", "order_id", F.col("l_partkey").alias("product_id"), "quantity", "unit_price",
        (F.col("order_date") + F.make_dt_interval(mins=F.col("l_linenumber"))).alias("created_at"))

    # whole cents, which take less room on their way than a decimal of 31 places
    cents = (F.col("unit_price") * 100).cast("bigint") * F.col("quantity")
    totals = lines.groupBy(F.col("order_id").alias("_order")).agg(F.sum(cents).alias("cents"))
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")

    def step(number: int, name: str, at):
        return F.struct((k * 10 + number).alias("record_id"), F.lit(name).alias("status"), at.alias("created_at"))

    placed = F.col("order_date")
    closed = _days(placed, 1 + k % 4)
    log = F.array_compact(F.array(
        step(1, L.PENDING, placed),
        F.when(k % 5 == 0, step(4, L.ITEMS_ADDED, placed + F.make_dt_interval(hours=F.lit(6)))),
        F.when(status == "F", step(2, L.COMPLETED, closed)),
        F.when((status == "O") & (k % 3 == 0), step(2, L.CANCELLED, closed)),
        F.when((status == "F") & (k % 12 == 0), step(3, L.REFUNDED, _days(placed, 2 + k % 4 + k % 2)))))
    # Totals meet the orders, of which there are fewer than rows of the log; questions about days or ids alone need no totals.
    order_log = (
        orders.select("o_orderkey", k.cast("string").alias("id"), "o_custkey", "o_orderstatus", ordered_at.alias("order_date"))
        .join(totals, F.col("id") == F.col("_order"), "left")
        .select("id", "o_custkey", "order_date", "cents", F.inline(log))
        .select("record_id", "id", F.col("o_custkey").alias("customer_id"), "order_date", "status",
                (F.coalesce("cents", F.lit(0)).cast("decimal(20,0)") / 100).cast("decimal(10,2)").alias("total_amount"), "created_at"))

    return Sources(customers, products, order_log, order_items,
                   lookups=Lookups(country_region=country_region))
