"""Source tables: schemas, readers and the raw projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.sources.lookups import Lookups

_ID, _TEXT, _WHEN = T.LongType(), T.StringType(), T.TimestampNTZType()
_PRICE, _DAY, _INT = T.DecimalType(10, 2), T.DateType(), T.IntegerType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SOURCE_SCHEMAS = {
    "source_customers": _schema(id=_ID, name=_TEXT, email=_TEXT, country=_TEXT, signup_date=_DAY, created_at=_WHEN),
    "source_products": _schema(id=_ID, name=_TEXT, category=_TEXT, price=_PRICE, created_at=_WHEN),
    "source_orders": _schema(record_id=_ID, id=_TEXT, customer_id=_ID, order_date=_WHEN, status=_TEXT,
                             total_amount=_PRICE, created_at=_WHEN),
    "source_order_items": _schema(id=_ID, order_id=_TEXT, product_id=_ID, quantity=_INT, unit_price=_PRICE,
                                  created_at=_WHEN),
}

# raw table -> (source table, unique key, renamed columns)
RAW_TABLES = {
    "raw_customers": ("source_customers", "id", {}),
    "raw_products": ("source_products", "id", {}),
    "raw_orders": ("source_orders", "record_id", {"id": "order_id"}),
    "raw_order_items": ("source_order_items", "id", {}),
}


@dataclass
class Sources:
    """The four source tables and the lookups."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    lookups: Lookups = field(default_factory=Lookups)

    def named(self) -> dict[str, DataFrame]:
        return {"source_customers": self.customers, "source_products": self.products,
                "source_orders": self.orders, "source_order_items": self.order_items}


def read_sources(spark: SparkSession, root: str, fmt: str = "parquet", lookups: Lookups | None = None,
                 **options: str) -> Sources:
    """Read ``root/source_*`` with the declared schemas (columns are pruned by each query)."""
    frames = {}
    for name, schema in SOURCE_SCHEMAS.items():
        frames[name.removeprefix("source_")] = (
            spark.read.schema(schema).options(**options).format(fmt).load(f"{root}/{name}"))
    return Sources(**frames, lookups=lookups or Lookups())


def read_jdbc_sources(spark: SparkSession, url: str, prefix: str = "data.", key_ranges: dict | None = None,
                      lookups: Lookups | None = None, **options: str) -> Sources:
    """Read the four tables over JDBC.

    ``key_ranges`` maps a table to ``(column, low, high, partitions)`` so that the
    read is split over tasks instead of running through one connection.
    """
    frames = {}
    for name, schema in SOURCE_SCHEMAS.items():
        reader = spark.read.format("jdbc").options(url=url, dbtable=f"{prefix}{name}", **options)
        if key_ranges and name in key_ranges:
            column, low, high, parts = key_ranges[name]
            reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high),
                                    numPartitions=str(parts))
        frame = reader.load()
        frames[name.removeprefix("source_")] = frame.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return Sources(**frames, lookups=lookups or Lookups())


def raw_table(frame: DataFrame, name: str) -> DataFrame:
    """Pass-through projection of a source table, with its renamed columns."""
    source, _, renames = RAW_TABLES[name]
    return frame.select(*[F.col(f).alias(renames.get(f, f)) for f in SOURCE_SCHEMAS[source].fieldNames()])


def table_stats(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, in one job; tables without rows are listed with 0."""
    counts = None
    for name, frame in frames.items():
        one = frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts
