"""Orders and items kept in hash buckets of the order id, so that order facts need no exchange on it.

Latest status, numbering within an order, item totals and the joins of orders with their items all work per order.  Derived from
plain tables, each fact shuffles status rows and items anew; here both are shuffled once, when they are stored, and
every later step reads bucket by bucket.

An order with more rows than one task should hold would fill its bucket.  Such orders are kept apart, in tables without
buckets, and go through the same code with exchanges, which adaptive execution splits and ``sequence_rows`` spreads over ranges.
No step looks beyond one order, so the facts of both parts together are those of the whole.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.ranking import CROWD
from orderloom.plans.warehouse import Warehouse
from orderloom.session import ensure_checkpoint_dir, pinned

KEY = "order_id"
BY_ORDER = ("raw_orders", "raw_order_items")


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Store ``df`` in ``buckets`` files by the hash of ``key``: one shuffle, one file per bucket.

    The files lie in the shared folder; the session's catalog only holds the name, without which Spark would not know the buckets.
    """
    spark, label = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}").saveAsTable(label))
    return spark.table(label)


def crowded_orders(tables: list[DataFrame], most: int) -> DataFrame:
    """Orders with more than ``most`` rows in one of the tables; counted in the map tasks first."""
    found = None
    for table in tables:
        rows = table.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(KEY)
        found = rows if found is None else found.unionByName(rows)
    return pinned(found.distinct())


def by_order(w: Warehouse, buckets: int | None = None, most: int = CROWD) -> list[Warehouse]:
    """Warehouses whose raw orders and items are stored by order id: the usual orders in buckets, then crowded ones, if any.

    ``buckets`` is by default the session's number of shuffle partitions; choose it so that a bucket fits a task.
    """
    count = buckets or int(w.spark.conf.get("spark.sql.shuffle.partitions"))
    tables = {name: w.raw[name] for name in BY_ORDER}
    crowded = crowded_orders(list(tables.values()), most)
    met = [F.col(KEY).eqNullSafe(F.col("_crowded"))]
    crowd = crowded.withColumnRenamed(KEY, "_crowded")
    none = crowded.isEmpty()
    parts = [{name: bucketed(t if none else t.join(crowd, met, "left_anti"), KEY, count) for name, t in tables.items()}]
    if not none:
        parts.append({name: pinned(t.join(crowd, met, "left_semi")) for name, t in tables.items()})
    return [_over(w, part) for part in parts]


def _over(w: Warehouse, tables: dict[str, DataFrame]) -> Warehouse:
    part = Warehouse(replace(w.sources), w.as_of, w.calendar, w.loaded_at)
    part.pin("raw", {**w.raw, **tables})
    for name in ("dim_customer", "product_links"):
        part.pin(name, getattr(w, name))
    return part


def fact(parts: list[Warehouse], name: str) -> DataFrame:
    """A fact at order, order line or status grain, of all parts together."""
    out = getattr(parts[0], name)
    for part in parts[1:]:
        out = out.unionByName(getattr(part, name))
    return out
