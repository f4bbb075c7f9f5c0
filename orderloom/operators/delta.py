"""What differs between two states of a table, and how far a change of one day reaches.

States are compared by a 128-bit print of their columns, so keys and prints meet instead of whole rows, and rows that are the
same on both sides are neither written nor stamped again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def prints(df: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """``keys`` and ``p1, p2``.  The hash skips nulls, so which columns are null is hashed as well."""
    columns = [c for c in df.columns if c not in (*keys, *ignore)]
    missing = F.array(*[F.col(c).isNull() for c in columns]) if columns else F.lit(0)
    return df.select(*keys, F.xxhash64(missing, *columns).alias("p1"), F.xxhash64(F.lit(1), *columns, missing).alias("p2"))


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """``keys, change``: what turns ``old`` into ``new``, without the rows that stay as they are.

    Keys are unique on each side; null keys equal each other.
    """
    before = prints(old, keys, ignore).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("p1").alias("_p1"), F.col("p2").alias("_p2"))
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    met = prints(new, keys, ignore).join(before, same_key, "full")
    change = (F.when(F.col("_p1").isNull(), INSERT).when(F.col("p1").isNull(), DELETE)
              .when((F.col("p1") != F.col("_p1")) | (F.col("p2") != F.col("_p2")), UPDATE))
    held = [F.when(F.col("p1").isNull(), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return met.select(*held, change.alias("change")).where(F.col("change").isNotNull())


def reach(rows: DataFrame, changed: DataFrame, day: str, ahead: int, month: bool) -> DataFrame:
    """``day, dirty, needed``: the rows whose frames hold a change, and those that are read to compute them again.

    Frames look back over ``ahead`` rows, and over the month so far if ``month``.  A changed row dirties itself and the ``ahead`` rows
    after it; a row that is gone dirties those after its old place.  ``rows`` has one row per calendar day, so one task is enough.
    """
    touched = changed.select(day, F.lit(True).alias("touched"), (F.col("change") == DELETE).alias("gone"))
    both = (rows.select(day).withColumn("real", F.lit(True)).join(touched, day, "full")
            .select(day, (F.coalesce("real", F.lit(False)) & ~F.coalesce("gone", F.lit(False))).alias("real"),
                    F.coalesce("touched", F.lit(False)).alias("touched")))
    in_order = W.orderBy(day).rowsBetween(W.unboundedPreceding, W.currentRow)
    # A row that is gone takes the place of the row after it.
    placed = both.withColumn("place", F.sum(F.col("real").cast("int")).over(in_order) + (~F.col("real")).cast("int"))
    by_place = W.orderBy("place")
    behind, before = by_place.rangeBetween(-ahead, 0), by_place.rangeBetween(0, ahead)
    this_month = W.partitionBy(F.trunc(F.col(day), "month")).orderBy(day)
    dirty = F.max("touched").over(behind)
    if month:
        dirty = dirty | F.max("touched").over(this_month.rowsBetween(W.unboundedPreceding, W.currentRow))
    marked = placed.withColumn("dirty", F.col("real") & dirty)
    needed = F.max("dirty").over(before)
    if month:
        needed = needed | F.max("dirty").over(this_month.rowsBetween(W.currentRow, W.unboundedFollowing))
    return marked.withColumn("needed", needed).where("real").select(day, "dirty", "needed")
