"""Positions at scale: numbering rows without pulling a group into one task.

A plain window sends all rows of a group to one task.  That is fine for orders with
a handful of rows, but neither for a ranking over all rows nor for a key that owns a
large share of them.  Here the rows are range-partitioned by the sort order, each
range is numbered on its own, and the sizes of earlier ranges are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.session import pinned

CROWD = 100_000      # rows of a key that one task numbers


def _fixed_ranges(df: DataFrame, *order, label: str) -> DataFrame:
    """Range-partition by ``order`` and store the range number of each row.

    Storing makes the number part of the data: range bounds come from a
    sample, so a recomputed plan could draw them elsewhere.  There are at most as many
    ranges as shuffle partitions; AQE merges neighbouring small ones.
    """
    return pinned(df.repartitionByRange(*order).withColumn(label, F.spark_partition_id()))


def rank_rows(df: DataFrame, key: str, by: str, groups: Sequence[str] = ()) -> DataFrame:
    """Ascending positions of ``by`` (nulls last, ties by the unique ``key``).

    Returns ``key, pos, n`` and per group column ``pos_in_<group>, n_in_<group>``.
    A descending rank with reversed ties is ``n - pos + 1``.
    """
    order = [F.col(by).asc_nulls_last(), F.col(key).asc()]
    rows = _fixed_ranges(df.select(key, by, *groups), *order, label="_range")
    # one row per range: bounded by the number of shuffle partitions
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
                          F.sum("_size").over(whole).alias("n"))
    local = W.partitionBy("_range").orderBy(*order)
    out = (rows.join(F.broadcast(starts), "_range")
           .withColumn("pos", F.col("_start") + F.row_number().over(local)))
    for group in groups:
        part_sizes = rows.groupBy("_range", group).agg(F.count(F.lit(1)).alias("_size"))
        part = W.partitionBy(group).orderBy("_range")
        part_starts = part_sizes.select(
            "_range", F.col(group).alias("_group"),
            F.coalesce(F.sum("_size").over(part.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.sum("_size").over(W.partitionBy(group)).alias(f"n_in_{group}"))
        local = W.partitionBy("_range", group).orderBy(*order)
        out = (out.withColumn("_local", F.row_number().over(local))
               .withColumnRenamed("_range", "_r")
               .join(part_starts, (F.col("_r") == F.col("_range")) & F.col(group).eqNullSafe(F.col("_group")))
               .withColumn(f"pos_in_{group}", F.col("_before") + F.col("_local"))
               .drop("_range", "_group", "_before", "_local")
               .withColumnRenamed("_r", "_range"))
    return out.select(key, "pos", "n", *[f"{p}_in_{g}" for g in groups for p in ("pos", "n")])


def sequence_rows(df: DataFrame, key: str, order: Sequence[str], seq: str, *, upcoming: tuple[str, str] | None = None,
                  last_flag: str | None = None) -> DataFrame:
    """Number the rows of each ``key`` by ``order`` (its last column unique within the key).

    ``upcoming=(column, name)`` adds the column's value on the next row of the key, and
    ``last_flag`` marks the row without a next one.

    Keys are counted first, in the map tasks as far as possible.  Those of up to ``CROWD`` rows are numbered by a window, with one
    shuffle; the rows of larger ones are spread over ranges.  Both ways give the same numbers.
    """
    counts = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > CROWD)
    crowded = pinned(counts.select("_key"))
    if crowded.isEmpty():
        return _number_in_tasks(df, key, order, seq, upcoming, last_flag)
    met = F.col(key).eqNullSafe(F.col("_key"))
    few, many = df.join(crowded, met, "left_anti"), df.join(crowded, met, "left_semi")
    return _number_in_tasks(few, key, order, seq, upcoming, last_flag).unionByName(
        _number_in_ranges(many, key, order, seq, upcoming, last_flag))


def _number_in_tasks(df: DataFrame, key: str, order: Sequence[str], seq: str, upcoming, last_flag) -> DataFrame:
    own = W.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    added = [F.row_number().over(own).alias(seq)]
    if upcoming:
        added.append(F.lead(upcoming[0]).over(own).alias(upcoming[1]))
    if last_flag:
        added.append(F.lead(F.lit(1)).over(own).isNull().alias(last_flag))
    return df.select(*[F.col(c) for c in df.columns], *added)


def _number_in_ranges(df: DataFrame, key: str, order: Sequence[str], seq: str, upcoming, last_flag) -> DataFrame:
    """The same for keys of any size.

    Rows are range-partitioned by key and order, so a key of any size is spread over as many ranges as
    it fills, and each range is numbered on its own.  Only a range's first and last key can go on in
    another one: at most two keys per range need the sizes of earlier ranges and the head of the next.
    """
    wanted = [F.col(c) for c in df.columns]
    sort = [F.col(c).asc_nulls_last() for c in order]
    rows = _fixed_ranges(df, F.col(key).asc_nulls_last(), *sort, label="_range")
    ahead = upcoming[0] if upcoming else key
    # bounded by the number of ranges: their border keys, and per border key and range its size and head
    borders = rows.groupBy("_range").agg(F.array(F.min(key), F.max(key), F.max(F.when(F.col(key).isNull(), F.col(key)))).alias("_k"),
                                         F.max(F.col(key).isNull()).alias("_null"))
    borders = (borders.select(F.explode("_k").alias("_border"), "_null")
               .where(F.col("_border").isNotNull() | F.col("_null")).select("_border").distinct())
    at_border = rows.join(F.broadcast(borders), F.col(key).eqNullSafe(F.col("_border")), "left_semi")
    head = F.min_by(F.struct(F.col(ahead).alias("value")), F.struct(*[f for c in order for f in (F.col(c).isNull(), F.col(c))])).alias("_head")
    edges = at_border.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_part")).agg(F.count(F.lit(1)).alias("_size"), head)
    across = W.partitionBy("_key").orderBy("_part")
    earlier = across.rowsBetween(W.unboundedPreceding, -1)
    edges = edges.select("_key", "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
                         F.lead("_head").over(across).alias("_next_head"))
    local = W.partitionBy("_range", key).orderBy(*sort)
    rows = rows.withColumns({"_local": F.row_number().over(local), "_next": F.lead(ahead).over(local),
                             "_end": F.lead(F.lit(1)).over(local).isNull()})
    rows = rows.join(F.broadcast(edges), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_part")), "left")
    added = [(F.coalesce("_before", F.lit(0)) + F.col("_local")).cast("int").alias(seq)]
    if upcoming:
        added.append(F.when(F.col("_end"), F.col("_next_head.value")).otherwise(F.col("_next")).alias(upcoming[1]))
    if last_flag:
        added.append((F.col("_end") & F.col("_next_head").isNull()).alias(last_flag))
    return rows.select(*wanted, *added)
