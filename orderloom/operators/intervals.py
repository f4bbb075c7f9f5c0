"""Join of points with the intervals that hold them, for any two tables, without comparing every pair.

Intervals fall into classes of width, each four times as wide as the one before (or as asked).  The bins of a class are as wide as its widest interval, so
an interval lies in two bins at most (three if its borders are fractions), however long it is.  A point looks into one bin of every class
that occurs, of which a 64-bit range has no more than 32.  Bins meet by an ordinary equality join, and the exact borders decide afterwards.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import moment

EPOCH = dt.datetime(1970, 1, 1)


def _whole(column: str, kind: str) -> Column:
    """A whole number that rises with the value: microseconds, days, or the number rounded down."""
    value = F.col(column)
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", moment(EPOCH), value)
    if kind == "timestamp":
        return F.unix_micros(value)
    if kind == "date":
        return F.unix_date(value).cast("bigint")
    return F.floor(value).cast("bigint")


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, on: Sequence[str] = (), bits: int = 2) -> DataFrame:
    """All pairs with equal ``on`` and ``start <= at < end``; a null ``end`` is open, null points and starts meet nothing.

    Each class is ``2 ** bits`` times as wide as the one before.  More bits make fewer classes, and so fewer rows per point on their way, but
    wider bins; take them where ``on`` leaves few intervals per bin anyway.

    Columns of ``points`` come first, then those of ``intervals`` without ``on``; apart from ``on`` their names must differ.
    """
    kind = dict(points.dtypes)[at]
    points = points.where(F.col(at).isNotNull()).withColumn("_p", _whole(at, kind))
    last = points.agg(F.max("_p")).first()[0]
    if last is None:
        last = 0
    # An open interval ends after the last point.
    spans = intervals.where(F.col(start).isNotNull()).withColumns({"_s": _whole(start, kind), "_e": _whole(end, kind)})
    spans = spans.withColumn("_e", F.least(F.coalesce("_e", F.lit(last + 1)), F.lit(last + 1))).where("_s <= _e")
    spans = spans.withColumn("_class", (F.floor(F.log2(F.col("_e") - F.col("_s") + 1) / bits) + 1).cast("int"))
    classes = sorted(r[0] for r in spans.select("_class").distinct().collect())       # 32 at most
    names = [c for c in intervals.columns if c not in on]
    binned = spans.select(*on, *names, "_class", F.explode(F.expr(
        f"sequence(shiftright(_s, {bits} * _class), shiftright(_e, {bits} * _class))")).alias("_bin"))
    looking = points.withColumn("_class", F.explode(F.array(*[F.lit(c) for c in classes]).cast("array<int>"))).withColumn(
        "_bin", F.expr(f"shiftright(_p, {bits} * _class)")).drop("_p")
    met = looking.join(binned, [*on, "_class", "_bin"])
    inside = (F.col(start) <= F.col(at)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    return met.where(inside).select(*[c for c in points.columns if c != "_p"], *names)
