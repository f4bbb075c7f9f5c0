"""Column helpers shared by all operators.

Money, shares and averages stay DECIMAL from end to end, so results do not depend
on how Spark orders partial sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import WindowSpec

from orderloom.functions import labels as L

MONEY = "decimal(20,2)"
RATE = "decimal(20,2)"
AVERAGE = "decimal(24,8)"


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def number(value) -> Column:
    """Literal that keeps comparisons with decimals exact."""
    return F.lit(Decimal(str(value)) if isinstance(value, float) else value)


# --- dates -------------------------------------------------------------------------

def dow0(day: str | Column) -> Column:
    """Day of week counted from Sunday = 0."""
    return F.dayofweek(col(day)) - 1


def date_key(day: str | Column) -> Column:
    """YYYYMMDD as an integer."""
    day = col(day)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def year_month(day: str | Column) -> Column:
    return F.date_format(col(day), "yyyy-MM")


def season(month: Column) -> Column:
    out = None
    for name, months in L.SEASONS:
        out = F.when(month.isin(*months), name) if out is None else out.when(month.isin(*months), name)
    return out


def weekend_label(day: str | Column) -> Column:
    return F.when(dow0(day).isin(0, 6), "Weekend").otherwise("Weekday")


def day_part(hour: Column) -> Column:
    out = None
    for name, first, last in L.DAY_PARTS:
        hit = hour.between(first, last)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(L.DAY_PART_REST)


def name_of(index: Column, names: Sequence[str]) -> Column:
    """Entry of a short fixed list, ``index`` counted from 0."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def padded_day_name(day: str | Column) -> Column:
    return F.rpad(name_of(dow0(day), L.DAY_NAMES), L.NAME_WIDTH, " ")


def moment(value: dt.datetime | dt.date) -> Column:
    """Timestamp literal without a zone; a plain literal would be shifted by the session's zone."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days that have passed between two timestamps without a zone."""
    return F.extract(F.lit("DAY"), col(end) - col(start)).cast("bigint")


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Exact hours between two timestamps without a zone, as a decimal."""
    span = col(end) - col(start)

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), span).cast("decimal(18,6)")

    seconds = part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")
    return (seconds.cast("decimal(20,6)") / F.lit(Decimal(3600))).cast(AVERAGE)


# --- labels ------------------------------------------------------------------------

def compare(left: Column, op: str, right) -> Column:
    if op == "in":
        return left.isin(*right)
    right = number(right) if isinstance(right, (int, float)) else F.lit(right)
    return {"=": left == right, ">=": left >= right, "<=": left <= right,
            ">": left > right, "<": left < right}[op]


def ladder(value: str | Column, steps: Iterable[tuple], otherwise, op: str = ">=") -> Column:
    value, out = col(value), None
    for bound, label in steps:
        hit = compare(value, op, bound)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def by_rules(rules: Iterable[tuple], otherwise=None) -> Column:
    out = None
    for conditions, label in rules:
        hit = None
        for name, op, value in conditions:
            test = compare(F.col(name), op, value)
            hit = test if hit is None else hit & test
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out if otherwise is None else out.otherwise(otherwise)


def has_any_word(text: Column, words: Iterable[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | text.contains(word)
    return F.coalesce(out, F.lit(False))


def first_keyword(text: Column, pairs: Iterable[tuple[str, str]], otherwise: str) -> Column:
    """Value of the first pair, in list order, whose keyword occurs in ``text``."""
    hits = [F.when(text.contains(keyword.lower()), value) for keyword, value in pairs]
    return F.coalesce(*hits, F.lit(otherwise))


def first_range(value: Column, ranges: Iterable[tuple], otherwise: str) -> Column:
    """Label of the closed range that holds ``value``."""
    hits = [F.when(value.between(F.lit(Decimal(str(lo))), F.lit(Decimal(str(hi)))), label)
            for lo, hi, label in ranges]
    return F.coalesce(*hits, F.lit(otherwise))


def is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the '-'-joined text of the columns, nulls replaced by a token."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(L.NULL_KEY_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def slim(df: DataFrame, made: dict[str, Column], whole: Sequence[str] = ()) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows without the columns that can be ``made`` from their others, and the way back, for an exchange of wide rows.

    Each row is tested: one that holds anything else than its others make of it keeps its own values.  Texts of 32 hexadecimal
    digits travel as 16 bytes.  Columns named in ``whole`` stay as they are: those that the rows are joined by on their way.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    made = {c: value.cast(kinds[c]) for c, value in made.items() if c in kinds and c not in whole}
    texts = [c for c, kind in kinds.items() if c.endswith("_key") and isinstance(kind, StringType) and c not in whole]
    as_made = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(value) for c, value in made.items()], F.lit(True))

    def packed(c: str) -> Column:
        value = F.when(F.col("_as_made"), F.lit(None)).otherwise(F.col(c)) if c in made else F.col(c)
        return (pack_digits(value) if c in texts else value).alias(c)

    def back(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({c: unpack_digits(F.col(c)) for c in texts})
        return rows.select(*[F.when(F.col("_as_made"), made[c]).otherwise(F.col(c)).alias(c) if c in made else F.col(c) for c in kinds])

    return df.withColumn("_as_made", as_made).select(*[packed(c) for c in kinds], "_as_made"), back


def pack_digits(text: Column) -> Column:
    """A text as bytes, 32 hexadecimal digits as 16.  The first byte tells the two forms apart, so no two texts share one."""
    digits = text.rlike("^[0-9a-f]{32}\\z")
    return F.when(digits, F.concat(F.lit(b"\x01"), F.unhex(text))).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def unpack_digits(packed: Column) -> Column:
    body = F.substring(packed, F.lit(2), F.octet_length(packed))
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(body))).otherwise(body.cast("string"))


# --- arithmetic --------------------------------------------------------------------

def zero(kind: str = RATE) -> Column:
    return F.lit(0).cast(kind)


def ratio(part: str | Column, whole: str | Column, times: int = 1, kind: str = MONEY) -> Column:
    """``times * part / whole`` rounded to two places, 0 unless ``whole`` is positive.

    ``kind`` is the type both sides are brought to; it leaves the quotient at least
    ten decimal places before it is rounded.
    """
    whole = col(whole)
    quotient = col(part).cast(kind) * F.lit(Decimal(times)) / F.when(whole > 0, whole.cast(kind))
    return F.when(whole > 0, F.round(quotient, 2).cast(RATE)).otherwise(zero())


def pct(part: str | Column, whole: str | Column, kind: str = MONEY) -> Column:
    return ratio(part, whole, 100, kind)


def _quotient(total: Column, count: Column) -> Column:
    return (total.cast(AVERAGE) / F.nullif(count, F.lit(0))).cast(AVERAGE)


def mean(value: str | Column) -> Column:
    """Exact average kept at eight decimal places."""
    value = col(value)
    return _quotient(F.sum(value), F.count(value))


def mean_over(value: str | Column, window: WindowSpec) -> Column:
    value = col(value)
    return _quotient(F.sum(value).over(window), F.count(value).over(window))


def rounded_mean_over(value: str | Column, window: WindowSpec) -> Column:
    value = col(value)
    quotient = F.sum(value).over(window).cast(AVERAGE) / F.nullif(F.count(value).over(window), F.lit(0))
    return F.round(quotient, 2).cast(RATE)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_if(condition: Column, value: str | Column) -> Column:
    """Sum of ``value`` over matching rows, 0 where none match."""
    return F.sum(F.when(condition, col(value)).otherwise(zero("decimal(10,2)")))


def ntile_of(position: str | Column, total: str | Column, buckets: int) -> Column:
    """``ntile`` from a 1-based position: the first ``total % buckets`` buckets get one row more."""
    position, total = col(position), col(total)
    size, extra = F.floor(total / buckets), total % buckets
    edge = extra * (size + 1)
    late = extra + F.ceil((position - edge) / F.greatest(size, F.lit(1)))
    return F.when(position <= edge, F.ceil(position / (size + 1))).otherwise(late).cast("int")
