"""Data-quality checks: each yields the number of failing rows (or repeated values)."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.functions.columns import number
from orderloom.session import pinned


@dataclass
class Expectations:
    """Checks of one table.  ``required="*"`` means every column of the table."""

    required: str = ""
    unique: str = ""
    unique_together: list[list[str]] = field(default_factory=list)
    unique_text: list[list[str]] = field(default_factory=list)  # columns joined by '-' must be unique
    accepted: dict[str, list[str]] = field(default_factory=dict)
    ranges: dict[str, tuple] = field(default_factory=dict)  # column -> (min, max, inclusive)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, column)

    def required_columns(self, all_columns: list[str]) -> list[str]:
        return list(all_columns) if self.required == "*" else self.required.split()

    def columns(self, all_columns: list[str]) -> list[str]:
        groups = [c for g in self.unique_together + self.unique_text for c in g]
        named = [*self.required_columns(all_columns), *self.unique.split(), *groups,
                 *self.accepted, *self.ranges, *self.references]
        return [c for c in all_columns if c in set(named)]


def outside(column: str, low, high, inclusive: bool):
    value, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | ((value < number(low)) if inclusive else (value <= number(low)))
    if high is not None:
        bad = bad | ((value > number(high)) if inclusive else (value >= number(high)))
    return bad


def row_tests(columns: list[str], checks: Expectations) -> dict[tuple[str, str], Column]:
    """(test, column) -> condition of a failing row, for all checks that look at one row at a time."""
    tests = {("not_null", c): F.col(c).isNull() for c in checks.required_columns(columns)}
    tests |= {("accepted_values", c): ~F.col(c).isin(*values) for c, values in checks.accepted.items()}
    return tests | {("accepted_range", c): outside(c, *bounds) for c, bounds in checks.ranges.items()}


def row_checks(df: DataFrame, table: str, checks: Expectations) -> DataFrame | None:
    """The row tests in a single pass over the table."""
    tests = row_tests(df.columns, checks)
    if not tests:
        return None
    names = [f"t{i}" for i in range(len(tests))]
    counted = df.agg(*[F.count_if(test).alias(n) for n, test in zip(names, tests.values())])
    rows = F.array(*[F.struct(F.lit(test).alias("test"), F.lit(column).alias("column_name"), F.col(n).alias("failures"))
                     for n, (test, column) in zip(names, tests)])
    return counted.select(F.lit(table).alias("table_name"), F.inline(rows))


class Watch:
    """Row tests that are counted while a table is written, without a pass of their own.

    ``over`` goes around the frame just before it is written, so that each of its tasks counts once.
    """

    def __init__(self, table: str, checks: Expectations):
        self.table, self.checks, self._seen, self._tests = table, checks, None, {}

    def over(self, df: DataFrame) -> DataFrame:
        self._tests = row_tests(df.columns, self.checks)
        if not self._tests:
            return df
        self._seen = Observation()
        return df.observe(self._seen, *[F.count_if(test).alias(f"t{i}") for i, test in enumerate(self._tests.values())])

    def results(self) -> list[tuple[str, str, str, int]]:
        """``table, test, column, failures`` of the written rows."""
        counts = self._seen.get if self._seen else {}
        return [(self.table, test, column, counts[f"t{i}"]) for i, (test, column) in enumerate(self._tests)]


def _text(*columns: str) -> Column:
    """Text of a key, null if a part is null; parts carry their length, so no two keys share a text."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[part for t in texts for part in (F.length(t).cast("string"), F.lit(":"), t)])


def _packed(text: Column) -> Column:
    """A key's text in fewer bytes: 32 hexadecimal digits as 16.  The first byte tells the two forms apart, so no two texts share one."""
    digits = text.rlike("^[0-9a-f]{32}$")
    return F.when(digits, F.concat(F.lit(b"\x01"), F.unhex(text))).otherwise(F.concat(F.lit(b"\x00"), F.encode(text, "UTF-8")))


def key_report(frames: dict[str, DataFrame], suite: dict[str, Expectations]) -> DataFrame | None:
    """Checks that compare rows with each other or with a parent, for all tables of ``suite`` in one shuffle.

    Every row sends the text of each of its checked keys once.  A domain is a set of key columns; its own table sends into slot 0, each
    table that refers to it into a slot of its own.  Per key the slots are counted, in the map tasks first, so a frequent key
    is one row per task.  Texts travel packed.  A key is repeated if slot 0 has it more than once, and an orphan if slot 0 lacks it.  Null keys are
    not compared; keys of different types are equal if their texts are.
    """
    domains, slots, sent, declared = {}, {}, {}, []

    def domain(table: str, key: Column, *name) -> int:
        found = domains.setdefault((table, *name), len(domains))
        if found not in slots:
            slots[found] = 0
            sent.setdefault(table, []).append((found, 0, key))
        return found

    for table, checks in suite.items():
        unique = [("unique", c, domain(table, _text(c), c)) for c in checks.unique.split()]
        unique += [("unique", "-".join(c), domain(table, F.concat_ws("-", *c), "text", *c)) for c in checks.unique_text]
        unique += [("unique_combination", "-".join(c), domain(table, _text(*c), "parts", *c)) for c in checks.unique_together]
        declared += [(table, test, column, found, 0) for test, column, found in unique]
        for column, (parent, name) in checks.references.items():
            found = domain(parent, _text(name), name)
            slots[found] += 1
            sent.setdefault(table, []).append((found, slots[found], _text(column)))
            declared.append((table, "relationships", column, found, slots[found]))
    if not declared:
        return None

    def keys(table: str) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(d).alias("domain"), F.lit(s).alias("slot"), _packed(key).alias("key")) for d, s, key in sent[table]])
        return frames[table].select(F.inline(entries)).where("key is not null")

    each = range(max(slots.values()) + 1)
    counts = (reduce(lambda a, b: a.unionByName(b), [keys(t) for t in sent])
              .groupBy("domain", "key").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in each]))
    orphaned = [F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}")).otherwise(0)) for i in each if i]
    failed = counts.groupBy("domain").agg(F.array(F.count_if(F.col("n0") > 1), *orphaned).alias("failed"))
    # one row per declared check, also where its tables are empty
    kind = "table_name string, test string, column_name string, domain int, slot int"
    listed = frames[declared[0][0]].sparkSession.createDataFrame(declared, kind)
    return listed.join(F.broadcast(failed), "domain", "left").select(
        "table_name", "test", "column_name", F.coalesce(F.get("failed", F.col("slot")), F.lit(0)).cast("bigint").alias("failures"))


def report(frames: dict[str, DataFrame], suite: dict[str, Expectations], store: bool = False) -> DataFrame:
    """``table_name, test, column_name, failures, passed`` for every check of the suite.

    With ``store`` the checked columns of each table are written to the checkpoint
    folder first; use it when the frames are long plans instead of stored tables.
    """
    narrow = {t: frames[t].select(*suite[t].columns(frames[t].columns)) for t in suite}
    if store:
        narrow = {t: pinned(df) for t, df in narrow.items()}
    parts = [row_checks(narrow[t], t, checks) for t, checks in suite.items()] + [key_report(narrow, suite)]
    out = reduce(lambda a, b: a.unionByName(b), [part for part in parts if part is not None])
    return out.withColumn("passed", F.col("failures") == 0)


def require_same_schema(new: DataFrame, stored: DataFrame, table: str) -> None:
    """Refuse to write when column names or types differ from the stored table."""
    wanted = {f.name: f.dataType for f in stored.schema.fields}
    given = {f.name: f.dataType for f in new.schema.fields}
    changed = sorted(n for n in wanted.keys() | given.keys() if wanted.get(n) != given.get(n))
    if changed:
        details = ", ".join(f"{n}: {wanted.get(n)} -> {given.get(n)}" for n in changed)
        raise ValueError(f"schema of {table} changed: {details}")
