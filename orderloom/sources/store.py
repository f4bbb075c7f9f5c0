"""Stored tables: Parquet folders that can be replaced whole or by month."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.columns import slim
from orderloom.operators.delta import DELETE, row_changes
from orderloom.operators.facts import made_keys
from orderloom.operators.quality import require_same_schema
from orderloom.session import pinned, spent_shuffles

MONTH = "_month"  # partition column, not part of the table's own columns
NOTES = "_notes"
CODEC = "zstd"  # halves keys, which are texts of hexadecimal digits


BUCKETS = 64


def month_of(column: str | Column) -> Column:
    """Month of a named column; any other way to divide a table is a whole number in itself."""
    return F.year(column) * 100 + F.month(column) if isinstance(column, str) else column


def by_month(rows: DataFrame, column: str | Column) -> DataFrame:
    """Rows spread by month: rebalancing avoids many small files, and AQE splits large months."""
    return rows.withColumn(MONTH, month_of(column)).hint("rebalance", MONTH).drop(MONTH)


def bucket_of(*keys: str) -> Column:
    """Divides a table by key instead of by month, so that an upsert knows its parts without reading the table."""
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


class Store:
    """Tables under one folder, which all executors must reach.

    A table is written to a new version folder, which becomes visible when that write has succeeded; readers of the old
    version are not disturbed.  A version is complete once its schema lies beside it, so a table without rows can be read.  Tables with a month column are partitioned by month, and an upsert rewrites only the
    months that change, in the newest version.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm.org.apache.hadoop.fs
        self._path = jvm.Path
        self._files = jvm.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self, name: str, kind: str = "v") -> list[int]:
        done = self._files.globStatus(self._path(f"{self.root}/{name}/{kind}*/_schema"))
        return sorted(int(s.getPath().getParent().getName()[len(kind):]) for s in done or [])

    def _folder(self, name: str) -> str | None:
        """The newest complete version; months are versions of their own kind."""
        for kind in ("monthly", "v"):
            versions = self._versions(name, kind)
            if versions:
                return f"{self.root}/{name}/{kind}{versions[-1]}"
        return None

    def exists(self, name: str) -> bool:
        return self._folder(name) is not None

    def read(self, name: str) -> DataFrame:
        return self.read_with_month(name).drop(MONTH)

    def read_with_month(self, name: str) -> DataFrame:
        folder = self._folder(name)
        if folder is None:
            raise ValueError(f"no table {name} in {self.root}")
        return self.spark.read.schema(self._schema(folder)).parquet(folder)

    def _schema(self, folder: str) -> T.StructType:
        stream = self._files.open(self._path(f"{folder}/_schema"))
        try:
            return T.StructType.fromJson(json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _keep_schema(self, folder: str, schema: T.StructType) -> None:
        stream = self._files.create(self._path(f"{folder}/_schema"), True)
        stream.writeBytes(schema.json())
        stream.close()

    def _stored_months(self, name: str) -> list[str]:
        months = self._files.globStatus(self._path(f"{self._folder(name)}/{MONTH}=*")) or []
        return [m.getPath().getName().split("=")[1] for m in months]

    def newest_rows(self, name: str) -> DataFrame:
        """Rows of the newest month of a table kept by months; the other months are not read."""
        numbers = [int(n) for n in self._stored_months(name) if n.lstrip("-").isdigit()]
        rows = self.read_with_month(name)
        return (rows.where(F.col(MONTH) == max(numbers)) if numbers else rows).drop(MONTH)

    # Notes of a run under way: what the tables held before it, sealed once complete.
    def note(self, name: str, df: DataFrame) -> DataFrame:
        with spent_shuffles(self.spark):
            df.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.root}/{NOTES}/{name}")
        return self.noted(name)

    def note_once(self, name: str, df: DataFrame) -> DataFrame:
        """The note as it is, or made now: what a run computes from the state before it must not be computed from the one after."""
        return self.noted(name) if self.has_note(name) else self.note(name, df)

    def noted(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{NOTES}/{name}")

    def has_note(self, name: str) -> bool:
        return self._files.exists(self._path(f"{self.root}/{NOTES}/{name}/_SUCCESS"))

    def seal_notes(self) -> None:
        self._files.mkdirs(self._path(f"{self.root}/{NOTES}/sealed"))

    def pending(self) -> bool:
        return self._files.exists(self._path(f"{self.root}/{NOTES}/sealed"))

    def clear_notes(self) -> None:
        # The seal goes first: notes without it are never followed.
        for part in ("sealed", ""):
            self._files.delete(self._path(f"{self.root}/{NOTES}/{part}".rstrip("/")), True)

    def _check(self, df: DataFrame, name: str) -> None:
        if self.exists(name):
            require_same_schema(df, self.read(name), name)

    def write(self, df: DataFrame, name: str, month: str | Column | None = None, keep_schema: bool = True,
              watch: Callable[[DataFrame], DataFrame] = lambda df: df, back: Callable[[DataFrame], DataFrame] | None = None,
              dealt: bool = False) -> DataFrame:
        """Replace a whole table and return its stored form.  ``watch`` goes around the rows as they are written.

        Rows that come slim already bring their way ``back``; those that are ``dealt`` lie by month already.
        """
        if keep_schema:
            self._check(df, name)
        kind = "v" if month is None else "monthly"
        versions = self._versions(name, kind)
        folder = f"{self.root}/{name}/{kind}{versions[-1] + 1 if versions else 1}"
        if month is not None:
            df = df.withColumn(MONTH, month_of(month))
            # A folder that a failed write has left is overwritten as a whole.
            df = self._write_months(df, folder, "static", watch, back, dealt)
        else:
            with spent_shuffles(self.spark):
                watch(df).write.mode("overwrite").option("compression", CODEC).parquet(folder)
        self._keep_schema(folder, df.schema)
        for old in versions[:-1]:  # the previous version stays for its readers
            self._files.delete(self._path(f"{self.root}/{name}/{kind}{old}"), True)
        return self.read(name)

    def _write_months(self, df: DataFrame, folder: str, mode: str, watch: Callable[[DataFrame], DataFrame] = lambda df: df,
                      back: Callable[[DataFrame], DataFrame] | None = None, dealt: bool = False) -> DataFrame:
        # rebalancing by month avoids many small files, and AQE splits large months; slim rows become whole behind it
        rows = df if dealt else df.hint("rebalance", MONTH)
        rows = back(rows) if back else rows
        with spent_shuffles(self.spark):
            (watch(rows).write.mode("overwrite").option("partitionOverwriteMode", mode)
             .option("compression", CODEC).partitionBy(MONTH).parquet(folder))
        return rows

    def replace_keys(self, name: str, rows: DataFrame, keys: list[str], month: str | Column | None = None,
                     changed: DataFrame | None = None, kept: bool = False, dealt: bool = False) -> DataFrame:
        """Upsert: drop the stored rows of the ``changed`` keys and add ``rows``.

        ``changed`` defaults to the keys of ``rows``; name it when a key may lose all
        its rows.  ``rows`` must hold each row once; with ``kept`` they are files already and need not be stored again, with
        ``dealt`` those lie by month.
        """
        self._check(rows, name)
        changed = rows.select(*keys).distinct() if changed is None else changed.select(*keys).distinct()
        if month is None:
            others = self.read(name).join(changed, keys, "left_anti")
            return self.write(others.unionByName(rows), name)
        rows = rows.withColumn(MONTH, month_of(month))
        rows = rows if kept else pinned(rows)
        stored = self.read_with_month(name)
        if isinstance(month, str):
            touched = stored.join(changed, keys, "left_semi").select(MONTH).unionByName(rows.select(MONTH))
        else:
            touched = changed.select(month.alias(MONTH))
        with spent_shuffles(self.spark):
            months = [r[0] for r in touched.distinct().collect()]  # calendar months: a short list
        if months:
            # Rows of other keys pass two exchanges, by key and by month: slim ones.
            made = made_keys(name, stored.columns)
            stored = stored.select(*keys, *[c for c in stored.columns if c not in keys])     # as the join by keys gives them
            others, back = slim(stored.where(F.col(MONTH).isin(*months)), made, keys)
            others = others.join(changed, keys, "left_anti")
            if dealt:
                content, back = back(others.hint("rebalance", MONTH)).unionByName(rows), None
            else:
                content = others.unionByName(slim(rows.select(*stored.columns), made, keys)[0])
            if {str(m) for m in months} >= set(self._stored_months(name)):
                # nothing stays as it is: a new version
                return self.write(content, name, F.col(MONTH), keep_schema=False, back=back, dealt=dealt)
            content = pinned(content)  # the files it was read from are about to be replaced
            with spent_shuffles(self.spark):
                left = {r[0] for r in content.select(MONTH).distinct().collect()}
            folder = self._folder(name)
            self._write_months(content, folder, "dynamic", back=back, dealt=dealt)
            for gone in set(months) - left:
                self._files.delete(self._path(f"{folder}/{MONTH}={gone}"), True)
        return self.read(name)

    def merge(self, name: str, rows: DataFrame, keys: Sequence[str], month: str | None = None, ignore: Sequence[str] = (),
              feed: bool = False) -> DataFrame:
        """Make the table equal to ``rows`` by writing only what differs; columns of ``ignore`` alone make no difference.

        With ``feed`` the changes are stored as ``<name>_changes``: the row as it is now, or was if it is gone, and ``change``.
        """
        self._check(rows, name)
        stored = self.read(name)
        changed = pinned(row_changes(stored, rows, keys, ignore))
        if feed:
            gone = changed.where(F.col("change") == DELETE)
            news = rows.join(changed.where(F.col("change") != DELETE), list(keys)).unionByName(stored.join(gone, list(keys)))
            self.write(news, f"{name}_changes")
        if changed.isEmpty():
            return stored
        fresh = rows.join(changed.where(F.col("change") != DELETE), list(keys), "left_semi")
        return self.replace_keys(name, fresh, list(keys), month, changed)
