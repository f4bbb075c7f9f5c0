"""Helpers shared by the operators of this subpackage: stored tables, clean-up, and small frames."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import ensure_checkpoint_dir

# A word is a run of characters other than space and the controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, as a URI that executors can open too."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Stored:
    """A table written once to the shared folder, so that its lineage ends there.

    Losing executors costs no recomputation of what led to it.  ``drop`` removes the files
    once nothing reads them any more.
    """

    def __init__(self, df: DataFrame, label: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.path = df.sparkSession, new_folder(df.sparkSession, label)
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of finished jobs now instead of at some later collection."""
    gc.collect()
    spark._jvm.System.gc()


def word_count(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_hash(text: Column) -> Column:
    """128 bits of a text as hexadecimal digits; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


HEAVY_SHARE = 4096


def join_weighted(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``keyed``, which has one row per key and in ``weight`` the number of its ``rows``.

    At most ``HEAVY_SHARE`` keys can hold 1/``HEAVY_SHARE`` of all ``total`` rows or more.  Those are broadcast, so their rows
    stay where they are; the others meet by a shuffle in which no key has more than that share.  Both frames are read
    twice, so they should be stored.
    """
    heavy = F.col(weight) * HEAVY_SHARE >= F.lit(total)
    crowd = F.broadcast(keyed.where(heavy))
    rest = rows.join(crowd.select(*keys), keys, "left_anti").join(keyed.where(~heavy), keys, how)
    return rows.join(crowd, keys).unionByName(rest)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
