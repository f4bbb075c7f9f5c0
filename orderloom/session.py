"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins on order, customer or product ids may meet one id that owns a large
    # share of the rows; AQE splits such partitions at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint`` usable and return its folder.

    A cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local
    master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="orderloom-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


# Spark's setting: shuffle files go when the execution that made them ends, not when the driver happens to collect garbage.
SPENT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writes = threading.Lock(), {}     # per session: writes under way, and the setting before them


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """Executions in here leave no shuffle files behind.

    For writes and other plans that run once: what they need later is stored.  A frame that is run again would shuffle
    again, so the setting is put back as it was once the last write is through.
    """
    with _lock:
        under_way, before = _writes.get(spark, (0, None))
        if not under_way:
            before = spark.conf.get(SPENT, None)
            spark.conf.set(SPENT, "true")
        _writes[spark] = (under_way + 1, before)
    try:
        yield
    finally:
        with _lock:
            under_way, before = _writes.pop(spark)
            if under_way > 1:
                _writes[spark] = (under_way - 1, before)
            elif before is None:
                spark.conf.unset(SPENT)
            else:
                spark.conf.set(SPENT, before)


def pinned(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and return its stored form.

    Lineage ends there, as with a checkpoint, but readers prune columns and push filters down.  Keys are texts of hexadecimal
    digits, which zstd halves and the default codec leaves as they are.  ``by`` names a column of few
    values that gets a folder per value.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pinned-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    with spent_shuffles(spark):
        writer.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
