"""Structured Streaming: new files of a source table flow into the stored warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from orderloom.plans.build import TABLES, apply_changes
from orderloom.sources.lookups import Lookups
from orderloom.sources.store import Store
from orderloom.sources.tables import RAW_TABLES, SOURCE_SCHEMAS, raw_table


def stream_raw_table(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """Streaming frame of a raw table over the Parquet files that arrive in ``folder``."""
    source, _, _ = RAW_TABLES[name]
    files = (spark.readStream.schema(SOURCE_SCHEMAS[source]).option("maxFilesPerTrigger", files_per_batch)
             .parquet(folder))
    return raw_table(files, name)


def keep_up_to_date(stream: DataFrame, name: str, store: Store, lookups: Lookups, progress: str,
                    calendar: tuple[dt.date, dt.date], today: Callable[[], dt.date] = dt.date.today,
                    tables: list[str] = TABLES) -> StreamingQuery:
    """Apply each micro-batch of a raw table to the store; runs until the waiting files are used up.

    A batch that is delivered again after a failure upserts the same keys, so it
    changes nothing.  Rows may arrive in any order: all keys they touch are computed
    again from their whole history.
    """
    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            apply_changes(store, {name: batch}, lookups, today(), calendar, tables=tables)

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", progress)
            .trigger(availableNow=True).start())
