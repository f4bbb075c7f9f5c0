"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

1. toxicity: a classifier trained on the labelled documents scores every text; documents of score 0.5 or more go.
2. near_duplicates: SimHash fingerprints of three-word shingles link documents at two or fewer differing bits; one row of each group
   stays, that of the smallest id (nulls last), then of the smallest text hash.  Rows without id and repeated rows take part.
3. repeated_strings: bytes covered by a string of 100 bytes that starts earlier are cut out of the texts.
4. decontamination: documents that cover half of the words of a benchmark item go.
5. mixing: sources take their targets; a document is emitted as often as its source's rate says.

All stages keep the columns of ``documents``; the last adds ``copy``, the number of a document's copy (``copy_``
and so on if the table has such a column).
Rows of equal id and text are near copies, so stage 2 leaves one of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import mixing, repeats, simhash, tiling, toxicity
from orderloom.llm.common import Stored, release, table, text_hash

REJECT = 0.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``REJECT``; all labels train, as none is held out here."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(docs, model, name="_score").where(F.col("_score") < REJECT).drop("_score")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: of smallest id (nulls last), then of smallest text hash, then any one of equal rows."""
    leads = Stored(simhash.group_leads(docs), "near-leads").df
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own"),
                        text_hash(F.col("text")).alias("own_h"))
    kept = whole.join(leads, F.col("own").eqNullSafe(F.col("id")) & (F.col("own_h") == F.col("h")))
    if leads.where("n > 1").isEmpty():
        return kept.select("row.*")
    # Rows of equal id and text can differ elsewhere; the choice among them must not depend on the order of tasks.
    one = kept.where("n > 1").groupBy("id", "h").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return kept.where("n = 1").select("row.*").unionByName(one.select("row.*"))


def repeated_strings_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated bytes; ``n_chars`` is that of the new text."""
    return repeats.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name, taken = "copy", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return mixing.emit(docs, copy_column=name)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("repeated_strings", repeated_strings_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# A trained classifier, fingerprints and byte matches have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stored = Stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if held:
            held.drop()
        release(spark)
        docs, held = stored.df, stored
    return STAGES[-1][1](spark, docs, sf_dir)
