"""Mixing sources to target weights: repetition rates per source, whole copies plus a seeded Bernoulli copy.

Native DataFrame code.  Texts are read once for their sizes and never shuffled: the rates
are one row per source, stored, and joined back as Spark sees fit by their measured size.

Defined cases: a null or empty text has size 0; null sources form one source, placed last;
a source without words has target 0, and so rate 0 for its (empty) documents; repeated rows
count each; the draw depends on id and text, so only rows equal in both share it, and rows without id draw by their text;
other columns pass through ``emit`` untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from orderloom.llm.common import Stored, text_hash, word_count

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
SEED = "mix-1"


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """``source, source_size, target`` of each source of ``sized(source, size)``.

    Sources in code point order take ``weights`` in turn and share ``share`` of all words.
    No target exceeds ``cap`` times its source; what is cut off goes to the others by weight.
    With sources sorted by cap per weight, let level k be what a unit of weight gets when
    the sources before k are held at their caps.  The largest level is the final one.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights) + 1
    sizes = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")).cast("double"))
    sizes = sizes.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    everything = W.partitionBy(F.lit(1))
    before = W.partitionBy(F.lit(1)).orderBy(F.col("most") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    earlier = before.rowsBetween(W.unboundedPreceding, -1)
    level = ((F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))))
    sizes = sizes.withColumn("level", level)
    return sizes.select("source", "source_size",
                        F.least("most", F.col("weight") * F.max("level").over(everything)).alias("target"))


def draw(key: Column, mark: Column, seed: str = SEED) -> Column:
    """A uniform number of [0, 1) that depends on the key, the text's hash and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), mark)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def with_copies(rows: DataFrame, targets: DataFrame, key: str, mark: Column, source: str, seed: str = SEED) -> DataFrame:
    """``rows``, whose texts have the hash ``mark``, with ``_mix_source_size``, ``_mix_target`` and ``_mix_copies``.

    Copies are floor(rate), plus one with the probability of the fraction.
    """
    t = targets.select(*[F.col(c).alias(f"_mix_{c}") for c in targets.columns])
    rate = F.when(F.col("_mix_source_size") > 0, F.col("_mix_target") / F.col("_mix_source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (draw(F.col(key), mark, seed) < rate - F.floor(rate)).cast("long")
    return (rows.join(t, F.col(source).eqNullSafe(F.col("_mix_source")))
            .withColumn("_mix_copies", copies).drop("_mix_source"))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> Stored:
    """Stored ``key, source, size, mark``; the only pass over the texts."""
    sized = docs.select(F.col(key), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                        text_hash(F.col(text)).alias("mark"))
    return Stored(sized, "mix-sizes")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """Per document what the mix takes of it: ``key, size, source_size, target, copies, taken``."""
    sized = measure(docs, key, text, source).df
    targets = Stored(source_targets(sized, weights, share, cap), "mix-targets").df
    return with_copies(sized, targets, key, F.col("mark"), "source", seed).select(
        key, "size", F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        F.col("_mix_copies").alias("copies"), (F.col("size") * F.col("_mix_copies")).alias("taken"))


def emit(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
         weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED,
         copy_column: str | None = None) -> DataFrame:
    """The mixed documents themselves, each as often as the mix takes it; all columns of ``docs`` are kept.

    ``copy_column`` names a column for the number of the copy, from 1.
    """
    columns = docs.columns
    targets = Stored(source_targets(measure(docs, key, text, source).df, weights, share, cap), "mix-targets").df
    rows = with_copies(docs, targets, key, text_hash(F.col(text)), source, seed).where(F.col("_mix_copies") > 0)
    number = [F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))).alias(copy_column or "_mix_copy")]
    out = rows.select(*columns, *number)
    return out if copy_column else out.drop("_mix_copy")
