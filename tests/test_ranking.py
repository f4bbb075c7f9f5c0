import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderloom.operators import ranking
from orderloom.operators.ranking import rank_rows, sequence_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one group and one value."""
    rows = spark.range(3000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 7919 % 101).alias("value"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("team"))
    return rows.withColumn("value", F.when(F.col("key") % 50 == 1, None).otherwise(F.col("value")))


@pytest.mark.parametrize("partitions", ["1", "8", "200"])
def test_rank_rows_equals_window(spark, skewed, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        order = [F.asc_nulls_last("value"), F.asc("key")]
        want = skewed.select("key", F.row_number().over(W.orderBy(*order)).alias("pos"),
                             F.row_number().over(W.partitionBy("team").orderBy(*order)).alias("pos_in_team"),
                             F.count("*").over(W.partitionBy("team")).alias("n_in_team"))
        got = rank_rows(skewed, "key", "value", ["team"])
        assert got.select("n").distinct().collect() == [(3000,)]
        got = got.select("key", F.col("pos").cast("int").alias("pos"),
                         F.col("pos_in_team").cast("int").alias("pos_in_team"), "n_in_team")
        assert got.count() == 3000
        assert got.exceptAll(want).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rank_rows_without_aqe_merging(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank_rows(skewed, "key", "value")
        want = skewed.select("key", F.row_number().over(W.orderBy(F.asc_nulls_last("value"), "key")).alias("want"))
        assert got.join(want, "key").where("pos != want").count() == 0
        # the rows really were split: the largest value group alone holds a third of them
        assert got.count() == 3000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("merge, crowd", [("true", 0), ("false", 0), ("true", 500), ("true", 100_000)])
def test_spread_sequence_equals_plain(spark, skewed, merge, crowd, monkeypatch):
    """Over ranges alone, with the crowded keys in ranges, and by windows alone."""
    monkeypatch.setattr(ranking, "CROWD", crowd)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    try:
        rows = skewed.where("value is not null")
        options = dict(key="team", order=["value", "key"], seq="seq", upcoming=("value", "next"), last_flag="last")
        window = W.partitionBy("team").orderBy("value", "key")
        plain = rows.select("*", F.row_number().over(window).alias("seq"), F.lead("value").over(window).alias("next"),
                            F.lead(F.lit(1)).over(window).isNull().alias("last"))
        spread = sequence_rows(rows, **options)
        assert spread.columns == plain.columns
        assert spread.count() == rows.count()
        assert spread.exceptAll(plain).count() == 0
        assert spread.where("last").count() == rows.select("team").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
