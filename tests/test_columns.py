import datetime as dt
from decimal import Decimal

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderloom.functions import labels as L
from orderloom.functions.columns import (by_rules, date_key, day_part, days_between, dow0, first_keyword, first_range,
                                         hours_between, ladder, mean, moment, ntile_of, pct, ratio, season, surrogate_key)
from orderloom.sources.lookups import COLLECTION_KEYWORDS, COUNTRY_REGIONS, PRICE_TIERS, Lookups


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_dates(spark):
    row = one(spark, sunday=dow0(F.lit(dt.date(2024, 3, 31))), saturday=dow0(F.lit(dt.date(2024, 3, 30))),
              key=date_key(F.lit(dt.date(2024, 2, 29))), winter=season(F.lit(12)), fall=season(F.lit(11)),
              hours=hours_between(F.lit("2024-01-01T00:00").cast("timestamp_ntz"),
                                  F.lit("2024-01-02T01:30").cast("timestamp_ntz")))
    assert row == {"sunday": 0, "saturday": 6, "key": 20240229, "winter": "Winter", "fall": "Fall",
                   "hours": Decimal("25.5")}


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # clocks change on 2024-03-10 there
        start, end = moment(dt.datetime(2024, 3, 9, 12)), moment(dt.datetime(2024, 3, 10, 11, 59))
        row = one(spark, start=start, hours=hours_between(start, end), days=days_between(start, end),
                  midnight=moment(dt.date(2024, 3, 10)), open=hours_between(start, F.lit(None).cast("timestamp_ntz")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row == {"start": dt.datetime(2024, 3, 9, 12), "hours": Decimal("23.98333333"), "days": 0,
                   "midnight": dt.datetime(2024, 3, 10), "open": None}


def test_day_parts(spark):
    hours = spark.range(24).select("id", day_part(F.col("id")).alias("part")).collect()
    parts = [r.part for r in hours]
    assert parts == ["Night"] * 6 + ["Morning"] * 6 + ["Afternoon"] * 6 + ["Evening"] * 5 + ["Night"]


def test_shares_round_half_up_and_guard_zero(spark):
    row = one(spark, third=pct(F.lit(1), F.lit(3)), tie=pct(F.lit(Decimal("1.005")), F.lit(100)),
              zero=pct(F.lit(5), F.lit(0)), negative=pct(F.lit(-1), F.lit(8)), ratio=ratio(F.lit(1), F.lit(8)),
              none=pct(F.lit(None).cast("int"), F.lit(2)))
    assert row == {"third": Decimal("33.33"), "tie": Decimal("1.01"), "zero": 0, "negative": Decimal("-12.50"),
                   "ratio": Decimal("0.13"), "none": None}


def test_mean_is_exact_and_ignores_nulls(spark):
    rows = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),), (Decimal("1.01"),), (None,)],
                                 "v decimal(10,2)")
    assert rows.agg(mean("v")).first()[0] == Decimal("1.00666667")
    assert rows.where("v is null").agg(mean("v")).first()[0] is None


def test_ladder_edges_and_null(spark):
    values = [Decimal(v) for v in ("49.99", "50", "149.99", "150", "399.99", "400", "500")]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "p decimal(10,2)")
    rows = frame.select(ladder("p", L.DETAILED_PRICE_TIER, "Budget").alias("d"),
                        first_range(F.col("p"), PRICE_TIERS, "Budget").alias("t")).collect()
    assert [r.d for r in rows] == ["Budget", "Mid-Range", "Mid-Range", "Premium", "Premium", "Luxury",
                                   "Ultra-Premium", "Budget"]
    assert [r.t for r in rows] == ["Budget", "Mid-Range", "Mid-Range", "Premium", "Premium", "Luxury", "Luxury",
                                   "Budget"]


def test_fractional_bounds_compare_exactly(spark):
    frame = spark.createDataFrame([(Decimal("0.80"),), (Decimal("0.79"),), (None,)], "x decimal(20,2)")
    got = [r[0] for r in frame.select(ladder("x", L.PURCHASE_PATTERN, L.PURCHASE_PATTERN_REST)).collect()]
    assert got == ["Explorer", "Variety Seeker", "Highly Loyal"]


def test_rules_take_the_first_match(spark):
    frame = spark.createDataFrame([(9, 3), (8, 4), (8, 3), (5, 2), (1, 1)], "price_decile int, price_quartile int")
    got = [r[0] for r in frame.select(by_rules(L.PRICE_POSITION_RULES, L.LOWEST_QUARTER)).collect()]
    assert got == ["Top 10%", "Top 25%", "Above Median", "Below Median", "Bottom 25%"]


def test_first_keyword_in_list_order(spark):
    row = one(spark, a=first_keyword(F.lit("classic signature"), COLLECTION_KEYWORDS, "Regular"),
              b=first_keyword(F.lit("nothing"), COLLECTION_KEYWORDS, "Regular"))
    assert row == {"a": "Premium", "b": "Regular"}


def test_surrogate_key(spark):
    row = one(spark, a=surrogate_key(F.lit("A"), F.lit(2)), n=surrogate_key(F.lit(None)))
    import hashlib
    assert row["a"] == hashlib.md5(b"A-2").hexdigest()
    assert row["n"] == hashlib.md5(L.NULL_KEY_TOKEN.encode()).hexdigest()


def test_ntile_equals_window(spark):
    for size in (1, 3, 4, 10, 11, 27):
        frame = spark.range(1, size + 1).withColumn("n", F.lit(size))
        for buckets in (4, 10):
            rows = frame.select(F.ntile(buckets).over(W.orderBy("id")).alias("want"),
                                ntile_of("id", "n", buckets).alias("got")).collect()
            assert all(r.want == r.got for r in rows)


def test_lookup_sizes(spark, tmp_path):
    pairs, counts = COUNTRY_REGIONS, {}
    for _, region in pairs:
        counts[region] = counts.get(region, 0) + 1
    assert counts == {"north america": 17, "europe": 31, "asia pacific": 27, "south america": 13, "africa": 50,
                      "other": 34}
    assert len(Lookups().category_group) == 19
    path = tmp_path / "tiers.csv"
    path.write_text("min_price,max_price,price_tier\n0,9.99,Low\n10,99,High\n")
    loaded = Lookups.from_csv(spark, price_tiers=str(path))
    assert loaded.price_tiers == [(Decimal("0.00"), Decimal("9.99"), "Low"), (Decimal("10.00"), Decimal("99.00"), "High")]
    path = tmp_path / "regions.csv"
    path.write_text("country,region\natlantis,ocean\n")
    assert [tuple(r) for r in Lookups.from_csv(spark, country_region=str(path)).country_region.collect()] == [("atlantis", "ocean")]


def test_metric_catalogue():
    domains = [d for d, *_ in L.metric_catalogue()]
    assert [domains.count(d) for d in ("orders", "products", "customers")] == [24, 14, 12]
    keys = {(m, t, v) for _, m, t, v in L.metric_catalogue()}
    assert len(keys) == 50  # unique even without the domain
