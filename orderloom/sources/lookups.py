"""The five small lookup tables: built-in values, or CSV files of the same shape."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Country and its region.
COUNTRY_REGIONS = [
    ("united states", "north america"), ("canada", "north america"), ("mexico", "north america"),
    ("guatemala", "north america"), ("belize", "north america"), ("honduras", "north america"),
    ("el salvador", "north america"), ("nicaragua", "north america"), ("costa rica", "north america"),
    ("panama", "north america"), ("cuba", "north america"), ("jamaica", "north america"), ("haiti", "north america"),
    ("dominican republic", "north america"), ("bahamas", "north america"), ("barbados", "north america"),
    ("trinidad and tobago", "north america"), ("united kingdom", "europe"), ("germany", "europe"),
    ("france", "europe"), ("italy", "europe"), ("spain", "europe"), ("netherlands", "europe"), ("belgium", "europe"),
    ("switzerland", "europe"), ("austria", "europe"), ("sweden", "europe"), ("norway", "europe"),
    ("denmark", "europe"), ("finland", "europe"), ("poland", "europe"), ("czech republic", "europe"),
    ("hungary", "europe"), ("slovakia", "europe"), ("slovenia", "europe"), ("croatia", "europe"),
    ("romania", "europe"), ("bulgaria", "europe"), ("greece", "europe"), ("portugal", "europe"),
    ("ireland", "europe"), ("iceland", "europe"), ("estonia", "europe"), ("latvia", "europe"),
    ("lithuania", "europe"), ("luxembourg", "europe"), ("malta", "europe"), ("cyprus", "europe"),
    ("japan", "asia pacific"), ("south korea", "asia pacific"), ("china", "asia pacific"),
    ("singapore", "asia pacific"), ("australia", "asia pacific"), ("new zealand", "asia pacific"),
    ("india", "asia pacific"), ("thailand", "asia pacific"), ("vietnam", "asia pacific"),
    ("malaysia", "asia pacific"), ("indonesia", "asia pacific"), ("philippines", "asia pacific"),
    ("taiwan", "asia pacific"), ("hong kong", "asia pacific"), ("bangladesh", "asia pacific"),
    ("pakistan", "asia pacific"), ("sri lanka", "asia pacific"), ("myanmar", "asia pacific"),
    ("cambodia", "asia pacific"), ("laos", "asia pacific"), ("mongolia", "asia pacific"), ("nepal", "asia pacific"),
    ("bhutan", "asia pacific"), ("brunei", "asia pacific"), ("maldives", "asia pacific"), ("fiji", "asia pacific"),
    ("papua new guinea", "asia pacific"), ("brazil", "south america"), ("argentina", "south america"),
    ("colombia", "south america"), ("peru", "south america"), ("chile", "south america"),
    ("venezuela", "south america"), ("ecuador", "south america"), ("bolivia", "south america"),
    ("paraguay", "south america"), ("uruguay", "south america"), ("guyana", "south america"),
    ("suriname", "south america"), ("french guiana", "south america"), ("nigeria", "africa"),
    ("south africa", "africa"), ("egypt", "africa"), ("kenya", "africa"), ("morocco", "africa"), ("ghana", "africa"),
    ("ethiopia", "africa"), ("tanzania", "africa"), ("algeria", "africa"), ("uganda", "africa"),
    ("angola", "africa"), ("mozambique", "africa"), ("madagascar", "africa"), ("cameroon", "africa"),
    ("ivory coast", "africa"), ("niger", "africa"), ("burkina faso", "africa"), ("mali", "africa"),
    ("malawi", "africa"), ("zambia", "africa"), ("senegal", "africa"), ("somalia", "africa"), ("chad", "africa"),
    ("zimbabwe", "africa"), ("guinea", "africa"), ("rwanda", "africa"), ("benin", "africa"), ("tunisia", "africa"),
    ("burundi", "africa"), ("togo", "africa"), ("sierra leone", "africa"), ("libya", "africa"),
    ("liberia", "africa"), ("central african republic", "africa"), ("mauritania", "africa"), ("eritrea", "africa"),
    ("gambia", "africa"), ("botswana", "africa"), ("namibia", "africa"), ("gabon", "africa"), ("lesotho", "africa"),
    ("guinea-bissau", "africa"), ("equatorial guinea", "africa"), ("mauritius", "africa"), ("eswatini", "africa"),
    ("djibouti", "africa"), ("comoros", "africa"), ("cape verde", "africa"), ("sao tome and principe", "africa"),
    ("seychelles", "africa"), ("russia", "other"), ("turkey", "other"), ("iran", "other"), ("iraq", "other"),
    ("afghanistan", "other"), ("uzbekistan", "other"), ("saudi arabia", "other"), ("yemen", "other"),
    ("syria", "other"), ("azerbaijan", "other"), ("jordan", "other"), ("georgia", "other"), ("tajikistan", "other"),
    ("israel", "other"), ("palestine", "other"), ("lebanon", "other"), ("kyrgyzstan", "other"),
    ("turkmenistan", "other"), ("armenia", "other"), ("kuwait", "other"), ("oman", "other"), ("qatar", "other"),
    ("bahrain", "other"), ("united arab emirates", "other"), ("kazakhstan", "other"), ("ukraine", "other"),
    ("belarus", "other"), ("moldova", "other"), ("north macedonia", "other"), ("albania", "other"),
    ("montenegro", "other"), ("bosnia and herzegovina", "other"), ("serbia", "other"), ("kosovo", "other"),
]

# Product category and its group.
CATEGORY_GROUPS = [
    ("Dresses", "Clothing"), ("Tops & Blouses", "Clothing"), ("Sweaters & Knitwear", "Clothing"),
    ("Jackets & Coats", "Clothing"), ("Pants & Trousers", "Clothing"), ("Skirts", "Clothing"),
    ("Jeans & Denim", "Clothing"), ("Handbags & Purses", "Accessories"), ("Jewelry & Watches", "Accessories"),
    ("Scarves & Wraps", "Accessories"), ("Belts & Accessories", "Accessories"),
    ("Sunglasses & Eyewear", "Accessories"), ("Hats & Hair Accessories", "Accessories"),
    ("Tech Accessories", "Accessories"), ("Shoes & Footwear", "Footwear"), ("Lingerie & Intimates", "Intimates"),
    ("Sleepwear & Loungewear", "Intimates"), ("Swimwear & Beachwear", "Intimates"),
    ("Activewear & Athleisure", "Activewear"),
]

# Closed price ranges; keywords in the order in which they are tried.
PRICE_TIERS = [("0", "49.99", "Budget"), ("50", "149.99", "Mid-Range"),
               ("150", "399.99", "Premium"), ("400", "999999", "Luxury")]
SEASON_KEYWORDS = [("spring", "Spring/Summer"), ("summer", "Spring/Summer"), ("fall", "Fall/Winter"),
                   ("winter", "Fall/Winter"), ("holiday", "Fall/Winter")]
COLLECTION_KEYWORDS = [("limited edition", "Limited Edition"), ("premium", "Premium"),
                       ("signature", "Premium"), ("classic", "Classic")]


@dataclass
class Lookups:
    """Key-value lookups are pairs, price tiers are ``(min, max, tier)`` in file order.

    The two lookups that are joined may also be frames of two columns.
    """

    country_region: list[tuple[str, str]] | DataFrame = field(default_factory=lambda: list(COUNTRY_REGIONS))
    category_group: list[tuple[str, str]] | DataFrame = field(default_factory=lambda: list(CATEGORY_GROUPS))
    price_tiers: list[tuple] = field(default_factory=lambda: list(PRICE_TIERS))
    season_keywords: list[tuple[str, str]] = field(default_factory=lambda: list(SEASON_KEYWORDS))
    collection_keywords: list[tuple[str, str]] = field(default_factory=lambda: list(COLLECTION_KEYWORDS))

    @classmethod
    def from_csv(cls, spark: SparkSession, **paths: str) -> "Lookups":
        """Replace built-in lookups by header CSV files, e.g. ``country_region="…/regions.csv"``."""
        schemas = {
            "country_region": "country string, region string",
            "category_group": "category string, category_group string",
            "price_tiers": "min_price decimal(10,2), max_price decimal(10,2), price_tier string",
            "season_keywords": "keyword string, seasonality string",
            "collection_keywords": "keyword string, collection_type string",
        }
        loaded = {}
        for name, path in paths.items():
            frame = spark.read.csv(path, header=True, schema=schemas[name])
            joined = name in ("country_region", "category_group")
            # tiers and keywords become conditions of one expression; the others stay tables
            loaded[name] = frame if joined else [tuple(row) for row in frame.collect()]
        return cls(**loaded)


def pairs_frame(spark: SparkSession, pairs: list[tuple[str, str]] | DataFrame, key: str, value: str) -> DataFrame:
    """Pairs as a frame; how it is joined is left to the optimizer, which knows its size."""
    if isinstance(pairs, DataFrame):
        return pairs.toDF(key, value)
    return spark.createDataFrame(pairs, f"{key} string, {value} string")
