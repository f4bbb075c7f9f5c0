import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.plans.warehouse import Warehouse  # noqa: E402
from orderloom.session import build_session  # noqa: E402
from orderloom.sources.tables import SOURCE_SCHEMAS, Sources  # noqa: E402

AS_OF = dt.date(2024, 3, 31)
CALENDAR = (dt.date(2024, 1, 1), dt.date(2024, 4, 1))


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "2", "spark.driver.memory": "6g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


CUSTOMERS = [
    # id, name, email, country, signup_date, created_at
    (1, "Ann", "ann@x", "UNITED STATES", dt.date(2021, 1, 3), at("2021-01-03")),   # Sunday
    (2, "Ben", "ben@x", "Germany", dt.date(2024, 1, 15), at("2024-01-15")),        # Monday
    (3, "Cid", "cid@x", "Atlantis", dt.date(2024, 2, 20), at("2024-02-20")),
]
PRODUCTS = [
    (1, "Classic Signature Spring Holiday", "Dresses", Decimal("49.99"), at("2023-01-01")),
    (2, "Limited Edition Fall Bag", "Handbags & Purses", Decimal("150.00"), at("2023-06-01")),
    (3, "Plain thing", "Gift Cards & Sets", Decimal("500.00"), at("2024-03-10")),
    (4, "Essential winter boot", "Shoes & Footwear", Decimal("399.99"), at("2024-01-01")),
]
ORDERS = [
    # record_id, id, customer_id, order_date, status, total_amount, created_at
    (1, "A", 1, at("2024-01-10T07:30"), "pending", Decimal("199.99"), at("2024-01-10T07:30")),
    (2, "A", 1, at("2024-01-10T07:30"), "completed", Decimal("199.99"), at("2024-01-12T07:30")),
    (3, "A", 1, at("2024-01-10T07:30"), "refunded", Decimal("199.99"), at("2024-01-20T07:30")),
    (4, "B", 2, at("2024-01-13T23:10"), "pending", Decimal("0.00"), at("2024-01-13T23:10")),
    # pending and completed on one day: the first is never in a daily snapshot
    (5, "C", 2, at("2024-02-29T12:00"), "pending", Decimal("500.00"), at("2024-02-29T12:00")),
    (6, "C", 2, at("2024-02-29T12:00"), "completed", Decimal("500.00"), at("2024-02-29T18:00")),
    # equal times: the record id decides
    (8, "D", 1, at("2024-03-02T19:00"), "cancelled", Decimal("150.00"), at("2024-03-02T19:00")),
    (7, "D", 1, at("2024-03-02T19:00"), "pending", Decimal("150.00"), at("2024-03-02T19:00")),
    # unknown customer, and no customer at all
    (9, "E", 99, at("2024-03-05T10:00"), "completed", Decimal("399.99"), at("2024-03-05T10:00")),
    (10, "F", None, at("2024-03-05T10:00"), "pending", Decimal("1.00"), at("2024-03-05T10:00")),
    # an order of 0 with a line
    (11, "G", 3, at("2024-03-09T10:00"), "completed", Decimal("0.00"), at("2024-03-09T10:00")),
]
ITEMS = [
    # id, order_id, product_id, quantity, unit_price, created_at
    (1, "A", 1, 1, Decimal("49.99"), at("2024-01-10T07:31")),
    (2, "A", 2, 1, Decimal("150.00"), at("2024-01-10T07:31")),
    (3, "C", 3, 1, Decimal("500.00"), at("2024-02-29T12:05")),
    (4, "D", 2, 1, Decimal("150.00"), at("2024-03-02T19:05")),
    (5, "E", 4, 1, Decimal("399.99"), at("2024-03-05T10:05")),
    (6, "G", 1, 3, Decimal("50.00"), at("2024-03-09T10:05")),
    (7, "C", 77, 1, Decimal("10.00"), at("2024-02-29T12:06")),  # unknown product
]


def make_sources(spark, customers=CUSTOMERS, products=PRODUCTS, orders=ORDERS, items=ITEMS) -> Sources:
    rows = {"source_customers": customers, "source_products": products, "source_orders": orders,
            "source_order_items": items}
    frames = {n.removeprefix("source_"): spark.createDataFrame(rows[n], s) for n, s in SOURCE_SCHEMAS.items()}
    return Sources(**frames)


@pytest.fixture(scope="session")
def sources(spark):
    return make_sources(spark)


@pytest.fixture(scope="session")
def warehouse(sources):
    return Warehouse(sources, AS_OF, CALENDAR)


def by(frame, *keys):
    """Rows of a small frame as dictionaries, by key."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r.asDict() for r in frame.collect()}
