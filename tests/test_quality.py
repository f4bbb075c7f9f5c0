import pytest

from orderloom.operators.quality import Expectations, key_report, report, require_same_schema
from orderloom.plans.catalog import stored_tables
from orderloom.plans.expectations import SUITE


@pytest.fixture(scope="module")
def frames(spark):
    child = spark.createDataFrame([(1, "a", 5, 1), (1, "b", -1, 2), (2, None, 0, 9), (None, "z", None, None),
                                   (None, "a", 3, 9)], "id int, label string, amount int, parent int")
    parent = spark.createDataFrame([(1,), (2,)], "key int")
    return {"child": child, "parent": parent}


def run(frames, checks):
    rows = report(frames, {"child": checks}) if not checks.references else report(
        frames, {"child": checks, "parent": Expectations("key")})
    return {(r.test, r.column_name): r.failures for r in rows.collect() if r.table_name == "child"}


def test_each_check(frames):
    assert run(frames, Expectations("id label")) == {("not_null", "id"): 2, ("not_null", "label"): 1}
    assert run(frames, Expectations(unique="id")) == {("unique", "id"): 1}  # nulls are not compared
    assert run(frames, Expectations(accepted={"label": ["a", "b"]})) == {("accepted_values", "label"): 1}
    assert run(frames, Expectations(ranges={"amount": (0, None, True)})) == {("accepted_range", "amount"): 1}
    assert run(frames, Expectations(ranges={"amount": (0, 5, False)})) == {("accepted_range", "amount"): 3}
    assert run(frames, Expectations(unique_together=[["id", "label"]])) == {("unique_combination", "id-label"): 0}
    assert run(frames, Expectations(references={"parent": ("parent", "key")})) == {("relationships", "parent"): 2}
    assert run(frames, Expectations("*"))[("not_null", "amount")] == 1


def test_key_checks_of_all_tables_share_one_shuffle(spark, frames):
    """One domain with several children, repeated, null and missing keys, empty tables; the keys move once."""
    other = spark.createDataFrame([(1, "1:a"), (7, "1"), (7, None), (2, "a")], "ref bigint, label string")
    lost = spark.createDataFrame([], "key int")
    tables = {**frames, "other": other, "lost": lost}
    suite = {"child": Expectations(unique="id label", unique_text=[["id", "label"]], references={"parent": ("parent", "key")}),
             "parent": Expectations(unique="key"),
             "other": Expectations(unique="ref", unique_together=[["ref", "label"]], references={"ref": ("parent", "key")}),
             "lost": Expectations(unique="key", references={"key": ("parent", "key")})}
    got = key_report(tables, suite)
    assert {(r.table_name, r.test, r.column_name): r.failures for r in got.collect()} == {
        ("child", "unique", "id"): 1, ("child", "unique", "label"): 1, ("child", "unique", "id-label"): 0,
        ("child", "relationships", "parent"): 2, ("parent", "unique", "key"): 0, ("other", "unique", "ref"): 1,
        ("other", "unique_combination", "ref-label"): 0, ("other", "relationships", "ref"): 2,
        ("lost", "unique", "key"): 0, ("lost", "relationships", "key"): 0}
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(domain") == 2   # all keys, then one row per domain
    assert "Join" not in plan.replace("BroadcastHashJoin", "", 1)
    assert key_report(frames, {"child": Expectations("id")}) is None


def test_suite_size(warehouse):
    tables = stored_tables(warehouse)
    counts = {"not_null": sum(len(e.required_columns(tables[t].columns)) for t, e in SUITE.items()),
              "unique": sum(len(e.unique.split()) + len(e.unique_text) for e in SUITE.values()),
              "accepted_values": sum(len(e.accepted) for e in SUITE.values()),
              "accepted_range": sum(len(e.ranges) for e in SUITE.values()),
              "relationships": sum(len(e.references) for e in SUITE.values()),
              "unique_combination": sum(len(e.unique_together) for e in SUITE.values())}
    assert counts == {"not_null": 208, "unique": 31, "accepted_values": 40, "accepted_range": 36,
                      "relationships": 16, "unique_combination": 1}


def test_hand_made_sources_fail_where_they_should(warehouse):
    tables = stored_tables(warehouse)
    names = ["source_customers", "source_products", "source_orders", "source_order_items", "fact_orders", "dim_customer",
             "dim_date"]
    suite = {t: SUITE[t] for t in names}
    failed = {(r.table_name, r.test, r.column_name): r.failures
              for r in report({t: tables[t] for t in names}, suite, store=True).collect() if not r.passed}
    assert failed == {("source_orders", "not_null", "customer_id"): 1,
                      ("source_orders", "relationships", "customer_id"): 1,
                      ("source_order_items", "relationships", "product_id"): 1,
                      ("fact_orders", "not_null", "customer_key"): 1}


def test_schema_guard(spark):
    stored = spark.createDataFrame([(1, "a")], "id int, name string")
    require_same_schema(spark.createDataFrame([("b", 2)], "name string, id int"), stored, "t")
    with pytest.raises(ValueError, match="id: IntegerType.* -> LongType"):
        require_same_schema(spark.createDataFrame([(1, "a")], "id bigint, name string"), stored, "t")
    with pytest.raises(ValueError, match="extra"):
        require_same_schema(spark.createDataFrame([(1, "a", 1)], "id int, name string, extra int"), stored, "t")
