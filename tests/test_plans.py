"""Plan shape: filters and column pruning reach the Parquet scans."""

import re

from revlens.plans import catalog as C

from tests.conftest import SF001


def _scans(df):
    """The formatted explain text and its Parquet scan sections."""
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return plan, re.findall(r"\(\d+\) Scan parquet.*?ReadSchema: [^\n]*", plan, re.S)


def test_rfm_input_pushes_date_window_and_prunes_columns(spark):
    plan, scans = _scans(C.clean_reviews(spark, SF001))
    orders = [s for s in scans if "o_orderdate" in s]
    assert orders, plan
    assert "GreaterThanOrEqual(o_orderdate" in orders[0] and "LessThanOrEqual(o_orderdate" in orders[0]
    schema = re.search(r"ReadSchema: struct<([^>]*)>", orders[0]).group(1)
    # only the columns the reviews use: no price, status, clerk or comment
    assert "o_totalprice" not in schema and "o_comment" not in schema and "o_clerk" not in schema


def test_summaries_read_no_text(spark):
    plan, scans = _scans(C.QUERIES["customer_summary"](spark, SF001))
    stored = [s for s in scans if "lineage-" in s]
    assert stored and all("content" not in s and "title" not in s for s in stored), plan


def test_rule_matching_joins_one_row_per_rule(spark):
    from revlens.operators import patterns
    rules = spark.createDataFrame([(1, [1, 2]), (2, [2])], "rule_id long, antecedent array<long>")
    baskets = spark.createDataFrame([(1, [1, 2, 3]), (2, [2])], "customer_id long, items array<long>")
    plan, _ = _scans(patterns.subset_matches(rules, "rule_id", "antecedent", baskets))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
