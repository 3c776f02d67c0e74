"""The physical plans hold what the design relies on."""

import re

import pytest

import __spark_entry__ as entry_points
from auditflow.operators.cleaning import cleaned_records
from auditflow.operators.reporting import count_panes, parse_audit, usable
from auditflow.operators.rules import ReportRules


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, values, tmp_path):
    values("{}").write.parquet(str(tmp_path / "raw"))
    return spark.read.schema("value string").parquet(str(tmp_path / "raw"))


@pytest.fixture
def codes(spark, tmp_path):
    df = spark.createDataFrame([("US", "A")], "countryCode string, area string")
    df.write.parquet(str(tmp_path / "codes"))
    return spark.read.parquet(str(tmp_path / "codes"))


def test_report_parses_each_text_once_and_counts_before_the_shuffle(stored):
    plan = plan_of(count_panes(usable(parse_audit(stored)), ReportRules()))
    assert plan.count("from_json") == 1
    assert plan.count("gettimestamp") == 1
    assert plan.count("Exchange") == 1
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")


@pytest.mark.parametrize("item_type", [None, "struct<type string>"])
def test_cleaning_parses_once_and_does_not_shuffle(stored, codes, item_type):
    plan = plan_of(cleaned_records(stored, codes, item_type=item_type).where("kind = 'clean'"))
    assert plan.count("from_json") == 1
    assert plan.count("BroadcastHashJoin") == 1
    assert not re.search(r"Exchange (hash|Single|Range)", plan)


def test_a_large_dimension_is_not_broadcast(spark, stored, codes):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = plan_of(cleaned_records(stored, codes))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize(
    "name",
    [n for n in entry_points.queries() if not n.startswith("stream_") and n not in entry_points.TEXT_QUERIES],
)
def test_no_query_multiplies_tables_or_runs_python(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, "/root/testdata/sf0.001"))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ObjectHashAggregate"):
        assert node not in plan, node
