"""A third of all rows share one key; a large dimension is joined by shuffle. Nothing is lost."""

import pytest
from pyspark.sql import functions as F

from auditflow.operators.cleaning import cleaned_records
from auditflow.operators.reporting import count_panes, parse_audit, usable
from auditflow.operators.rules import ReportRules

ROWS = 60_000


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def key():
    return F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50))


def test_hot_country_without_broadcast(spark, no_broadcast):
    items = F.lit('","data":[{"n":1},{"n":2}]}')
    text = F.concat(F.lit('{"dt":"t","countryCode":"'), key(), items)
    messages = spark.range(0, ROWS, 1, 6).select(text.alias("value"))
    codes = spark.createDataFrame(
        [("hot", "H")] + [(f"k{i}", f"A{i}") for i in range(0, 50, 2)],
        "countryCode string, area string",
    )
    got = (
        cleaned_records(messages, codes)
        .select(F.from_json("value", "area string, n int").alias("r"))
        .groupBy("r.area", "r.n").count().collect()
    )
    counts = {(r.area, r.n): r["count"] for r in got}
    assert sum(counts.values()) == 2 * ROWS
    assert counts["H", 1] == counts["H", 2] == ROWS // 3
    unknown = sum(1 for i in range(ROWS) if i % 3 and (i % 50) % 2)
    assert counts[None, 1] == unknown


def test_hot_pane(spark):
    text = F.concat(F.lit('{"dt":"2024-01-01 00:00:05","type":"'), key(), F.lit('","area":"X"}'))
    rows = usable(parse_audit(spark.range(0, ROWS, 1, 6).select(text.alias("value"))))
    panes = count_panes(rows, ReportRules())
    counts = {r.type: r["count"] for r in panes.collect()}
    assert counts["hot"] == ROWS // 3 and sum(counts.values()) == ROWS and len(counts) == 51
