import json

import golden
import pytest

from auditflow.__main__ import _sink, start
from auditflow.streaming.sinks import ConnectorSink, FolderSink


@pytest.fixture
def land(values, tmp_path):
    def write(*texts):
        values(*texts).coalesce(1).write.mode("append").text(f"{tmp_path}/in")
        return ["--source", "text", f"path={tmp_path}/in", "--drain",
                "--checkpoint", f"{tmp_path}/checkpoint"]

    return write


def test_clean(spark, tmp_path, land):
    source = land('{"dt":"t","countryCode":"US","data":[{"n":1}]}', "{bad")
    areas = spark.createDataFrame([("A", "US")], "area string, codes string")
    areas.write.json(f"{tmp_path}/areas")
    start(spark, ["clean", *source, "--areas", "json", f"path={tmp_path}/areas",
                  "--sink", "text", f"path={tmp_path}/out"]).awaitTermination()
    rows = spark.read.text(f"{tmp_path}/out").collect()
    assert {r.kind: r.value for r in rows if r.kind != "clean"} == {"malformed": "{bad"}
    assert [json.loads(r.value) for r in rows if r.kind == "clean"] == [
        {"area": "A", "dt": "t", "n": 1}
    ]


def test_report(spark, tmp_path, land):
    for times in golden.BATCHES:
        source = land(*map(golden.message, times))
        start(spark, ["report", *source, "--state", f"{tmp_path}/state", "--doc-id",
                      "--sink", "json", f"path={tmp_path}/out",
                      "--side", "text", f"path={tmp_path}/side"]).awaitTermination()
    rows = spark.read.json(f"{tmp_path}/out").collect()
    assert sorted((r.batch_id, r["count"], r.data) for r in rows) == [
        (b, n, f"2024-01-01 {t}") for b, _, n, t in golden.EMISSIONS
    ]
    assert len({r.doc_id for r in rows}) == 2  # a window that fires again keeps its id
    late = spark.read.text(f"{tmp_path}/side").collect()
    assert [(r.kind, r.value) for r in late] == [("late", f"{golden.ms(golden.LATE[1])}\ta\tX")]


def test_native(spark, tmp_path, land):
    source = land(golden.message("00:00:05"), golden.message("00:02:00"))
    start(spark, ["native", *source, "--out", f"{tmp_path}/out",
                  "--window-seconds", "30"]).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.window_start_ms, r["count"]) for r in rows] == [(golden.DAY_MS, 1)]


def test_sinks():
    assert _sink(["text", "path=/x"], "kind") == FolderSink("/x", "text", "kind")
    assert _sink(["kafka", "kafka.bootstrap.servers=h:1", "topic.clean=c"]) == ConnectorSink(
        "kafka", {"kafka.bootstrap.servers": "h:1"}, {"clean": "c"}
    )
