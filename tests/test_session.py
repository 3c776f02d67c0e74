from types import SimpleNamespace

import pytest

from auditflow.operators.partitioning import spread
from auditflow.session import SETTINGS, prepare, stage, workspace


def fake_session(master, shared=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared),
        sparkContext=SimpleNamespace(master=master),
    )


def test_workspace_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first.startswith(f"{shared}/auditflow/x-") and first != second
    on_cluster = workspace(fake_session("yarn", "hdfs://h/cp/"), "x")
    assert on_cluster.startswith("hdfs://h/cp/auditflow/x-")


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(fake_session("yarn"), "x")
    assert workspace(fake_session("local[2]"), "x").startswith("/")


def test_stage_stores_rows_and_schema(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a bigint, b string")
    stored = stage(df, "pair")
    assert stored.schema == df.schema
    assert sorted(map(tuple, stored.collect())) == [(1, None), (2, "b")]
    assert stored.inputFiles()


def test_spread_moves_rows_on_request_only(spark):
    one = spark.range(0, 10, 1, 1)
    assert spread(one, None) is one
    assert spread(one, 4).rdd.getNumPartitions() == 4
    assert spread(one, 4).count() == 10


def test_prepare_applies_the_settings(spark):
    prepare(spark)
    assert {k: spark.conf.get(k) for k in SETTINGS} == SETTINGS


def test_submitted_settings_win():
    zone = "spark.sql.session.timeZone"
    seen = {}
    session = SimpleNamespace(
        conf=SimpleNamespace(set=seen.__setitem__),
        sparkContext=SimpleNamespace(getConf=lambda: SimpleNamespace(contains=lambda key: key == zone)),
    )
    assert prepare(session) is session
    assert seen == {k: v for k, v in SETTINGS.items() if k != zone}
