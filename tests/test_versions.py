import pytest
from pyspark.errors import StreamingQueryException

from auditflow.sources import versions
from auditflow.sources.dimension import AreaDimension
from auditflow.sources.versions import DimensionLog
from auditflow.streaming.jobs import clean_job
from auditflow.streaming.sinks import FolderSink


class Table:
    """An area table that a test changes, and a log over it as each new process would open it."""

    def __init__(self, spark, path):
        self.rows, self.path, self.opened = [], str(path), 0
        self.schema = "area string, codes string"
        self.spark = spark

    def log(self):
        self.opened += 1
        load = lambda session: session.createDataFrame(self.rows, self.schema)
        return DimensionLog(
            AreaDimension(load, refresh_seconds=0, path=f"{self.path}/areas", optional=True), f"{self.path}/log"
        )


def codes(df):
    return dict(map(tuple, df.collect()))


@pytest.fixture
def areas(spark, tmp_path):
    return Table(spark, tmp_path)


def test_a_replayed_batch_sees_its_first_snapshot(spark, areas):
    areas.rows = [("A", "US,TW"), ("B", "IN")]
    assert codes(areas.log().for_batch(spark, 0)) == {"US": "A", "TW": "A", "IN": "B"}
    areas.rows = [("A", "US"), ("C", "IN,PK")]
    assert codes(areas.log().for_batch(spark, 0)) == {"US": "A", "TW": "A", "IN": "B"}
    log = areas.log()
    assert codes(log.for_batch(spark, 1)) == {"US": "A", "IN": "C", "PK": "C"}
    areas.rows = [("Z", "US")]
    assert codes(areas.log().for_batch(spark, 1)) == {"US": "A", "IN": "C", "PK": "C"}
    assert codes(log.at(spark, 0)) == {"US": "A", "TW": "A", "IN": "B"}
    changed = {r.countryCode: r.gone for r in spark.read.parquet(f"{areas.path}/log/log/version=1").collect()}
    assert changed == {"TW": True, "IN": False, "PK": False}


def test_no_change_makes_no_version(spark, areas, tmp_path):
    areas.rows = [("A", "US")]
    for batch in range(3):
        assert codes(areas.log().for_batch(spark, batch)) == {"US": "A"}
    assert [p.name for p in (tmp_path / "log" / "log").iterdir() if p.is_dir()] == ["version=0"]
    assert len([p for p in (tmp_path / "log" / "pins").iterdir() if p.is_dir()]) == 2


def test_an_empty_table_and_whole_versions(spark, areas, monkeypatch):
    monkeypatch.setattr(versions, "WHOLE_EVERY", 2)
    assert codes(areas.log().for_batch(spark, 0)) == {}
    for batch in range(1, 6):
        areas.rows = [("A", f"US,X{batch}"), (f"B{batch}", "IN")]
        log = areas.log()
        assert codes(log.for_batch(spark, batch)) == {"US": "A", f"X{batch}": "A", "IN": f"B{batch}"}
    assert codes(log.at(spark, 3)) == {"US": "A", "X3": "A", "IN": "B3"}
    assert spark.read.parquet(f"{areas.path}/log/log/version=4").count() == 3


def test_a_version_without_a_pin_is_overwritten(spark, areas):
    areas.rows = [("A", "US")]
    areas.log().for_batch(spark, 0)
    left = spark.createDataFrame([("US", "lost", False)], "countryCode string, area string, gone boolean")
    left.write.parquet(f"{areas.path}/log/log/version=1")
    assert codes(areas.log().for_batch(spark, 0)) == {"US": "A"}
    areas.rows = [("B", "US")]
    assert codes(areas.log().for_batch(spark, 1)) == {"US": "B"}


class BreaksOnce(FolderSink):
    """Writes the second batch, then fails once, so that the batch is replayed."""

    failed = []

    def write(self, rows, batch_id):
        super().write(rows, batch_id)
        if batch_id == 1 and not self.failed:
            self.failed.append(batch_id)
            raise RuntimeError("planted")


def test_a_table_changed_between_failure_and_replay(spark, areas, tmp_path):
    BreaksOnce.failed.clear()
    message = '{"dt":"d","countryCode":"US","data":[{"type":"t"}]}'
    for n in range(2):
        spark.createDataFrame([(message,)], "value string").coalesce(1).write.text(str(tmp_path / "in" / f"{n}"))
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(tmp_path / "in" / "*"))

    def run():
        clean_job(
            raw, areas.log(), BreaksOnce(str(tmp_path / "out"), split_by="kind"), str(tmp_path / "cp"),
            trigger={"availableNow": True},
        ).awaitTermination()

    areas.rows = [("A", "US")]
    with pytest.raises(StreamingQueryException, match="planted"):
        run()
    areas.rows = [("B", "US")]
    run()
    found = spark.read.schema("value string, batch_id int, kind string").parquet(str(tmp_path / "out")).collect()
    assert sorted((r.batch_id, r.kind, '"area":"A"' in r.value) for r in found) == [(0, "clean", True), (1, "clean", True)]
