import json
import shutil
from pathlib import Path

import golden
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from reference_model import simulate
from test_lateness import random_batches

from auditflow.operators.rules import ReportRules
from auditflow.plans import streams
from auditflow.sources.dimension import AreaDimension
from auditflow.sources.streams import raw_stream
from auditflow.streaming.exact import ExactReport
from auditflow.streaming.jobs import clean_job, native_job, report_job
from auditflow.streaming.replay import replay
from auditflow.streaming.sinks import ConnectorSink, FolderSink

DRAIN = {"availableNow": True}


class Feed:
    """A landing folder, a job and its outputs under one path."""

    def __init__(self, spark, path, report_class=ExactReport, rules=ReportRules()):
        self.spark, self.path = spark, str(path)
        self.report = report_class(
            f"{path}/state", FolderSink(f"{path}/emitted"),
            FolderSink(f"{path}/side", "text", split_by="kind"), rules,
        )

    def land(self, *texts):
        rows = self.spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1)
        rows.write.mode("append").parquet(f"{self.path}/in")

    def raw(self):
        return raw_stream(self.spark, "parquet", path=f"{self.path}/in")

    def run(self):
        report_job(self.raw(), self.report, f"{self.path}/checkpoint", DRAIN).awaitTermination()

    def emissions(self):
        rows = self.spark.read.parquet(f"{self.path}/emitted").select(
            "batch_id", "window_start_ms", "type", "area", "count", "max_ms"
        )
        return sorted(tuple(r) for r in rows.collect())

    def side(self):
        rows = self.spark.read.text(f"{self.path}/side").select("batch_id", "kind", "value")
        return sorted(tuple(r) for r in rows.collect())


def expect_golden(feed):
    assert feed.emissions() == [
        (b, golden.ms(w), "a", "X", n, golden.ms(t)) for b, w, n, t in golden.EMISSIONS
    ]
    assert feed.side() == [(golden.LATE[0], "late", f"{golden.ms(golden.LATE[1])}\ta\tX")]


def test_golden_case_as_a_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for times in golden.BATCHES:
        feed.land(*map(golden.message, times))
        feed.run()
    expect_golden(feed)


def test_numbers_of_each_batch_are_handed_out(spark, tmp_path):
    feed, seen = Feed(spark, tmp_path), []
    feed.report.watch = seen.append
    for times in golden.BATCHES:
        feed.land(*map(golden.message, times), "{bad", "{bad")
        feed.run()
    expect = feed.emissions()
    assert [m["batch_id"] for m in seen] == list(range(len(golden.BATCHES)))
    assert all((m["malformed"], m["bad_time"], m["no_key"]) == (2, 0, 0) for m in seen)
    assert [m["late"] for m in seen] == [int(m["batch_id"] == golden.LATE[0]) for m in seen]
    first = {}
    for batch, *pane in expect:
        first.setdefault(tuple(pane[:3]), batch)
    for m in seen:
        mine = [(b, *rest) for b, *rest in expect if b == m["batch_id"]]
        assert m["fired"] == sum(first[tuple(p[1:4])] == m["batch_id"] for p in mine)
        assert m["refired"] == len(mine) - m["fired"]
    assert sum(m["refired"] for m in seen) > 0
    assert all(m["watermark_ms"] == m["max_ms"] - ReportRules().delay_ms for m in seen)


class FailsAtEachStep(ExactReport):
    """Fails once in every batch, each time one step later."""

    def __init__(self, *args):
        super().__init__(*args)
        self.failed = set()

    def _fail_once(self, step, batch_id):
        if batch_id % 3 == step and batch_id not in self.failed:
            self.failed.add(batch_id)
            raise RuntimeError("planted failure")

    def _emit(self, panes, seen_before, seen, batch_id):
        super()._emit(panes, seen_before, seen, batch_id)
        self._fail_once(0, batch_id)

    def _set_aside(self, counted, batch_id):
        super()._set_aside(counted, batch_id)
        self._fail_once(1, batch_id)

    def _hold(self, spark, panes, seen, batch_id):
        super()._hold(spark, panes, seen, batch_id)
        self._fail_once(2, batch_id)


def test_failed_batches_are_replayed_without_a_trace(spark, tmp_path):
    feed = Feed(spark, tmp_path, FailsAtEachStep)
    for times in golden.BATCHES:
        feed.land(*map(golden.message, times))
        with pytest.raises(StreamingQueryException, match="planted failure"):
            feed.run()
        feed.run()
    assert len(feed.report.failed) == len(golden.BATCHES)
    expect_golden(feed)


def test_unusable_rows_are_set_aside(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    bad = {"{bad": "malformed", '{"dt":"x","type":"a","area":"X"}': "bad_time",
           '{"dt":"2024-01-01 00:00:05","type":"a"}': "no_key"}
    feed.land(*bad)
    feed.run()
    feed.land(golden.message("00:00:05"))
    feed.run()
    feed.land(golden.message("00:01:10"))
    feed.run()
    assert feed.side() == sorted((0, kind, text) for text, kind in bad.items())
    assert feed.emissions() == [(2, golden.DAY_MS, "a", "X", 1, golden.ms("00:00:05"))]


def test_every_copy_of_a_row_is_kept(spark, tmp_path, values):
    feed = Feed(spark, tmp_path)
    feed.report(values(golden.message("00:10:00")), 0)
    late, good = golden.message("00:00:05"), golden.message("00:09:30")
    feed.report(values(*["{bad"] * 7, *[late] * 5, *[good] * 3, None, None), 1)
    feed.report(values(golden.message("00:12:00")), 2)
    assert feed.emissions() == [
        (2, golden.ms("00:09:00"), "a", "X", 3, golden.ms("00:09:30")),
        (2, golden.ms("00:10:00"), "a", "X", 1, golden.ms("00:10:00")),
    ]
    line = f"{golden.ms('00:00:05')}\ta\tX"
    side = feed.side()
    assert side.count((1, "malformed", "{bad")) == 7
    assert side.count((1, "late", line)) == 5
    assert len(side) == 14


def test_state_of_another_batch_is_refused(spark, tmp_path, values):
    report = Feed(spark, tmp_path).report
    report(values(golden.message("00:00:05")), 0)
    report(values(golden.message("00:00:06")), 1)
    with pytest.raises(ValueError, match="not that of batch 2"):
        report(values(golden.message("00:00:07")), 3)


@pytest.mark.parametrize("seed", [21, 22])
def test_exact_report_against_the_row_by_row_model(spark, tmp_path, seed):
    rules = ReportRules()
    batches = random_batches(seed, rules)[:8]
    feed = Feed(spark, tmp_path)
    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "event_ms bigint, type string, area string")
        dt = F.date_format(F.timestamp_millis("event_ms"), "yyyy-MM-dd HH:mm:ss").alias("dt")
        feed.report(df.select(F.to_json(F.struct(dt, "type", "area")).alias("value")), number)
    emissions, late, _ = simulate(batches, rules.window_ms, rules.delay_ms, rules.lateness_ms)
    assert feed.emissions() == emissions
    assert feed.side() == sorted((b, "late", f"{ms}\t{t}\t{a}") for b, ms, t, a in late)


def test_clean_job_looks_the_dimension_up_for_each_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    table = str(tmp_path / "areas")
    dimension = AreaDimension(
        lambda s: s.read.parquet(table), refresh_seconds=0, path=f"{tmp_path}/kept", optional=True
    )

    def store(rows):
        spark.createDataFrame(rows, "area string, codes string").write.mode("overwrite").parquet(
            table
        )

    def round_(number):
        feed.land(f'{{"dt":"{number}","countryCode":"US","data":[{{"n":1}},{{"n":2}}]}}', "{bad")
        sink = FolderSink(f"{tmp_path}/clean", "text", split_by="kind")
        clean_job(
            feed.raw(), dimension, sink, f"{tmp_path}/clean_checkpoint", trigger=DRAIN
        ).awaitTermination()

    round_(0)  # the table does not exist yet
    store([("A", "US")])
    round_(1)
    store([("B", "US,TW")])
    round_(2)
    store([])
    round_(3)
    store([("A", "TW")])
    round_(4)
    rows = spark.read.text(f"{tmp_path}/clean").collect()
    assert [r.value for r in rows if r.kind == "malformed"] == ["{bad"] * 5
    clean = [json.loads(r.value) for r in rows if r.kind == "clean"]
    assert len(clean) == 10
    areas = {int(c["dt"]): c.get("area") for c in clean}
    assert areas == {0: None, 1: "A", 2: "B", 3: "B", 4: None}


def test_the_first_read_of_the_dimension_must_work(spark, tmp_path):
    dimension = AreaDimension(lambda s: s.read.parquet(f"{tmp_path}/none"), path=f"{tmp_path}/kept")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        dimension.current(spark)


def test_the_last_good_snapshot_outlives_the_process(spark, tmp_path):
    good = spark.createDataFrame([("A", "US")], "area string, codes string")
    kept = f"{tmp_path}/kept"
    assert AreaDimension(lambda s: good, path=kept).current(spark).collect()

    def broken(session):
        raise OSError("the table is away")

    again = AreaDimension(broken, path=kept)
    assert [tuple(r) for r in again.current(spark).collect()] == [("US", "A")]


def test_a_snapshot_is_never_older_than_a_micro_batch(spark, tmp_path):
    now, reads = [0.0], []

    def load(session):
        reads.append(now[0])
        return session.createDataFrame([("A", "US")], "area string, codes string")

    dimension = AreaDimension(load, clock=lambda: now[0], path=f"{tmp_path}/kept")
    for now[0] in (0.0, 59.9, 120.1, 179.9):
        dimension.current(spark)
    assert reads == [0.0, 59.9, 120.1, 179.9]


def test_a_fresh_checkpoint_overwrites_nothing(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(golden.message("00:00:05"), "{bad")
    feed.run()
    feed.land(golden.message("00:01:10"))
    feed.run()
    before = feed.emissions(), feed.side()
    assert all(before)
    with pytest.raises(StreamingQueryException, match="belongs to another run"):
        report_job(feed.raw(), feed.report, f"{tmp_path}/fresh", DRAIN).awaitTermination()
    assert (feed.emissions(), feed.side()) == before
    feed.land(golden.message("00:02:30"))
    feed.run()
    assert len(feed.emissions()) == len(before[0]) + 1


def test_output_of_an_unknown_run_is_refused(spark, tmp_path, values):
    values("a").write.text(f"{tmp_path}/out/batch_id=0")
    with pytest.raises(ValueError, match="unknown run"):
        FolderSink(str(tmp_path / "out"), "text").write(values("b"), 0)


def test_a_replayed_batch_overwrites_its_folder(spark, tmp_path, values):
    sink = FolderSink(str(tmp_path / "out"), "text")
    sink.write(values("a", "b"), 3)
    sink.write(values("c"), 4)
    sink.write(values("a", "b"), 3)
    rows = spark.read.text(str(tmp_path / "out")).collect()
    assert sorted((r.batch_id, r.value) for r in rows) == [(3, "a"), (3, "b"), (4, "c")]


def test_connector_rows_carry_their_topic(spark):
    rows = spark.createDataFrame(
        [("clean", "1"), ("malformed", "2"), ("no_data", "3")], "kind string, value string"
    )
    sink = ConnectorSink("kafka", topics={"clean": "cleaned", "*": "rejects"})
    assert [tuple(r) for r in sink.addressed(rows).collect()] == [
        ("cleaned", "1"), ("rejects", "2"), ("rejects", "3")
    ]
    with pytest.raises(Exception, match="no topic for rows of kind"):
        ConnectorSink("kafka", topics={"clean": "cleaned"}).addressed(rows).collect()
    assert ConnectorSink("jdbc").addressed(rows).columns == ["kind", "value"]


def test_many_files_in_any_order_give_the_same_final_panes(spark, tmp_path):
    """What the native report counts does not depend on how the events are cut into files."""
    given = "/root/testdata/sf0.001"
    folder = str(tmp_path / "cut")
    # Files only: the given folder may be one that nobody but its owner can write to.
    (tmp_path / "cut").mkdir()
    for path in Path(given).iterdir():
        if path.name != "events.parquet":
            shutil.copyfile(path, f"{folder}/{path.name}")
    events = spark.read.parquet(f"{given}/events.parquet")
    events.repartition(40, F.xxhash64("event_id")).write.parquet(f"{folder}/events.parquet")
    whole, cut = (streams.stream_native_final(spark, d) for d in (given, folder))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))


def test_native_report_in_order(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for times in (["00:00:05", "00:00:20"], ["00:00:59", "00:01:05"], ["00:03:00"]):
        feed.land(*map(golden.message, times))
        native_job(
            feed.raw(), f"{tmp_path}/native", f"{tmp_path}/native_checkpoint", trigger=DRAIN
        ).awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/native").collect()
    assert sorted((r.window_start_ms, r.type, r.area, r["count"], r.data) for r in rows) == [
        (golden.ms("00:00:00"), "a", "X", 3, "2024-01-01 00:00:59"),
        (golden.ms("00:01:00"), "a", "X", 1, "2024-01-01 00:01:05"),
    ]


def test_a_replayed_batch_lands_in_equal_files(spark, tmp_path):
    sizes = []

    def start(raw):
        def count(batch, _):
            found = batch.groupBy(F.input_file_name()).count().collect()
            sizes.append(sorted(r["count"] for r in found))

        return raw.writeStream.foreachBatch(count).option("checkpointLocation", f"{tmp_path}/cp").trigger(**DRAIN).start()

    one_piece = [spark.range(0, 4000, 1, 1), spark.range(0, 400, 1, 1)]
    replay(spark, [b.selectExpr("cast(id as string) as value") for b in one_piece], start)
    cores = spark.sparkContext.defaultParallelism
    assert [(len(s), sum(s)) for s in sizes] == [(cores, 4000), (cores, 400)]
    assert all(max(s) - min(s) <= 1 for s in sizes)
