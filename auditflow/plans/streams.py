"""Streaming queries: the given tables replayed through the jobs, results read back."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from auditflow.functions.times import format_time
from auditflow.plans import clean, report
from auditflow.session import workspace
from auditflow.sources import tables
from auditflow.sources.dimension import AreaDimension
from auditflow.streaming.exact import ExactReport
from auditflow.streaming.jobs import clean_job, native_job, report_job
from auditflow.streaming.replay import replay
from auditflow.streaming.sinks import FolderSink

DRAIN = {"availableNow": True}

# Micro-batches of a replay. Events come up to 40 steps late, over several micro-batches, so panes
# that have fired get more rows, and rows come after the lateness.
STREAM_BATCHES = 9
STREAM_STEP_MS = 3 * 60 * report.MINUTE
STREAM_RULES = replace(report.RULES, lateness_ms=2 * 24 * 60 * report.MINUTE)

# Bounds one micro-batch of the cleaning job, which has no state; it has no bearing on the result.
FILES_PER_BATCH = 1_000

_EMITTED = (
    "batch_id bigint, window_start_ms bigint, type string, area string, count bigint, "
    "max_ms bigint"
)
_SIDE = "value string, batch_id bigint, kind string"


def _as_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = tables.table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
    # A pattern, because a streaming read of a plain path insists on a folder.
    return reader.parquet(f"{sf_dir}/{name}.*")


def _cleaned(spark: SparkSession, out: str) -> DataFrame:
    records = spark.read.schema(_SIDE).parquet(out).where("kind = 'clean'")
    return clean.read_records(records, clean.RECORD)


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.messages_from(_as_stream(spark, sf_dir, "lineitem"), spark, sf_dir)
    dimension = AreaDimension(lambda session: tables.areas(session, sf_dir))
    out = workspace(spark, "clean")
    pieces = spark.conf.get(tables.PIECES, None)
    clean_job(
        raw.select("value"), dimension, FolderSink(out, split_by="kind"),
        workspace(spark, "checkpoint"), trigger=DRAIN, pieces=int(pieces) if pieces else None,
    ).awaitTermination()
    return _cleaned(spark, out)


def stream_clean_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area table changes between micro-batches: none, the first, an empty and a second one."""
    months = [None, tables.FIRST_SNAPSHOT, tables.EMPTY_SNAPSHOT, tables.SECOND_SNAPSHOT, None]
    messages = tables.messages_from(tables.table(spark, sf_dir, "lineitem"), spark, sf_dir)
    in_force: list[int | None] = []

    def batches() -> Iterator[DataFrame]:
        for first, after in zip(months, months[1:]):
            in_force[:] = [first]
            since = F.lit(True) if first is None else F.col("batch_id") >= first
            until = F.lit(True) if after is None else F.col("batch_id") < after
            yield messages.where(since & until).select("value")

    def load(session: SparkSession) -> DataFrame:
        return tables.area_snapshots(session, sf_dir).where(F.col("version") == F.lit(in_force[0]))

    dimension = AreaDimension(load, refresh_seconds=0, path=workspace(spark, "areas"))
    out, checkpoint = workspace(spark, "clean"), workspace(spark, "checkpoint")
    replay(spark, batches(), lambda raw: clean_job(
        raw, dimension, FolderSink(out, split_by="kind"), checkpoint, trigger=DRAIN
    ))
    return _cleaned(spark, out)


class _Replayed:
    """The exact report over the events in their order of arrival."""

    def __init__(self, spark: SparkSession, sf_dir: str, report_class: type = ExactReport):
        self.emitted, self.side = workspace(spark, "emitted"), workspace(spark, "side")
        self.checkpoint = workspace(spark, "checkpoint")
        self.report = report_class(
            workspace(spark, "state"), FolderSink(self.emitted),
            FolderSink(self.side, split_by="kind"), STREAM_RULES,
        )
        self.spark = spark
        arrival = tables.arrival_ms(STREAM_STEP_MS)
        longest = tables.DELAY_STEPS * STREAM_STEP_MS
        replay(
            spark, tables.audit_batches(spark, sf_dir, arrival, STREAM_BATCHES, longest), self._start
        )

    def _start(self, raw: DataFrame) -> StreamingQuery:
        return report_job(raw, self.report, self.checkpoint, trigger=DRAIN)

    def changelog(self) -> DataFrame:
        log = self.spark.read.schema(_EMITTED).parquet(self.emitted)
        return log.select(
            "batch_id", "window_start_ms", "type", "area", "count",
            format_time(F.col("max_ms")).alias("data"),
        )

    def aside(self) -> DataFrame:
        return self.spark.read.schema(_SIDE).parquet(self.side)


def stream_report_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _Replayed(spark, sf_dir).changelog()


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    aside = _Replayed(spark, sf_dir).aside()
    return aside.where("kind = 'late'").select("batch_id", "value")


_PLANTED = "planted failure"


class _FailsOnce(ExactReport):
    """Stops once in the third batch, after its outputs are written and before its state is."""

    failed = False

    def _hold(self, spark, panes, seen, batch_id):
        if batch_id == 2 and not self.failed:
            self.failed = True
            raise RuntimeError(_PLANTED)
        super()._hold(spark, panes, seen, batch_id)


class _Restarted(_Replayed):
    """Starts the job again from its checkpoint after the planted failure, which must take place."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir, _FailsOnce)
        if not self.report.failed:
            raise RuntimeError("the planted failure did not take place")

    def _start(self, raw: DataFrame) -> StreamingQuery:
        query = super()._start(raw)
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if _PLANTED not in str(error):
                raise
            query = super()._start(raw)
        return query


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _Restarted(spark, sf_dir).changelog()


def stream_native_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the order of their time, over several micro-batches."""
    out, checkpoint = workspace(spark, "native"), workspace(spark, "checkpoint")
    replay(
        spark,
        tables.audit_batches(spark, sf_dir, tables.event_ms(), STREAM_BATCHES, 0),
        lambda raw: native_job(raw, out, checkpoint, report.RULES, DRAIN),
    )
    return spark.read.parquet(out)


QUERIES = {
    f.__name__: f
    for f in (
        stream_clean, stream_clean_refresh, stream_report_changelog, stream_late, stream_restart,
        stream_native_final,
    )
}

_ARRIVAL = report.arrival_sql(STREAM_STEP_MS)
BATCH_SQL = f"""({_ARRIVAL} - (SELECT min({_ARRIVAL}) FROM events))
             // ((SELECT max({_ARRIVAL}) - min({_ARRIVAL}) FROM events) // {STREAM_BATCHES} + 1)"""

_CHANGELOG = f"""
WITH {report.lateness_sql(BATCH_SQL, STREAM_RULES)}
SELECT batch_id, ws AS window_start_ms, type, area, n AS count,
       strftime(make_timestamp(mx * 1000), '%Y-%m-%d %H:%M:%S') AS data
FROM emission"""

_RULES = report.RULES
_MONTH = "CAST(substr(dt, 1, 4) AS INTEGER) * 12 + CAST(substr(dt, 6, 2) AS INTEGER)"

ORACLE = {
    "stream_clean": clean.ORACLE["clean_enrich_left"],
    "stream_clean_refresh": f"""
WITH {clean.MESSAGES_SQL}
SELECT type, score, level, dt,
       CASE WHEN {_MONTH} >= {tables.SECOND_SNAPSHOT}
              THEN CASE WHEN r_name <> '{tables.DROPPED_REGION}' THEN r_name END
            WHEN {_MONTH} >= {tables.FIRST_SNAPSHOT}
              THEN CASE WHEN r_name <> '{tables.UNLISTED_REGION}' THEN r_name END END AS area
FROM item""",
    "stream_report_changelog": _CHANGELOG,
    "stream_restart": _CHANGELOG,
    "stream_late": f"""
WITH {report.lateness_sql(BATCH_SQL, STREAM_RULES)}
SELECT batch_id, {report.LATE_LINE_SQL} FROM judged WHERE late""",
    "stream_native_final": f"""
WITH {report.audit_sql()}
SELECT window_start_ms, type, area, count,
       strftime(make_timestamp(mx * 1000), '%Y-%m-%d %H:%M:%S') AS data
FROM (
  SELECT ws AS window_start_ms, type, area, count(*) AS count, max(ms) AS mx
  FROM audit WHERE status = 'ok'
  GROUP BY ws, type, area)
WHERE window_start_ms + {_RULES.window_ms}
      <= (SELECT max(ms) FROM audit WHERE status = 'ok')
         - {_RULES.delay_ms + _RULES.lateness_ms}""",
}
