"""Batch queries of the reporting pipeline, over events that arrive in numbered batches."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.functions.times import format_time
from auditflow.operators import lateness
from auditflow.operators.reporting import (
    as_documents,
    count_panes,
    late_line,
    parse_audit,
    rejected,
    usable,
    window_start,
)
from auditflow.operators.rules import ReportRules
from auditflow.session import stage
from auditflow.sources import tables

MINUTE = 60_000

# The given events are minutes apart, so window, delay and lateness are scaled up accordingly.
RULES = ReportRules(window_ms=60 * MINUTE, delay_ms=10 * MINUTE, lateness_ms=90 * MINUTE)

ZONE = "America/New_York"

# Arrival time covered by one batch.
BATCH_MS = 60 * MINUTE


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_audit(tables.audit_events(spark, sf_dir, BATCH_MS), RULES)


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usable(_audit(spark, sf_dir))


@dataclass
class _Replay:
    """Counted panes per batch, stored once, and what follows from them."""

    panes: DataFrame
    marks: DataFrame
    on_time: DataFrame
    late: DataFrame

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> _Replay:
        panes = stage(count_panes(_rows(spark, sf_dir), RULES, "batch_id"), "panes")
        marks = stage(lateness.batch_watermark(panes, RULES), "marks")
        return cls(panes, marks, *lateness.split_late(panes, marks, RULES))

    def log(self) -> DataFrame:
        fires = stage(lateness.fire_batches(self.panes, self.marks, RULES), "fires")
        return lateness.changelog(self.on_time, fires)


def _shown(panes: DataFrame) -> DataFrame:
    keep = [c for c in panes.columns if c != "max_ms"]
    return panes.select(*keep, format_time(F.col("max_ms")).alias("data"))


def report_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("event_ms", "type", "area")


def report_parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(parse_audit(tables.loose_audit_events(spark, sf_dir), RULES))
    return rows.select("event_ms", "type", "area")


def report_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of a zone that changes its clocks meanwhile, read and shown there."""
    rows = usable(parse_audit(tables.spring_audit_events(spark, sf_dir), replace(RULES, zone=ZONE)))
    return rows.select("event_ms", "type", "area", format_time(F.col("event_ms"), ZONE).alias("data"))


def report_bad_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = rejected(_audit(spark, sf_dir)).where("reason = 'bad_time'")
    parts = F.from_json("value", "dt string, type string, username string, area string")
    return bad.select(parts.alias("r")).select("r.*")


def report_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(_audit(spark, sf_dir)).groupBy("batch_id", "reason").agg(
        F.count(F.lit(1)).alias("count")
    )


def _panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_panes(_rows(spark, sf_dir), RULES)


def report_window_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panes(spark, sf_dir).drop("max_ms")


def report_window_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_panes(spark, sf_dir).drop("count"))


def batch_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = _rows(spark, sf_dir).groupBy("batch_id").agg(F.max("event_ms").alias("max_ms"))
    return lateness.batch_watermark(stage(latest, "latest"), RULES)


# Batches without rows after which a source partition no longer holds the watermark.
IDLE_BATCHES = 3


def _partition_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.big_table(spark, sf_dir, "events").withColumn("partition", tables.source_partition())
    messages = tables.audit_events_from(events, spark, sf_dir, tables.arrival_ms(), BATCH_MS, "partition")
    rows = usable(parse_audit(messages, RULES))
    return stage(rows.groupBy("batch_id", "partition").agg(F.max("event_ms").alias("max_ms")), "latest")


def partition_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch the watermark that the slowest source partition holds."""
    return lateness.partition_watermark(_partition_latest(spark, sf_dir), RULES, tables.PARTITIONS)


def partition_watermark_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where partitions at rest are left out."""
    return lateness.partition_watermark(_partition_latest(spark, sf_dir), RULES, tables.PARTITIONS, IDLE_BATCHES)


def report_partition_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every emission under the watermark of the slowest partition that is not at rest."""
    panes = stage(count_panes(_rows(spark, sf_dir), RULES, "batch_id"), "panes")
    marks = stage(partition_watermark_idle(spark, sf_dir), "marks")
    on_time, _ = lateness.split_late(panes, marks, RULES)
    return _shown(lateness.changelog(on_time, stage(lateness.fire_batches(panes, marks, RULES), "fires")))


def report_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = stage(_Replay.of(spark, sf_dir).late, "late")
    rows = _rows(spark, sf_dir).withColumn(
        "window_start_ms", window_start(F.col("event_ms"), RULES)
    )
    return lateness.late_rows(rows, late).select("batch_id", late_line().alias("value"))


def report_window_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(lateness.final_panes(_Replay.of(spark, sf_dir).on_time))


def report_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_Replay.of(spark, sf_dir).log())


def report_first_fire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(lateness.first_emissions(_Replay.of(spark, sf_dir).log()))


def report_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(lateness.last_emissions(_Replay.of(spark, sf_dir).log()))


def report_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_documents(_Replay.of(spark, sf_dir).log())


QUERIES = {
    f.__name__: f
    for f in (
        report_parse, report_parse_lenient, report_zone, report_bad_time, report_quarantine,
        report_window_count, report_window_max, batch_watermark, partition_watermark,
        partition_watermark_idle, report_partition_changelog, report_late_rows,
        report_window_final, report_changelog, report_first_fire, report_upsert, report_doc,
    )
}

_LOCATED = """events LEFT JOIN nation ON user_id % 25 = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey"""

_TIME = "strftime(make_timestamp(mx * 1000), '%Y-%m-%d %H:%M:%S') AS data"


def arrival_sql(step_ms: int = tables.STEP_MS) -> str:
    return (
        f"epoch_ms(ts) + CASE WHEN event_id % 5 = 0 THEN event_id // 5 * 37 % {tables.DELAY_STEPS} * {step_ms} "
        "ELSE event_id % 60 * 1000 END"
    )


def audit_sql(batch: str = f"({arrival_sql()}) // {BATCH_MS}", rules: ReportRules = RULES) -> str:
    """Events with status, batch and window."""
    return f"""
audit AS (
  SELECT *, ms - ms % {rules.window_ms} AS ws
  FROM (
    SELECT event_id, user_id, event_type AS type, r_name AS area,
           epoch_ms(date_trunc('second', ts)) AS ms,
           {batch} AS batch_id,
           CASE WHEN event_id % 101 = 0 THEN 'malformed' WHEN event_id % 97 = 0 THEN 'bad_time'
                WHEN event_id % 103 = 0 THEN 'no_key' ELSE 'ok' END AS status
    FROM {_LOCATED})
)"""


def _mark_sql(rules: ReportRules) -> str:
    return f"""
mark AS (
  SELECT batch_id,
         max(mx) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - {rules.delay_ms} AS wm_before,
         max(mx) OVER (ORDER BY batch_id) - {rules.delay_ms} AS wm_after
  FROM (SELECT batch_id, max(ms) AS mx FROM audit WHERE status = 'ok' GROUP BY batch_id)
)"""


def partition_mark_sql(idle_batches: int | None = None, rules: ReportRules = RULES) -> str:
    """``mark`` by partition, each batch looking back over all single events before it."""
    kept = "" if idle_batches is None else f"WHERE number - last < {idle_batches}"
    return f"""
sent AS (
  SELECT batch_id, ms, CASE WHEN user_id % {tables.PARTITIONS} = {tables.PARTITIONS - 1}
    AND epoch_ms(ts) // {3_600_000 * tables.REST_HOURS} % 2 = 1 THEN 0 ELSE user_id % {tables.PARTITIONS} END AS part
  FROM audit JOIN (SELECT event_id, ts FROM events) USING (event_id) WHERE status = 'ok'
),
line AS (SELECT batch_id, row_number() OVER (ORDER BY batch_id) - 1 AS number FROM (SELECT DISTINCT batch_id FROM sent)),
state AS (
  SELECT l.batch_id, l.number, p.part, coalesce(max(greatest(s.mx, 0)), 0) AS seen, coalesce(max(s.number), -1) AS last
  FROM line l CROSS JOIN (SELECT unnest(range({tables.PARTITIONS})) AS part) p
  LEFT JOIN (SELECT part, number, max(ms) AS mx FROM sent JOIN line USING (batch_id) GROUP BY part, number) s
    ON s.part = p.part AND s.number <= l.number
  GROUP BY l.batch_id, l.number, p.part
),
slowest AS (
  SELECT l.batch_id, coalesce(min(seen), 0) AS seen
  FROM line l LEFT JOIN (SELECT * FROM state {kept}) s USING (batch_id) GROUP BY l.batch_id
),
mark AS (
  SELECT batch_id,
         max(seen) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
           - {rules.delay_ms} AS wm_before,
         max(seen) OVER (ORDER BY batch_id) - {rules.delay_ms} AS wm_after
  FROM slowest
)"""


def lateness_sql(
    batch: str = f"({arrival_sql()}) // {BATCH_MS}", rules: ReportRules = RULES, mark: str | None = None
) -> str:
    """Rows marked late or not, and every emission, straight from the single events."""
    last = f"ws + {rules.window_ms} - 1"
    return audit_sql(batch, rules) + f""",
{mark or _mark_sql(rules)},
judged AS (
  SELECT audit.*, coalesce({last} + {rules.lateness_ms} <= wm_before, false) AS late
  FROM audit JOIN mark USING (batch_id) WHERE status = 'ok'
),
fire AS (
  SELECT ws, min(mark.batch_id) AS fire_batch
  FROM (SELECT DISTINCT ws FROM judged) JOIN mark ON wm_after >= {last} GROUP BY ws
),
counted AS (
  SELECT ws, type, area, greatest(batch_id, fire_batch) AS batch_id, ms
  FROM judged JOIN fire USING (ws) WHERE NOT late
),
emission AS (
  SELECT e.batch_id, e.ws, e.type, e.area, count(*) AS n, max(c.ms) AS mx
  FROM (SELECT DISTINCT ws, type, area, batch_id FROM counted) e
  JOIN counted c ON c.ws = e.ws AND c.type = e.type AND c.area = e.area
                AND c.batch_id <= e.batch_id
  GROUP BY e.batch_id, e.ws, e.type, e.area
)"""


def _emission_sql(pick: str) -> str:
    return f"""
WITH {lateness_sql()}
SELECT batch_id, ws AS window_start_ms, type, area, n AS count, {_TIME}
FROM emission
QUALIFY batch_id = {pick}(batch_id) OVER (PARTITION BY ws, type, area)"""


LATE_LINE_SQL = "ms || chr(9) || type || chr(9) || area AS value"

ORACLE = {
    "report_parse": f"""
WITH {audit_sql()} SELECT ms AS event_ms, type, area FROM audit WHERE status = 'ok'""",
    "report_parse_lenient": f"""
WITH {audit_sql()} SELECT ms AS event_ms, type, area FROM audit""",
    "report_zone": f"""
SELECT epoch_ms(there) AS event_ms, type, area,
       strftime(timezone('{ZONE}', there), '%Y-%m-%d %H:%M:%S') AS data
FROM (SELECT timezone('{ZONE}', date_trunc('second', ts) + INTERVAL {tables.SPRING_DAYS} DAY) AS there,
             event_type AS type, r_name AS area FROM {_LOCATED})""",
    "report_bad_time": f"""
WITH {audit_sql()}
SELECT CASE event_id % 4 WHEN 0 THEN 'bad' WHEN 1 THEN '' WHEN 2 THEN '1970-01-01 00:00:00' END
         AS dt,
       CASE WHEN event_id % 103 <> 0 THEN type END AS type, 'user' || user_id AS username, area
FROM audit WHERE status = 'bad_time'""",
    "report_quarantine": f"""
WITH {audit_sql()}
SELECT batch_id, status AS reason, count(*) AS count FROM audit WHERE status <> 'ok'
GROUP BY batch_id, status""",
    "report_window_count": f"""
WITH {audit_sql()}
SELECT ws AS window_start_ms, type, area, count(*) AS count FROM audit WHERE status = 'ok'
GROUP BY ws, type, area""",
    "report_window_max": f"""
WITH {audit_sql()}
SELECT window_start_ms, type, area, {_TIME} FROM (
  SELECT ws AS window_start_ms, type, area, max(ms) AS mx FROM audit WHERE status = 'ok'
  GROUP BY ws, type, area)""",
    "batch_watermark": f"""
WITH {lateness_sql()} SELECT batch_id, wm_before, wm_after FROM mark""",
    "partition_watermark": f"""
WITH {audit_sql()}, {partition_mark_sql()} SELECT batch_id, wm_before, wm_after FROM mark""",
    "partition_watermark_idle": f"""
WITH {audit_sql()}, {partition_mark_sql(IDLE_BATCHES)} SELECT batch_id, wm_before, wm_after FROM mark""",
    "report_partition_changelog": f"""
WITH {lateness_sql(mark=partition_mark_sql(IDLE_BATCHES))}
SELECT batch_id, ws AS window_start_ms, type, area, n AS count, {_TIME} FROM emission""",
    "report_late_rows": f"""
WITH {lateness_sql()} SELECT batch_id, {LATE_LINE_SQL} FROM judged WHERE late""",
    "report_window_final": f"""
WITH {lateness_sql()}
SELECT window_start_ms, type, area, count, {_TIME} FROM (
  SELECT ws AS window_start_ms, type, area, count(*) AS count, max(ms) AS mx
  FROM judged WHERE NOT late GROUP BY ws, type, area)""",
    "report_changelog": f"""
WITH {lateness_sql()}
SELECT batch_id, ws AS window_start_ms, type, area, n AS count, {_TIME} FROM emission""",
    "report_first_fire": _emission_sql("min"),
    "report_upsert": _emission_sql("max"),
    "report_doc": f"""
WITH {lateness_sql()} SELECT {_TIME}, type, area, n AS count FROM emission""",
}
