"""The long-running jobs: cleaning, the exact report and the native report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from auditflow.functions.times import format_time
from auditflow.operators.cleaning import cleaned_records
from auditflow.operators.partitioning import spread
from auditflow.operators.reporting import parse_audit, usable
from auditflow.operators.rules import ReportRules
from auditflow.sources.dimension import AreaDimension
from auditflow.sources.versions import DimensionLog
from auditflow.streaming.exact import ExactReport
from auditflow.streaming.sinks import ConnectorSink, FolderSink

# A micro-batch per minute, each one a checkpoint; pass availableNow=True to drain and stop.
EVERY_MINUTE = {"processingTime": "60 seconds"}


def clean_job(
    raw: DataFrame,
    dimension: AreaDimension | DimensionLog,
    sink: FolderSink | ConnectorSink,
    checkpoint: str,
    on_missing: str = "null",
    item_type: str | None = None,
    trigger: dict = EVERY_MINUTE,
    pieces: int | None = None,
) -> StreamingQuery:
    """Clean a stream of messages; the dimension is looked up anew for each micro-batch.

    With a ``DimensionLog`` a replayed micro-batch sees the snapshot of its first run.

    ``pieces`` deals each micro-batch out over so many tasks, see ``spread``.

    ``sink`` receives ``kind, value`` in one pass over the input: cleaned records under ``clean``,
    unusable messages under the name of their problem.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        codes = dimension.for_batch(batch.sparkSession, batch_id)
        sink.write(cleaned_records(spread(batch, pieces), codes, on_missing, item_type), batch_id)

    return (
        raw.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def report_job(
    raw: DataFrame, report: ExactReport, checkpoint: str, trigger: dict = EVERY_MINUTE
) -> StreamingQuery:
    """Run the exact report on a stream of audit events."""
    return (
        raw.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def native_report(raw: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """Final panes by Spark's own stateful aggregate, for ``append`` output.

    Simpler than the exact report, with two differences: too-late rows are dropped instead of
    handed out, and they are accepted for up to one micro-batch longer.
    """
    events = usable(parse_audit(raw, rules)).withColumn("ts", F.timestamp_millis("event_ms"))
    wait_ms = rules.delay_ms + rules.lateness_ms
    return (
        events.withWatermark("ts", f"{wait_ms} milliseconds")
        .groupBy(F.window("ts", f"{rules.window_ms} milliseconds"), "type", "area")
        .agg(F.count(F.lit(1)).alias("count"), F.max("event_ms").alias("max_ms"))
        .select(
            F.unix_millis("window.start").alias("window_start_ms"), "type", "area", "count",
            format_time(F.col("max_ms")).alias("data"),
        )
    )


def native_job(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    rules: ReportRules = ReportRules(),
    trigger: dict = EVERY_MINUTE,
) -> StreamingQuery:
    """The native report into a folder, each final pane exactly once."""
    return (
        native_report(raw, rules)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
