"""The report with lateness, refiring and a late side output, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from auditflow.operators.lateness import is_too_late
from auditflow.operators.reporting import (
    PANE_KEY,
    late_line,
    parse_audit,
    window_last,
    window_start,
)
from auditflow.operators.rules import ReportRules
from auditflow.session import no_rows, one_row
from auditflow.streaming.runs import claim
from auditflow.streaming.sinks import ConnectorSink, DocumentSink, FolderSink

# Kinds of rows that are set aside.
ASIDE = ("late", "malformed", "bad_time", "no_key")

_STATE_SCHEMA = (
    "kind string, window_start_ms bigint, type string, area string, "
    "count bigint, max_ms bigint, touched boolean, batch_id bigint"
)


def _total(number: Column) -> Column:
    return F.coalesce(F.sum(number), F.lit(0)).cast("bigint")


@dataclass
class ExactReport:
    """``foreachBatch`` function of the report.

    Spark's own windowed aggregate drops late rows without handing them out, and filters by the
    watermark of one batch earlier; so open panes are kept here as a small table instead. A batch
    reads only the state its predecessor left and writes its own outputs by overwriting, state
    last, so a batch that is replayed after a failure leaves the same result. State lives in two
    places in turn and holds open panes, not events; every micro-batch writes all open panes anew.
    A few numbers reach the driver, observed while the counts are written, without another reading.
    State that another run left in the same place is refused.

    ``emissions`` receives ``window_start_ms, type, area, count, max_ms`` for every firing and
    refiring; ``side`` receives ``kind, value``: too-late rows as tab-joined lines under ``late``,
    and unusable rows with their raw text under ``malformed``, ``bad_time`` and ``no_key``.

    ``watch`` is called after each batch with its numbers: ``batch_id``, the rows of each kind set
    aside, panes that ``fired`` first and ``refired``, ``max_ms`` (latest time seen so far) and
    ``watermark_ms``. A replayed batch calls it again.
    """

    state_path: str
    emissions: FolderSink | ConnectorSink | DocumentSink
    side: FolderSink | ConnectorSink
    rules: ReportRules = ReportRules()
    watch: Callable[[dict[str, int | None]], None] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held, seen_before = self._held(spark, batch_id)
        rows = self._classified(batch, seen_before)

        # One pass over the rows, counted before the shuffle; all later steps work on its result.
        # Rows to set aside are only counted, a row per kind, to know whether there are any.
        ones = rows.select(
            "kind", *(F.when(F.col("kind") == "pane", F.col(c)).alias(c) for c in PANE_KEY),
            F.lit(1).cast("bigint").alias("count"), F.col("event_ms").alias("max_ms"),
            F.lit(True).alias("touched"),
        )
        merged = (
            ones.unionByName(held)
            .groupBy("kind", *PANE_KEY)
            .agg(
                F.sum("count").alias("count"),
                F.max("max_ms").alias("max_ms"),
                F.max("touched").alias("touched"),
            )
        )
        told = Observation()
        merged = merged.observe(
            told,
            F.max(F.when(F.col("kind").isin("pane", "late"), F.col("max_ms"))).alias("max_ms"),
            *(_total(F.when(F.col("kind") == k, F.col("count"))).alias(k) for k in ASIDE),
        )
        merged = self._stored(spark, merged, f"{self.state_path}/merged")
        seen_now, aside = told.get["max_ms"], {k: told.get[k] for k in ASIDE}
        # Held panes are no newer than what was seen before, so they do not move the maximum.
        seen = max((m for m in (seen_before, seen_now) if m is not None), default=None)

        panes = merged.where("kind = 'pane'").select(*PANE_KEY, "count", "max_ms", "touched")
        fired = self._emit(panes, seen_before, seen, batch_id)
        # A second reading of the batch, without a shuffle, and only where there is something to write.
        away = rows.where("kind <> 'pane'") if any(aside.values()) else rows.where("false")
        self._set_aside(away.select("kind", "value"), batch_id)
        self._hold(spark, panes, seen, batch_id)
        if self.watch:
            wm = self._watermark(seen)
            self.watch({"batch_id": batch_id, **aside, **fired.get, "max_ms": seen, "watermark_ms": wm})

    def _watermark(self, seen: int | None) -> int | None:
        return None if seen is None else max(seen, 0) - self.rules.delay_ms

    def _classified(self, batch: DataFrame, seen_before: int | None) -> DataFrame:
        """``kind``, ``event_ms``, window, type and area of each row, and the text to set aside."""
        audit = parse_audit(batch, self.rules)
        start = window_start(F.col("event_ms"), self.rules)
        wm_before = F.lit(self._watermark(seen_before)).cast("bigint")
        ok = F.col("status") == "ok"
        late = is_too_late(start, wm_before, self.rules)
        kind = F.when(~ok, F.col("status")).when(late, "late").otherwise("pane")
        text = F.when(ok, late_line()).otherwise(F.col("value"))

        return audit.select(
            kind.alias("kind"), start.alias("window_start_ms"), "type", "area", "event_ms",
            text.alias("value"),
        )

    def _emit(
        self, panes: DataFrame, seen_before: int | None, seen: int | None, batch_id: int
    ) -> Observation:
        """Panes that fire now, and panes that fired before and got new rows; their numbers."""
        last = window_last(F.col("window_start_ms"), self.rules)
        before, after = self._watermark(seen_before), self._watermark(seen)
        passed = F.lit(False) if after is None else last <= after
        first_time = F.lit(True) if before is None else last > before
        fired = panes.where(passed & (F.col("touched") | first_time))
        told = Observation()
        if self.watch:
            fired = fired.observe(
                told, _total(first_time.cast("int")).alias("fired"), _total((~first_time).cast("int")).alias("refired")
            )
        self.emissions.write(fired.select(*PANE_KEY, "count", "max_ms"), batch_id)
        return told

    def _set_aside(self, away: DataFrame, batch_id: int) -> None:
        """Late and unusable rows, each as often as it came."""
        self.side.write(away, batch_id)

    def _hold(self, spark, panes: DataFrame, seen: int | None, batch_id: int) -> None:
        """Keep panes that may still change, and last of all mark the batch as done."""
        open_panes = panes
        if seen is not None:
            expires = window_last(F.col("window_start_ms"), self.rules) + self.rules.lateness_ms
            open_panes = panes.where(expires > self._watermark(seen))
        mark = one_row(spark, _STATE_SCHEMA, kind="mark", max_ms=seen, batch_id=batch_id)
        kept = open_panes.select(
            F.lit("pane").alias("kind"), "*", F.lit(batch_id).cast("bigint").alias("batch_id")
        )
        kept.unionByName(mark).write.mode("overwrite").parquet(self._slot(batch_id))

    def _held(self, spark, batch_id: int) -> tuple[DataFrame, int | None]:
        """The predecessor's open panes and the latest event time seen by then."""
        columns = ["kind", *PANE_KEY, "count", "max_ms", "touched"]
        if batch_id == 0:
            claim(spark, self.state_path)
            return no_rows(spark, _STATE_SCHEMA).select(*columns), None
        state = spark.read.schema(_STATE_SCHEMA).parquet(self._slot(batch_id - 1))
        marks = state.where("kind = 'mark'").take(2)
        if len(marks) != 1 or marks[0].batch_id != batch_id - 1:
            raise ValueError(f"the state at {self.state_path} is not that of batch {batch_id - 1}")
        panes = state.where("kind = 'pane'").withColumn("touched", F.lit(False))
        return panes.select(*columns), marks[0].max_ms

    def _slot(self, batch_id: int) -> str:
        return f"{self.state_path}/slot={batch_id % 2}"

    @staticmethod
    def _stored(spark, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
