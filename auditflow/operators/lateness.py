"""Watermark, allowed lateness, refiring and the side output for rows that come too late.

Input arrives in numbered batches. The watermark is the latest event time seen so far (never
below the epoch) minus the delay, and moves between batches. All tests depend only on a row's
batch and window, so they run on panes already counted per (batch, window, type, area).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditflow.operators.asof import asof_max, negated, running_max
from auditflow.operators.reporting import PANE_KEY, window_last
from auditflow.operators.rules import ReportRules

# Batches per bucket, and windows per bucket, of the running scans.
BATCHES_PER_BUCKET = 65_536
WINDOWS_PER_BUCKET = 4_096


def batch_watermark(latest: DataFrame, rules: ReportRules) -> DataFrame:
    """``(batch_id, wm_before, wm_after)`` in milliseconds; ``wm_before`` is null at first.

    ``latest(batch_id, max_ms)`` may have any number of rows per batch: counted panes, or one row.
    """
    per_batch = latest.groupBy("batch_id").agg(F.max("max_ms").alias("_max"))
    seen = running_max(per_batch, "batch_id", "_max", BATCHES_PER_BUCKET)

    def mark(col: str) -> Column:
        return F.greatest(F.col(col), F.lit(0)) - F.lit(rules.delay_ms)

    return seen.select(
        "batch_id",
        F.when(F.col("max_before").isNotNull(), mark("max_before")).alias("wm_before"),
        mark("max_upto").alias("wm_after"),
    )


def partition_watermark(
    latest: DataFrame, rules: ReportRules, partitions: int, idle_batches: int | None = None
) -> DataFrame:
    """``(batch_id, wm_before, wm_after)`` where each source partition has a watermark of its own.

    ``latest(batch_id, partition, max_ms)`` may have any number of rows per batch and partition;
    partitions are numbered from 0 to ``partitions - 1``, and rows of others or of none are not
    counted. Each keeps the latest time it has brought, the epoch until it brings any, and the
    slowest one holds the watermark: rows of one partition are not late because another is ahead.

    Without ``idle_batches`` a partition that brings nothing holds it for ever. With it, one that has
    brought no rows in that many batches of the input, the present one included, is left out until it
    brings some again; if all are left out the watermark stays. It never goes back, so what a partition
    brings after a rest may be late. ``wm_before`` is null at first.

    The table worked on has a row per batch and partition, not per row or pane.
    """
    known = latest.where(F.col("partition").between(0, partitions - 1))
    per_batch = known.groupBy("batch_id", "partition").agg(F.max("max_ms").alias("_max"))
    # Batches in the order of the input, so that numbers left out are no rest.
    batches = latest.select("batch_id").distinct()
    every = batches.select("batch_id", F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))).alias("partition"))
    told = every.join(per_batch, ["batch_id", "partition"], "left")
    seen = running_max(told, "batch_id", "_max", BATCHES_PER_BUCKET, "partition")
    reached = F.greatest("max_upto", F.lit(0)) - F.lit(rules.delay_ms)
    if idle_batches is not None:
        numbered = _numbered(batches)
        seen = seen.join(numbered, "batch_id").withColumn("_active", F.when(F.col("_max").isNotNull(), F.col("number")))
        seen = seen.withColumnRenamed("max_upto", "_reached").drop("max_before")
        seen = running_max(seen, "batch_id", "_active", BATCHES_PER_BUCKET, "partition")
        resting = (F.col("number") - F.coalesce("max_upto", F.lit(-1)) >= idle_batches)
        reached = F.when(~resting, F.greatest("_reached", F.lit(0)) - F.lit(rules.delay_ms))
    slowest = seen.groupBy("batch_id").agg(F.min(reached).alias("_slowest"))
    # Where all rest it stays, which at first is the delay before the epoch.
    start = F.lit(-rules.delay_ms).cast("long")
    marks = running_max(
        slowest.withColumn("_slowest", F.coalesce("_slowest", start)), "batch_id", "_slowest", BATCHES_PER_BUCKET
    )
    return marks.select("batch_id", F.col("max_before").alias("wm_before"), F.col("max_upto").alias("wm_after"))


def _numbered(batches: DataFrame) -> DataFrame:
    """``batch_id, number``: the place of each batch among all of them, from 0.

    Counted within buckets of batches; only the buckets' sizes are summed in one line.
    """
    bucketed = batches.withColumn("_bucket", F.col("batch_id") - F.pmod(F.col("batch_id"), F.lit(BATCHES_PER_BUCKET)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("batch_id"))
    return bucketed.withColumn("_place", place).join(starts, "_bucket").select(
        "batch_id", (F.col("_start") + F.col("_place") - 1).alias("number")
    )


def is_too_late(start: Column, wm_before: Column, rules: ReportRules) -> Column:
    """The window, lateness included, ended before the batch began; never true at first."""
    expires = window_last(start, rules) + F.lit(rules.lateness_ms)
    return F.coalesce(expires <= wm_before, F.lit(False))


def split_late(
    panes: DataFrame, marks: DataFrame, rules: ReportRules
) -> tuple[DataFrame, DataFrame]:
    """Panes that still count and panes whose rows are too late."""
    marked = panes.join(marks.select("batch_id", "wm_before"), "batch_id")
    late = is_too_late(F.col("window_start_ms"), F.col("wm_before"), rules)
    return marked.where(~late).drop("wm_before"), marked.where(late).drop("wm_before")


def late_rows(rows: DataFrame, late_panes: DataFrame) -> DataFrame:
    """The rows behind the late panes.

    ``late_panes`` should be a stored table (``session.stage``): it is tiny next to the rows, and
    its true size then lets the planner avoid shuffling them.
    """
    late_keys = late_panes.select("batch_id", "window_start_ms").distinct()
    return rows.join(late_keys, ["batch_id", "window_start_ms"], "left_semi")


def final_panes(on_time: DataFrame) -> DataFrame:
    """The last value of every pane, fired or not."""
    return on_time.groupBy(*PANE_KEY).agg(
        F.sum("count").alias("count"), F.max("max_ms").alias("max_ms")
    )


def fire_batches(panes: DataFrame, marks: DataFrame, rules: ReportRules) -> DataFrame:
    """``(window_start_ms, fire_batch)``: the first batch whose watermark passes the window.

    Windows the watermark never passes are left out.
    """
    last = window_last(F.col("window_start_ms"), rules)
    points = panes.select((-last).alias("at")).distinct()
    refs = marks.select(negated("wm_after").alias("at"), negated("batch_id").alias("value"))
    found = asof_max(points, refs, WINDOWS_PER_BUCKET * rules.window_ms)
    return found.where("value is not null").select(
        (-F.col("at") - F.lit(rules.window_ms - 1)).alias("window_start_ms"),
        negated("value").alias("fire_batch"),
    )


def changelog(on_time: DataFrame, fires: DataFrame) -> DataFrame:
    """Every emission: cumulative ``count`` and ``max_ms`` per pane and emitting batch.

    Rows up to the window's first firing are emitted together; after it each batch that brings
    rows emits the pane again. One exchange by pane serves both the sum and the running totals.
    """
    emitted = on_time.join(fires, "window_start_ms").withColumn(
        "batch_id", F.greatest("batch_id", "fire_batch")
    )
    steps = (
        emitted.repartition(*PANE_KEY)
        .groupBy(*PANE_KEY, "batch_id")
        .agg(F.sum("count").alias("count"), F.max("max_ms").alias("max_ms"))
    )
    so_far = (
        Window.partitionBy(*PANE_KEY)
        .orderBy("batch_id")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return steps.select(
        "batch_id", *PANE_KEY,
        F.sum("count").over(so_far).alias("count"),
        F.max("max_ms").over(so_far).alias("max_ms"),
    )


def first_emissions(log: DataFrame) -> DataFrame:
    """The first emission of each pane."""
    return _one_emission(log, F.min_by)


def last_emissions(log: DataFrame) -> DataFrame:
    """The newest emission of each pane: what an upsert by pane leaves in the index."""
    return _one_emission(log, F.max_by)


def _one_emission(log: DataFrame, pick) -> DataFrame:
    chosen = pick(F.struct("batch_id", "count", "max_ms"), "batch_id")
    return log.groupBy(*PANE_KEY).agg(chosen.alias("_e")).select(
        "_e.batch_id", *PANE_KEY, "_e.count", "_e.max_ms"
    )
