"""Reporting: audit events to counts per (window, type, area)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.functions.evaluate import with_once
from auditflow.functions.json import one_object
from auditflow.functions.text import tab_line
from auditflow.functions.times import format_time, parse_time_ms
from auditflow.operators.rules import ReportRules

PANE_KEY = ["window_start_ms", "type", "area"]

_AUDIT_SCHEMA = "dt string, type string, area string"


def window_start(ms: Column, rules: ReportRules) -> Column:
    """Start of the tumbling window ``[start, start + size)``, aligned to the epoch."""
    return ms - F.pmod(ms, F.lit(rules.window_ms))


def window_last(start: Column, rules: ReportRules) -> Column:
    """The last millisecond that belongs to the window."""
    return start + F.lit(rules.window_ms - 1)


def parse_audit(df: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """Parse ``value`` into ``event_ms``, ``type``, ``area`` and ``status``.

    Status is ``ok``, ``malformed`` (not exactly one JSON object), ``bad_time`` (missing or unreadable time,
    or exactly the epoch) or ``no_key`` (type or area missing). Other columns are kept.
    """
    keep = [c for c in df.columns if c != "value"]
    parsed = with_once(df, "_m", one_object(F.col("value"), _AUDIT_SCHEMA))
    timed = with_once(parsed, "event_ms", parse_time_ms(F.col("_m.dt"), rules.lenient_time, rules.zone))
    status = (
        F.when(F.col("_m").isNull(), "malformed")
        .when(F.col("event_ms").isNull() | (F.col("event_ms") == 0), "bad_time")
        .when(F.col("_m.type").isNull() | F.col("_m.area").isNull(), "no_key")
        .otherwise("ok")
    )
    return timed.select(*keep, "value", "event_ms", "_m.type", "_m.area", status.alias("status"))


def usable(audit: DataFrame) -> DataFrame:
    """Rows that can be counted."""
    return audit.where("status = 'ok'").drop("status", "value")


def rejected(audit: DataFrame) -> DataFrame:
    """Rows that cannot, with the raw text and the reason."""
    keep = [c for c in audit.columns if c not in ("event_ms", "type", "area", "status")]
    return audit.where("status <> 'ok'").select(*keep, F.col("status").alias("reason"))


def count_panes(rows: DataFrame, rules: ReportRules, *keys: str) -> DataFrame:
    """Count and latest time per window, type and area (and ``keys``).

    Rows are counted before the shuffle, so a hot (type, area) sends one row per window and task.
    """
    return (
        rows.withColumn("window_start_ms", window_start(F.col("event_ms"), rules))
        .groupBy(*keys, *PANE_KEY)
        .agg(F.count(F.lit(1)).alias("count"), F.max("event_ms").alias("max_ms"))
    )


def as_documents(panes: DataFrame, with_id: bool = False) -> DataFrame:
    """Result documents ``data, type, area, count``; ``with_id`` adds a key stable per pane.

    An index that upserts by ``doc_id`` keeps one document per pane instead of one per emission.
    """
    docs = [format_time(F.col("max_ms")).alias("data"), "type", "area", "count"]
    if with_id:
        key = F.sha2(F.to_json(F.struct(*PANE_KEY)), 256)
        return panes.select(key.alias("doc_id"), *docs)
    return panes.select(*docs)


def late_line() -> Column:
    """A too-late row as ``epoch milliseconds, type, area`` joined by tabs."""
    return tab_line(F.col("event_ms"), F.col("type"), F.col("area"))
