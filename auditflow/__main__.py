"""Command line of the jobs: ``python -m auditflow {clean,report,native} ...``.

Sources and sinks are given as a Spark format and its options, for example
``--source kafka kafka.bootstrap.servers=host:9092 subscribe=messages`` or
``--sink text path=/data/out``. A sink without a ``path`` is taken for a connector, where
``topic.KIND=NAME`` names the topic of each kind of row, ``topic.*=NAME`` that of all others.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from auditflow.operators.rules import ReportRules
from auditflow.session import build_session
from auditflow.sources.dimension import AreaDimension
from auditflow.sources.streams import raw_stream
from auditflow.sources.versions import DimensionLog
from auditflow.streaming.exact import ExactReport
from auditflow.streaming.jobs import EVERY_MINUTE, clean_job, native_job, report_job
from auditflow.streaming.sinks import ConnectorSink, DocumentSink, FolderSink


def _format_and_options(words: list[str]) -> tuple[str, dict[str, str]]:
    format, *pairs = words
    return format, dict(pair.split("=", 1) for pair in pairs)


def _sink(words: list[str], split_by: str | None = None) -> FolderSink | ConnectorSink:
    format, options = _format_and_options(words)
    if "path" in options:
        return FolderSink(options["path"], format, split_by)
    topics = {k.removeprefix("topic."): v for k, v in options.items() if k.startswith("topic.")}
    rest = {k: v for k, v in options.items() if not k.startswith("topic.")}
    return ConnectorSink(format, rest, topics)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="auditflow", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--source", nargs="+", required=True, help="format and options")
    shared.add_argument("--checkpoint", required=True, help="folder of the streaming checkpoint")
    shared.add_argument("--drain", action="store_true", help="stop when the input is used up")
    shared.add_argument("--time-zone", help="zone of the times that are read and written")

    clean = jobs.add_parser("clean", parents=[shared])
    clean.add_argument("--areas", nargs="+", required=True, help="format and options of the table")
    clean.add_argument("--refresh-seconds", type=float, default=30.0)
    clean.add_argument("--areas-optional", action="store_true", help="start without a readable table")
    clean.add_argument("--areas-log", help="folder of versions, so that a replay sees the areas of its first run")
    clean.add_argument("--pieces", type=int, help="deal each micro-batch out over so many tasks")
    clean.add_argument("--sink", nargs="+", required=True, help="cleaned and unusable records")
    clean.add_argument("--on-missing", choices=["null", "fail"], default="null")
    clean.add_argument("--item-type", help="declared struct type of the items")

    timed = argparse.ArgumentParser(add_help=False)
    timed.add_argument("--window-seconds", type=int, default=60)
    timed.add_argument("--delay-seconds", type=int, default=10)
    timed.add_argument("--lateness-seconds", type=int, default=30)
    timed.add_argument("--strict-time", action="store_true")

    report = jobs.add_parser("report", parents=[shared, timed])
    report.add_argument("--state", required=True, help="folder of the open panes")
    report.add_argument("--sink", nargs="+", required=True, help="result documents")
    report.add_argument("--doc-id", action="store_true", help="add an id to upsert by")
    report.add_argument("--side", nargs="+", required=True, help="too-late and unusable rows")

    native = jobs.add_parser("native", parents=[shared, timed])
    native.add_argument("--out", required=True, help="folder of the final panes")
    return parser


def start(spark: SparkSession, argv: list[str] | None = None) -> StreamingQuery:
    """Start the job the arguments describe."""
    args = _parser().parse_args(argv)
    if args.time_zone:
        spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    format, options = _format_and_options(args.source)
    raw = raw_stream(spark, format, **options)
    trigger = {"availableNow": True} if args.drain else EVERY_MINUTE
    if args.job == "clean":
        areas_format, areas_options = _format_and_options(args.areas)
        dimension = AreaDimension(
            lambda session: session.read.format(areas_format).options(**areas_options).load(),
            args.refresh_seconds,
            path=f"{args.checkpoint.rstrip('/')}-areas",
            optional=args.areas_optional,
        )
        if args.areas_log:
            dimension = DimensionLog(dimension, args.areas_log)
        return clean_job(
            raw, dimension, _sink(args.sink, split_by="kind"), args.checkpoint,
            args.on_missing, args.item_type, trigger, args.pieces,
        )
    rules = ReportRules(
        args.window_seconds * 1000, args.delay_seconds * 1000, args.lateness_seconds * 1000,
        not args.strict_time,
    )
    if args.job == "native":
        return native_job(raw, args.out, args.checkpoint, rules, trigger)
    documents = DocumentSink(_sink(args.sink), args.doc_id)
    report = ExactReport(args.state, documents, _sink(args.side, split_by="kind"), rules)
    return report_job(raw, report, args.checkpoint, trigger)


if __name__ == "__main__":
    start(build_session()).awaitTermination()
