"""Feeding a stored table to a streaming job in a fixed order of arrival."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from auditflow.operators.partitioning import spread
from auditflow.session import workspace
from auditflow.sources.streams import raw_stream


def replay(
    spark: SparkSession,
    batches: Iterable[DataFrame],
    start: Callable[[DataFrame], StreamingQuery],
) -> None:
    """Land one arrival batch after the other and drain the job after each.

    ``batches`` give texts in ``value`` in the order of arrival, ``start`` starts the job on a
    stream of texts. A file source orders files by time stamp only, so landing is what makes the
    order of arrival certain on any file system, however many files a batch has: what has landed
    since the last round is one micro-batch, with no bound on its files. Each round resumes the job
    from its checkpoint; the caller fixes their number.

    A batch lands in equal files, one for each core. Texts are small as stored and costly to parse, and
    a file of one row group is one task, so the cut of the table would leave a few tasks most of the work.
    """
    landing = workspace(spark, "landing")
    for batch in batches:
        spread(batch, spark.sparkContext.defaultParallelism).write.mode("append").parquet(landing)
        start(raw_stream(spark, "parquet", path=landing)).awaitTermination()
