"""Keeping the outputs and the state of different runs of a job apart."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Spark's own name for the streaming query a thread works for; it outlives restarts, and a fresh
# checkpoint gets another one.
_QUERY = "sql.streaming.queryId"


def claim(spark: SparkSession, path: str) -> None:
    """Mark ``path`` as that of the run at work, before its first micro-batch writes there.

    Micro-batches are numbered per checkpoint. With a fresh checkpoint numbers start again and would
    overwrite what an earlier run left; so a path that another run has marked, or that holds data
    without a mark, is refused. A replay of the same run's first batch is let through.
    """
    run = spark.sparkContext.getLocalProperty(_QUERY) or "without a query"
    owner = _first(spark, f"{path}/_run", "text", "value")
    if owner is None:
        if _first(spark, path, "binaryFile", "path") is not None:
            raise ValueError(f"{path} holds data of an unknown run; give this run a folder of its own")
        spark.range(1).selectExpr(f"'{run}' as value").write.mode("overwrite").text(f"{path}/_run")
    elif owner != run:
        raise ValueError(
            f"{path} belongs to another run ({owner}); its batches would be overwritten. Give this run "
            "folders of its own, or go on with the checkpoint of that run"
        )


def _first(spark: SparkSession, path: str, format: str, column: str) -> str | None:
    reader = spark.read.format(format).option("recursiveFileLookup", "true")
    try:
        rows = reader.load(path).select(column).take(1)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows[0][0] if rows else None
