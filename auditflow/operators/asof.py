"""Running maxima and as-of lookups that never put a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_max(df: DataFrame, order: str, value: str, width: int, *by: str) -> DataFrame:
    """Add ``max_upto`` and ``max_before``: the maximum of ``value`` up to / before each row.

    ``order`` must be unique, or unique for each ``by``, which may not be null; then each has a
    maximum of its own. The line of order values is cut into buckets of ``width``; each bucket is
    scanned on its own, and only the bucket maxima (one row per bucket) are scanned together, so the
    widest window sees ``range / width`` rows. ``df`` is read twice and should be a stored table or
    cheap to derive from one.
    """
    bucketed = df.withColumn("_bucket", F.col(order) - F.pmod(F.col(order), F.lit(width)))
    inside = Window.partitionBy(*by, "_bucket").orderBy(order)
    heads = bucketed.groupBy(*by, "_bucket").agg(F.max(value).alias("_head"))
    across = Window.partitionBy(*by).orderBy("_bucket") if by else Window.orderBy("_bucket")
    carried = heads.select(
        *by, "_bucket", F.max("_head").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried")
    )
    own_upto = F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    own_before = F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        bucketed.withColumns({"_upto": own_upto, "_before": own_before})
        .join(carried, [*by, "_bucket"])
        .select(
            *df.columns,
            F.greatest("_upto", "_carried").alias("max_upto"),
            F.greatest("_before", "_carried").alias("max_before"),
        )
    )


def asof_max(points: DataFrame, refs: DataFrame, width: int) -> DataFrame:
    """For each distinct point the maximum ``value`` over references at or before it.

    ``points(at)`` and ``refs(at, value)`` give ``(at, value)``; value is null where no reference
    comes first. Both are merged to one row per position before the scan.
    """
    line = (
        points.select("at", F.lit(None).cast(refs.schema["value"].dataType).alias("value"),
                      F.lit(True).alias("asked"))
        .unionByName(refs.select("at", "value", F.lit(False).alias("asked")))
        .groupBy("at")
        .agg(F.max("value").alias("value"), F.max("asked").alias("asked"))
    )
    return (
        running_max(line, "at", "value", width)
        .where("asked")
        .select("at", F.col("max_upto").alias("value"))
    )


def negated(col: str) -> Column:
    """Reverses an ordering, turning "first at or after" into "last at or before"."""
    return -F.col(col)
