"""Versions of the dimension, so that a replayed micro-batch sees the snapshot of its first run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.session import one_row
from auditflow.sources.dimension import CODES_SCHEMA, AreaDimension
from auditflow.streaming.runs import claim

# Every so many versions the whole dimension is written instead of its changes.
WHOLE_EVERY = 32

_LOG = f"{CODES_SCHEMA}, gone boolean, version bigint"
_PIN = "batch_id bigint, version bigint"


class DimensionLog:
    """The dimension a micro-batch is pinned to, kept as changes in a folder of its own.

    The first run of a batch takes the newest snapshot, appends what changed as a version (none if
    nothing did) and pins the batch to it; only then does the batch read it. A replay, also in a
    new process, finds the pin and reads that version, whatever the area table holds by then. The
    last two pins are kept, since only the last batch is ever replayed. A version left behind
    without a pin is overwritten. Old versions stay, and earlier ones than the last whole one may
    be removed from outside. The folder belongs to one run.
    """

    def __init__(self, dimension: AreaDimension, path: str):
        self._dimension = dimension
        self._path = path.rstrip("/")

    def for_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """``(countryCode, area)`` for this batch, the same each time it is run."""
        if batch_id == 0:
            claim(spark, self._path)
        pins = {p.batch_id: p.version for p in self._pins(spark)}
        if batch_id not in pins:
            newest = max(pins.values(), default=-1)
            pins[batch_id] = self._append(spark, newest)
            pin = one_row(spark, _PIN, batch_id=batch_id, version=pins[batch_id])
            pin.write.mode("overwrite").parquet(f"{self._path}/pins/slot={batch_id % 2}")
        return self.at(spark, pins[batch_id])

    def at(self, spark: SparkSession, version: int) -> DataFrame:
        """``(countryCode, area)`` of a version: the newest change of each country."""
        log = spark.read.schema(_LOG).parquet(f"{self._path}/log")
        since = version // WHOLE_EVERY * WHOLE_EVERY
        newest = F.max_by(F.struct("area", "gone"), "version").alias("last")
        codes = log.where(F.col("version").between(since, version)).groupBy("countryCode").agg(newest)
        return codes.where("NOT last.gone").select("countryCode", "last.area")

    def _append(self, spark: SparkSession, newest: int) -> int:
        now, version = self._dimension.current(spark), newest + 1
        kept = f"{self._path}/log/version={version}"
        if newest < 0:
            now.withColumn("gone", F.lit(False)).write.mode("overwrite").parquet(kept)
            return version
        changes = _changes(self.at(spark, newest), now)
        if changes.isEmpty():
            return newest
        if version % WHOLE_EVERY == 0:
            changes = now.withColumn("gone", F.lit(False))
        changes.write.mode("overwrite").parquet(kept)
        return version

    def _pins(self, spark: SparkSession) -> list:
        try:
            return spark.read.schema(_PIN).parquet(f"{self._path}/pins").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []


def _changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """``countryCode, area, gone`` where the two differ."""
    had = before.select("countryCode", F.col("area").alias("was"), F.lit(True).alias("had"))
    has = now.withColumn("has", F.lit(True))
    both = had.join(has, "countryCode", "full_outer")
    differ = ~F.col("had").eqNullSafe(F.col("has")) | ~F.col("was").eqNullSafe(F.col("area"))
    return both.where(differ).select("countryCode", "area", F.col("has").isNull().alias("gone"))
