"""The refreshable area dimension of a running job."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from auditflow.operators.dimension import invert_areas
from auditflow.session import no_rows, one_row, workspace

log = logging.getLogger(__name__)

CODES_SCHEMA = "countryCode string, area string"


class AreaDimension:
    """Holds the newest usable snapshot of the area table, re-read at most every 30 s.

    That is half the trigger of the jobs, so each of their micro-batches reads it anew. ``load``
    returns the current ``(area, codes)`` table from any batch source. It is called anew for each
    refresh, because a DataFrame once joined to a stream never sees later changes. A snapshot
    replaces the one before it as a whole. An empty one, or a failed read, keeps the one before it.

    If the very first read fails, the job fails, unless ``optional``; then, as with an empty table,
    every lookup misses until there is a snapshot. ``path`` is a folder that outlives the process:
    a restarted job finds the last good snapshot there.
    """

    def __init__(
        self,
        load: Callable[[SparkSession], DataFrame],
        refresh_seconds: float = 30.0,
        clock: Callable[[], float] = time.monotonic,
        path: str | None = None,
        optional: bool = False,
    ):
        self._load = load
        self._refresh = refresh_seconds
        self._clock = clock
        self._path = path
        self._optional = optional
        self._read_at: float | None = None
        self._slots: list[str] = []
        self._slot = -1

    def current(self, spark: SparkSession) -> DataFrame:
        """``(countryCode, area)``, read from a stored table so that its true size is known."""
        if self._read_at is None or self._clock() - self._read_at >= self._refresh:
            self._read_at = self._clock()
            self._reload(spark)
        if self._slot < 0:
            return no_rows(spark, CODES_SCHEMA)
        return self._stored(spark, self._slot)

    def for_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The newest snapshot; a replayed batch may see a newer one (see ``DimensionLog``)."""
        return self.current(spark)

    def _reload(self, spark: SparkSession) -> None:
        if not self._slots:
            # Two places in turn: the snapshot in force is never overwritten.
            self._path = self._path or workspace(spark, "areas")
            self._slots = [f"{self._path}/{n}" for n in range(2)]
            self._slot = self._slot_in_force(spark)
        target = (self._slot + 1) % 2
        try:
            invert_areas(self._load(spark)).select("countryCode", "area").write.mode(
                "overwrite"
            ).parquet(self._slots[target])
            if self._stored(spark, target).isEmpty():
                log.warning("the area table is empty; keeping the snapshot before it")
            else:
                one_row(spark, "slot int", slot=target).write.mode("overwrite").parquet(self._mark())
                self._slot = target
        except Exception:
            if self._slot < 0 and not self._optional:
                raise
            log.exception("reading the area table failed; keeping the snapshot before it")

    def _mark(self) -> str:
        return f"{self._path}/in_force"

    def _slot_in_force(self, spark: SparkSession) -> int:
        """The slot an earlier process left in force, -1 if none."""
        try:
            rows = spark.read.schema("slot int").parquet(self._mark()).take(1)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        return rows[0].slot if rows else -1

    def _stored(self, spark: SparkSession, slot: int) -> DataFrame:
        return spark.read.schema(CODES_SCHEMA).parquet(self._slots[slot])
