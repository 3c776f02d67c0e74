"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Set on every session this package works with, unless the session was built or submitted with its own.
SETTINGS = {
    # Times are read and written in this zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A repeated key inside one JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Rows of several kinds go to separate folders in one pass, without a sort by kind.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Rows may be long texts, so batches handed to Python are bounded by their bytes, too.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Native-mode window state lives off-heap and is checkpointed as changes.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "auditflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply those of ``SETTINGS`` that the session was not built or submitted with."""
    given = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; on a cluster the setting is
    required, because executors could not see a folder of the driver's machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="auditflow-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/auditflow/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a small intermediate table once and read it back.

    This cuts lineage in a way that survives lost executors, keeps several readers from repeating
    the work above, and gives the planner the table's true size when it chooses a join.
    """
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(spark: SparkSession, schema: str, **values: object) -> DataFrame:
    """A single row made by Spark itself, in one partition; values not given are null."""
    fields = StructType.fromDDL(schema)
    return spark.range(0, 1, 1, 1).select(
        *(F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in fields)
    )


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table, known to the planner as such."""
    return one_row(spark, schema).where(F.lit(False))
