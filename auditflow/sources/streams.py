"""Raw message streams: one JSON text per record in ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def raw_stream(spark: SparkSession, format: str, **options: str) -> DataFrame:
    """A streaming DataFrame with the single column ``value``.

    ``format="kafka"`` takes the usual connector options (the connector must be on the class
    path); file formats take ``path`` and, to bound a micro-batch, ``maxFilesPerTrigger``.
    """
    reader = spark.readStream.format(format).options(**options)
    if format in ("parquet", "orc"):
        reader = reader.schema("value string")
    return reader.load().selectExpr("cast(value as string) as value")
