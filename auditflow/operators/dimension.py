"""The country-to-area dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditflow.functions.text import split_codes
from auditflow.operators.asof import asof_max
from auditflow.session import stage

# Batches per bucket of the as-of scan.
BATCHES_PER_BUCKET = 65_536


def invert_areas(areas: DataFrame, *keys: str) -> DataFrame:
    """``(area, codes)`` with comma-listed codes to one ``(countryCode, area)`` row per code.

    A code listed under several areas takes the smallest area name, so the result has one row per
    code and a join to it never multiplies rows. ``keys`` are extra grouping columns.
    """
    return (
        areas.where("area is not null and codes is not null")
        .select(*keys, "area", F.explode_outer(split_codes(F.col("codes"))).alias("countryCode"))
        .where("countryCode is not null")
        .groupBy(*keys, "countryCode")
        .agg(F.min("area").alias("area"))
    )


def snapshot_per_batch(batches: DataFrame, codes: DataFrame) -> DataFrame:
    """The newest non-empty snapshot at or before each batch: ``(batch_id, version)``.

    ``codes`` is the inverted dimension with a ``version``; an empty snapshot has no rows there,
    so the one before it stays in force. Version is null before the first snapshot.
    """
    versions = codes.groupBy("version").agg(F.max("version").alias("value"))
    points = batches.select(F.col("batch_id").cast("bigint").alias("at")).distinct()
    refs = versions.select(F.col("version").cast("bigint").alias("at"),
                           F.col("value").cast("bigint").alias("value"))
    found = asof_max(points, refs, BATCHES_PER_BUCKET)
    return found.select(F.col("at").alias("batch_id"), F.col("value").alias("version"))


def lookup_asof(
    messages: DataFrame, snapshots: DataFrame, batches: DataFrame | None = None
) -> DataFrame:
    """Add ``version`` and ``area`` to messages that carry ``batch_id`` and ``countryCode``.

    Each snapshot replaces the one before it as a whole, so a code it no longer lists misses.
    ``batches`` may give the batch numbers from a cheaper source than the parsed messages. They are
    read once, and the version per batch is stored so that its true size decides how the messages
    are joined.
    """
    codes = invert_areas(snapshots, "version")
    batches = messages if batches is None else batches
    batches = stage(batches.select("batch_id").distinct(), "batches")
    in_force = stage(snapshot_per_batch(batches, codes), "versions")
    return messages.join(in_force, "batch_id", "left").join(
        codes, ["version", "countryCode"], "left"
    )
