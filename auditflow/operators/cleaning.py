"""Cleaning: parse a message, look up its area, give one output record per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditflow.functions.evaluate import with_once
from auditflow.functions.json import (
    BYTE_MARK,
    as_written,
    continued,
    one_object,
    opened,
    scalar_as_written,
    with_literals_as_text,
    without_keys,
    without_null_members,
)


def parse_messages(df: DataFrame, item_type: str | None = None) -> DataFrame:
    """Parse ``value`` into ``dt``, ``countryCode`` and ``items``; other columns are kept.

    Items are variants: objects with any keys, their numbers and nulls as marked strings (see
    ``with_literals_as_text``), which ``cleaned_records`` writes as they were. With a declared
    ``item_type`` (a struct) only its keys are read, which is faster.

    ``problem`` is null for a usable message, else ``malformed`` (not exactly one JSON object) or
    ``no_data`` (missing, or no array). The raw text is kept only for messages with a problem, so
    exploding does not copy it.
    """
    keep = [c for c in df.columns if c != "value"]
    schema = f"dt string, countryCode string, data array<{item_type or 'variant'}>"
    as_text = lambda name: F.col(f"_m.{name}")
    if item_type:
        parsed = with_once(df, "_m", one_object(F.col("value"), schema))
    else:
        as_text = lambda name: scalar_as_written(F.col(f"_m.{name}"), BYTE_MARK)
        marked = with_once(df, "_text", with_literals_as_text(F.col("value"), BYTE_MARK))
        parsed = with_once(marked, "_m", one_object(F.col("_text"), schema))
    problem = F.when(F.col("_m").isNull(), "malformed").when(F.col("_m.data").isNull(), "no_data")
    checked = parsed.withColumn("problem", problem)
    usable = F.col("problem").isNull()
    return checked.select(
        *keep, as_text("dt").alias("dt"), as_text("countryCode").alias("countryCode"),
        F.when(usable, F.col("_m.data")).alias("items"), "problem", F.when(~usable, F.col("value")).alias("raw"),
    )


def enrich(messages: DataFrame, codes: DataFrame, on_missing: str = "null") -> DataFrame:
    """Add ``area`` by ``countryCode``; every message is kept.

    ``on_missing="null"`` leaves the area null for an unknown code, ``"fail"`` stops the job. The
    dimension is broadcast when its size is under the session's broadcast threshold; a larger one
    is joined by shuffle, where adaptive execution splits hot codes.
    """
    joined = messages.join(codes.select("countryCode", "area"), "countryCode", "left")
    if on_missing == "null":
        return joined
    if on_missing != "fail":
        raise ValueError(f"on_missing must be 'null' or 'fail', not {on_missing!r}")
    unknown = F.concat(F.lit("no area for country code "),
                       F.coalesce("countryCode", F.lit("null")))
    is_lost = F.col("area").isNull()
    if "problem" in messages.columns:
        is_lost = is_lost & F.col("problem").isNull()
    return joined.withColumn(
        "area", F.when(is_lost, F.raise_error(unknown).cast("string")).otherwise(F.col("area"))
    )


def explode_items(messages: DataFrame) -> DataFrame:
    """One row per item. A message with a problem stays as one row, an empty one gives none."""
    keep = [c for c in messages.columns if c != "items"]
    # An outer explode, because a plain one makes the planner parse the message again in a filter.
    rows = messages.select(*keep, F.posexplode_outer("items").alias("_pos", "item"))
    return rows.where("_pos is not null or problem is not null").drop("_pos")


def cleaned_records(
    df: DataFrame, codes: DataFrame, on_missing: str = "null", item_type: str | None = None
) -> DataFrame:
    """The whole cleaning step: ``(kind, value)``.

    Kind ``clean`` holds items as JSON text with ``area`` and ``dt`` put in and null members left out
    at every depth. Messages with a problem come out whole under its name, elements that are no objects under
    ``bad_item``.
    """
    rows = enrich(parse_messages(df, item_type), codes, on_missing)
    item, area, dt = F.col("item"), F.col("area"), F.col("dt")
    if item_type:
        rows = explode_items(rows)
        no_object = item.isNull()
        text = F.to_json(item.withField("area", area).withField("dt", dt))
    else:
        # Written once for all items of a message.
        rows = with_once(rows, "_new", F.to_json(F.struct(area, dt)))
        rows = explode_items(with_once(rows, "_head", opened(F.col("_new"))).drop("area", "dt", "_new"))
        rows = with_once(rows, "_marked", F.to_json(without_keys(item, "area", "dt")))
        rows = with_once(rows, "_kept", without_null_members(F.col("_marked"), BYTE_MARK))
        rows = with_once(rows, "_own", as_written(F.col("_kept"), BYTE_MARK))
        no_object = F.col("_own").isNull()
        text = continued(F.col("_head"), F.col("_own"))
    read = F.when(no_object, "bad_item").otherwise("clean")
    return rows.select(
        F.coalesce("problem", read).alias("kind"),
        F.coalesce(text, "raw", _bad_item(item, item_type), F.lit("null")).alias("value"),
    )


def _bad_item(item: Column, item_type: str | None) -> Column:
    return F.to_json(item) if item_type else as_written(F.to_json(item), BYTE_MARK)


def rejected_records(df: DataFrame, item_type: str | None = None) -> DataFrame:
    """The rows of ``cleaned_records`` that are not clean, without writing those that are."""
    rows = explode_items(parse_messages(df, item_type))
    item = F.col("item")
    is_object = item.isNotNull() if item_type else item.try_cast("map<string,variant>").isNotNull()
    bad = rows.where(F.col("problem").isNotNull() | ~is_object)
    return bad.select(
        F.coalesce("problem", F.lit("bad_item")).alias("kind"),
        F.coalesce("raw", F.lit(None) if item_type else _bad_item(item, item_type), F.lit("null")).alias("value"),
    )
