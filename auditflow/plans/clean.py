"""Batch queries of the cleaning pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.operators.cleaning import (
    cleaned_records,
    enrich,
    explode_items,
    parse_messages,
    rejected_records,
)
from auditflow.operators.dimension import invert_areas, lookup_asof
from auditflow.sources import tables

# Declared items read only these keys; without a declared type, items keep every key.
SCORED_ITEM = "struct<type string, score double, level string>"

# How the checks read a cleaned record back into columns.
RECORD = "type string, score double, level string, area string, dt string"
RECORD_WITH_LINE = RECORD + ", line struct<order bigint, price decimal(20,4)>"


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_messages(tables.messages(spark, sf_dir), SCORED_ITEM)
    return parsed.where("problem is null")


def _item_columns() -> list[Column]:
    return [F.col("item.type"), F.col("item.score"), F.col("item.level")]


def dim_invert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invert_areas(tables.areas(spark, sf_dir)).select("countryCode", "area")


def dim_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return invert_areas(tables.conflicting_areas(spark, sf_dir)).select("countryCode", "area")


def dim_snapshot_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup_asof(
        _parsed(spark, sf_dir), tables.area_snapshots(spark, sf_dir),
        batches=tables.message_batches(spark, sf_dir),
    )
    return found.select("batch_id", "dt", "countryCode", "version", "area")


def clean_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("dt", "countryCode", F.size("items").alias("n_items"))


def clean_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = rejected_records(tables.messages(spark, sf_dir))
    return records.select(F.col("kind").alias("reason"), "value")


def clean_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_items(_parsed(spark, sf_dir)).select("dt", "countryCode", *_item_columns())


def _enriched(spark: SparkSession, sf_dir: str, complete: bool, on_missing: str) -> DataFrame:
    codes = invert_areas(tables.areas(spark, sf_dir, complete=complete))
    items = explode_items(enrich(_parsed(spark, sf_dir), codes, on_missing))
    return items.select(*_item_columns(), "area", "dt")


def clean_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, complete=False, on_missing="null")


def clean_enrich_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, complete=True, on_missing="fail")


def read_records(records: DataFrame, schema: str) -> DataFrame:
    return records.select(F.from_json("value", schema).alias("r")).select("r.*")


def clean_json_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = invert_areas(tables.areas(spark, sf_dir))
    records = cleaned_records(tables.messages(spark, sf_dir), codes, item_type=SCORED_ITEM)
    return read_records(records.where("kind = 'clean'"), RECORD)


def clean_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = invert_areas(tables.areas(spark, sf_dir))
    records = cleaned_records(tables.messages(spark, sf_dir, extra_keys=True), codes)
    clean = records.where("kind = 'clean'")
    # The number's text, before any reader makes something of it.
    long = F.regexp_extract("value", '"long":([^,}]*)', 1).alias("line_long")
    read = clean.select(long, F.from_json("value", RECORD_WITH_LINE).alias("r"), F.contains("value", F.lit("null")).alias("nulls"))
    return read.select(
        "r.type", "r.score", "r.level", "r.area", "r.dt",
        F.col("r.line.order").alias("line_order"),
        F.col("r.line.price").cast("string").alias("line_price"),
        "line_long", "nulls",
    )


QUERIES = {
    f.__name__: f
    for f in (
        dim_invert, dim_conflict, dim_snapshot_asof, clean_parse, clean_quarantine,
        clean_explode, clean_enrich_left, clean_enrich_strict, clean_json_out, clean_passthrough,
    )
}

_NATION = "nation JOIN region ON n_regionkey = r_regionkey"

_CODES = f"""
code_area AS (
  SELECT n_name AS code, r_name FROM {_NATION}
  UNION ALL
  SELECT 'C' || n_nationkey, r_name FROM {_NATION}
)"""

MESSAGES_SQL = f"""
msg AS (
  SELECT l.*, r_name,
         year(l_shipdate) * 12 + month(l_shipdate) AS batch_id,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS dt,
         CASE WHEN l_linenumber % 2 = 1 THEN n_name ELSE 'C' || n_nationkey END AS code,
         CASE l_partkey % 200 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no_data'
                              WHEN 2 THEN 'bad_item' WHEN 3 THEN 'malformed' END AS problem
  FROM lineitem l LEFT JOIN ({_NATION}) ON l_suppkey % 25 = n_nationkey
),
item AS (
  SELECT dt, code, r_name, l_returnflag AS type, l_discount AS score, l_linestatus AS level,
         l_orderkey, l_extendedprice
  FROM msg WHERE problem IS NULL AND l_quantity < 50
  UNION ALL
  SELECT dt, code, r_name, 'tax', l_tax, l_linestatus, l_orderkey, l_extendedprice
  FROM msg WHERE problem IS NULL AND l_quantity < 50 AND l_tax > 0
)"""

_LISTED_AREA = f"CASE WHEN r_name <> '{tables.UNLISTED_REGION}' THEN r_name END AS area"

_RECORDS = f"WITH {MESSAGES_SQL} SELECT type, score, level, {_LISTED_AREA}, dt FROM item"

ORACLE = {
    "dim_invert": f"""
WITH {_CODES}
SELECT code AS "countryCode", r_name AS area FROM code_area
WHERE r_name <> '{tables.UNLISTED_REGION}'""",
    "dim_conflict": """
WITH listed AS (
  SELECT n_nationkey, n_name, n_regionkey AS k FROM nation
  UNION ALL
  SELECT n_nationkey, n_name, (n_regionkey + 1) % 5 FROM nation WHERE n_nationkey % 3 = 0
), code_area AS (
  SELECT n_name AS code, r_name FROM listed JOIN region ON k = r_regionkey
  UNION ALL
  SELECT 'C' || n_nationkey, r_name FROM listed JOIN region ON k = r_regionkey
)
SELECT code AS "countryCode", min(r_name) AS area FROM code_area GROUP BY code""",
    "dim_snapshot_asof": f"""
WITH {_CODES}, {MESSAGES_SQL},
snapshot AS (
  SELECT {tables.FIRST_SNAPSHOT} AS version, code, r_name FROM code_area
  WHERE r_name <> '{tables.UNLISTED_REGION}'
  UNION ALL
  SELECT {tables.SECOND_SNAPSHOT}, code, r_name FROM code_area
  WHERE r_name <> '{tables.DROPPED_REGION}'
),
in_force AS (
  SELECT b.batch_id, max(s.version) AS version
  FROM (SELECT DISTINCT batch_id FROM msg) b
  LEFT JOIN (SELECT DISTINCT version FROM snapshot) s ON s.version <= b.batch_id
  GROUP BY b.batch_id
)
SELECT msg.batch_id, msg.dt, msg.code AS "countryCode", CAST(f.version AS BIGINT) AS version,
       s.r_name AS area
FROM msg JOIN in_force f ON msg.batch_id = f.batch_id
LEFT JOIN snapshot s ON s.version = f.version AND s.code = msg.code
WHERE problem IS NULL""",
    "clean_parse": f"""
WITH {MESSAGES_SQL}
SELECT dt, code AS "countryCode",
       CASE WHEN l_quantity >= 50 THEN 0 WHEN l_tax > 0 THEN 2 ELSE 1 END AS n_items
FROM msg WHERE problem IS NULL""",
    "clean_quarantine": f"""
WITH {MESSAGES_SQL}
SELECT problem AS reason,
       CASE l_partkey % 200 WHEN 0 THEN '{{"dt":"' || dt || '","countryCode'
                            WHEN 1 THEN header WHEN 2 THEN '1' ELSE header || '],[' || header END AS value
FROM (SELECT *, '{{"dt":"' || dt || '","countryCode":"' || code || '"}}' AS header FROM msg)
WHERE problem IS NOT NULL""",
    "clean_explode": f"""
WITH {MESSAGES_SQL} SELECT dt, code AS "countryCode", type, score, level FROM item""",
    "clean_enrich_left": _RECORDS,
    "clean_enrich_strict": f"""
WITH {MESSAGES_SQL} SELECT type, score, level, r_name AS area, dt FROM item""",
    "clean_json_out": _RECORDS,
    "clean_passthrough": f"""
WITH {MESSAGES_SQL}
SELECT type, score, level, {_LISTED_AREA}, dt, l_orderkey AS line_order,
       CAST(CAST(l_extendedprice AS DECIMAL(20,4)) AS VARCHAR) AS line_price,
       '1' || l_orderkey || '{tables.LONG_TAIL}' AS line_long, false AS nulls
FROM item""",
}
