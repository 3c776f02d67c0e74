"""Messages, audit events and area tables derived row by row from the given tables.

Every view is a projection with at most a lookup in the 25-row nation table, so it adds no shuffle
to the query it feeds, and no key, however frequent, is gathered into one row.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.functions.times import TIME_FORMAT
from auditflow.operators.partitioning import spread

# Snapshot versions of the area table, in months (year * 12 + month), and what each one lists.
FIRST_SNAPSHOT = 1995 * 12 + 10
EMPTY_SNAPSHOT = 1997 * 12 + 6
SECOND_SNAPSHOT = 1999 * 12 + 2

# The region left out of the first area table, and the one left out of the second.
UNLISTED_REGION = "ASIA"
DROPPED_REGION = "AMERICA"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_part(number: Column, by: int) -> Column:
    """Integer division, exact for any 64-bit number."""
    return F.call_function("div", number, F.lit(by))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "n_regionkey", "r_name"
    )


def _codes() -> Column:
    """Two codes per nation, its name and a short one; every other list has trailing commas."""
    short = F.concat(F.lit("C"), F.col("n_nationkey").cast("string"))
    tail = F.when(F.col("n_nationkey") % 2 == 1, ",,").otherwise("")
    return F.concat(F.col("n_name"), F.lit(","), short, tail)


def areas(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """``(area, codes)``; one region is missing unless ``complete``."""
    listed = _nations(spark, sf_dir)
    if not complete:
        listed = listed.where(F.col("r_name") != UNLISTED_REGION)
    return listed.select(F.col("r_name").alias("area"), _codes().alias("codes"))


def conflicting_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third nation is also listed under the next region."""
    region = table(spark, sf_dir, "region")
    also = F.when(F.col("n_nationkey") % 3 == 0, (F.col("n_regionkey") + 1) % 5)
    listed = table(spark, sf_dir, "nation").select(
        "n_nationkey", "n_name",
        F.explode(F.array_compact(F.array("n_regionkey", also))).alias("_region"),
    )
    return listed.join(region, F.col("_region") == F.col("r_regionkey")).select(
        F.col("r_name").alias("area"), _codes().alias("codes")
    )


def area_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(version, area, codes)``: two snapshots with an empty one between them."""
    versions = F.array(*(F.lit(v) for v in (FIRST_SNAPSHOT, EMPTY_SNAPSHOT, SECOND_SNAPSHOT)))
    listed = (
        ((F.col("version") == FIRST_SNAPSHOT) & (F.col("r_name") != UNLISTED_REGION))
        | ((F.col("version") == SECOND_SNAPSHOT) & (F.col("r_name") != DROPPED_REGION))
    )
    return _nations(spark, sf_dir).withColumn("version", F.explode(versions)).select(
        "version", F.when(listed, F.col("r_name")).alias("area"),
        F.when(listed, _codes()).alias("codes"),
    )


def _items(extra_keys: bool) -> Column:
    """Two items per line, one if it bears no tax, none if the quantity is 50."""
    extras = (
        [
            F.lit("stale").alias("dt"), F.lit("stale").alias("area"),
            F.struct(F.col("l_orderkey").alias("order"),
                     F.col("l_extendedprice").cast("decimal(20,4)").alias("price")).alias("line"),
        ]
        if extra_keys
        else []
    )
    goods = F.struct(F.col("l_returnflag").alias("type"), F.col("l_discount").alias("score"),
                     F.col("l_linestatus").alias("level"), *extras)
    tax = F.struct(F.lit("tax").alias("type"), F.col("l_tax").alias("score"),
                   F.col("l_linestatus").alias("level"), *extras)
    both = F.array_compact(F.array(goods, F.when(F.col("l_tax") > 0, tax)))
    return F.when(F.col("l_quantity") < 50, both).otherwise(F.slice(both, 1, 0))


# What follows the order number in a number of 60 digits and more.
LONG_TAIL = "7" * 59 + ".10"

# Setting that deals the large tables out over so many tasks, for tables of one or a few files.
PIECES = "spark.auditflow.pieces"


def big_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pieces = spark.conf.get(PIECES, None)
    return spread(table(spark, sf_dir, name), int(pieces) if pieces else None)


def messages(spark: SparkSession, sf_dir: str, extra_keys: bool = False) -> DataFrame:
    """``(batch_id, value)``: one message per order line; the batch is the month it was shipped.

    The country is that of the supplier number, by name or short code. Some part numbers give
    unusable messages: cut short, without ``data``, with an item that is no object, or two objects.
    """
    return messages_from(big_table(spark, sf_dir, "lineitem"), spark, sf_dir, extra_keys)


def _month() -> Column:
    return (F.year("l_shipdate") * 12 + F.month("l_shipdate")).cast("bigint").alias("batch_id")


def message_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``batch_id`` of every message, from the one column it depends on."""
    return table(spark, sf_dir, "lineitem").select(_month())


def messages_from(
    lines: DataFrame, spark: SparkSession, sf_dir: str, extra_keys: bool = False
) -> DataFrame:
    """``messages`` over any reading of the order lines, a streaming one too."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    located = lines.join(nation, F.col("l_suppkey") % 25 == F.col("n_nationkey"), "left")
    short = F.concat(F.lit("C"), F.col("n_nationkey").cast("string"))
    header = [
        F.date_format("l_shipdate", TIME_FORMAT).alias("dt"),
        F.when(F.col("l_linenumber") % 2 == 1, F.col("n_name")).otherwise(short)
        .alias("countryCode"),
    ]
    whole = F.to_json(F.struct(*header, _items(extra_keys).alias("data")))
    if extra_keys:
        # A number and a null that no column type writes.
        members = F.concat(F.lit('"line":{"long":1'), F.col("l_orderkey").cast("string"), F.lit(f'{LONG_TAIL},"none":null,'))
        # By pattern: its search skips ahead, that of plain replacement compares at every byte.
        whole = F.regexp_replace(whole, F.lit(r'"line":\{'), members)
    fault = F.col("l_partkey") % 200
    value = (
        F.when(fault == 0, F.substring(whole, 1, 40))
        .when(fault == 1, F.to_json(F.struct(*header)))
        .when(fault == 2, F.to_json(F.struct(*header, F.array(F.lit(1)).alias("data"))))
        .when(fault == 3, F.concat(F.to_json(F.struct(*header)), F.lit("],["), F.to_json(F.struct(*header))))
        .otherwise(whole)
    )
    return located.select(_month(), value.alias("value"))


# Late events are late by up to this many steps.
DELAY_STEPS = 40
STEP_MS = 300_000


def event_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def arrival_ms(step_ms: int = STEP_MS) -> Column:
    """Arrival time of an event: within a minute, but up to 40 steps late for every fifth one."""
    event_id = F.col("event_id")
    late = whole_part(event_id, 5) * 37 % DELAY_STEPS * step_ms
    delay = F.when(event_id % 5 == 0, late).otherwise(event_id % 60 * 1000)
    return event_ms() + delay


def audit_events(spark: SparkSession, sf_dir: str, batch_ms: int) -> DataFrame:
    """``(batch_id, value)``: one audit message per event, in arrival batches of ``batch_ms``."""
    events = big_table(spark, sf_dir, "events")
    return audit_events_from(events, spark, sf_dir, arrival_ms(), batch_ms)


def audit_batches(
    spark: SparkSession, sf_dir: str, arrival: Column, batches: int, most_delay_ms: int
) -> Iterator[DataFrame]:
    """The messages in their order of arrival, in so many batches that cover equal times.

    One row, the first and the last arrival, comes to the driver. The bounds on event time let the
    scan of a batch skip the rest of the table, however its files are cut and ordered.
    """
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min(arrival), F.max(arrival)).first()
    if first is None:
        return
    kind = events.schema["ts"].dataType
    width = (last - first) // batches + 1
    number = whole_part(arrival - F.lit(first), width)
    messages = audit_events_from(events, spark, sf_dir, number, 1, "ts")

    def moment(ms: int) -> Column:
        return F.timestamp_millis(F.lit(ms)).cast(kind)

    for n in range(batches):
        start = first + n * width
        near = F.col("ts").between(moment(start - most_delay_ms), moment(start + width))
        yield messages.where(near & (F.col("batch_id") == n)).select("value")


def audit_events_from(
    events: DataFrame, spark: SparkSession, sf_dir: str, arrival: Column, batch_ms: int, *keep: str
) -> DataFrame:
    """Audit messages over any reading of the events, with the columns to ``keep``.

    Some event numbers give rows to be set aside: broken JSON, no type, or a time that is text,
    empty, missing, or exactly the epoch.
    """
    located = _located(events, spark, sf_dir)
    event_id = F.col("event_id")
    bad_time = (
        F.when(event_id % 4 == 0, "bad").when(event_id % 4 == 1, "")
        .when(event_id % 4 == 2, "1970-01-01 00:00:00")
    )
    time = F.when(event_id % 97 == 0, bad_time).otherwise(F.date_format("ts", TIME_FORMAT))
    kind = F.when(event_id % 103 != 0, F.col("event_type"))
    value = F.when(event_id % 101 == 0, F.lit('{"dt":')).otherwise(_audit_json(time, kind))
    batch = whole_part(arrival, batch_ms)
    return located.select(batch.alias("batch_id"), value.alias("value"), *keep)


# Source partitions of the audit events, and hours for which the last of them rests at a time.
PARTITIONS = 5
REST_HOURS = 12


def source_partition() -> Column:
    """The partition an event comes by: by user, but the last one rests every other half day."""
    own = F.pmod(F.col("user_id"), F.lit(PARTITIONS))
    resting = whole_part(event_ms(), 3_600_000 * REST_HOURS) % 2 == 1
    return F.when((own == PARTITIONS - 1) & resting, 0).otherwise(own).alias("partition")


# Moves the events over a change of clocks in spring.
SPRING_DAYS = 60


def spring_audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` with the events' times some weeks later, as a clock on the wall may show them."""
    located = _located(big_table(spark, sf_dir, "events"), spark, sf_dir)
    time = F.date_format(F.col("ts") + F.expr(f"INTERVAL {SPRING_DAYS} DAYS"), TIME_FORMAT)
    return located.select(_audit_json(time, F.col("event_type")).alias("value"))


def loose_audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` with times a lenient reader accepts: unpadded, signed, long, rolled over, or with a tail."""
    located = _located(big_table(spark, sf_dir, "events"), spark, sf_dir)
    form = F.col("event_id") % 8

    def part(name: str) -> Column:
        return F.expr(f"extract({name} from ts)").cast("int")

    def joined(year: Column, month: Column, hour: Column, minute: Column) -> Column:
        date = F.concat_ws("-", *(c.cast("string") for c in (year, month, part("day"))))
        clock = F.concat_ws(":", *(c.cast("string") for c in (hour, minute, part("second"))))
        return F.concat(date, F.lit(" "), clock)

    plain = F.date_format("ts", TIME_FORMAT)
    year, month, hour, minute = part("year"), part("month"), part("hour"), part("minute")
    time = (
        F.when(form == 0, plain)
        .when(form == 1, F.concat(plain, F.lit("xyz")))
        .when(form == 2, joined(year, month, hour, minute))
        .when(form == 3, joined(year - 1, month + 12, hour, minute))
        .when(form == 4, joined(year + 100_000, month - 1_200_000, hour, minute))
        .when(form == 5, joined(year, month, hour + 1_000_000, minute - 60_000_000))
        .when(form == 6, F.concat(F.lit("-"), joined(100_000 - year, month + 1_200_000, hour, minute)))
        .otherwise(joined(year, month, F.lit(0), hour * 60 + minute))
    )
    return located.select(_audit_json(time, F.col("event_type")).alias("value"))


def _located(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the region of their user, as the area."""
    nations = _nations(spark, sf_dir).select("n_nationkey", F.col("r_name").alias("area"))
    return events.join(nations, F.col("user_id") % 25 == F.col("n_nationkey"), "left")


def _audit_json(time: Column, kind: Column) -> Column:
    user = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    return F.to_json(
        F.struct(time.alias("dt"), kind.alias("type"), user.alias("username"), F.col("area"))
    )
