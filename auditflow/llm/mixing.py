"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditflow.llm.common import table
from auditflow.session import stage

# Sources in order weigh these in turn.
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
# Documents whose keys share a bucket; only buckets on a budget's edge are sorted.
BUCKET = 5_000
WORD = r"[^\x20\x09-\x0D]+"


def size(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*columns: Column) -> Column:
    """A number above 0 and below 1 from the MD5 of the columns' text, the same on every run."""
    text = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sources: DataFrame, share: float = SHARE, most: float = MOST, weights=WEIGHTS) -> DataFrame:
    """``source, source_size, documents, target`` from ``source, source_size, documents``.

    Sources in the order of their code points, null last, weigh ``weights`` in turn and share
    ``share`` of all sizes. A source gets at most ``most`` times its size; what is above is shared
    out again by weight until none is above. So the sources with the least size for their weight
    are filled first, and all others get one amount per weight. There is one row per source here, so
    their order and running sums are taken in one task.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    turn = ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int")
    weighed = sources.withColumn("weight", F.element_at(cycle, turn)).withColumn(
        "full", F.col("source_size") * F.lit(float(most))
    )
    by_need = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    left = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * share).alias("all"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("full").over(before), F.lit(0.0)).alias("filled"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("gone"),
    ).withColumn("level", (F.col("all") - F.col("filled")) / (F.col("weights") - F.col("gone")))
    # The level at the first source that is not filled holds for all from there on.
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("level"))
    level = F.first(open_level, ignorenulls=True).over(by_need)
    return left.withColumn("open", level).select(
        "source",
        "source_size",
        "documents",
        F.when(F.col("open").isNull(), F.col("full")).otherwise(F.col("open") * F.col("weight")).alias("target"),
    )


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, text_hash``: what the mix needs of ``docs``, without the texts."""
    return docs.select("doc_id", "source", size(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))


def mix(
    docs: DataFrame, share: float = SHARE, most: int = MOST, weights=WEIGHTS, bucket: int = BUCKET
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` per row of ``sized`` documents.

    ``docs`` has the columns of ``sized`` and a ``quality`` above 0, the weight of the draw; null
    counts as 1, and other columns are not read.

    Whole passes over a source come first: each of its documents is taken as often as the source's
    size goes into its target. The rest goes to documents in the order of their exponential keys
    ``-ln(u) / quality`` until their sizes reach what is left; the document on that edge gives the
    words that still fit, so each source meets its target to the word. ``u`` comes from a hash of
    doc_id and size, so reruns agree; documents with equal keys follow doc_id, size and text hash,
    and rows that are equal in these are interchangeable. A null text has size 0, a null source is a
    source, a source without words has target 0, and an empty table gives an empty mix.

    Keys are dealt to buckets that rise with the key, about ``bucket`` documents each. Running sums
    go over buckets; only buckets on the edge are sorted, each by itself, so no source is sorted as
    a whole however large it is.
    """
    quality = F.coalesce(F.col("quality").cast("double"), F.lit(1.0))
    key = -F.log(uniform(F.col("doc_id"), F.col("size"))) / quality
    keyed = docs.select("doc_id", "source", "size", "text_hash", quality.alias("quality"), key.alias("key"))
    keyed = stage(keyed, "mix-keys")
    sources = keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents"), F.avg("quality").alias("mean")
    )
    means = sources.select("source", "mean")
    plan = stage(targets(sources.drop("mean"), share, most, weights), "mix-targets")
    plan = stage(plan.join(means, plan["source"].eqNullSafe(means["source"])).select(plan["*"], "mean"), "mix-plan")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("passes", passes.cast("long")).withColumn(
        "rest", (F.round("target").cast("long") - F.col("passes") * F.col("source_size"))
    )
    # Rises with the key and is about even over 0 to 1.
    rising = 1 - F.exp(-F.col("key") * F.col("mean"))
    number = F.floor(rising * F.ceil(F.col("documents") / bucket)).cast("long")
    placed = keyed.join(plan.withColumnRenamed("source", "s"), keyed["source"].eqNullSafe(F.col("s"))).select(
        keyed["*"], "source_size", "target", "passes", "rest", number.alias("bucket")
    )
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(sums.withColumn("start", F.coalesce(F.sum("bucket_size").over(running), F.lit(0))), "mix-buckets")
    starts = starts.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "start", "bucket_size")
    known = placed.join(starts, placed["source"].eqNullSafe(starts["s"]) & (placed["bucket"] == starts["b"])).drop("s", "b")
    edge = (F.col("start") < F.col("rest")) & (F.col("start") + F.col("bucket_size") > F.col("rest"))
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("key", F.col("doc_id").asc_nulls_last(), "size", F.col("text_hash"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    on_edge = known.where(edge).withColumn(
        "before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    whole = F.when(F.col("start") < F.col("rest"), F.col("size")).otherwise(0)
    columns = ["doc_id", "source", "size", "source_size", "target", "passes"]
    extra = on_edge.select(*columns, part.alias("extra")).unionByName(
        known.where(~edge).select(*columns, whole.alias("extra"))
    )
    return extra.select(
        *columns[:-1], (F.col("passes") * F.col("size") + F.col("extra")).cast("long").alias("taken")
    )


def with_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``quality``: 2 where the label is good, 1/2 where it is bad, else 1.

    Of several labels of a document the mean decides. Labels of no document have no effect.
    """
    good = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__labelled")).agg(F.avg("quality").alias("__good"))
    scale = F.when(F.col("__good") >= 0.5, 2.0).when(F.col("__good") < 0.5, 0.5).otherwise(1.0)
    joined = docs.join(good, docs["doc_id"] == good["__labelled"], "left")
    return joined.withColumn("quality", scale).drop("__labelled", "__good")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of ``docs`` with the labels' quality; see ``mix``."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    # Staged, so that texts do not ride through the join with the labels.
    return mix(with_quality(stage(sized(docs), "mix-sizes"), labels))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixed(spark, table(spark, sf_dir, "documents"), sf_dir).drop("source")


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS BIGINT) AS size
  FROM documents
), good AS (SELECT doc_id, avg(quality) AS good FROM labels GROUP BY doc_id
), keyed AS (
  SELECT s.*, -ln((CAST('0x' || substr(md5(coalesce(CAST(s.doc_id AS VARCHAR), '') || '|' || CAST(size AS VARCHAR)), 1, 12)
                   AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
    / CASE WHEN good >= 0.5 THEN 2.0::DOUBLE WHEN good < 0.5 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS key
  FROM sized s LEFT JOIN good g ON s.doc_id = g.doc_id
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source
), weighed AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS most FROM sources
), need AS (
  SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS n, sum(source_size) OVER () * 1.5::DOUBLE AS every,
    sum(weight) OVER () AS weights FROM weighed
), levels AS (
  SELECT *, (every - coalesce(sum(most) OVER f, 0)) / (weights - coalesce(sum(weight) OVER f, 0)) AS level
  FROM need WINDOW f AS (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), opened AS (SELECT min(n) AS n FROM levels WHERE level * weight <= most
), plan AS (
  SELECT l.source, l.source_size, CASE WHEN l.n < coalesce(o.n, l.n + 1) THEN l.most ELSE k.level * l.weight END AS target
  FROM levels l CROSS JOIN opened o LEFT JOIN levels k ON k.n = o.n
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM plan
), placed AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.passes, CAST(round(p.target) AS BIGINT) - p.passes * p.source_size AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN parts p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  CAST(passes * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed
"""
