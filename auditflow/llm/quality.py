"""Quality rules: counts of each text, and a hashed n-gram likelihood ratio between trusted and raw text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import table
from auditflow.session import stage

# Buckets of n-grams (a prime), and the multiplier that makes one number of two words.
BUCKETS, PAIR = 16_381, 1_000_003
# Log ratios are whole millionths, so that their sums do not depend on the order.
UNIT = 1_000_000
# The least mean log ratio of a kept document, in millionths.
LEAST_RATIO = -65_000
FEWEST_WORDS, MOST_REPEATED = 50, 50
WORD, SYMBOL = r"[^\x20\x09-\x0D]+", "[#*$%&|<>]"
# Words of a window that is looked for again in the text, and the bits of a place in it.
REPEAT, PLACE_BITS = 3, 26
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _from(values: Column, place: int) -> Column:
    return F.slice(values, F.lit(place + 1), F.greatest(F.size(values) - place, F.lit(0)))


def _but_last(values: Column, n: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - n, F.lit(0)))


def buckets_of(hashes: Column) -> Column:
    """The bucket of every word, then that of every two words in a row, from the words' CRC32."""
    pairs = F.zip_with(_but_last(hashes, 1), _from(hashes, 1), lambda a, b: (a * PAIR + b) % BUCKETS)
    return F.concat(F.transform(hashes, lambda h: h % BUCKETS), pairs)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the trusted target: labelled good (by the mean of several labels) and never toxic."""
    of = labels.where("doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("q"), F.max("toxic").alias("t"))
    return of.where((F.col("q") >= 0.5) & (F.coalesce("t", F.lit(0)) == 0)).select("doc_id")


def log_ratios(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row, ``weights array<long>``: ``ln(p_target / p_raw)`` of each bucket in millionths.

    The raw multinomial counts the n-grams of all documents, the target those of documents with a
    ``trusted`` doc_id; every count has one added. Each task sums its buckets before the shuffle, so
    a frequent n-gram weighs no more than a rare one, and the row has a fixed size.
    """
    known = stage(trusted.select(F.col("doc_id").alias("__id")).distinct(), "trusted").withColumn("__trusted", F.lit(1))
    # Joined by doc_id at every size: labels grow with the documents, and a broadcast would end somewhere.
    marked = docs.select("doc_id", "text").join(known.hint("merge"), F.col("doc_id") == F.col("__id"), "left")
    hashed = marked.select(F.coalesce("__trusted", F.lit(0)).alias("trusted"), F.transform(words_of(F.col("text")), F.crc32).alias("h"))
    grams = hashed.select("trusted", F.explode(buckets_of(F.col("h"))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    none = docs.sparkSession.range(0, BUCKETS, 1, 1).select(F.col("id").alias("bucket"), F.lit(0).alias("raw"), F.lit(0).alias("target"))
    dense = counts.union(none).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    row = dense.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("buckets"),
        (F.sum("raw") + BUCKETS).alias("raw"), (F.sum("target") + BUCKETS).alias("target"),
    )
    share = lambda n, total: (n + 1).cast("double") / F.col(total)
    ratio = lambda x: F.log(share(x["target"], "target") / share(x["raw"], "raw"))
    return row.select(F.transform("buckets", lambda x: F.round(ratio(x) * UNIT).cast("long")).alias("weights"))


def _duplicate_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))
    return F.size(lines) - F.size(F.array_distinct(lines))


def _marked_windows(hashes: Column) -> Column:
    """For every window a part of its hash above its place, in order: equal windows are neighbours."""
    pairs = F.zip_with(_but_last(hashes, 2), _but_last(_from(hashes, 1), 1), lambda a, b: F.shiftleft(a, 31).bitwiseXOR(b))
    windows = F.zip_with(pairs, _from(hashes, 2), lambda a, b: F.shiftleft(F.xxhash64(a, b), PLACE_BITS))
    return F.sort_array(F.transform(windows, lambda w, i: w.bitwiseOR(i.cast("long"))))


def _neighbours(values: Column, same, part) -> Column:
    """``part`` of all values that are the ``same`` as the one before or after them."""
    both = F.zip_with(_but_last(values, 1), _from(values, 1), lambda a, b: F.when(same(a, b), F.array(part(a), part(b))))
    return F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull())))


def _suspects(windows: Column, n_words: Column) -> Column:
    """Places of windows whose part of a hash stands twice: all that repeat, and hardly any others."""
    place = lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    found = _neighbours(windows, lambda a, b: F.shiftrightunsigned(a.bitwiseXOR(b), PLACE_BITS) == 0, place)
    # Beyond this size a place does not fit beside the hash, and all windows are compared.
    return F.when(n_words < 1 << PLACE_BITS, found).otherwise(F.sequence(F.lit(0), n_words - REPEAT))


def _covered(places: Column) -> Column:
    """Words in windows that start at the sorted ``places``."""
    steps = F.zip_with(_but_last(places, 1), _from(places, 1), lambda a, b: F.least(b - a, F.lit(REPEAT)))
    return F.aggregate(steps, F.lit(0), lambda n, step: n + step) + F.when(F.size(places) > 0, REPEAT).otherwise(0)


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, the five counts (long) and ``h``, the CRC32 of each word, per row of ``docs(doc_id, text)``.

    Windows of three words that stand twice or more are found by sorting parts of their hashes; those
    that agree are compared by their words, so the counts are exact. Each select below is a step
    whose columns are made once.
    """
    words = docs.select(
        "doc_id",
        words_of(F.col("text")).alias("words"),
        F.coalesce(F.regexp_count("text", F.lit(SYMBOL)), F.lit(0)).alias("n_symbols"),
        _duplicate_lines(F.col("text")).alias("n_dup_lines"),
    )
    own = ["doc_id", "words", "n_symbols", "n_dup_lines"]
    hashed = words.select(*own, F.size("words").alias("n_words"), F.transform("words", F.crc32).alias("h"))
    own += ["n_words", "h"]
    marked = hashed.select(*own, _marked_windows(F.col("h")).alias("windows"))
    suspected = marked.select(*own, _suspects(F.col("windows"), F.col("n_words")).alias("suspects"))
    window = lambda p: F.struct(*(F.get("words", p + i) for i in range(REPEAT)))
    named = F.transform("suspects", lambda p: F.struct(window(p).alias("w"), p.alias("p")))
    named = suspected.select(*own, F.sort_array(named).alias("named"))
    repeated = F.sort_array(_neighbours(F.col("named"), lambda a, b: a["w"] == b["w"], lambda x: x["p"]))
    counted = named.select(*own, repeated.alias("places")).select(
        "doc_id", "h", "n_words", F.length(F.array_join("words", "")).alias("word_chars"), "n_symbols", "n_dup_lines",
        _covered(F.col("places")).alias("n_repeat_words"),
    )
    return counted.select("doc_id", *(F.col(c).cast("long").alias(c) for c in _COUNTS), "h")


def judged(docs: DataFrame, weights: DataFrame, least_ratio: int = LEAST_RATIO) -> DataFrame:
    """``doc_id``, the counts, ``base_failed, log_ratio, kept`` per row of ``docs(doc_id, text)``.

    ``weights`` is the row of ``log_ratios``. ``log_ratio`` is the mean over a text's n-grams, all of
    them, so its length has no say; null without words. A document is kept if it has at least
    ``FEWEST_WORDS`` words, at most ``MOST_REPEATED`` per cent of them in repeated windows, and a mean of
    at least ``least_ratio`` millionths. Null and empty texts have no words and fail. Rows are judged
    one by one, so repeated rows get equal verdicts; other columns are not read, and an empty table
    gives an empty result. A text of any length is judged whole.
    """
    told = described(docs).select("*", weights.scalar().alias("weights"))
    summed = F.aggregate(
        buckets_of(F.col("h")), F.lit(0).cast("long"), lambda total, b: total + F.element_at(F.col("weights"), (b + 1).cast("int"))
    )
    n_grams = F.greatest(F.col("n_words") * 2 - 1, F.lit(0))
    scored = told.select("doc_id", *_COUNTS, summed.alias("total"), n_grams.alias("n_grams"))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored.select(
        "doc_id", *_COUNTS, failed.alias("base_failed"),
        F.when(F.col("n_grams") > 0, F.col("total") / (F.col("n_grams") * F.lit(float(UNIT)))).alias("log_ratio"),
        (~failed & (F.col("total") >= F.col("n_grams") * least_ratio)).alias("kept"),
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the verdict of every document, with good labelled documents as the target."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = stage(log_ratios(docs, trusted_ids(table(spark, sf_dir, "labels"))), "log-ratios")
    return judged(docs, weights)


# CRC32 of a UTF-8 text: a table of all bytes from the polynomial, and a pass over the bytes.
_CRC_TABLE = (
    "(SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: "
    "CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n)))"
)


def crc32_sql(text: str, crc: str) -> str:
    """SQL for the CRC32 of ``text``, given the name of a column with the table of all bytes."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    return (
        f"xor(4294967295, list_reduce(list_transform(range(len(hex(encode({text}))) // 2), lambda i: {byte}), "
        f"lambda c, b: xor({crc}[(xor(c, b) & 255) + 1], c >> 8), 4294967295))"
    )


OP11_SQL = rf"""
WITH words AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc
), places AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
), hashes AS MATERIALIZED (SELECT word, {crc32_sql('word', 'crc')} AS h FROM (SELECT DISTINCT word FROM places), crc
), hashed AS (SELECT id, i, h FROM places JOIN hashes USING (word)
), grams AS MATERIALIZED (
  SELECT id, h % {BUCKETS} AS bucket FROM hashed
  UNION ALL
  SELECT a.id, (a.h * {PAIR} + b.h) % {BUCKETS} FROM hashed a JOIN hashed b ON a.id = b.id AND b.i = a.i + 1
), trusted AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING avg(quality) >= 0.5 AND coalesce(max(toxic), 0) = 0
), known AS (SELECT id, doc_id IN (SELECT doc_id FROM trusted) AS trusted FROM words
), counts AS (
  SELECT bucket, count(*) AS raw, count(*) FILTER (coalesce(trusted, false)) AS target FROM grams JOIN known USING (id) GROUP BY bucket
), every AS (SELECT sum(raw) + {BUCKETS} AS raw, sum(target) + {BUCKETS} AS target FROM counts
), weights AS (
  SELECT bucket, CAST(round(ln(((c.target + 1)::DOUBLE / e.target::DOUBLE) / ((c.raw + 1)::DOUBLE / e.raw::DOUBLE)) * {UNIT}) AS BIGINT) AS weight
  FROM counts c, every e
), totals AS (SELECT id, sum(weight) AS total, count(*) AS n FROM grams JOIN weights USING (bucket) GROUP BY id
), windows AS (
  SELECT id, i, array_to_string(w[i:i + 2], ' ') AS key FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), twice AS (SELECT id, i FROM windows QUALIFY count(*) OVER (PARTITION BY id, key) > 1
), repeated AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY id
), lines AS (
  SELECT id, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n
  FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM words) WHERE regexp_matches(line, '{WORD}') GROUP BY id
), counted AS (
  SELECT id, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '{SYMBOL}')) AS BIGINT) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN lines l USING (id) LEFT JOIN repeated r USING (id)
), failed AS (
  SELECT *, n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  total::DOUBLE / (n * {UNIT}.0::DOUBLE) AS log_ratio, NOT base_failed AND total >= n * {LEAST_RATIO} AS kept
FROM failed LEFT JOIN totals USING (id)
"""
