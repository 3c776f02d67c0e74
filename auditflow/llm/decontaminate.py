"""Benchmark decontamination by template windows and slot consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.functions.evaluate import with_once
from auditflow.llm.common import table, with_columns_of
from auditflow.session import stage

# Template words in a window, and the share of an item's windows that makes a leak.
WINDOW, SHARE = 8, 0.5
# Words of an item in a row that make a leak whatever its share.
RUN = 13
# A word or number with the sentence mark and spaces before it.
TOKEN = r"[.!?:]?[ ]*(?:[\p{L}\p{M}]+|[0-9]+(?:[.,/][0-9]+)*)"
NAME, NUMBER, UNIT = "<name>", "<num>", "<unit>"
# Words for units of measure and money.
UNITS = (
    "mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "yard", "yards", "mile", "miles", "meter", "meters",
    "metre", "metres", "g", "kg", "mg", "gram", "grams", "lb", "lbs", "pound", "pounds", "ounce", "ounces", "ml", "l",
    "liter", "liters", "litre", "litres", "gallon", "gallons", "second", "seconds", "minute", "minutes", "hour",
    "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "cent", "cents",
    "euro", "euros", "percent", "degree", "degrees", "mph", "kmh",
)


def tokens(text: Column) -> Column:
    """Words and numbers of a text, with what tells a name from the first word of a sentence."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def bare(token: Column) -> Column:
    return F.lower(F.ltrim(token, F.lit(".!?: ")))


def _capitalised(word: Column) -> Column:
    first, second = F.substring(word, 1, 1), F.substring(word, 2, 1)
    return (first != F.lower(first)) & (second != F.upper(second))


def canonical(token: Column) -> Column:
    """The word in lower case, or the placeholder of its type.

    A name is a capitalised word inside a sentence: a space and no sentence mark stands before it.
    """
    word = bare(token)
    return (
        F.when((F.substring(token, 1, 1) == " ") & _capitalised(F.substring(token, 2, 2)), NAME)
        .when((word >= "0") & (word < ":"), NUMBER)
        .when(word.isin(*UNITS), UNIT)
        .otherwise(word)
    )


def _windows(hashes: Column, length: int) -> Column:
    """Hashes of all runs of so many template words; none if there are fewer."""
    at = F.when(F.size(hashes) >= length, F.sequence(F.lit(0), F.size(hashes) - length))
    return F.transform(at, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(length))))


def _plain(words: Column, at: Column, length: Column) -> Column:
    """Whether the window at a place has a word that is no placeholder."""
    return F.exists(F.slice(words, at + 1, length), lambda w: ~w.isin(NAME, NUMBER, UNIT))


def _items(benchmark: DataFrame, window: int) -> DataFrame:
    """``item_id, item_hash, raw, words, own, named, length, at, windows``, equal rows once.

    ``at`` are the places of the windows that count: those with a word that is no placeholder. Items
    that have none, and items shorter than a window, are searched by their ``own`` words. ``named``
    says that the first word would be a name inside a sentence.
    """
    rows = benchmark.select("item_id", F.xxhash64("text").alias("item_hash"), tokens(F.col("text")).alias("t")).distinct()
    rows = rows.where(F.size("t") > 0).select(
        "item_id", "item_hash", "t", F.transform("t", bare).alias("raw"), F.transform("t", canonical).alias("template"),
        F.least(F.size("t"), F.lit(window)).alias("length"),
    )
    rows = _replaced(rows, "template", F.col("template"))
    rows = rows.withColumn("every", F.sequence(F.lit(0), F.size("t") - F.col("length")))
    rows = with_once(rows, "plain", F.filter("every", lambda a: _plain(F.col("template"), a, F.col("length"))))
    own = (F.size("t") < window) | (F.size("plain") == 0)
    rows = rows.withColumn("own", own)
    return rows.select(
        "item_id", "item_hash", "raw", "own", "length",
        F.when(F.col("own"), F.col("raw")).otherwise(F.col("template")).alias("words"),
        (~F.col("own") & _capitalised(F.ltrim(F.get("t", F.lit(0)), F.lit(".!?: ")))).alias("named"),
        F.when(F.col("own"), F.col("every")).otherwise(F.col("plain")).alias("at"),
    ).withColumn("windows", F.size("at"))


def _slots() -> Column:
    """The distinct slots in the windows ``at`` of a reading, with the item's and the document's value.

    Numbers before different words of the item are different slots.
    """
    return F.array_distinct(F.filter(
        F.transform("words", lambda w, i: F.when(
            w.isin(NAME, NUMBER, UNIT)
            & F.exists("at", lambda a: (a <= i) & (i < a + F.col("length"))),
            F.struct(
                w.alias("kind"), F.get("raw", i).alias("item"), _beside(w, i).alias("beside"),
                F.get("here_raw", i).alias("doc"),
            ),
        )),
        lambda s: s.isNotNull(),
    ))


def _beside(word: Column, i: Column) -> Column:
    return F.when(word == NUMBER, F.coalesce(F.get("raw", i + 1), F.lit(""))).otherwise("")


def _key(slot: Column) -> Column:
    return F.struct(slot["kind"], slot["item"], slot["beside"])


def _judged(readings: DataFrame) -> DataFrame:
    """Readings with the windows ``at`` whose words are the item's own or that hold no contradicting slot."""
    keys = F.transform(_slots(), _key)
    torn = F.filter(F.array_distinct("keys"), lambda k: F.size(F.filter("keys", lambda x: x == k)) > 1)
    # What a lambda refers to is made by itself, or it would be made again for each element.
    held = with_once(with_once(readings, "keys", keys), "torn", torn)
    odd = F.transform("words", lambda w, i: F.exists("torn", lambda k: k == F.struct(w, F.get("raw", i), _beside(w, i))))
    of = lambda c, a: F.slice(c, a + 1, F.col("length"))
    fits = F.filter("at", lambda a: (of("here_raw", a) == of("raw", a)) | ~F.exists(of("odd", a), lambda x: x))
    judged = _replaced(with_once(held, "odd", odd), "at", fits)
    return judged.where(F.size("at") > 0).drop("keys", "torn", "odd")


def _replaced(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``with_once`` for a column that is there already."""
    return with_once(df, "__new", expr).drop(name).withColumnRenamed("__new", name)


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """Documents that hold benchmark items, also with other numbers, names and units.

    ``doc_id, text_hash, item_id, n_windows, item_windows, first_word, same_values`` per document and
    item. Both are turned into template words; windows of ``window`` of them are joined by hash.
    Windows of placeholders alone say nothing and do not count: a table of numbers is no leak, and
    costs no more than its words. An item shorter than a window is one window of its own words; the
    first word of a longer one may be a name in the document.

    Windows that match at one shift form a reading. A slot is a placeholder with the item's value, a
    number also with the word behind it. Where the document has two values for one slot, the windows
    with it are left out, unless their words are the item's own. A document leaks an item if the
    readings have at least ``share`` of its windows, or ``RUN`` words of the item in a row.
    ``same_values`` says that all slots have the item's own values; ``first_word`` is the first word
    of the earliest reading, from 0.

    Null and empty texts have no windows. Rows equal in doc_id and text are reported once, rows that
    repeat a doc_id with another text by themselves, and null is a doc_id like any other. An empty
    table or benchmark gives an empty result; other columns, whatever their names, are not read. Very
    long texts are cut into words once. Windows are joined, never paired within a group: a passage
    that many documents share costs a row per document and window.
    """
    docs = docs.select("doc_id", "text")
    items = stage(_items(benchmark, window), "items")
    kinds = items.groupBy("length", "own").count().collect()
    wanted = stage(_item_windows(items, window), "item-windows")
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), tokens(F.col("text")).alias("t"))
    hashed = with_once(words, "hashes", F.transform("t", lambda t: F.xxhash64(canonical(t))))
    if any(r.own for r in kinds):
        hashed = with_once(hashed, "own_hashes", F.transform("t", lambda t: F.xxhash64(bare(t))))
    # Windows of every length that some item has, in one pass over the words.
    every = [_windows(F.col("own_hashes" if own else "hashes"), length) for length, own in sorted({(r.length, r.own) for r in kinds})]
    every = [F.transform(w, lambda h, i: F.struct(i.alias("place"), h.alias("hash"))) for w in every] or [
        F.array().cast("array<struct<place: int, hash: bigint>>")
    ]
    here = hashed.select("doc_id", "text_hash", F.explode(F.flatten(F.array_compact(F.array(*every))) if len(every) > 1 else every[0]).alias("w"))
    here = here.select("doc_id", "text_hash", "w.place", "w.hash")
    found = here.join(wanted, "hash")
    # A shift is a document's and an item's alignment; its windows are at most those of the item.
    shifts = found.groupBy("doc_id", "text_hash", "item_id", "item_hash", (F.col("place") - F.col("at")).alias("shift")).agg(
        F.collect_set("at").alias("at"), F.first("windows").alias("windows")
    )
    shifts = stage(shifts, "shifts")
    least = lambda windows: F.ceil(F.col(windows) * share)
    # Windows in a row that RUN words have.
    row = max(1, RUN - window + 1)
    enough = shifts.groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(
        F.sum(F.size("at")).alias("n"), F.first("windows").alias("windows")
    ).where(F.col("n") >= F.least(least("windows"), F.lit(row))).drop("windows", "n")
    keys = ["doc_id", "text_hash", "item_id", "item_hash"]
    likely = _null_safe(shifts, enough, keys)
    lengths = items.select("item_id", "item_hash", F.size("words").alias("size"))
    parts = stage(
        _null_safe_join(likely, lengths, ["item_id", "item_hash"]).groupBy("doc_id", "text_hash").agg(
            F.collect_list(F.struct("item_id", "item_hash", "shift", "at", "windows", "size")).alias("readings")
        ),
        "readings",
    )
    texts = docs.withColumn("text_hash", F.xxhash64("text"))
    # Only the side without texts is built up in memory, and texts are not sorted.
    texts = _null_safe_join(texts, parts.hint("shuffle_hash"), ["doc_id", "text_hash"])
    cut = texts.select("doc_id", "text_hash", tokens(F.col("text")).alias("t"), "readings").select(
        "doc_id", "text_hash", F.explode(F.transform("readings", lambda r: F.struct(
            r["item_id"].alias("item_id"), r["item_hash"].alias("item_hash"), r["shift"].alias("shift"),
            r["at"].alias("at"), r["windows"].alias("windows"),
            # The document's words that stand against the item's.
            F.transform(F.sequence(F.lit(0), r["size"] - 1), lambda i: F.get(F.col("t"), r["shift"] + i)).alias("here"),
        ))).alias("r"),
    ).select("doc_id", "text_hash", "r.*")
    # The item's own words come by a join after the texts are gone, one row for each reading.
    cut = stage(cut.distinct(), "readings-cut")
    cut = _null_safe_join(
        cut, items.select("item_id", "item_hash", "raw", "words", "own", "named", "length"), ["item_id", "item_hash"]
    )
    cut = with_once(cut, "here_raw", F.transform("here", bare))
    cut = _replaced(cut, "here", F.when(F.col("own"), F.col("here_raw")).otherwise(F.transform("here", canonical)))
    # A first word that is a name in the document is read as one.
    name = F.col("named") & F.coalesce(F.get("here", F.lit(0)) == NAME, F.lit(False))
    cut = _replaced(cut, "words", F.when(name, _as_name(F.col("words"))).otherwise(F.col("words")))
    of = lambda c, a: F.slice(c, a + 1, F.col("length"))
    checked = _replaced(cut, "at", F.filter("at", lambda a: of("here", a) == of("words", a))).where(F.size("at") > 0)
    slotted = with_once(_judged(checked), "slots", _slots())
    same = F.forall("slots", lambda s: s["item"] == s["doc"])
    slotted = with_once(slotted, "quotes", F.filter("at", lambda a: of("here_raw", a) == of("raw", a)))
    quoted = F.exists("quotes", lambda a: F.forall(F.sequence(F.lit(1), F.lit(row)), lambda k: F.array_contains("quotes", a + k - 1)))
    counted = slotted.withColumn("quoted", quoted).groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("n_windows"),
        F.first("windows").alias("item_windows"),
        F.min(F.col("shift") + F.array_min("at")).alias("first_word"),
        F.bool_and(same).alias("same_values"),
        F.bool_or("quoted").alias("quoted"),
    )
    return counted.where((F.col("n_windows") >= least("item_windows")) | F.col("quoted")).select(
        "doc_id", "text_hash", "item_id",
        *(F.col(c).cast("long").alias(c) for c in ("n_windows", "item_windows", "first_word")), "same_values",
    )


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """``item_id, item_hash, windows, at, hash`` of each window that counts, with the first word also as a name."""
    codes = lambda words: F.transform(words, lambda w: F.xxhash64(w))
    # Hashed as the windows of documents are.
    whole = {n: _windows(F.col("codes"), n) for n in range(1, window + 1)}
    hashes = whole[window]
    for n in range(1, window):
        hashes = F.when(F.col("length") == n, whole[n]).otherwise(hashes)
    coded = with_once(items, "codes", codes("words")).withColumn("hashes", hashes)
    own = ["item_id", "item_hash", "windows"]
    plain = coded.select(*own, F.explode("at").alias("at"), "hashes").select(*own, "at", F.get("hashes", F.col("at")).alias("hash"))
    as_name = _as_name(F.slice("words", 1, window))
    first = items.where(F.col("named") & F.array_contains("at", 0)).select(
        *own, F.lit(0).alias("at"), F.get(_windows(codes(as_name), window), F.lit(0)).alias("hash")
    )
    return plain.unionByName(first)


def _as_name(words: Column) -> Column:
    """The words with a name for the first."""
    return F.transform(words, lambda w, i: F.when(i == 0, F.lit(NAME)).otherwise(w))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose keys are in ``right``; null equals null."""
    other = right.select(*(F.col(k).alias(f"__{k}") for k in keys))
    same = [left[k].eqNullSafe(other[f"__{k}"]) for k in keys]
    return left.join(other, same, "left_semi")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    other = right.select(*(F.col(c).alias(f"__{c}" if c in keys else c) for c in right.columns))
    return left.join(other, [left[k].eqNullSafe(other[f"__{k}"]) for k in keys]).drop(*(f"__{k}" for k in keys))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """``docs`` without those that leak an item; columns as in ``docs``."""
    found = stage(leaks(docs, benchmark, window, share).select("doc_id", "text_hash").distinct(), "leaks")
    found = found.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"))
    same = docs["doc_id"].eqNullSafe(found["__doc"]) & (F.xxhash64(docs["text"]) == found["__text"])
    return with_columns_of(docs.join(found, same, "left_anti"), docs)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that leaks a benchmark item, with the item and how much of it."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def _canonical_sql(t: str) -> str:
    word = f"lower(ltrim({t}, '.!?: '))"
    units = ", ".join(f"'{u}'" for u in UNITS)
    return (
        f"CASE WHEN substr({t}, 1, 1) = ' ' AND substr({t}, 2, 1) <> lower(substr({t}, 2, 1)) "
        f"AND substr({t}, 3, 1) <> upper(substr({t}, 3, 1)) THEN '{NAME}' "
        f"WHEN {word} >= '0' AND {word} < ':' THEN '{NUMBER}' WHEN {word} IN ({units}) THEN '{UNIT}' ELSE {word} END"
    )


_KINDS = f"('{NAME}', '{NUMBER}', '{UNIT}')"

OP10_SQL = rf"""
WITH d AS (
  SELECT DISTINCT doc_id, text, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS t FROM documents
), i AS (
  SELECT DISTINCT item_id, text, regexp_extract_all(coalesce(text, ''), '{TOKEN}') AS t FROM benchmark WHERE len(t) > 0
), dw AS (
  SELECT doc_id, text, list_transform(t, lambda x: {_canonical_sql('x')}) AS w,
    list_transform(t, lambda x: lower(ltrim(x, '.!?: '))) AS raw FROM d
), iw AS (
  SELECT item_id, text, list_transform(t, lambda x: {_canonical_sql('x')}) AS template, ltrim(t[1], '.!?: ') AS start,
    list_transform(t, lambda x: lower(ltrim(x, '.!?: '))) AS raw, least(len(t), {WINDOW}) AS length FROM i
), told AS (
  SELECT *, len(raw) < {WINDOW} OR len(list_filter(range(0, len(raw) - length + 1),
    lambda a: len(list_filter(template[a + 1:a + length], lambda x: x NOT IN {_KINDS})) > 0)) = 0 AS own FROM iw
), items AS (
  SELECT item_id, text, raw, length, own, CASE WHEN own THEN raw ELSE template END AS w,
    NOT own AND substr(start, 1, 1) <> lower(substr(start, 1, 1)) AND substr(start, 2, 1) <> upper(substr(start, 2, 1)) AS named,
    list_filter(range(0, len(raw) - length + 1),
      lambda a: own OR len(list_filter(template[a + 1:a + length], lambda x: x NOT IN {_KINDS})) > 0) AS places
  FROM told
), forms AS (
  SELECT item_id, text, raw, length, own, w, false AS as_name, places FROM items
  UNION ALL SELECT item_id, text, raw, length, own, list_concat(['{NAME}'], w[2:]), true, places FROM items WHERE named
), item_windows AS (
  SELECT item_id, text AS item_text, raw, length, own, as_name, w, len(places) AS windows, a AS item_at,
    array_to_string(w[a + 1:a + length], ' ') AS key
  FROM (SELECT *, unnest(places) AS a FROM forms)
), doc_windows AS (
  SELECT doc_id, text, raw, w, length, own, p AS place,
    array_to_string(CASE WHEN own THEN raw[p + 1:p + length] ELSE w[p + 1:p + length] END, ' ') AS key
  FROM (SELECT dw.*, l.length, l.own, unnest(range(0, greatest(0, len(w) - l.length + 1))) AS p
        FROM dw CROSS JOIN (SELECT DISTINCT length, own FROM items) l)
), matches AS (
  SELECT dense_rank() OVER (ORDER BY d.doc_id, d.text, i.item_id, i.item_text, place - item_at) AS reading,
    d.doc_id, d.text, i.item_id, i.item_text, place - item_at AS shift, item_at, place, i.length, windows, i.w, i.raw AS item_raw,
    d.raw AS doc_raw, i.raw[item_at + 1:item_at + i.length] = d.raw[place + 1:place + i.length] AS exact
  FROM doc_windows d JOIN item_windows i ON d.key = i.key AND d.length = i.length AND d.own = i.own
  -- An item is read with a name for its first word just where the document has one.
  WHERE as_name = (place >= item_at AND coalesce(d.w[place - item_at + 1], '') = '{NAME}'
    AND EXISTS (FROM items n WHERE n.named AND n.item_id IS NOT DISTINCT FROM i.item_id AND n.text = i.item_text))
), slots AS (
  SELECT reading, item_at, w[item_at + k] AS kind, item_raw[item_at + k] AS item_value, doc_raw[place + k] AS doc_value,
    CASE WHEN w[item_at + k] = '{NUMBER}' THEN coalesce(item_raw[item_at + k + 1], '') ELSE '' END AS beside
  FROM (SELECT *, unnest(range(1, length + 1)) AS k FROM matches) WHERE w[item_at + k] IN {_KINDS}
), torn AS (
  SELECT reading, kind, item_value, beside FROM slots GROUP BY ALL HAVING count(DISTINCT doc_value) > 1
), odd AS (
  SELECT DISTINCT s.reading, s.item_at FROM slots s JOIN torn t
    ON s.reading = t.reading AND s.kind = t.kind AND s.item_value = t.item_value AND s.beside = t.beside
), fits AS (
  SELECT m.* FROM matches m LEFT JOIN odd o ON m.reading = o.reading AND m.item_at = o.item_at WHERE exact OR o.reading IS NULL
), same AS (
  SELECT f.reading, coalesce(bool_and(item_value = doc_value), true) AS same
  FROM fits f LEFT JOIN slots s ON f.reading = s.reading AND f.item_at = s.item_at GROUP BY f.reading
), quoted AS (
  SELECT DISTINCT reading FROM (
    SELECT reading, item_at - row_number() OVER (PARTITION BY reading ORDER BY item_at) AS island FROM fits WHERE exact
  ) GROUP BY reading, island HAVING count(*) >= {max(1, RUN - WINDOW + 1)}
), counted AS (
  SELECT f.doc_id, f.text, f.item_id, f.item_text, count(DISTINCT item_at) AS n_windows, max(windows) AS item_windows,
    min(place) AS first_word, bool_and(s.same) AS same_values, bool_or(q.reading IS NOT NULL) AS quoted
  FROM fits f JOIN same s ON f.reading = s.reading LEFT JOIN quoted q ON f.reading = q.reading
  GROUP BY f.doc_id, f.text, f.item_id, f.item_text
)
SELECT doc_id, item_id, n_windows, item_windows, first_word, same_values
FROM counted WHERE quoted OR n_windows >= ceil(item_windows * {SHARE}::DOUBLE)
"""
