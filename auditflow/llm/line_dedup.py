"""Line dedup: an exact set-similarity join of the lines of all documents."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import table, with_columns_of
from auditflow.session import stage

SIMILARITY = 0.8
# Rarity is known per bucket of words, in steps of a third of a power of two.
BUCKETS = 1 << 18
BLANKS = " \t\n\x0b\x0c\r"
LAST = (1 << 63) - 1
_TINY = 1e-9


def _words(line: Column) -> Column:
    """The words of a line that is not blank; most lines can be split at a plain character, without a pattern."""
    several = F.lit(False)
    for blanks in ("  ", *BLANKS.strip(" ")):
        several = several | F.contains(line, F.lit(blanks))
    trimmed = F.btrim(line, F.lit(BLANKS))
    return F.when(several, F.split(trimmed, r"[\x20\x09-\x0D]+")).otherwise(F.split(trimmed, " "))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) == ""


def rarity(docs: DataFrame) -> DataFrame:
    """One row, ``ranks array<bigint>``: how frequent the words of each bucket are in the whole table.

    Words are dealt to a fixed number of buckets, so each task sends that many counts at most, and the
    row has a fixed size of eight bytes for each; a rank stands above the 55 bits that a key has of the
    hash. Any fixed order of words gives the same join; a better one only gives fewer candidates.
    """
    lines = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    words = lines.select(F.explode(_words(F.col("line"))).alias("w"))
    counts = words.groupBy(_bucket(F.xxhash64("w")).alias("b")).agg(F.count("*").alias("n"))
    none = docs.sparkSession.range(0, BUCKETS, 1, 1).select(F.col("id").cast("int").alias("b"), F.lit(0).cast("long").alias("n"))
    dense = counts.union(none).groupBy("b").agg(F.max("n").alias("n"))
    step = F.least(F.lit(127), F.floor(F.log2(F.col("n") + 1) * 3)).cast("long")
    packed = dense.select(F.struct("b", F.shiftleft(step, 55).alias("rank")).alias("s")).agg(F.array_sort(F.collect_list("s")).alias("a"))
    return packed.select(F.col("a.rank").alias("ranks"))


def _bucket(code: Column) -> Column:
    return code.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _keys(line: Column, ranks: Column) -> Column:
    """The set of a line's words as numbers that rise with frequency: a rank above 55 bits of a hash."""
    codes = F.transform(_words(line), lambda word: F.xxhash64(word))
    # Without the null that a lookup may give, Spark sorts plain numbers.
    rank = lambda code: F.coalesce(F.get(ranks, _bucket(code)), F.lit(0).cast("long"))
    keys = F.transform(codes, lambda code: rank(code).bitwiseOR(F.shiftrightunsigned(code, 9)))
    return F.sort_array(F.array_distinct(keys))


def _parity(keys: Column, part: int, parts: int) -> Column:
    """64 bits, each the parity of the words dealt to it: equal words of two lines cancel out.

    Words are dealt to ``parts`` (a power of two) such numbers, of which this is one.
    """
    own = F.filter(keys, lambda k: F.shiftright(k, 6).bitwiseAND(F.lit(parts - 1)) == part)
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(own, F.lit(0).cast("long"), lambda bits, k: bits.bitwiseXOR(bit(k)))


# Columns of parities: two for the postings of all classes, four for those of the few that are left.
TWO = ("even", "odd")
FOUR = ("bits0", "bits1", "bits2", "bits3")


def _parities(names: tuple[str, ...]) -> list[Column]:
    return [_parity(F.col("keys"), i, len(names)).alias(name) for i, name in enumerate(names)]


def _with_two_parities(lines: DataFrame) -> DataFrame:
    """``lines`` with the columns ``TWO``, as ``_parities`` gives them, without an array for each."""

    def parity(bit: Callable[[Column], Column]) -> Column:
        one = lambda k: F.call_function("shiftleft", bit(k), k.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        return F.aggregate("keys", F.lit(0).cast("long"), lambda bits, k: bits.bitwiseXOR(one(k)))

    both = parity(lambda k: F.lit(1).cast("long"))
    odd = parity(lambda k: F.shiftright(k, 6).bitwiseAND(F.lit(1).cast("long")))
    found = lines.select("*", both.alias("both"), odd.alias("odd"))
    return found.select(*lines.columns, F.col("both").bitwiseXOR(F.col("odd")).alias("even"), "odd")


def _ruled_out(names: tuple[str, ...], similarity: float) -> Column:
    """Whether the parities of ``a`` and ``b`` differ in more words than similar lines can."""
    different = [F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in names]
    return F.col("a.n") + F.col("b.n") - sum(different, F.lit(0)) < 2 * _needed(similarity)


def _described(lines: DataFrame, ranks: Column, similarity: float) -> DataFrame:
    """``lines`` with ``keys``, ``n``, the parities ``TWO`` and ``prefix`` in place of ``line``."""
    others = [c for c in lines.columns if c != "line"]
    # The ranks are one value for the whole query; the optimizer puts them straight into the lookup.
    keyed = lines.select("*", ranks.alias("ranks")).select(*others, _keys(F.col("line"), F.col("ranks")).alias("keys"))
    sized = _with_two_parities(keyed.select("*", F.size("keys").alias("n")))
    first = F.col("n") - F.ceil(F.col("n") * similarity - _TINY).cast("int") + 1
    return sized.select("*", F.slice("keys", 1, first).alias("prefix"))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``doc`` and ``tag``, which stand for a row: its doc_id and 64 bits of its text."""
    return docs.withColumn("doc", F.coalesce("doc_id", F.lit(LAST))).withColumn("tag", _tag())


def _tag() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _needed(similarity: float) -> Column:
    """Words that lines of ``a.n`` and ``b.n`` words must share."""
    return F.ceil((F.col("a.n") + F.col("b.n")) * (similarity / (1 + similarity)) - _TINY)


def _may_match(similarity: float, parities: tuple[str, ...]) -> Column:
    """The filters by length, by place in the prefix and by parity, for postings ``a`` and ``b``."""
    shorter, longer = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    behind = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    return (
        (shorter >= longer * F.lit(similarity) - _TINY)
        & (F.least("a.pos", "b.pos") + behind >= _needed(similarity))
        & ~_ruled_out(parities, similarity)
    )


def _postings(lines: DataFrame, similarity: float, parities: tuple[str, ...], *others: str) -> DataFrame:
    """A row for each prefix word of lines that can match a line with other words at all."""
    open_lines = lines.where(F.col("n") >= (F.col("n") + 1) * F.lit(similarity) - _TINY)
    return open_lines.select(*others, "n", *parities, F.posexplode("prefix").alias("pos", "word"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A staged table, made when the shuffle files of the steps before it may go.

    Spark removes them when the driver's JVM finds that nothing refers to them, by default every half
    hour; the steps here would leave several times the input on the disks until then.
    """
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return stage(df, name)


def _plausible(pairs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Pairs that the parities do not rule out; much smaller rows than those with all words."""
    sketch = known.select("doc", "place", "n", *FOUR)
    a, b = sketch.alias("a"), sketch.alias("b")
    both = pairs.alias("p").join(a, (F.col("p.doc") == F.col("a.doc")) & (F.col("p.place") == F.col("a.place")))
    both = both.join(b, (F.col("p.e_doc") == F.col("b.doc")) & (F.col("p.e_place") == F.col("b.place")))
    return both.where(~_ruled_out(FOUR, similarity)).select("p.*")


def _verified(pairs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """``doc, place`` of the later line of pairs whose words are similar enough."""
    late = known.select("doc", "place", F.col("keys").alias("late"))
    early = known.select(F.col("doc").alias("e_doc"), F.col("place").alias("e_place"), F.col("keys").alias("early"))
    both = pairs.join(late, ["doc", "place"]).join(early, ["e_doc", "e_place"])
    shared = F.size(F.array_intersect("late", "early"))
    enough = shared >= (F.size("late") + F.size("early") - shared) * F.lit(similarity) - _TINY
    return both.where(enough).select("doc", "place").distinct()


def _likeliest(entries: DataFrame) -> DataFrame:
    """For each line one earlier line: of those that come first for a prefix word, the most frequent."""
    entries = entries.select("word", "doc", "place")
    first = entries.groupBy("word").agg(F.min(F.struct("doc", "place")).alias("e"))
    both = entries.join(first, "word").where(F.col("e") < F.struct("doc", "place"))
    counted = both.groupBy("doc", "place", F.col("e.doc").alias("e_doc"), F.col("e.place").alias("e_place")).agg(
        F.count("*").alias("shared")
    )
    best = F.max(F.struct("shared", "e_doc", "e_place")).alias("best")
    return counted.groupBy("doc", "place").agg(best).select("doc", "place", "best.e_doc", "best.e_place")


def _later(postings: DataFrame, others: DataFrame, similarity: float) -> DataFrame:
    """Pairs of a line and an earlier one that share a prefix word and pass the filters.

    A pair is found for the first word of each run that the prefixes share. Postings carry the word
    before for that; with the whole prefix, to tell the first word of all, they would be twice as large.
    """
    a, b = postings.alias("a"), others.alias("b")
    earlier = F.struct("b.doc", "b.place") < F.struct("a.doc", "a.place")
    starts = F.coalesce(F.col("a.before") != F.col("b.before"), F.lit(True))
    joined = a.join(b, (F.col("a.word") == F.col("b.word")) & earlier & _may_match(similarity, FOUR) & starts)
    return joined.select("a.doc", "a.place", F.col("b.doc").alias("e_doc"), F.col("b.place").alias("e_place")).distinct()


def kept_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc, tag, kept``: the numbers of the lines with words that stay; see ``line_dedup``."""
    keyed = _keyed(docs.select("doc_id", "text").where("text is not null"))
    ranks = _stored(rarity(docs), "line-ranks").select("ranks").scalar()
    lines = keyed.select("doc", "tag", F.posexplode(F.split("text", "\n")).alias("number", "line")).where(~_blank(F.col("line")))
    place = F.struct("tag", "number")
    described = _described(lines.select("doc", place.alias("place"), "line"), ranks, similarity)
    # Lines of the same words are one class, and all but the first of a class go.
    code = [F.xxhash64("keys", F.lit(i)).alias(f"code{i}") for i in (1, 2)]
    first = F.min(F.struct("doc", "place", "n", *TWO, "prefix")).alias("f")
    coded = described.select(*code, "doc", "place", "n", *TWO, "prefix")
    classes = _stored(coded.groupBy("code1", "code2").agg(first).select("code1", "f.*"), "line-classes")
    # Which classes may have a partner at all.
    postings = _postings(classes, similarity, TWO, "code1")
    a, b = postings.alias("a"), postings.alias("b")
    partner = (F.col("a.word") == F.col("b.word")) & (F.col("a.code1") != F.col("b.code1")) & _may_match(similarity, TWO)
    likely = _stored(a.join(b, partner, "left_semi").select("code1").distinct(), "line-likely")
    asked = classes.select("code1", "doc", "place").join(likely, "code1", "left_semi")
    by_doc = asked.groupBy("doc", "place.tag").agg(F.collect_set("place.number").alias("numbers"))
    # Rows equal in doc_id and text are read once; mostly there are none.
    repeated = _stored(keyed.groupBy("doc", "tag").count().where("count > 1").select("doc", "tag"), "line-repeated")
    rows = keyed.select("doc", "tag", "text")
    once = rows.join(repeated, ["doc", "tag"], "left_anti").unionByName(
        rows.join(repeated, ["doc", "tag"], "left_semi").dropDuplicates(["doc", "tag"])
    )
    parts = once.join(by_doc, ["doc", "tag"]).select("doc", "tag", F.split("text", "\n").alias("all"), "numbers").select(
        "doc", "tag", F.explode(F.transform("numbers", lambda i: F.struct(i.alias("number"), F.get("all", i).alias("line")))).alias("l")
    ).select("doc", "tag", "l.*")
    described = _described(parts.select("doc", place.alias("place"), "line"), ranks, similarity)
    known = _stored(described.select("*", *_parities(FOUR)), "line-known")
    # First each line against its likeliest partner: this settles groups of near copies with one pair
    # per line. Then what is left against all earlier lines.
    entries = _postings(known, similarity, FOUR, "doc", "place", "prefix")
    before = F.get("prefix", F.col("pos") - 1).alias("before")
    entries = _stored(entries.select("doc", "place", "n", *FOUR, "pos", "word", before), "line-entries")
    likeliest = _stored(_plausible(_likeliest(entries), known, similarity), "line-likeliest")
    settled = _stored(_verified(likeliest, known, similarity), "line-settled")
    left = entries.join(settled, ["doc", "place"], "left_anti")
    pairs = _stored(_later(left, entries, similarity), "line-pairs")
    gone = _stored(settled.union(_verified(pairs, known, similarity)), "line-gone")
    staying = classes.select("doc", "place").join(gone, ["doc", "place"], "left_anti")
    return staying.groupBy("doc", "place.tag").agg(F.sort_array(F.collect_set("place.number")).alias("kept"))


def line_dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept`` (array of line numbers from 0) per row of ``docs``.

    Lines end at line feeds; a line is the set of its words, which ASCII white space parts. A line
    goes if an earlier line has a Jaccard similarity of at least ``similarity`` with it, whether that
    one stays or not. Earlier is a smaller doc_id, null last, and within a document a smaller line
    number. Rows that repeat a doc_id are ordered by a hash of their text; rows equal in both are
    judged as one and all keep its lines. Lines without words always stay. A null text has no lines;
    other columns are not read, and an empty table gives an empty result.

    Equal sets are one class, found with partial sums before the shuffle. Of the words of a class,
    in the order of rarity, those of the prefix are its postings; lines that share one and pass the
    filters by length, place and parity are candidates, and whole word sets are compared last.
    """
    kept = kept_lines(docs, similarity)
    numbered = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("i"), _blank(line).alias("blank")))
    lines = _keyed(docs.select("doc_id", "text")).select(
        "doc_id", "doc", "tag",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"),
        F.transform(F.filter(numbered, lambda x: x["blank"]), lambda x: x["i"]).alias("blank"),
    )
    lines = lines.withColumn("n_lines", F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")))
    none = F.array().cast("array<int>")
    joined = lines.join(kept, ["doc", "tag"], "left").withColumn(
        "kept", F.sort_array(F.concat(F.coalesce("blank", none), F.coalesce("kept", none)))
    )
    return joined.select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"), "kept",
    )


def without_repeated_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with the lines that stay, in their order; columns as in ``docs``.

    A document that loses all its lines with words goes. A null text stays null. A column ``n_chars``
    is set to the length of the new text.
    """
    kept = stage(kept_lines(docs, similarity), "lines-kept").select(
        F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), F.col("kept").alias("__kept")
    )
    keyed = docs.withColumn("__tag2", _tag())
    joined = keyed.join(
        kept, (F.coalesce(docs["doc_id"], F.lit(LAST)) == kept["__doc"]) & (keyed["__tag2"] == kept["__tag"]), "left"
    )
    lines = F.split("text", "\n")
    blank = F.filter(
        F.transform(lines, lambda line, i: F.when(_blank(line), i)), lambda i: i.isNotNull()
    )
    order = F.sort_array(F.concat(blank, F.coalesce("__kept", F.array().cast("array<int>"))))
    text = F.array_join(F.transform(order, lambda i: F.get(lines, i)), "\n")
    had_words = ~_blank(F.col("text"))
    left = joined.where(F.col("text").isNull() | ~had_words | F.col("__kept").isNotNull())
    out = left.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return with_columns_of(out, docs)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stay in each document, as a list of numbers, over the whole table."""
    found = line_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.concat_ws(",", F.col("kept").cast("array<string>")).alias("kept_lines"))


OP1_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS number
  FROM documents
), sets AS (
  SELECT doc_id, number, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS words FROM lines
), classes AS (
  SELECT words, len(words) AS n, min((doc_id, number)) AS first FROM sets WHERE len(words) > 0 GROUP BY words
), counts AS (SELECT word, count(*) AS f FROM (SELECT unnest(words) AS word FROM classes) GROUP BY word
), prefixes AS (
  SELECT first, n, word FROM (
    SELECT c.first, c.n, c.word, row_number() OVER (PARTITION BY c.first ORDER BY f, c.word) AS place
    FROM (SELECT first, n, unnest(words) AS word FROM classes) c JOIN counts USING (word)
  ) WHERE place <= n - ceil(n * {SIMILARITY} - 1e-9) + 1
), pairs AS (
  SELECT DISTINCT a.first AS late, b.first AS early FROM prefixes a JOIN prefixes b ON a.word = b.word AND b.first < a.first
), gone AS (
  SELECT DISTINCT late FROM pairs p JOIN classes a ON a.first = late JOIN classes b ON b.first = early
  WHERE len(list_intersect(a.words, b.words)) >= {SIMILARITY} * (a.n + b.n - len(list_intersect(a.words, b.words))) - 1e-9
), kept AS (
  SELECT doc_id, number FROM sets WHERE len(words) = 0
  UNION ALL SELECT first[1], first[2] FROM classes WHERE first NOT IN (SELECT late FROM gone)
), listed AS (SELECT doc_id, count(*) AS n, string_agg(CAST(number AS VARCHAR), ',' ORDER BY number) AS kept_lines FROM kept GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(string_split(text, chr(10))), 0) - coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(kept_lines, '') AS kept_lines
FROM documents d LEFT JOIN listed l ON d.doc_id = l.doc_id
"""
