"""License scans by a positional index of rare words."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import ascii_lower, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words that may be put in or left out between the key phrases of a template.
SLACK = 12


@dataclass(frozen=True)
class Template:
    """Key phrases that must all stand in a file, one after another as far apart as here.

    ``gaps`` are the words between the start of the first phrase and that of each further one.
    """

    label: str
    keys: tuple[str, ...]
    gaps: tuple[int, ...] = ()
    base: bool = False


# Labels, and words of public license texts and notices.
TEMPLATES = (
    Template("mit", ("under the mit license",), base=True),
    Template("apache-2", ("apache license version 2",), base=True),
    Template("cc-by-nc", ("cc by nc",), base=True),
    Template("agpl", ("gnu affero general public license",)),
    Template("bsd-text", ("redistribution and use in source and binary forms", "are permitted provided that"), (11,)),
    Template("cc-by-nc-4", ("cc by nc 4 0",)),
    Template("gpl", ("gnu general public license",)),
    Template("gpl-2", ("gnu general public license version 2",)),
    Template("gpl-3", ("gnu general public license version 3",)),
    Template("isc-text", ("permission to use copy modify and or distribute this software",)),
    Template("lgpl", ("gnu lesser general public license",)),
    Template("mit-text", ("permission is hereby granted free of charge", "to deal in the software without restriction"), (20,)),
    Template("mpl-2", ("mozilla public license version 2",)),
    Template("unlicense", ("free and unencumbered software released into the public domain",)),
)


def words_of(text: Column) -> Column:
    """Lower-case words; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def vocabulary(templates=TEMPLATES) -> list[str]:
    return sorted({w for t in templates for key in t.keys for w in key.split()})


def _literals(words) -> Column:
    return F.array(*(F.lit(w) for w in words)) if words else F.array().cast("array<string>")


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> tuple[dict[str, int], int]:
    """In how many documents each template word stands, and the number of documents.

    The whole table is counted; what comes to the driver is one number per template word.
    """
    found = docs.select(F.explode_outer(F.array_intersect(words_of(F.col("text")), _literals(vocabulary(templates)))).alias("word"))
    counts = dict(found.where("word is not null").groupBy("word").agg(F.count("*")).collect())
    return counts, docs.count()


def _rarest(key: list[str], counts: dict[str, int]) -> list[tuple[str, int]]:
    """The two words of highest IDF and where the phrase has them first."""
    order = sorted(set(key), key=lambda w: (counts.get(w, 0), w))
    return [(w, key.index(w)) for w in order[:2]]


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """License labels of each row of ``docs(doc_id, text)``.

    Words come from whole texts, lower-cased in A-Z. The index holds, for each key phrase, its two
    words of highest IDF in the corpus and their places. A file's places of such words give starts
    of phrases; starts that the postings agree on are kept if the whole phrase stands there, and a
    template is found where its further phrases follow within ``SLACK`` words of their place.

    ``n_words``; ``n_base``, ``first_word``, ``last_word``: places of the base phrases, null if
    none; ``base_labels``, ``labels``: distinct, sorted, joined by commas, empty if none; ``score``:
    1 with a label, else half of the largest share, by IDF, of a template's words in the file.
    Null texts have no words; rows are scanned one by one, so repeated rows and hot keys are as any
    other, and other columns are not read. An empty table gives an empty result.
    """
    counts, rows = document_frequencies(docs, templates)
    idf = {w: _idf(counts.get(w, 0), rows) for w in vocabulary(templates)}
    keys = {key: key.split() for t in templates for key in t.keys}
    anchors = sorted({w for key in keys.values() for w, _ in _rarest(key, counts)})
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    near = F.transform("words", lambda w, i: F.struct(i.alias("pos"), w.alias("word")))
    marked = words.select(
        "doc_id",
        "words",
        # Most files have no anchor and are done here.
        F.when(
            F.arrays_overlap("words", _literals(anchors)),
            F.filter(near, lambda x: F.array_contains(_literals(anchors), x["word"])),
        ).alias("hits"),
        F.array_intersect("words", _literals(vocabulary(templates))).alias("present"),
    )
    numbers = {key: f"k{i}" for i, key in enumerate(keys)}
    none = F.array().cast("array<int>")
    placed = marked.select(
        "doc_id", "words", "present",
        *(
            F.when(F.col("hits").isNull(), none).otherwise(_starts(keys[key], counts)).alias(name)
            for key, name in numbers.items()
        ),
    )
    found = {t.label: _follow(t, numbers) for t in templates}
    base = [found[t.label] for t in templates if t.base]
    shares = [
        sum((F.when(F.array_contains("present", w), F.lit(idf[w])).otherwise(0.0) for w in ws), F.lit(0.0))
        / F.lit(sum(idf[w] for w in ws))
        for ws in (sorted({w for key in t.keys for w in keys[key]}) for t in templates)
    ]
    every = F.concat(*base) if base else none
    result = placed.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        every.alias("base"),
        _labels([t for t in templates if t.base], found).alias("base_labels"),
        _labels(templates, found).alias("labels"),
        F.round(F.greatest(*shares, F.lit(0.0)) / 2, 6).alias("share"),
    )
    return result.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"),
        "base_labels",
        "labels",
        F.when(F.col("labels") != "", F.lit(1.0)).otherwise(F.col("share")).alias("score"),
    )


def _idf(count: int, rows: int) -> float:
    return log((rows + 1) / (count + 1)) + 1


def _starts(key: list[str], counts: dict[str, int]) -> Column:
    """Places where the phrase stands, from the postings of its rarest words."""

    def posting(word: str, at: int) -> Column:
        return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["pos"] - at)

    postings = [posting(*rare) for rare in _rarest(key, counts)]
    agreed = F.array_distinct(reduce(F.array_intersect, postings))
    return F.filter(
        agreed, lambda s: (s >= 0) & (F.slice(F.col("words"), s + 1, F.lit(len(key))) == _literals(key))
    )


def _follow(template: Template, numbers: dict[str, str]) -> Column:
    """Starts of a template: first phrases that all further ones follow."""

    def before(starts: Column, further: Column, gap: int) -> Column:
        return F.filter(starts, lambda s: F.exists(further, lambda f: F.abs(f - s - gap) <= SLACK))

    starts = F.col(numbers[template.keys[0]])
    for key, gap in zip(template.keys[1:], template.gaps):
        starts = before(starts, F.col(numbers[key]), gap)
    return starts


def _labels(templates, found: dict[str, Column]) -> Column:
    named = [F.when(F.size(found[t.label]) > 0, t.label) for t in sorted(templates, key=lambda t: t.label)]
    return F.concat_ws(",", *named)


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and places of license phrases in every document."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql() -> str:
    """The same rows without an index: every place of every phrase is looked at."""
    quoted = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    keys = {key: key.split() for t in TEMPLATES for key in t.keys}
    names = {key: f"k{i}" for i, key in enumerate(keys)}
    starts = ",\n  ".join(
        f"CASE WHEN contains(line, ' {k} ') THEN list_filter(range(0, len(w)), "
        f"lambda i: w[i + 1] = '{ws[0]}' AND w[i + 1:i + {len(ws)}] = {quoted(ws)}) ELSE [] END AS {names[k]}"
        for k, ws in keys.items()
    )

    def followed(t):
        out = names[t.keys[0]]
        for key, gap in zip(t.keys[1:], t.gaps):
            out = f"list_filter({out}, lambda s: len(list_filter({names[key]}, lambda f: abs(f - s - {gap}) <= {SLACK})) > 0)"
        return out

    found = lambda ts: ", ".join(
        f"CASE WHEN len({followed(t)}) > 0 THEN '{t.label}' END" for t in sorted(ts, key=lambda t: t.label)
    )
    base = [t for t in TEMPLATES if t.base]
    shares = []
    for t in TEMPLATES:
        ws = sorted({w for key in t.keys for w in keys[key]})
        idf = lambda w: f"idf['{w}']"
        shares.append(
            "(" + " + ".join(f"CASE WHEN list_contains(w, '{w}') THEN {idf(w)} ELSE 0 END" for w in ws)
            + ") / (" + " + ".join(map(idf, ws)) + ")"
        )
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{WORD}') AS w FROM documents
), vocabulary AS (SELECT unnest({quoted(vocabulary())}) AS word
), counted AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS word FROM words) GROUP BY word
), weights AS (
  SELECT map_from_entries(list((v.word, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (coalesce(n, 0) + 1)) + 1))) AS idf
  FROM vocabulary v LEFT JOIN counted c ON c.word = v.word
), placed AS (SELECT *,
  {starts}
  FROM (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS line FROM words) CROSS JOIN weights
), labelled AS (
  SELECT *, list_concat({", ".join(followed(t) for t in base)}) AS base,
    concat_ws(',', {found(base)}) AS base_labels, concat_ws(',', {found(TEMPLATES)}) AS labels FROM placed
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(base) AS BIGINT) AS n_base, list_min(base) AS first_word,
  list_max(base) AS last_word, base_labels, labels,
  CASE WHEN labels <> '' THEN 1.0::DOUBLE ELSE round(greatest({", ".join(shares)}) / 2, 6) END AS score
FROM labelled
"""


OP4_SQL = _sql()
