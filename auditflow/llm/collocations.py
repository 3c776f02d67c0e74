"""Phrase collocation mining: an FM-index per shard, counts summed across shards."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditflow.llm.common import table
from auditflow.llm.factors import mix, word_hashes
from auditflow.llm.fm_index import FMIndex
from auditflow.session import stage

LONGEST, LEAST, SHARE, TOP = 3, 10, 50, 2000
UNKNOWN = "und"
# Words of an index, and bytes of text whose phrases are summed in one block; neither has to hold.
SHARD_WORDS = 1 << 19
BLOCK_BYTES = 16 << 20
# Blocks a shard is dealt to at once; beyond, blocks are dealt out a second time.
FAN = 4096
# Parts of a block that are summed one after another, and rows that wait to be summed.
SLICES, PENDING = 4, 500_000
_PARTS = "block long, phrases binary, sizes binary, numbers binary"
_SUMS = "lang string, phrase string, a long, left long, right long"
# What ends a piece, and the mark that stands for it, which is no word.
ENDS, MARK = b".,;:!?\n\x0b\x0c\r", b"."
_TABLE = bytes(10 if b in ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_PACK = zstandard.ZstdCompressor(level=3)


def tokens(text: bytes) -> list[bytes]:
    """Lower-case words of a text in UTF-8, with ``MARK`` where a piece ends and at the end."""
    return text.translate(_TABLE).replace(b"\n", b" . ").split() + [MARK]


def shard_phrases(lang: bytes, words: list[bytes], longest: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(key, hash, numbers) of every n-gram of one language in a shard.

    A key is the language, a line feed (no phrase holds one) and the phrase. The empty phrase counts
    all words. ``numbers`` has three columns: occurrences, and those with a word before and after.
    """
    encoded = pa.array([MARK, *words], pa.binary()).dictionary_encode()
    del words
    ids = encoded.indices.to_numpy()
    known = encoded.dictionary
    hashes = word_hashes(known.to_pylist())
    keys, marks, numbers = [], [], []

    def add(phrases: pa.Array, mark: np.ndarray, *columns: np.ndarray) -> None:
        prefix = pa.scalar(lang, pa.binary())
        keys.append(pc.binary_join_element_wise(prefix, phrases, pa.scalar(b"\n", pa.binary())))
        marks.append(mix(mark + np.uint64(0x9E3779B97F4A7C15)))
        numbers.append(np.column_stack(columns))

    all_words = np.array([np.count_nonzero(ids)])
    with np.errstate(over="ignore"):
        seed = word_hashes([lang])[0]
        add(pa.array([b""], pa.binary()), np.array([seed]), all_words, all_words * 0, all_words * 0)
        for ngrams in FMIndex(ids, longest).enumerate():
            columns = ngrams.words.T
            phrases = pc.binary_join_element_wise(*(known.take(pa.array(c)) for c in columns), pa.scalar(b" ", pa.binary()))
            mark = np.full(len(ngrams.words), seed)
            for c in columns:
                mark = mix(mark ^ hashes[c])
            add(phrases, mark, ngrams.count, ngrams.left, ngrams.right)
    return pa.concat_arrays(keys), np.concatenate(marks), np.concatenate(numbers)


def _packed(keys: pa.Array, marks: np.ndarray, numbers: np.ndarray, block: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per block: its phrases, their lengths, and numbers after the sizes of its slices."""
    place = block * SLICES + (marks >> np.uint64(48)).astype(np.int64) % SLICES
    order = np.argsort(place, kind="stable")
    keys, numbers, place = keys.take(pa.array(order)), numbers[order], place[order]
    block = place // SLICES
    offsets = np.frombuffer(keys.buffers()[1], dtype="<i4")[keys.offset:keys.offset + len(keys) + 1]
    data = memoryview(keys.buffers()[2] or b"")
    starts = np.flatnonzero(np.append(True, np.diff(block) != 0)[:len(block)])
    rows, weight = [], 0
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["block", "phrases", "sizes", "numbers"]
    for a, b in zip(starts, np.append(starts[1:], len(block))):
        sizes = np.diff(offsets[a:b + 1]).astype("<i4")
        slices = np.bincount(place[a:b] % SLICES, minlength=SLICES)
        told = np.concatenate([slices, numbers[a:b].T.ravel()]).astype("<i8")
        rows.append((block[a], *map(_PACK.compress, (data[offsets[a]:offsets[b]], sizes.tobytes(), told.tobytes()))))
        weight += len(rows[-1][1])
        if weight >= 1 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)
            rows, weight = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def _unpacked(part: tuple[bytes, bytes, bytes], unpack: zstandard.ZstdDecompressor, number: int | None = None) -> pa.Table:
    """The phrases of a row, or those of one slice of it, in memory of their own."""
    data, sizes, numbers = (unpack.decompress(p) for p in part)
    sizes, numbers = np.frombuffer(sizes, "<i4"), np.frombuffer(numbers, "<i8")
    slices, columns = numbers[:SLICES], numbers[SLICES:].reshape(3, len(sizes))
    a, b = (0, len(sizes)) if number is None else (int(slices[:number].sum()), int(slices[:number + 1].sum()))
    offsets = np.append(0, np.cumsum(sizes))
    own = data[offsets[a]:offsets[b]]
    starts = (offsets[a:b + 1] - offsets[a]).astype("<i4").tobytes()
    key = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(starts), pa.py_buffer(own)])
    return pa.table([key, *(pa.array(c[a:b].copy()) for c in columns)], names=["key", "a", "left", "right"])


def _index(longest: int, blocks: int, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                keys, marks, numbers = shard_phrases(lang, held.pop(lang), longest)
                yield from _packed(keys, marks, numbers, (marks % np.uint64(blocks)).astype(np.int64))

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                words = tokens(text.as_buffer().to_pybytes() if text.is_valid else b"")
                held.setdefault(lang.as_py(), []).extend(words)
                size += len(words)
                if size >= shard_words:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def _sum(parts: list[pa.Table]) -> pa.Table:
    summed = pa.concat_tables(parts).group_by("key").aggregate([(c, "sum") for c in ("a", "left", "right")])
    return summed.rename_columns(["key", "a", "left", "right"]).combine_chunks()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _dealt_again(blocks: int):
    """Rows of blocks of blocks, summed as far as memory allows, as rows of ``blocks`` finer ones each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for block, rows in groupby(_rows(batches), key=lambda r: r[0]):
            parts: list[pa.Table] = []

            def flush(parts=parts, block=block) -> Iterator[pa.RecordBatch]:
                if parts:
                    table = _sum(parts)
                    parts.clear()
                    key = table["key"].combine_chunks()
                    marks = word_hashes(key.to_pylist())
                    numbers = np.column_stack([table[c].to_numpy() for c in ("a", "left", "right")])
                    yield from _packed(key, marks, numbers, block * blocks + (marks % np.uint64(blocks)).astype(np.int64))

            held = 0
            for _, *part in rows:
                parts.append(_unpacked(part, unpack))
                held += parts[-1].num_rows
                if held >= PENDING:
                    yield from flush()
                    held = 0
            yield from flush()

    return run


def _summed(least: int):
    """Sums of each block from its rows, which come one after another."""

    def finished(table: pa.Table) -> Iterator[pa.RecordBatch]:
        ends = pc.equal(pc.binary_slice(table["key"], -1), pa.scalar(b"\n", pa.binary()))
        table = table.filter(pc.or_(pc.greater_equal(table["a"], least), ends))
        langs, phrases = [], []
        for key in table["key"].to_pylist():
            lang, _, phrase = key.rpartition(b"\n")
            langs.append(lang.decode("utf-8"))
            phrases.append(phrase.decode("utf-8"))
        arrays = [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), *(table[c].combine_chunks() for c in ("a", "left", "right"))]
        yield from pa.Table.from_arrays(arrays, names=["lang", "phrase", "a", "left", "right"]).to_batches(max_chunksize=50_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for _, rows in groupby(_rows(batches), key=lambda r: r[0]):
            packed = [row[1:] for row in rows]
            for number in range(SLICES):
                parts, held, distinct = [], 0, 0
                for part in packed:
                    parts.append(_unpacked(part, unpack, number))
                    held += parts[-1].num_rows
                    if held >= max(PENDING, 2 * distinct):
                        parts = [_sum(parts)]
                        held = distinct = parts[0].num_rows
                yield from finished(_sum(parts))

    return run


def phrases(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
    fan: int = FAN,
) -> DataFrame:
    """``lang, phrase, a, left, right`` of every phrase of up to ``longest`` words that stands ``least`` times.

    ``a`` counts all occurrences, overlaps included; ``left`` and ``right`` those with a word of the
    same piece before and after. The empty phrase of each language has the number of its words,
    whatever ``least`` is.

    Each task cuts its texts into shards of about ``shard_words`` words, makes an FM-index per shard
    and language and enumerates every n-gram in it. A phrase has one row per shard that holds it, and
    its hash names the block in which these are summed, so a phrase or language with most of the rows
    weighs no more than any other. Parts of a block travel packed; blocks are as many as the bytes of
    text ask for, and a task sums one after another, slice by slice. Beyond ``FAN`` blocks a shard would
    be cut too finely, and phrases are dealt out twice. Keys are the phrases themselves.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).cast("binary")
    texts = docs.select(lang.alias("lang"), F.col("text").cast("binary").alias("text"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, ceil(total / block_bytes))
    parts = texts.mapInArrow(_index(longest, min(blocks, fan), shard_words), _PARTS)
    met = lambda parts: parts.repartition(F.col("block")).sortWithinPartitions("block")
    if blocks > fan:
        parts = met(parts).mapInArrow(_dealt_again(ceil(blocks / fan)), _PARTS)
    return met(parts).mapInArrow(_summed(least), _SUMS)


def score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))`` by exact arithmetic; counts have up to 15 digits."""
    wide = lambda c: c.cast("decimal(15,0)")
    above = F.lit(1_000_000).cast("decimal(7,0)") * wide(a) * wide(a)
    return F.call_function("div", above, wide(left) * wide(right)).cast("long")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP, **sizes: int
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, left, right``: the first ``top`` phrases of each language.

    Texts are lower-cased in A-Z and cut at ``.,;:!?`` and line ends into pieces, these at spaces and
    tabs into words. Candidates are phrases of 2 to ``longest`` words that stand ``least`` times; the
    score is that of their weakest cut into two parts of ``l`` and ``r`` occurrences, the leftmost if
    several are. Candidates inside a longer one that has ``share`` per cent of their count are left
    out. The order is by score, count and phrase (by its bytes), so there are no ties. ``n`` counts
    all words of the language, ``left`` and ``right`` are as in ``phrases``.

    Null and empty texts have no words, a null language is ``und``, very long texts make a shard of
    their own, repeated rows count as often as they stand there, and other columns are not read. An
    empty table gives an empty result. ``sizes`` are passed on to ``phrases``.
    """
    found = stage(phrases(docs, longest, least, **sizes), "phrases")
    words = found.where("phrase = ''").select("lang", F.col("a").alias("n"))
    count = found.where("phrase <> ''").select("lang", "phrase", "a")
    candidates = found.where(F.contains("phrase", F.lit(" ")))
    cut = candidates.select("lang", "phrase", "a", F.split("phrase", " ").alias("w")).select(
        "lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")
    )
    joined = lambda w, at, n: F.array_join(F.slice(w, at, n), " ")
    cut = cut.select(
        "lang", "phrase", "a", "k",
        joined("w", F.lit(1), F.col("k")).alias("head"), joined("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("tail"),
    )
    cut = cut.join(count.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cut = cut.join(count.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    weakest = cut.groupBy("lang", "phrase").agg(
        F.min(F.struct(score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("x")
    ).select("lang", "phrase", "x.score", "x.l", "x.r")
    inner = F.expr(
        "flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), "
        "i -> array_join(slice(w, i, m), ' '))))"
    )
    held = candidates.select("lang", "a", F.split("phrase", " ").alias("w")).where(F.size("w") > 2)
    held = held.select("lang", F.col("a").alias("most"), F.explode(inner).alias("phrase"))
    held = held.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    kept = candidates.join(held, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))
    )
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.drop("most").join(weakest, ["lang", "phrase"]).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= top).join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "left", "right"
    )


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of every language in the whole table."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), places AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM (SELECT *, unnest([1, 2, 3]) AS k FROM words) WHERE len(w) >= k
), counted AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a,
    count(*) FILTER (i > 1) AS "left", count(*) FILTER (i + k - 1 < len(w)) AS "right"
  FROM places GROUP BY ALL
), candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND a >= 10
), parts AS (
  SELECT lang, phrase, a, m, array_to_string(w[1:m], ' ') AS head, array_to_string(w[m + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS m FROM candidates)
), cuts AS (
  SELECT p.lang, p.phrase, p.a, p.m, h.a AS l, t.a AS r, CAST(1000000::HUGEINT * p.a * p.a // (h.a::HUGEINT * t.a) AS BIGINT) AS score
  FROM parts p JOIN counted h ON h.lang = p.lang AND h.phrase = p.head JOIN counted t ON t.lang = p.lang AND t.phrase = p.tail
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, m) = 1
), longer AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE k = 3
), most AS (SELECT lang, phrase, max(a) AS most FROM longer GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN most m ON c.lang = m.lang AND c.phrase = m.phrase
  WHERE most IS NULL OR 100 * most < 50 * a
), ranked AS (
  SELECT k.*, s.l, s.r, s.score, row_number() OVER (PARTITION BY k.lang ORDER BY s.score DESC, k.a DESC, encode(k.phrase)) AS rank
  FROM kept k JOIN weakest s ON k.lang = s.lang AND k.phrase = s.phrase
)
SELECT r.lang, rank, phrase, a, l, r, n, score, "left", "right" FROM ranked r JOIN totals t ON r.lang = t.lang WHERE rank <= 2000
"""
