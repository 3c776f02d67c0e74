"""Substring dedup: relative Lempel-Ziv parsing of documents against all earlier ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from auditflow.llm.common import table
from auditflow.llm.factors import (
    CHUNK, SEED_WORDS, chunks, first_of, joined_runs, pair_key, runs_hash, windows, word_hashes,
)
from auditflow.session import stage

WINDOW = 13
LAST = (1 << 63) - 1
# ``row`` tells rows of one doc_id apart by a hash of the text; ``place`` is the number of a word.
# ``start`` holds the seed in its upper and the place in its lower 32 bits.
_INDEX = "start long, doc long, row long, marks binary"
SEED_BITS = np.uint64(32)
SEED = np.uint64(0xFFFFFFFF)
# Seeds that hold this share of all entries are dealt out by window; at most so many are there.
HOT_SHARE = 4096
# Of this many windows of a batch, one share of them makes a seed worth counting.
BATCH_SHARE = 256
_FACTORS = "doc long, row long, place long, n long, ref long, ref_place long"


def _binary(data: bytes, offsets: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(data)]
    )


def _entries(
    doc: np.ndarray, row: np.ndarray, place: np.ndarray, seed: np.ndarray, mark: np.ndarray
) -> list[pa.RecordBatch]:
    """Index entries for windows given by document, then place.

    Windows that a smaller document of the same batch has are factors already and are passed on as
    such; so of a window that many documents share, a batch sends one document's.
    """
    first = first_of(seed, mark)
    known = doc[first] < doc
    out = []
    asked = np.flatnonzero(~known)
    if len(asked):
        starts, lengths = joined_runs(doc[asked], place[asked], seed[asked], row[asked], rising=(1,))
        at = asked[starts]
        offsets = np.append(0, np.cumsum(lengths * mark.itemsize))
        out.append(_batch(seed[at], place[at], doc[at], row[at], _binary(mark[asked].tobytes(), offsets)))
    if len(told := np.flatnonzero(known)):
        ref, ref_place = doc[first[told]], place[first[told]]
        starts, lengths = joined_runs(doc[told], place[told], ref, ref_place, row[told], rising=(1, 3))
        at = told[starts]
        packed = np.zeros(len(at), dtype=[("kind", "u1"), ("n", "<i8"), ("ref", "<i8"), ("ref_place", "<i8")])
        packed["n"], packed["ref"], packed["ref_place"] = lengths, ref[starts], ref_place[starts]
        offsets = np.arange(len(at) + 1) * packed.itemsize
        # Any seed will do; one of their document spreads those of a large group of copies.
        out.append(_batch(pair_key(doc[at].view(np.uint64), place[at].view(np.uint64)) & SEED, place[at], doc[at], row[at], _binary(packed.tobytes(), offsets)))
    return out


def _batch(seed: np.ndarray, place: np.ndarray, doc: np.ndarray, row: np.ndarray, marks: pa.Array) -> pa.RecordBatch:
    start = (seed << SEED_BITS | place.astype(np.uint64)).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(start), pa.array(doc), pa.array(row), marks], names=["start", "doc", "row", "marks"]
    )


def _windows_of(hashes: np.ndarray, window: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed, mark) of each window; a hot seed gives way to a hash of the window's two ends."""
    seed, mark = windows(hashes, window)
    seed &= SEED
    if len(hot) and len(at := np.flatnonzero(np.isin(seed, hot))):
        size = min(SEED_WORDS, window)
        kmers = runs_hash(hashes, size)
        seed[at] = pair_key(kmers[at], kmers[at + window - size]) & SEED
    return seed, mark


def _frequent(window: int):
    """Per batch the seeds that start at least one of ``BATCH_SHARE`` of its entries, and (null) all entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                held, size = [], 0
                for text in batch.column(0):
                    hashes = word_hashes((text.as_py() or b"").split())
                    for a, b in chunks(len(hashes) - window + 1):
                        seed, _ = windows(hashes[a:b + window - 1], window)
                        # An entry starts where the seed changes.
                        held.append((seed & SEED)[np.append(True, seed[1:] != seed[:-1])])
                        size += len(held[-1])
                        if size >= CHUNK:
                            yield _counts(np.concatenate(held))
                            held, size = [], 0
                if held:
                    yield _counts(np.concatenate(held))

    return run


def _counts(seeds: np.ndarray) -> pa.RecordBatch:
    values, counts = np.unique(seeds, return_counts=True)
    often = counts * BATCH_SHARE >= len(seeds)
    return pa.RecordBatch.from_arrays(
        [pa.array([None, *values[often].tolist()], pa.int64()), pa.array([len(seeds), *counts[often].tolist()], pa.int64())],
        names=["seed", "n"],
    )


def hot_seeds(read: DataFrame, window: int) -> np.ndarray:
    """Seeds of more than one of ``HOT_SHARE`` index entries: at most so many, whatever the input.

    A seed of twice one of ``BATCH_SHARE`` of all entries is always found: batches in which it is
    rarer than that, and which do not report it, hold less than half of it.
    """
    counted = read.select("text").mapInArrow(_frequent(window), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    counted = stage(counted, "seeds")
    total = counted.where("seed IS NULL").agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("seed").isNotNull() & (F.col("n") > F.lit(total // HOT_SHARE))).select("seed").collect()
    return np.array(sorted(r.seed for r in found), dtype=np.uint64)


def _index(window: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                ids = [LAST if i is None else i for i in batch.column(0).to_pylist()]
                texts, rows = batch.column(1), batch.column(2).to_pylist()
                held, size = [], 0
                for i in sorted(range(len(ids)), key=ids.__getitem__):
                    text = texts[i].as_py() or b""
                    hashes = word_hashes(text.split())
                    for a, b in chunks(len(hashes) - window + 1):
                        seed, mark = _windows_of(hashes[a:b + window - 1], window, hot)
                        held.append((np.full(b - a, ids[i]), np.full(b - a, rows[i]), np.arange(a, b), seed, mark))
                        size += b - a
                        if size >= CHUNK:
                            yield from _entries(*map(np.concatenate, zip(*held)))
                            held, size = [], 0
                if held:
                    yield from _entries(*map(np.concatenate, zip(*held)))

    return run


def _lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Factors from index entries in the order of seed, document, row and start.

    Of the last seed of a batch the first document of each window is carried to the next batch.
    """
    carried = None
    with np.errstate(over="ignore"):
        for batch in batches:
            starts, docs, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            seeds = starts.view(np.uint64) >> SEED_BITS
            places = starts & 0xFFFFFFFF
            marks = batch.column(3)
            offsets = np.frombuffer(marks.buffers()[1], dtype="<i4")[marks.offset:marks.offset + len(marks) + 1]
            data = np.frombuffer(marks.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] else np.empty(0, np.uint8)
            lengths = np.diff(offsets)
            told = lengths % 8 == 1
            if told.any():
                packed = data[np.repeat(told, lengths)].view([("kind", "u1"), ("n", "<i8"), ("ref", "<i8"), ("ref_place", "<i8")])
                yield _factors(docs[told], rows[told], places[told], packed["n"], packed["ref"], packed["ref_place"])
            asked = ~told
            counts = lengths[asked] // 8
            if not len(counts):
                continue
            mark = data[np.repeat(asked, lengths)].view("<u8")
            within = np.arange(len(mark)) - np.repeat(np.cumsum(counts) - counts, counts)
            seed = np.repeat(seeds[asked], counts)
            doc, row = np.repeat(docs[asked], counts), np.repeat(rows[asked], counts)
            place = np.repeat(places[asked], counts) + within
            if carried is not None and carried[0][0] == seed[0]:
                n = len(carried[0])
                seed, mark, doc, row, place = (np.concatenate(p) for p in zip(carried, (seed, mark, doc, row, place)))
            else:
                n = 0
            first = first_of(seed, mark)
            found = np.flatnonzero(doc[first] < doc)
            found = found[found >= n]
            if len(found):
                ref, ref_place = doc[first[found]], place[first[found]]
                heads, runs = joined_runs(doc[found], place[found], ref, ref_place, row[found], rising=(1, 3))
                at = found[heads]
                yield _factors(doc[at], row[at], place[at], runs, ref[heads], ref_place[heads])
            keep = np.flatnonzero((seed == seed[-1]) & (first == np.arange(len(first))))
            carried = (seed[keep], mark[keep], doc[keep], row[keep], place[keep])


def _factors(*columns: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.ascontiguousarray(c, dtype=np.int64)) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split(" ")[0] for c in _FACTORS.split(", ")])


def factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc, row, at, n, ref, ref_at``: runs of windows that stand in a smaller doc_id, too.

    All documents are the reference. Its index is dealt into blocks by seed: the least k-mer of a
    window, so neighbouring windows mostly share an entry, and equal windows meet in one block. In
    its block each window is looked up; a run of them that goes on at one place of the reference is
    a factor, ``n`` windows from word ``at`` on, equal to the text of ``ref`` from ``ref_at`` on.
    The windows over the border of two factors are looked up like all others. A window is known by
    32 bits of its seed and 64 bits of its own, and both are compared. Windows of a seed that holds
    much of the index (a first pass counts them) are dealt out by their ends instead, so that no
    block holds all of them. A null doc_id stands above all others.
    """
    return _factors_of(_with_rows(docs), window)


def _factors_of(rows: DataFrame, window: int) -> DataFrame:
    read = rows.select("doc_id", F.col("text").cast("binary").alias("text"), "row")
    seed = F.shiftright("start", 32)
    entries = read.mapInArrow(_index(window, hot_seeds(read, window)), _INDEX).repartition(seed)
    found = entries.sortWithinPartitions(seed, "doc", "row", "start").mapInArrow(_lookup, _FACTORS)
    return found.select("doc", "row", F.col("place").alias("at"), "n", "ref", F.col("ref_place").alias("ref_at"))


def _with_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, text, doc, row``: ``row`` is zero, or for ids that are repeated 64 bits of the text.

    Rows that agree in them and in their doc_id are taken for equal rows. Repeated ids are stored,
    so that Spark knows their size when it joins them; where there are few, no text is moved.
    """
    doc = F.coalesce("doc_id", F.lit(LAST))
    again = docs.groupBy(doc.alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again")
    joined = docs.withColumn("doc", doc).join(stage(again, "repeated-ids"), F.col("doc") == F.col("again"), "left")
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    return joined.select(
        "doc_id", "text", "doc", F.when(F.col("again").isNotNull(), text).otherwise(F.lit(0)).alias("row")
    )


def parse(at: list[int], n: list[int], ref: list[int], ref_at: list[int], window: int) -> list[tuple[int, int]]:
    """Greedy factors as (start, end) in words, from runs of windows in any order.

    A run that goes on where another ends, in the text and in the reference, is one factor with it.
    """
    runs = sorted(zip(at, n, ref, ref_at))
    out: list[list[int]] = []
    for start, count, doc, place in runs:
        if out and out[-1][0] + out[-1][1] == start and (out[-1][2], out[-1][3] + out[-1][1]) == (doc, place):
            out[-1][1] += count
        else:
            out.append([start, count, doc, place])
    return [(start, start + count + window - 1) for start, count, _, _ in out]


@F.pandas_udf(BinaryType())
def packed(texts: pd.Series) -> pd.Series:
    """Each text compressed, for a shuffle: a third less than the shuffle's own compression leaves."""
    codec = zstandard.ZstdCompressor(level=1)
    return texts.map(lambda t: codec.compress(t.encode("utf-8", "surrogatepass")) if isinstance(t, str) else None)


def remove(text: Column, runs: Column, window: int = WINDOW) -> Column:
    """``struct<n_words, n_removed, n_factors, kept>`` of a ``packed`` text and its factors' runs (null: none)."""

    @F.pandas_udf("n_words long, n_removed long, n_factors long, kept string")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        codec = zstandard.ZstdDecompressor()
        for texts, *columns in batches:
            rows = []
            for text, *parts in zip(texts, *columns):
                words = codec.decompress(text).split() if text is not None else []
                spans = parse(*parts, window) if parts[0] is not None and len(parts[0]) else []
                kept, at = [], 0
                for start, end in spans:
                    kept += words[at:start]
                    at = max(at, end)
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), len(spans), b" ".join(kept).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "n_factors", "kept"])

    return run(text, runs["at"], runs["n"], runs["ref"], runs["ref_at"])


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, n_factors, kept`` per row of ``docs(doc_id, text)``.

    Each word that a window of ``window`` consecutive words covers goes, if the same words also
    start somewhere in a document with a smaller doc_id. All windows are judged on the input. Words
    are parted by ASCII white space and compared unchanged; ``kept`` has one space between them.
    Null and short texts keep their words (none). Rows of equal doc_id never remove each other's
    words; a null doc_id is above all others. Other columns are not read.

    Of a window that many documents share, each batch of the scan sends one document's entry, and
    a block is read in order with one entry per window in memory. Texts are shuffled once, compressed,
    to meet the factors; documents are joined by doc_id and, where that is repeated, a hash of the text.
    """
    docs = docs.select("doc_id", "text")
    rows = _with_rows(docs)
    runs = _factors_of(rows, window).groupBy("doc", "row").agg(F.collect_list(F.struct("at", "n", "ref", "ref_at")).alias("runs"))
    joined = rows.select("doc_id", "doc", "row", packed("text").alias("packed")).join(runs, ["doc", "row"], "left")
    return joined.select("doc_id", remove(F.col("packed"), F.col("runs"), window).alias("r")).select("doc_id", "r.*")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that each document keeps, over the whole table."""
    found = dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 13], ' ') AS key
  FROM (SELECT *, unnest(range(0, len(w) - 12)) AS i FROM w)
), firsts AS (SELECT key, min(doc_id) AS first FROM windows GROUP BY key
), repeated AS (
  SELECT doc_id, list(i) AS starts FROM windows JOIN firsts USING (key) WHERE first < doc_id GROUP BY doc_id
), covered AS (
  SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda i: range(i, i + 13)))) AS gone FROM repeated
), kept AS (
  SELECT w.doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i, coalesce(gone, []) AS gone
  FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id
), map AS (
  SELECT k.doc_id, k.i, k.word FROM kept k LEFT JOIN (SELECT doc_id, unnest(gone) AS i FROM covered) g
    ON k.doc_id = g.doc_id AND k.i = g.i WHERE g.i IS NULL
), lines AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS line FROM map GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(line, '')) AS kept_sha256
FROM w LEFT JOIN lines l ON w.doc_id = l.doc_id
"""
