"""Order MinHash fingerprints, whose likeness follows edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import table

# Code points in a k-mer, k-mers in a tuple, tuples in a fingerprint.
K, TUPLE, TUPLES = 6, 2, 32
# Code points hashed at once, so that very long texts need bounded memory.
CHUNK = 1 << 20
# Documents in a run of neighbours that one task reads in order, and the most runs there are.
RUN, RUNS = 2_000, 20_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(np.iinfo(np.uint64).max)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _factors(tuples: int) -> np.ndarray:
    """An odd factor for each order of the k-mers."""
    return _mix(np.arange(1, tuples + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def _kmers(text: str, k: int) -> np.ndarray:
    """Hashes of all k-mers in text order; a shorter text is one k-mer."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    k = min(k, len(points))
    out = np.zeros(len(points) - k + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * _ODD + points[i:len(points) - k + 1 + i]
        return _mix(out + np.uint64(k))


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how often it came before)."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.empty(len(ranked), dtype=bool)
    new[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    if len(starts) == len(ranked):
        return _mix(hashes)
    nth = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.append(starts, len(ranked))))
    numbered = np.empty_like(hashes)
    numbered[order] = nth.astype(np.uint64)
    with np.errstate(over="ignore"):
        return _mix(hashes + numbered * _ODD)


def fingerprint_of(text: str, k: int = K, size: int = TUPLE, tuples: int = TUPLES) -> np.ndarray:
    """``tuples`` 32-bit numbers; all zero for an empty text.

    For each of so many orders of the occurrence-numbered k-mers the ``size`` least are taken, put
    back into text order, and hashed together with their number.
    """
    if not text:
        return np.zeros(tuples, dtype="<u4")
    numbered = _numbered(_kmers(text, k))
    size = min(size, len(numbered))
    marks = np.full(tuples, size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        places = np.stack([_least(numbered, factor, size) for factor in _factors(tuples)])
        for column in np.sort(places, axis=1).T:
            marks = _mix(marks * _ODD + numbered[column])
    return ((marks >> np.uint64(32)).astype("<u4")) | np.uint32(1)


def _least(numbered: np.ndarray, factor: np.uint64, size: int) -> np.ndarray:
    """Places of the ``size`` k-mers that come first in one order."""
    found, values = [], []
    for at in range(0, len(numbered), CHUNK):
        keys = numbered[at:at + CHUNK] * factor
        for _ in range(min(size, len(keys))):
            least = keys.argmin()
            found.append(at + least)
            values.append(keys[least])
            keys[least] = _LAST
    if len(found) > size:
        found = [found[i] for i in np.lexsort((found, values))[:size]]
    return np.array(found)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal tuples, an estimate of how near two texts are in edit distance."""
    return float(np.mean(a == b))


def _hex(numbers: np.ndarray) -> str:
    return numbers.astype(">u4").tobytes().hex()


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _bounds(docs: DataFrame, run: int) -> list[int]:
    """Some doc_ids that part the table into runs of about ``run`` documents; the largest is last.

    Chosen by a hash of the id, so a rerun finds the same. Eight times as many are looked at as there
    are runs, of which there are at most ``RUNS``; beyond that, runs are longer.
    """
    ids = docs.select("doc_id").where("doc_id is not null")
    rows, top = ids.agg(F.count("*"), F.max("doc_id")).first()
    if not rows:
        return []
    step = max(1, rows // (8 * min(RUNS, max(1, rows // run))))
    chosen = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).distinct()
    return sorted({*sorted(r[0] for r in chosen.collect())[7::8], top})


def edited_fingerprints(
    docs: DataFrame, k: int = K, size: int = TUPLE, tuples: int = TUPLES, run: int = RUN
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how near these and the next text are.

    Documents follow each other by descending doc_id, null last, and rows that repeat a doc_id by
    text, null first; after the last comes the first. The edited text has its last
    ``floor(n_chars / 2)`` code points replaced by as many of the next text's first. A null text is
    empty; two empty texts are fully alike, and a single document is its own next one. Columns
    other than ``doc_id`` and ``text`` are not read.

    The table is parted into runs at some of its doc_ids. Each run is read in order by one task, and
    the document at its top is sent to the run above as well, as the next one of that run's last.
    """
    docs = docs.select("doc_id", "text")
    bounds = _bounds(docs, run)
    edges = np.array(bounds, dtype=np.int64)
    runs = max(1, len(bounds))

    @F.pandas_udf("int")
    def run_of(ids: pd.Series) -> pd.Series:
        # Ids up to a bound and above the one before; without id a row is below all others.
        found = np.searchsorted(edges, ids.fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64))
        return pd.Series(np.minimum(found, runs - 1), dtype="int32")

    nothing = not bounds
    placed = docs.withColumn("own", run_of(F.coalesce("doc_id", F.lit(-(1 << 63)))) if not nothing else F.lit(0))
    first = F.col("doc_id").isin(bounds) if len(bounds) <= 200 else None
    if first is None:
        spark = docs.sparkSession
        tops = spark.createDataFrame([(b,) for b in bounds], "top long")
        placed = placed.join(tops, placed["doc_id"] == tops["top"], "left")
        first = F.col("top").isNotNull()
    first = F.lit(True) if nothing else F.coalesce(first, F.lit(False))
    above = F.struct(F.pmod(F.col("own") + 1, F.lit(runs)).alias("run"), F.lit(1).alias("guest"))
    here = F.struct(F.col("own").alias("run"), F.lit(0).alias("guest"))
    sent = placed.select("doc_id", "text", F.explode(F.when(first, F.array(here, above)).otherwise(F.array(here))).alias("p"))
    ordered = (
        sent.select("p.run", "p.guest", "doc_id", "text")
        .repartition("run")
        .sortWithinPartitions("run", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    )

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def result(doc, after):
            doc_id, text, own = doc
            half = len(text) // 2
            edited = text[:len(text) - half] + after[0][:half]
            marks = fingerprint_of(edited, k, size, tuples) if edited != text else own
            digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            return (
                doc_id, len(text), digest, _hex(own), _hex(marks), likeness(own, marks), likeness(own, after[1]),
            )

        waiting, at = None, None
        for batch in batches:
            out = []
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            for number, guest, doc_id, text in zip(batch["run"], batch["guest"], ids, batch["text"]):
                text = text if isinstance(text, str) else ""
                if number != at:
                    waiting, at = None, number
                elif guest and waiting is None:
                    continue
                own = fingerprint_of(text, k, size, tuples)
                if waiting is not None:
                    out.append(result(waiting, (text, own)))
                waiting = None if guest else (doc_id, text, own)
            frame = pd.DataFrame(out, columns=[c.split(" ")[0] for c in _RESULT.split(", ")])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    return ordered.mapInPandas(rows, _RESULT)


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, over the whole table."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
