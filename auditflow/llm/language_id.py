"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditflow.llm.common import table, with_columns_of
from auditflow.session import stage

UNKNOWN = "und"
# Code points hashed at once, so that very long texts need bounded memory.
CHUNK = 1 << 20
_ODD = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class Settings:
    """``rows_per_label`` bounds the labelled rows that are fitted on, in expectation; they are
    chosen by a hash of their id. Document frequencies come from all labelled rows given."""

    longest: int = 3
    bits: int = 14
    rows_per_label: int = 600
    passes: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    settings: Settings

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Calibrated probability of each label from the counts of one text."""
        at = np.flatnonzero(counts)
        x = scaled(counts[at].astype(np.float64), self.idf[at])
        return softmax((self.weights[:, at] @ x + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def scaled(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with damped counts, scaled to length one."""
    x = np.log1p(counts) * idf
    return x / (np.sqrt(x @ x) or 1.0)


def ngram_counts(text: str, settings: Settings) -> np.ndarray:
    """Hashed counts of the n-grams of 1 to ``longest`` lower-case letters and gaps of a whole text."""
    size = 1 << settings.bits
    counts = np.zeros(size, dtype=np.int64)
    text = text.lower()
    for at in range(0, len(text), CHUNK):
        part = text[at:at + CHUNK + settings.longest - 1]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        # ASCII that is no letter is a gap; other characters stand for themselves.
        points = np.where((points < 97) | (points > 122) & (points < 128), np.uint32(32), points)
        own = min(CHUNK, len(text) - at)
        mark = np.zeros(len(points), dtype=np.uint32)
        for n in range(settings.longest):
            with np.errstate(over="ignore"):
                mark = mark[: len(points) - n] * _ODD + points[n:] + np.uint32(n + 1)
                places = (mark * _ODD) >> np.uint32(32 - settings.bits)
            counts += np.bincount(places[:own], minlength=size)
    return counts.astype(np.float32)


def _document_frequencies(rows: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """In how many of all texts each feature is, and the number of texts.

    Every task counts for itself, so what is shuffled is one row per feature and task.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, texts = np.zeros(1 << settings.bits, dtype=np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                seen += ngram_counts(text, settings) > 0
                texts += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"feature": np.append(at, -1), "n": np.append(seen[at], texts)})

    counted = rows.select("text").mapInPandas(count, "feature long, n long")
    found = counted.groupBy("feature").agg(F.sum("n").alias("n")).toPandas().set_index("feature")["n"]
    out = np.zeros(1 << settings.bits)
    total = int(found.pop(-1)) if -1 in found.index else 0
    out[found.index] = found.to_numpy()
    return out, total


def _sample(rows: DataFrame, settings: Settings) -> pd.DataFrame:
    """About ``rows_per_label`` rows of each label as counts, in the order of their hash."""
    # Stored, so that its size is known and texts need not be shuffled to meet a few labels.
    sizes = stage(rows.groupBy("lang").agg(F.count("*").alias("rows_of_label")), "labels")
    unit = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / F.lit(float(1 << 53))
    chosen = (
        rows.join(sizes, "lang")
        .withColumn("unit", unit)
        .where(F.col("unit") * F.col("rows_of_label") < settings.rows_per_label)
    )

    def featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for unit, lang, text in zip(batch["unit"], batch["lang"], batch["text"]):
                counts = ngram_counts(text, settings)
                at = np.flatnonzero(counts)
                out.append((unit, lang, at.astype("<u4").tobytes() + counts[at].astype("<f4").tobytes()))
            yield pd.DataFrame(out, columns=["unit", "lang", "counts"])

    # Equal rows share a unit; equal bytes make their order immaterial.
    found = chosen.select("unit", "lang", "text").mapInPandas(featurize, "unit double, lang string, counts binary")
    return found.toPandas().sort_values(["unit", "lang", "counts"]).reset_index(drop=True)


def _row(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(data) // 2
    return np.frombuffer(data[:half], dtype="<u4"), np.frombuffer(data[half:], dtype="<f4")


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], labels: int, size: int, s: Settings):
    """Follow-the-regularised-leader, one row at a time, with elastic-net penalties.

    The last feature is the bias and has no penalty.
    """
    z, n = np.zeros((labels, size + 1)), np.zeros((labels, size + 1))

    def weights(at):
        zs, ns = z[:, at], n[:, at]
        l1, l2 = np.where(at == size, 0, s.l1), np.where(at == size, 0, s.l2)
        w = -(zs - np.sign(zs) * l1) / ((s.beta + np.sqrt(ns)) / s.alpha + l2)
        return np.where(np.abs(zs) <= l1, 0, w)

    for _ in range(s.passes):
        for at, x, label in rows:
            w = weights(at)
            p = softmax(w @ x)
            p[label] -= 1
            g = p[:, None] * x[None, :]
            old = n[:, at]
            new = old + g * g
            z[:, at] += g - (np.sqrt(new) - np.sqrt(old)) / s.alpha * w
            n[:, at] = new
    return weights(np.arange(size + 1))


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """What the logits must be divided by for the least log loss, by golden-section search."""

    def loss(t):
        p = softmax(logits / np.exp(t))[np.arange(len(truth)), truth]
        return -np.log(np.maximum(p, 1e-300)).mean()

    low, high, ratio = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(rows: DataFrame, settings: Settings = Settings()) -> Model | None:
    """A model of ``rows(doc_id, text, lang)``; rows without text or label are left out.

    None if no labelled row is left. ``doc_id`` only serves to choose the sample. A fifth of the
    sample is kept from the fit for the temperature.
    """
    rows = rows.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    size = 1 << settings.bits
    seen, texts = _document_frequencies(rows, settings)
    sample = _sample(rows, settings) if texts else None
    if sample is None or sample.empty:
        return None
    idf = np.log((1 + texts) / (1 + seen)) + 1
    labels = tuple(sorted(sample["lang"].unique()))
    number = {label: i for i, label in enumerate(labels)}
    data = []
    for lang, counts in zip(sample["lang"], sample["counts"]):
        at, values = _row(counts)
        x = scaled(values.astype(np.float64), idf[at])
        data.append((np.append(at, size).astype(np.int64), np.append(x, 1.0), number[lang]))
    held = [i for i in range(len(data)) if i % 5 == 4]
    fitted = _ftrl([d for i, d in enumerate(data) if i % 5 != 4], len(labels), size, settings)
    temperature = 1.0
    if len(held) >= 10 and len(labels) > 1:
        logits = np.stack([fitted[:, data[i][0]] @ data[i][1] for i in held])
        temperature = _temperature(logits, np.array([data[i][2] for i in held]))
    return Model(labels, idf, fitted[:, :-1], fitted[:, -1], temperature, settings)


def predict(text: Column, model: Model | None) -> Column:
    """``struct<lang_pred, score>`` of each whole text; ``und`` and 0 for texts without letters."""

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for value in batch:
                if model is None or not isinstance(value, str):
                    out.append((UNKNOWN, 0.0))
                else:
                    p = model.scores(ngram_counts(value, model.settings))
                    best = int(p.argmax())
                    out.append((model.labels[best], float(p[best])))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    # A null argument stands for a text that is not looked at.
    return run(F.when(text.rlike(r"\p{L}"), text))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from the fit; rows without id are fitted on."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every whole text, fitted on the rows that are not held out.

    Repeated rows get equal answers; ties go to the first label in order. An empty table gives an
    empty result; without any labelled row every prediction is ``und``.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    found = docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text"), model).alias("p")
    )
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, least_score: float = 0.5, settings: Settings = Settings()) -> DataFrame:
    """The documents whose language is known with at least this score; columns as in ``docs``.

    The model is fitted on the labelled ones of these documents; if none is labelled, none can be
    rejected for its score, and only texts without letters go.
    """
    model = fit(docs, settings)
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = docs.withColumn("__p", predict(F.col("text"), model))
    kept = found.where((F.col("__p.lang_pred") != UNKNOWN) & (F.col("__p.score") >= least_score))
    return with_columns_of(kept, docs)
