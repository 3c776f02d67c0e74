import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditflow.llm import language_id as L

from .conftest import LONG, rows_of

WORDS = {"xx": ["bako", "tiru", "mona", "keli"], "yy": ["schtz", "pfrg", "strum", "krnz"], "zz": ["ñoá", "éaí", "óuñ", "áeé"]}


def rows(n, seed, label=True):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        lang = pick.choice(list(WORDS))
        text = " ".join(pick.choice(WORDS[lang]) for _ in range(pick.randrange(4, 30)))
        out.append((seed * 10_000 + i, text, lang if label else None))
    return out


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.createDataFrame(rows(300, 1), "doc_id long, text string, lang string"))


def predicted(df, model):
    return df.select("doc_id", L.predict(F.col("text"), model).alias("p")).select("doc_id", "p.*")


def test_held_out_accuracy(spark, model):
    unseen = rows(200, 2)
    got = {r.doc_id: r for r in predicted(spark.createDataFrame(unseen, "doc_id long, text string, lang string"), model).collect()}
    right = [got[i].lang_pred == lang for i, _, lang in unseen]
    assert np.mean(right) > 0.98 and all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(docs, model):
    df = docs((1, None), (2, ""), (3, "12 34 !?"), (None, "bako tiru"), (4, LONG), (5, "schtz krnz"), (5, "schtz krnz"))
    got = predicted(df, model).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert got[3].lang_pred == "xx" and got[5] == got[6] and got[5].lang_pred == "yy"


def test_same_model_in_every_run(spark):
    df = spark.createDataFrame(rows(120, 3), "doc_id long, text string, lang string")
    a, b = L.fit(df), L.fit(df.repartition(3))
    assert (a.weights == b.weights).all() and a.temperature == b.temperature


def test_the_penalty_gives_zeros(spark):
    df = spark.createDataFrame(rows(120, 4), "doc_id long, text string, lang string")
    loose, strict = (L.fit(df, L.Settings(l1=l1)) for l1 in (0.0, 0.5))
    assert np.count_nonzero(strict.weights) < np.count_nonzero(loose.weights)


def test_temperature_is_the_best(spark):
    logits = np.array([[2.0, 0.0], [2.0, 0.0], [2.0, 0.0], [0.0, 2.0]])
    truth = np.array([0, 0, 1, 1])
    best = L._temperature(logits, truth)
    loss = lambda t: -np.log(L.softmax(logits / t)[np.arange(4), truth]).mean()
    assert all(loss(best) <= loss(t) + 1e-9 for t in (0.5 * best, 0.9 * best, 1.1 * best, 2 * best))


def test_nothing_to_learn_from(spark, docs):
    none = spark.createDataFrame([(1, None, "en"), (2, "a", None), (3, "12", "en")], "doc_id long, text string, lang string")
    assert L.fit(none) is None
    assert [r.lang_pred for r in predicted(docs((1, "abc"), (2, None)), None).collect()] == ["und", "und"]
    assert L.fit(none.where("false")) is None and predicted(docs(), None).count() == 0


def test_one_label(spark):
    df = spark.createDataFrame([(i, "abc def", "en") for i in range(20)], "doc_id long, text string, lang string")
    assert {r.score for r in predicted(df, L.fit(df)).collect()} == {1.0}


def test_rejection_keeps_rows_as_they_are(spark):
    extra = [(9_001, "12 34", "xx"), (9_002, None, "xx"), (9_003, "", None)]
    good = rows(100, 5) + rows(20, 6, label=False)
    df = spark.createDataFrame([(*r, "p") for r in good + extra], "doc_id long, text string, lang string, p string")
    kept = L.keep_identified(df)
    assert kept.columns == df.columns
    assert rows_of(kept, *df.columns) == rows_of(df.where("doc_id not in (9001, 9002, 9003)"), *df.columns)


def test_chunks_do_not_matter(monkeypatch):
    text = "Straße und Weg, ñandú. " * 20
    whole = L.ngram_counts(text, L.Settings())
    monkeypatch.setattr(L, "CHUNK", 11)
    assert (L.ngram_counts(text, L.Settings()) == whole).all()
