import random

import pytest

from auditflow.llm import quality as Q

from .conftest import LONG, by_sql, rows_of

DOCS = "doc_id BIGINT, text VARCHAR"


def corpus():
    draw = random.Random(4)
    pool = [f"w{i}" for i in range(40)] + ["é|x", "a#b", "***", " "]
    some = lambda n: "".join(draw.choice(pool) + draw.choice([" ", "\n", "\t ", "\r\n"]) for _ in range(n))
    rows = [(i, some(draw.choice([1, 2, 3, 49, 50, 51, 200]))) for i in range(60)]
    return rows + [
        (None, None), (None, ""), (61, " \n\t"), (62, LONG), (62, LONG), (63, "a b c a b c " * 20), (64, "line one\n\nline one\n \n \nx"),
        (65, "a a a"), (66, "a a a a"), (67, "b c\nb c\nb c"), (68, "x y z " + some(300) + "x y z"),
    ]


def tables(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "h", [1], 7, 8) for i, t in rows], "doc_id long, text string, h string, words array<int>, n_words int, weights int")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


LABELS = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(40)] + [(None, 1, 0), (1, 0, None), (2, None, None), (999, 1, 0)]


def verdicts(spark, rows, labels):
    docs, labels = tables(spark, rows, labels)
    weights = Q.log_ratios(docs, Q.trusted_ids(labels))
    weights.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/weights-{len(rows)}")
    return Q.judged(docs, spark.read.parquet(path))


@pytest.mark.parametrize("labels", [LABELS, []])
def test_same_as_sql_on_odd_rows(spark, labels):
    rows = corpus()
    names, expected = by_sql(Q.OP11_SQL, documents=(DOCS, rows), labels=("doc_id BIGINT, quality INT, toxic INT", labels))
    got = rows_of(verdicts(spark, rows, labels), *names)
    assert got == expected


def test_counts(spark):
    docs, _ = tables(spark, [(1, "a b c a b c"), (2, "a a a a"), (3, "x #1\ny\nx #1\n\n"), (4, None)], [])
    found = {r.doc_id: tuple(r[1:6]) for r in Q.described(docs).collect()}
    assert found == {1: (6, 6, 0, 0, 6), 2: (4, 4, 0, 0, 4), 3: (5, 7, 2, 1, 0), 4: (0, 0, 0, 0, 0)}


def test_windows_with_equal_marks_are_compared_by_words(spark, monkeypatch):
    monkeypatch.setattr(Q, "_marked_windows", lambda h: Q.F.transform(h, lambda x, i: i.cast("long")))
    docs, _ = tables(spark, [(1, "a b c d e f g a b c")], [])
    suspects = Q._suspects(Q.F.sequence(Q.F.lit(0).cast("long"), Q.F.lit(7).cast("long")), Q.F.lit(10))
    assert docs.select(suspects).first()[0] == list(range(8))
    assert Q.described(docs).first().n_repeat_words == 6


def test_verdict_follows_the_target(spark):
    good, bad = "the cat sat on a mat " * 12, "buy | cheap | pills | now | click | here " * 10
    words = lambda text, i: " ".join(f"{w}{i * 31 % 7}" for w in text.split())
    rows = [(i, " ".join(words(good if i % 2 else bad, j) for j in range(i, i + 4))) for i in range(40)]
    labels = [(i, i % 2, 0) for i in range(20)]
    for r in verdicts(spark, rows, labels).collect():
        assert (r.log_ratio > 0) == bool(r.doc_id % 2)


def test_empty_table(spark):
    assert verdicts(spark, [], []).count() == 0
