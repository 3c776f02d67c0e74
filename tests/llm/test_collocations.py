import random
import re
from collections import Counter

import numpy as np
import pytest

from auditflow.llm import collocations as C
from auditflow.llm.fm_index import FMIndex, suffix_order

from .conftest import LONG, by_sql, rows_of

WORDS = ["new", "york", "the", "of", "Ünter", "a\x1cb", "new york", "x"]


def corpus(seed, n=60):
    draw = random.Random(seed)
    text = lambda: "".join(draw.choice(WORDS) + draw.choice([" ", " ", "  ", "\t", ", ", "\n", ".", "; "]) for _ in range(draw.randint(0, 40)))
    rows = [(i, text(), draw.choice(["en", "de", None, "x\ny"])) for i in range(n)]
    return rows + [(None, None, "en"), (3, "", None), (3, "NEW YORK " * 30, "en"), (3, "NEW YORK " * 30, "en"), (9, LONG[:60_000], "fr")]


def table(spark, rows):
    df = spark.createDataFrame([(i, t, lang, 5, "p", "k") for i, t, lang in rows], "doc_id long, text string, lang string, a int, phrase string, block string")
    return df.repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_sql_whatever_the_shards(spark, seed):
    rows = corpus(seed)
    names, expected = by_sql(C.OP13_SQL, documents=("doc_id BIGINT, text VARCHAR, lang VARCHAR", rows))
    assert expected
    assert rows_of(C.collocations(table(spark, rows)), *names) == expected
    assert rows_of(C.collocations(table(spark, rows), shard_words=50, block_bytes=400), *names) == expected
    assert rows_of(C.collocations(table(spark, rows), shard_words=50, block_bytes=400, fan=3), *names) == expected


def test_counts_of_every_phrase(spark):
    rows = corpus(3)
    counts, before, after = Counter(), Counter(), Counter()
    for _, text, lang in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", low):
            words = re.findall(r"[^\x20\t]+", piece)
            counts[lang or "und", ""] += len(words)
            for k in (1, 2, 3, 4):
                for i in range(len(words) - k + 1):
                    key = lang or "und", " ".join(words[i:i + k])
                    counts[key] += 1
                    before[key] += i > 0
                    after[key] += i + k < len(words)
    got = C.phrases(table(spark, rows), longest=4, least=1, shard_words=30, block_bytes=300).collect()
    assert {(r.lang, r.phrase): r.a for r in got} == dict(counts)
    assert all((before[r.lang, r.phrase], after[r.lang, r.phrase]) == (r.left, r.right) for r in got)


def test_parts_of_a_block_are_summed_in_rounds(monkeypatch):
    monkeypatch.setattr(C, "PENDING", 3)
    parts = [b for _ in range(20) for b in C._index(3, 1, 2)(iter([_batch("en", "a b c a b c")]))]
    summed = {r["phrase"]: r["a"] for b in C._summed(1)(iter(parts)) for r in b.to_pylist()}
    assert summed["a b"] == 40 and summed["c a b"] == 20 and summed[""] == 120


def _batch(lang, text):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([lang.encode()]), pa.array([text.encode()])], names=["lang", "text"])


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**13, 10**13 + 7, 10**14)], "a long, l long, r long")
    a, left, right = 10**13, 10**13 + 7, 10**14
    assert df.select(C.score(df.a, df.l, df.r)).first()[0] == 1_000_000 * a * a // (left * right)


def test_index_against_a_scan():
    draw = np.random.default_rng(5)
    for size, kinds in ((1, 1), (40, 3), (300, 5), (300, 200)):
        ids = np.concatenate([[0], draw.integers(0, kinds + 1, size), [0]])
        found = {tuple(w): n for grams in FMIndex(ids, 4).enumerate() for w, n in zip(grams.words.tolist(), grams.count.tolist())}
        plain = Counter(
            tuple(ids[i:i + k].tolist()) for k in (1, 2, 3, 4) for i in range(len(ids) - k + 1) if ids[i:i + k].all()
        )
        assert found == dict(plain)


def test_order_of_many_symbols():
    ids = np.random.default_rng(1).integers(0, 1 << 30, 500)
    order = suffix_order(ids, 5)
    padded = np.append(ids, [0] * 5)
    keys = [tuple(padded[i:i + 5]) for i in order]
    assert keys == sorted(keys)


def test_empty_table(spark):
    assert C.collocations(table(spark, []).limit(0)).count() == 0
    assert C.collocations(table(spark, [(1, None, None), (2, " .", "en")])).count() == 0
