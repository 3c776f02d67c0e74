import hashlib
import math
import re

import pytest

from auditflow.llm import mixing as M

from .conftest import LONG, rows_of


def plain_targets(sizes, share=1.5, most=2):
    """Resharing by weight until no source is above what it may have."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if per * weight[s] > most * sizes[s]}
        if not over:
            return out | {s: per * weight[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "Z": 5, None: 40}, {"a": 0, "b": 7}, {"é": 3, "z": 3, "zz": 900, "a": 8},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, documents long")
    got = {r.source: r.target for r in M.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def mixed(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, quality double, size string, key string")
    kept = df.select("doc_id", "source", M.size(df["text"]).alias("size"), M.F.xxhash64("text").alias("text_hash"), "quality")
    return M.mix(kept, **settings)


ROWS = [(i, "w " * (i % 7 + 1), f"s{i % 4}", 0.5 + i % 3, "x", "y") for i in range(200)]


@pytest.mark.parametrize("bucket", [1, 8, 5_000])
def test_prefix_of_the_keys_order(spark, bucket):
    got = {r.doc_id: r for r in mixed(spark, ROWS, bucket=bucket).collect()}
    assert len(got) == len(ROWS)
    sources = {}
    for i, text, source, quality, *_ in ROWS:
        sources.setdefault(source, []).append((i, len(text.split()), quality))
    targets = plain_targets({s: sum(n for _, n, _ in ds) for s, ds in sources.items()})
    for source, ds in sources.items():
        total = sum(n for _, n, _ in ds)
        passes = int(targets[source] // total)
        left = math.floor(targets[source] + 0.5) - passes * total

        def key(d):
            u = (int(hashlib.md5(f"{d[0]}|{d[1]}".encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)
            return -math.log(u) / d[2]

        for i, n, _ in sorted(ds, key=key):
            take = min(n, max(0, left))
            left -= n
            assert got[i].taken == passes * n + take
        assert sum(got[i].taken for i, _, _ in ds) == math.floor(targets[source] + 0.5)


def test_odd_rows(spark):
    rows = [
        (1, None, "a", None, "", ""), (2, "", None, 1.0, "", ""), (None, "x y", None, 2.0, "", ""), (3, LONG, "b", 1.0, "", ""),
        (3, LONG, "b", 1.0, "", ""), (4, "  one\x0btwo", "b", 1.0, "", ""),
    ]
    got = mixed(spark, rows).collect()
    assert sorted(r.size for r in got) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    again = mixed(spark, rows)
    assert rows_of(again, "doc_id", "size", "taken") == rows_of(mixed(spark, rows[::-1]), "doc_id", "size", "taken")


def test_empty_table(spark):
    assert mixed(spark, []).count() == 0


def test_quality_from_labels(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (77, 0)], "doc_id long, quality int")
    sized = M.sized(docs((1, "a"), (2, "a"), (3, "a"), (None, "a"), (4, "a")))
    got = {r.doc_id: r.quality for r in M.with_quality(sized, labels).collect()}
    assert got == {1: 2.0, 2: 0.5, 3: 1.0, None: 1.0, 4: 1.0}
