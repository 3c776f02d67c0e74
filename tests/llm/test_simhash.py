import random

import pytest
import xxhash

from auditflow.llm import simhash as S
from auditflow.llm.bktree import BKTree
from auditflow.llm.components import connected

from .conftest import LONG, rows_of


def plain(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, "A", "a b c", "a b c d", "x  Y\tz\x0bq É é ü", "one two " * 50, LONG[:2000]])
def test_fingerprint(text):
    assert S.simhash_of(text) & (1 << 64) - 1 == plain(text)


def test_chunks_do_not_matter(monkeypatch):
    text = " ".join(str(i * i) for i in range(500))
    whole = S.simhash_of(text)
    monkeypatch.setattr(S, "CHUNK", 7)
    assert S.simhash_of(text) == whole


def test_tree_finds_what_a_scan_finds():
    pick = random.Random(1)
    values = [pick.getrandbits(8) for _ in range(120)]
    tree = BKTree()
    for v in values:
        tree.add(v)
    for q in range(0, 256, 5):
        assert sorted(tree.within(q, 2)) == sorted({v for v in values if (v ^ q).bit_count() <= 2})


def groups(prints, distance):
    parent = {p: p for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= distance:
                parent[top(a)] = top(b)
    return {p: min(q for q in prints if top(q) == top(p)) for p in prints}


@pytest.mark.parametrize("tree", [2_000, 3])
def test_links_connect_what_all_pairs_connect(spark, tree):
    pick = random.Random(2)
    prints = {pick.getrandbits(63) for _ in range(30)}
    for p in list(prints):
        for _ in range(6):
            for _ in range(pick.randrange(4)):
                p ^= 1 << pick.randrange(63)
            prints.add(p)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r.node: r.root for r in connected(S.links(df, 4, tree=tree)).collect()}
    assert {p: roots.get(p, p) for p in prints} == groups(prints, 4)


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert rows_of(connected(links), "node", "root") == rows_of(
        spark.createDataFrame([(i, 0) for i in range(41)] + [(100, 100), (101, 100)], "node long, root long"), "node", "root"
    )


BASE = " ".join(f"w{i}" for i in range(400))


def test_odd_rows(docs):
    df = docs(
        (5, BASE), (3, BASE.upper()), (3, BASE), (9, "other words here"), (None, BASE), (None, "alone with no id"),
        (7, None), (8, ""), (6, " \t"), (2, LONG), (2, LONG),
    )
    found = S.near_duplicates(df)
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {
        (5, 3), (3, 3), (9, 9), (None, 3), (None, None), (7, 6), (8, 6), (6, 6), (2, 2),
    }
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 6, 9]


def test_empty_table(docs):
    assert S.near_duplicates(docs()).count() == 0
    assert S.keep_one(docs()).count() == 0
