import hashlib
import random

import numpy as np
import pytest

from auditflow.llm import order_minhash as O

from .conftest import LONG


def plain(text, k=O.K, size=O.TUPLE, tuples=O.TUPLES):
    """Tuples of (k-mer, number of its occurrence) in text order, one for each order of them."""
    k = min(k, len(text))
    seen, marked = {}, []
    for i in range(len(text) - k + 1):
        kmer = text[i:i + k]
        seen[kmer] = seen.get(kmer, 0) + 1
        marked.append((kmer, seen[kmer]))
    numbered = O._numbered(O._kmers(text, k))
    code = dict(zip(marked, map(int, numbered)))
    assert len(set(code.values())) == len(marked)
    out = []
    for factor in map(int, O._factors(tuples)):
        least = sorted(range(len(marked)), key=lambda i: code[marked[i]] * factor % (1 << 64))[:size]
        out.append(tuple(marked[i] for i in sorted(least)))
    return out


@pytest.mark.parametrize("a, b", [
    ("the cat sat on the mat and the cat sat", "the cat sat on a mat and the cat sat"),
    ("aaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaa"),
    ("abc", "abc"), ("abcdef", "abcdefg"),
])
def test_tuples_are_equal_where_the_plain_ones_are(a, b):
    same = O.fingerprint_of(a) == O.fingerprint_of(b)
    assert list(same) == [x == y for x, y in zip(plain(a), plain(b))]


def test_order_counts():
    a, b = "alpha beta gamma delta " * 3, "epsilon zeta eta theta " * 3
    assert O.likeness(O.fingerprint_of(a + b), O.fingerprint_of(b + a)) < 0.9


def test_chunks_do_not_matter(monkeypatch):
    text = "".join(random.Random(3).choice("abcd ") for _ in range(500))
    whole = O.fingerprint_of(text)
    monkeypatch.setattr(O, "CHUNK", 37)
    assert (O.fingerprint_of(text) == whole).all()


@pytest.mark.parametrize("run", [1, 2, 2_000])
def test_next_text_over_all_runs(spark, docs, run):
    pick = random.Random(4)
    rows = [(i * 3, "".join(pick.choice("abcdé ") for _ in range(pick.randrange(0, 60)))) for i in range(60)]
    rows += [(500, None), (501, LONG), (None, "no id"), (3, "again")]
    got = {(r.doc_id, r.n_chars, r.edited_sha256): r for r in O.edited_fingerprints(docs(*rows), run=run).collect()}
    assert len(got) == len(rows)
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        row = got[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()]
        marks = [O.fingerprint_of(t) for t in (text, edited, after)]
        assert row.fingerprint == marks[0].astype(">u4").tobytes().hex()
        assert row.edited_fingerprint == marks[1].astype(">u4").tobytes().hex()
        assert row.near_edited == np.mean(marks[0] == marks[1]) and row.near_next == np.mean(marks[0] == marks[2])


def test_few_rows(docs):
    assert O.edited_fingerprints(docs()).count() == 0
    one = O.edited_fingerprints(docs((1, "abcd"))).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [(1.0, hashlib.sha256(b"abab").hexdigest())]
    assert O.edited_fingerprints(docs((None, "a"), (None, "b"))).count() == 2
    assert [r.near_edited for r in O.edited_fingerprints(docs((4, ""), (4, ""))).collect()] == [1.0, 1.0]
