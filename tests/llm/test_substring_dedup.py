import random

import pytest

from auditflow.llm import factors as X
from auditflow.llm import substring_dedup as S

from .conftest import LONG


def plain(rows, window):
    """Kept words of each row: every window against every window of smaller ids."""
    top = lambda i: (1 << 63) - 1 if i is None else i
    words = [(t or "").encode().split() for _, t in rows]
    first = {}
    for (i, _), ws in zip(rows, words):
        for a in range(len(ws) - window + 1):
            key = tuple(ws[a:a + window])
            first[key] = min(top(i), first.get(key, top(i)))
    out = []
    for (i, _), ws in zip(rows, words):
        gone = {
            a + k for a in range(len(ws) - window + 1) if first[tuple(ws[a:a + window])] < top(i) for k in range(window)
        }
        out.append((i, len(ws), len(gone), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode()))
    return sorted(out, key=str)


def got(df, window):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.dedup(df, window).collect()), key=str)


def mosaic(n, seed):
    """Texts put together from a few passages, so that windows repeat in all sorts of ways."""
    pick = random.Random(seed)
    passages = [[f"w{pick.randrange(8)}" for _ in range(pick.randrange(3, 25))] for _ in range(6)]
    out = []
    for i in range(n):
        words = [w for _ in range(pick.randrange(5)) for w in pick.choice(passages)] + [f"u{i}"] * pick.randrange(3)
        out.append((pick.randrange(10 * n), " ".join(words)))
    return out


@pytest.mark.parametrize("window, chunk", [(13, 1 << 20), (13, 50), (7, 9)])
def test_against_every_window(monkeypatch, docs, window, chunk):
    # The size is read where the functions run; small batches make windows meet in the index.
    monkeypatch.setattr(S, "CHUNK", chunk)
    rows = mosaic(80, chunk)
    assert got(docs(*rows).repartition(5), window) == plain(rows, window)


def test_odd_rows(docs):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [
        (None, passage), (None, passage + " x"), (3, passage), (3, passage), (3, "a " + passage), (1, None), (2, ""), (4, "\t\x0b "),
        (9, LONG), (8, LONG), (7, "p1 p2 p3"), (10, passage + " y " + passage), (-5, "word " * 13),
    ]
    assert got(docs(*rows), 13) == plain(rows, 13)


def test_empty_table(docs):
    assert S.dedup(docs()).count() == 0


def test_factors_are_substrings_of_the_reference(docs):
    rows = {i: t for i, t in mosaic(60, 5)}
    found = S.factors(docs(*rows.items()), 9).collect()
    assert found
    for r in found:
        own, ref = rows[r.doc].split(), rows[r.ref].split()
        n = r.n + 8
        assert r.ref < r.doc and own[r.at:r.at + n] == ref[r.ref_at:r.ref_at + n]


def test_parse_joins_runs_that_go_on():
    assert S.parse([5, 0, 9], [4, 5, 2], [1, 1, 2], [15, 10, 3], 3) == [(0, 11), (9, 13)]


def test_windows_of_equal_words_have_equal_seeds_and_marks():
    words = X.word_hashes([b"a", b"b", b"c", b"d", b"e", b"f", b"g"] * 4)
    seeds, marks = X.windows(words, 9)
    assert len(seeds) == len(words) - 8
    assert (seeds[:7] == seeds[7:14]).all() and (marks[:7] == marks[7:14]).all() and len(set(marks)) == 7
    assert len(X.windows(words[:8], 9)[0]) == 0


def test_windows_of_one_seed_are_told_apart_by_more_than_32_bits(docs):
    """The first six words are the seed of both, and 32 bits of the windows' hashes are equal."""
    one = "the quick phrase number 122173 of a360 b921 r1 r2 r3 r4 r5"
    other = "the quick phrase number 122173 of a591 b684 r1 r2 r3 r4 r5"
    (seeds, marks), (same, own) = (X.windows(X.word_hashes(t.encode().split()), 13) for t in (one, other))
    assert seeds[0] == same[0] and int(marks[0]) >> 32 == int(own[0]) >> 32 and marks[0] != own[0]
    rows = [(1, one), (2, other), (3, other)]
    for df in (docs(*rows).coalesce(1), docs(*rows).repartition(3)):
        assert got(df, 13) == plain(rows, 13)


def test_first_of_compares_both_numbers(monkeypatch):
    seeds, marks = (X.np.array(c, dtype="u8") for c in ([1, 1, 2, 1, 2, 1], [5, 6, 5, 5, 5, 6]))
    expected = [0, 1, 2, 0, 2, 1]
    assert X.first_of(seeds, marks).tolist() == expected
    monkeypatch.setattr(X, "pair_key", lambda s, m: X.np.zeros_like(s))
    assert X.first_of(seeds, marks).tolist() == expected


def equal_checksums():
    """Two texts without a common word whose CRC32 agree in 31 bits."""
    return [" ".join(f"q{i}x{j}" for j in range(14)) for i in (7392, 24198)]


def test_rows_of_one_id_with_equal_checksums_are_told_apart(docs):
    a, b = equal_checksums()
    rows = [(1, a), (None, a), (None, b), (5, b), (5, a)]
    assert got(docs(*rows), 13) == plain(rows, 13)
    rows = [(1, a), (7, a), (7, b), (7, b)]
    assert got(docs(*rows), 13) == plain(rows, 13)


def test_windows_of_a_phrase_in_a_third_of_all_rows_are_dealt_out(docs, monkeypatch):
    """A seed that many different windows share is hot; its windows get seeds of their own, the same for equal ones."""
    phrase = "alpha beta gamma delta epsilon zeta"
    rows = [(i, f"u{i % 40} v{i % 7} a{i} b{i % 5} {phrase} c{i % 3} d{i % 40} e{i % 2} f f f f g{i % 4}") for i in range(300)]
    rows += [(1000 + i, " ".join(f"x{i}y{k}" for k in range(30))) for i in range(600)]
    table = docs(*rows).repartition(4)
    texts = table.select(S.F.col("text").cast("binary").alias("text"))
    assert len(hot := S.hot_seeds(texts, 13)) and len(hot) <= S.HOT_SHARE
    hashes = X.word_hashes(rows[0][1].encode().split())
    with S.np.errstate(over="ignore"):
        seeds, _ = S._windows_of(hashes, 13, hot)
        plain_seeds, _ = S._windows_of(hashes, 13, hot[:0])
    spread = {int(s) for s, p in zip(seeds, plain_seeds) if p in hot}
    assert len(spread) > len({int(p) for p in plain_seeds if p in hot})
    assert got(table, 13) == plain(rows, 13)


def test_only_repeated_ids_carry_a_hash_of_the_text(docs):
    found = S._with_rows(docs((1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, None), (S.LAST - 1, "e"))).collect()
    assert {r.doc_id for r in found if r.row} == {2, None} and len({r.row for r in found}) == 5
