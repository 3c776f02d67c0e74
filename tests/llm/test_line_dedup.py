import random
from collections import Counter

import pytest
import xxhash

from auditflow.llm import line_dedup as L

from .conftest import LONG, rows_of


def plain(rows, similarity=0.8, in_order=True):
    """Numbers of the lines that stay, by comparing each line with every earlier one."""
    tag = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) + (1 << 63)) % (1 << 64)
    lines = {}
    for i, t in rows:
        for k, line in enumerate([] if t is None else t.split("\n")):
            lines[(1 << 63) - 1 if i is None else i, tag(t), k] = frozenset(line.encode().split())
    order = sorted(lines)
    stays = {
        place for n, place in enumerate(order)
        if not lines[place] or not any(
            lines[p] and len(lines[p] & lines[place]) >= similarity * len(lines[p] | lines[place]) - 1e-9 for p in order[:n]
        )
    }
    out = []
    for i, t in rows:
        n = 0 if t is None else len(t.split("\n"))
        out.append((i, n, tuple(k for k in range(n) if ((1 << 63) - 1 if i is None else i, tag(t), k) in stays)))
    return sorted(out, key=str) if in_order else out


def got(df, **settings):
    return sorted(((r.doc_id, r.n_lines, tuple(r.kept)) for r in L.line_dedup(df, **settings).collect()), key=str)


def texts(n, seed):
    pick = random.Random(seed)
    vocabulary = [f"w{min(int(pick.expovariate(0.05)), 200)}" for _ in range(300)]
    lines = [" ".join(pick.choice(vocabulary) for _ in range(pick.randrange(1, 25))) for _ in range(25)]
    out = []
    for _ in range(n):
        text = []
        for _ in range(pick.randrange(6)):
            words = pick.choice(lines).split()
            for _ in range(pick.randrange(4)):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
            pick.shuffle(words)
            text.append(" ".join(words))
        out.append((pick.randrange(5 * n), "\n".join(text)))
    return out


@pytest.mark.parametrize("seed, similarity", [(1, 0.8), (2, 0.8), (3, 0.6), (4, 0.9)])
def test_against_all_pairs(docs, seed, similarity):
    rows = texts(120, seed)
    assert got(docs(*rows), similarity=similarity) == plain(rows, similarity)


ROWS = [
    (1, "a b c d e\n\nA b c d e"), (2, "a b c d e f\r\n \t\nx"), (2, "a b c d e f\nother"), (None, "a b c d e\nnew one"), (3, None), (4, ""),
    (5, LONG + "\n" + LONG), (5, LONG + "\n" + LONG), (6, "word"), (7, "q\nq\nq"), (0, "\n\n"), (8, "x  x\ty"), (9, "y x"),
]


def test_odd_rows(docs):
    assert got(docs(*ROWS)) == plain(ROWS)


def test_text_of_the_lines_that_stay(docs):
    df = docs(*ROWS)
    kept = L.without_repeated_lines(df)
    assert kept.columns == df.columns
    expected = []
    for (i, _, numbers), (_, t) in zip(plain(ROWS, in_order=False), ROWS):
        lines = [] if t is None else t.split("\n")
        left = None if t is None else "\n".join(lines[k] for k in numbers)
        if t is None or not t.split() or any(lines[k].split() for k in numbers):
            expected.append((i, left, None if left is None else len(left)))
    assert rows_of(kept, "doc_id", "text", "n_chars") == Counter(expected)


def test_empty_table(docs):
    assert L.line_dedup(docs()).count() == 0
    assert L.without_repeated_lines(docs()).count() == 0
    assert got(docs((1, None), (2, " "))) == [(1, 0, ()), (2, 1, (0,))]


def test_rows_of_one_id_with_equal_checksums_are_told_apart(docs):
    a, b = (" ".join(f"q{i}x{j}" for j in range(14)) for i in (7392, 24198))
    found = L.line_dedup(docs((1, a), (None, a), (None, b), (3, a), (3, b))).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("1", 0), ("3", 0), ("3", 1), ("None", 1), ("None", 1)]


def test_postings_carry_no_lists_of_words(docs, monkeypatch):
    kinds, stage = {}, L.stage
    monkeypatch.setattr(L, "stage", lambda df, name: (kinds.update({name: [kind for _, kind in df.dtypes]}), stage(df, name))[1])
    rows = texts(60, 5)
    assert got(docs(*rows)) == plain(rows)
    assert not any(kind.startswith("array") for kind in kinds["line-entries"] + kinds["line-pairs"])


BLANKS = (" ", "  ", "\t", "\r", "\x0b", "\x0c", " \t ", "\x0c\x0b")


def test_lines_with_any_blanks_have_the_same_words(docs):
    words = ["one", "two", "three", " four", "five\x85", "six", "seven", "eight"]
    rows = [(1, " ".join(words)), *((i, blank + blank.join(words) + blank) for i, blank in enumerate(BLANKS, 2))]
    rows += [(100, "\n".join(blank.join(words[1:]) + " nine" for blank in BLANKS)), (101, "\t".join(words[:5])), (102, " \r\n" + " ".join(words[:5]) + " ")]
    assert got(docs(*rows)) == plain(rows)


def test_a_pair_that_shares_several_rare_words_is_found_once(docs, spark):
    a, b = (" ".join(f"v{j}" for j in range(k, k + 60)) for k in (0, 3))
    prefixes = {1: [10, 11, 12, 20, 21, 30, 31], 2: [10, 11, 13, 20, 21, 30, 32]}
    described = [
        (i, i, 60, 0, 0, 0, 0, pos, word, words[pos - 1] if pos else None) for i, words in prefixes.items() for pos, word in enumerate(words)
    ]
    postings = spark.createDataFrame(
        described, "doc long, place long, n int, bits0 long, bits1 long, bits2 long, bits3 long, pos int, word long, before long"
    )
    found = L._later(postings, postings, L.SIMILARITY).collect()
    assert [(r.doc, r.place, r.e_doc, r.e_place) for r in found] == [(2, 2, 1, 1)]
    assert got(docs((1, a), (2, b))) == plain([(1, a), (2, b)])
