import re

from auditflow.llm import licenses as C

from .conftest import LONG

ROWS = [
    (1, "Released under the MIT License."),
    (2, "Licensed under CC-BY-NC 4.0 / cc by nc"),
    (3, "under the mit\nlicense under THE mit license; Apache License, Version 2.0"),
    (4, "mit license under the"),
    (5, None),
    (6, ""),
    (None, "this is the GNU General Public License, version 3 of it"),
    (7, "no such thing under ünder the mít license"),
    (8, LONG + "under the MIT license"),
    (8, LONG + "under the MIT license"),
    (9, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files "
        "to deal in the Software without restriction"),
    (10, "Permission is hereby granted, free of charge. " + "x " * 80 + "to deal in the software without restriction"),
    (11, "cc by cc by nc by nc"),
]


def plain(text):
    words = re.findall("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    found = {}
    for t in C.TEMPLATES:
        places = [[i for i in range(len(words)) if words[i:i + len(k.split())] == k.split()] for k in t.keys]
        found[t.label] = [
            s for s in places[0] if all(any(abs(f - s - g) <= C.SLACK for f in p) for p, g in zip(places[1:], t.gaps))
        ]
    base = [s for t in C.TEMPLATES if t.base for s in found[t.label]]
    labels = sorted(t.label for t in C.TEMPLATES if found[t.label])
    return (
        len(words), len(base), min(base, default=None), max(base, default=None),
        ",".join(x for x in labels if any(t.base and t.label == x for t in C.TEMPLATES)), ",".join(labels),
    )


def test_against_a_search_for_every_phrase(docs):
    got = C.scan(docs(*ROWS)).collect()
    assert [(r.doc_id, *r[1:7]) for r in got] == [(i, *plain(t)) for i, t in ROWS]
    assert all((r.score == 1) == bool(r.labels) and 0 <= r.score <= 1 for r in got)


def test_the_index_uses_the_rarest_words():
    assert C._rarest("under the mit license".split(), {"under": 9, "the": 99, "mit": 1, "license": 5}) == [("mit", 2), ("license", 3)]
    assert C._rarest(["a", "a"], {}) == [("a", 0)]


def test_empty_table(docs):
    assert C.scan(docs()).count() == 0
