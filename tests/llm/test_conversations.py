import heapq
import random
from itertools import product

import pytest

from auditflow.llm import conversations as V
from auditflow.llm.glr import Repairer

from .conftest import by_sql, rows_of

NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(symbols):
    """Least (cost, audit) by searching every edit in order of cost."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(symbols) and state in ("", "a"):
            return cost, audit
        go = lambda role, more, edit, to: role in NEXT[state] and heapq.heappush(heap, (cost + more, audit + edit, to, NEXT[state][role]))  # noqa: E731, B023
        for role in "ua":
            go(role, 3, "I", at)
        if at < len(symbols):
            symbol = symbols[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state))
            if symbol != "d":
                more = 3 * symbol.isupper()
                go(symbol.lower(), more, "K", at + 1)
                for role in "ua":
                    go(role, more + 3, "R", at + 1)


def test_every_short_sequence():
    parser = Repairer()
    for size in range(4):
        for symbols in map("".join, product("suaxSUAXd", repeat=size)):
            assert parser.repair(symbols) == cheapest(symbols)


@pytest.mark.parametrize("seed", range(5))
def test_runs_chained_are_the_whole(seed):
    draw, parser = random.Random(seed), Repairer()
    for _ in range(60):
        symbols = "".join(draw.choice("suaxSUAXd") for _ in range(draw.randint(1, 60)))
        size = draw.randint(1, 9)
        runs = [symbols[i:i + size] for i in range(0, len(symbols), size)]
        audits = list(parser.chained((len(r), parser.table(r)) for r in runs))
        assert (parser.cost(symbols, "".join(audits)), "".join(audits)) == parser.repair(symbols) == cheapest(symbols)
        assert [len(a.replace("I", "")) for a in audits] == [len(r) for r in runs]


def test_another_grammar():
    with pytest.raises(ValueError):
        Repairer({"S": ((), ("l", "S", "r"))}, "S", insertable="")
    pair = Repairer({"S": (("u", "a"), ("u", "u", "a"))}, "S")
    assert pair.repair("ua") == (0, "KK") and pair.repair("uua") == (0, "KKK") and pair.repair("") == (6, "II")


def conversations():
    draw = random.Random(9)
    roles = ["system", "user", "assistant", "tool", "", None, "user", "assistant", "use\nr"]
    texts = ["Yes.", "No!", "why", "", " \t\n", None, "Ünd?", "a.b", "long " * 50 + "end. ", "x "]
    rows = [(i, t, draw.choice(roles), draw.choice(texts)) for i in range(120) for t in range(draw.randint(1, 8))]
    rows += [(None, None, "user", "hi."), (None, None, "user", "hi."), (None, 4, None, None), (500, None, "user", None)]
    rows += [(500, 7, "user", "again."), (500, 7, "user", "again."), (500, 7, "assistant", "b."), (500, 12, "assistant", "b.")]
    rows += [(600, t, draw.choice(["user", "assistant"]), f"turn {t}" + draw.choice([".", ""])) for t in range(2, 400, 3)]
    return rows + [(700, 5, "user", "same.")] * 40


def table(spark, rows):
    df = spark.createDataFrame([(*r, "m", 3, 4) for r in rows], "conv_id long, turn long, role string, text string, mark string, copies int, kind int")
    return df.repartition(5)


@pytest.mark.parametrize("run", [1, 7, V.RUN])
def test_same_as_sql_on_odd_rows(spark, run):
    rows = conversations()
    names, expected = by_sql(V.OP12_SQL, conversations=("conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR", rows))
    found = V.summaries(V.repair(V.damaged(table(spark, rows)), run))
    ids = {r[0] for r in rows}
    got = rows_of(found, *names)
    at = names.index("conv_id")
    kept = {r[at] for r in got}
    assert sum((got - expected).values()) == 0
    missing = expected - got
    assert {r[at] for r in missing} == ids - kept
    assert all(not any(v for i, v in enumerate(r) if i not in (at, len(r) - 1)) for r in missing)


def test_repaired_rows(spark):
    rows = [(1, 1, "assistant", "hello."), (1, 2, "user", "what?"), (1, 3, "user", ""), (2, 1, "system", "Be."), (2, 2, "user", "Go.")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, copies int")
    fixed = V.repair(df)
    assert {r.conv_id: (r.cost, r.audit) for r in fixed.collect()} == {1: (10, "IKKDI"), 2: (3, "KKI")}
    got = sorted((r.conv_id, r.place, r.role, r.text) for r in V.repaired_rows(fixed).collect())
    assert [g[2:] for g in got[:4]] == [("user", ""), ("assistant", "hello."), ("user", "what?"), ("assistant", "")]
    assert got[4:] == [(2, 0, "system", "Be."), (2, 1, "user", "Go."), (2, 2, "assistant", "")]


def test_empty_table(spark):
    empty = table(spark, conversations()).limit(0)
    assert V.summaries(V.repair(V.damaged(empty))).count() == 0
