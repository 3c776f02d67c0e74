import pytest

from auditflow.llm import decontaminate as D

from .conftest import LONG, by_sql, rows_of

Q = "A train with Anna leaves Paris at 30 km per hour and Bob waits 30 minutes before he follows Anna at 45 km per hour to the same town."
OTHER = "Completely different question about the colour of seven clouds over one small village near the river bank in early spring."


@pytest.fixture
def items(spark):
    def make(*rows):
        return spark.createDataFrame([(*r, 1, "w") for r in rows], "item_id long, text string, at int, words string")

    return make


def test_canonical_words(spark):
    df = spark.createDataFrame([("He met Anna in Rome. Then 3,000.5 km. NASA is old: Yes",)], "text string")
    got = df.select(D.F.transform(D.tokens(D.F.col("text")), D.canonical).alias("w")).first().w
    assert got == ["he", "met", "<name>", "in", "<name>", "then", "<num>", "<unit>", "nasa", "is", "old", "yes"]


def found(docs, items, rows, questions=((1, Q), (2, OTHER)), **settings):
    got = D.leaks(docs(*rows), items(*questions), **settings).collect()
    return sorted(((r.doc_id, r.item_id, r.same_values) for r in got), key=str)


def test_exact_and_changed_values(docs, items):
    changed = Q.replace("Anna", "Zoe").replace("30", "12").replace("45", "99").replace("Bob", "Max").replace("Paris", "Oslo")
    rows = [(1, f"Some text before it. {Q} And after."), (2, f"intro words. {changed}"), (3, "nothing of the kind here " * 9)]
    assert found(docs, items, rows) == [(1, 1, True), (2, 1, False)]


def test_two_readings_in_one_document(docs, items):
    other = Q.replace("30", "12")
    assert found(docs, items, [(1, f"{Q} {other}")]) == [(1, 1, False)]


def test_share_of_an_item(docs, items):
    words = Q.split()
    most, few = " ".join(words[:22]), " ".join(words[:14])
    fewer = " ".join(words[:12])
    rows = [(1, most), (2, few), (3, fewer)]
    assert found(docs, items, rows) == [(1, 1, True), (2, 1, True)]
    assert found(docs, items, rows, share=0.2) == [(1, 1, True), (2, 1, True), (3, 1, True)]


def test_short_items(docs, items):
    rows = [(1, "we ask: why is it so? and go on"), (2, "why is it")]
    assert found(docs, items, rows, [(5, "Why is it so?"), (6, "!!"), (7, None), (8, "")]) == [(1, 5, True)]


def test_odd_rows(docs, items):
    rows = [(None, Q), (1, None), (2, ""), (3, LONG), (4, Q), (4, Q), (4, OTHER), (5, LONG + Q)]
    assert found(docs, items, rows, [(1, Q), (1, Q), (None, OTHER)]) == sorted(
        [(None, 1, True), (4, 1, True), (4, None, True), (5, 1, True)], key=str
    )
    df = docs(*rows)
    kept = D.clean(df, items((1, Q)))
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text == OTHER) for r in kept.collect()) == [(1, False), (2, False), (3, False), (4, True)]


def test_empty_tables(docs, items):
    assert D.leaks(docs(), items((1, Q))).count() == 0
    assert D.leaks(docs((1, Q)), items()).count() == 0
    assert D.clean(docs((1, Q)), items()).count() == 1


def test_slots_judged_per_window(docs, items):
    """One changed value leaves out its own windows only; 30 km and 30 minutes are two slots."""
    odd = Q.replace("at 30 km", "at 12 km").replace("30 minutes", "77 minutes")
    twice = Q.replace("with Anna", "with Zoe")
    whole = Q.replace("Anna", "Zoe")
    torn = "A train with Zoe leaves Paris at 30 km per hour and Bob waits 30 minutes before he follows Max at 45 miles."
    item = "A train with Anna leaves Paris at 30 km per hour and Anna waits 30 minutes before Anna follows Anna at 45 km."
    many = "A train with Zoe leaves Paris at 30 km per hour and Max waits 30 minutes before Tom follows Kim at 45 km."
    rows = [(1, odd), (2, twice), (3, whole), (4, f"intro {Q}"), (5, many), (6, torn), (7, LONG)]
    got = D.leaks(docs(*rows), items((1, Q), (2, item))).collect()
    by = {(r.doc_id, r.item_id): r for r in got}
    assert (by[1, 1].n_windows, by[1, 1].same_values) == (by[1, 1].item_windows, False)
    assert (by[2, 1].n_windows, by[2, 1].same_values) == (by[2, 1].item_windows - 4, True)
    assert (by[3, 1].n_windows, by[4, 1].n_windows) == (by[3, 1].item_windows,) * 2
    assert (3, 1) in by and not {(5, 2), (6, 2), (7, 1)} & set(by)
    kept = D.clean(docs(*rows), items((1, Q))).collect()
    assert not {1, 2, 3, 4} & {r.doc_id for r in kept}


def test_a_run_of_words_is_a_leak_whatever_its_share(docs, items):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    part = lambda a, n: " ".join(words[a:a + n])
    apart = f"{part(0, 12)} x {part(20, 12)}"
    rows = [(1, part(10, 29)), (2, f"a b {part(46, 13)}"), (3, part(5, 12)), (4, apart)]
    questions = items((1, " ".join(words)))
    assert sorted(r.doc_id for r in D.leaks(docs(*rows), questions).collect()) == [1, 2]
    assert sorted(r.doc_id for r in D.clean(docs(*rows), questions).collect()) == [3, 4]


def test_items_of_a_window_or_less(docs, items):
    """The first word may follow any other, and a short item is its own words and no template."""
    eight, six, measure = "What is the colour of the old house?", "Why does Anna run so far?", "12 km"
    rows = [
        (1, "so they ask What is the colour of the old house and go"), (2, f"so. {eight}"), (3, "they ask Why does Anna run so far"),
        (4, "they ask why does Max run so far"), (5, "a walk of 30 miles"), (6, "a walk of 12 km or so"), (7, "She said Zoe is the colour of"),
    ]
    got = D.leaks(docs(*rows), items((1, eight), (2, six), (3, measure))).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 1), (3, 2), (6, 3)]


NUMBERS = "Sort these: " + " ".join(str(i * 37 % 91) for i in range(40)) + " and give the sum of the first and the last of them."


def test_a_table_of_numbers_is_no_leak(docs, items):
    table = " ".join(str(i * 53 % 97) for i in range(10_000))
    megabyte = "\n".join(" ".join(str(i * j % 99_991) for i in range(1, 21)) for j in range(1, 9_000))
    rows = [(1, table), (2, megabyte), (3, f"{table} {NUMBERS}")]
    assert len(megabyte) > 900_000
    assert found(docs, items, rows, [(1, NUMBERS)]) == [(3, 1, True)]


def test_an_item_of_numbers_alone_is_found_by_its_own_words(docs, items):
    item = "3 1 4 1 5 9 2 6 5 3 5"
    rows = [(1, f"so {item} it is"), (2, "9 9 9 9 9 9 9 9 9 9 9 9")]
    assert found(docs, items, rows, [(1, item)]) == [(1, 1, True)]


def test_same_as_sql_on_odd_rows(docs, items):
    odd = Q.replace("at 30 km", "at 12 km").replace("with Anna", "with Zoe")
    rows = [(i, t) for i, t in enumerate([
        Q, odd, OTHER, f"He said {OTHER}", f"He said {Q} {odd}", Q.replace("30", "7"), NUMBERS, NUMBERS.replace("37", "38"),
        " ".join(Q.split()[:14]), " ".join(Q.split()[5:15]), None, "", "They ask Why is it so", Q.replace("Anna", "Eve"),
    ])] + [(None, Q), (3, Q), (3, Q)]
    questions = [(1, Q), (1, Q), (2, OTHER), (3, NUMBERS), (4, "Why is it so?"), (5, "7 7 7 7 7 7 7 7 7"), (None, odd), (6, None)]
    names, expected = by_sql(
        D.OP10_SQL, documents=("doc_id BIGINT, text VARCHAR", rows), benchmark=("item_id BIGINT, text VARCHAR", questions)
    )
    assert rows_of(D.leaks(docs(*rows), items(*questions)), *names) == expected
