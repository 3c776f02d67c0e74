"""Small tables for the operators, with what real ones may hold in odd rows."""

from collections import Counter

import pytest

LONG = "word " * 30_000


@pytest.fixture
def docs(spark):
    """A table of documents from ``(doc_id, text)`` pairs, with columns that clash with inner names."""

    def make(*rows):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, n int, doc string, tag int, fp string, "
            "words string, place string, key string, size string, hash string, root string"
        )
        return spark.createDataFrame(
            [(i, t, None, None, None, 7, "x", 3, "y", "w", "p", "k", "s", "h", "r") for i, t in rows], schema
        )

    return make


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def by_sql(sql, **tables):
    """Rows of a query's SQL over small tables given as ``(column names and types, rows)``."""
    import duckdb

    con = duckdb.connect()
    for name, (columns, rows) in tables.items():
        con.execute(f"CREATE TABLE {name} ({columns})")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, Counter(cursor.fetchall())
