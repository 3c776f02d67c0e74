"""Registered text queries against their SQL on the small tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from auditflow.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", ORACLE)
def test_same_rows_as_sql(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = tables.execute(ORACLE[name])
    named = [d[0] for d in cursor.description]
    assert sorted(named) == sorted(df.columns)
    expected = Counter(cursor.fetchall())
    assert expected and Counter(tuple(r[c] for c in named) for r in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_a_row_for_each_document(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    assert sorted(r.doc_id for r in got.collect()) == ids
