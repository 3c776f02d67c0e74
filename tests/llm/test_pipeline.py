"""The pipeline on the small tables, and its stages on planted rows."""

from pathlib import Path

import pytest

import corpus_pipeline as P

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The small tables' documents and planted ones, in a folder with the other tables."""
    folder = tmp_path_factory.mktemp("planted")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first().text
    text = max((r.text for r in docs.collect()), key=lambda t: len(set(t.split())))
    words = text.split()
    extra = [
        (10_001, "12 34 56", "en", "src1", 8),
        (10_002, None, None, None, None),
        (10_003, " ".join(words[1:]), "en", "src0", 1),
        (10_004, "of the and " + item, "en", "src0", 1),
    ]
    docs.union(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    return str(folder), docs.columns


def test_stages_take_effect(spark, planted):
    folder, columns = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, apply in P.STAGES[:-1]:
        docs = P.stage(apply(spark, docs, folder), name)
        assert docs.columns == columns
        seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert not {10_001, 10_002} & seen["language_id"] and {10_003, 10_004} <= seen["language_id"]
    assert 10_003 not in seen["simhash_near_dedup"]
    assert 10_004 in seen["line_dedup"] and 10_004 not in seen["benchmark_decontamination"]
    # Documents without a fault stay.
    assert len(seen["benchmark_decontamination"]) > 0.7 * len(seen["language_id"])
    mixed = P.mix_sources(spark, docs, folder).collect()
    assert {r.doc_id for r in mixed} == seen["benchmark_decontamination"]
    for source in {r.source for r in mixed}:
        rows = [r for r in mixed if r.source == source]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1


def test_run_gives_the_last_stage(spark):
    again = [sorted(map(str, P.run(spark, SF_DIR).collect())) for _ in range(2)]
    assert again[0] and again[0] == again[1]
