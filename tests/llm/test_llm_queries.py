from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from saleloom.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import prose

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.execute(ORACLE[name])
    columns = sorted(c[0] for c in want.description)
    expected = sorted(want.df()[columns].itertuples(index=False, name=None))
    found = QUERIES[name](spark, FOLDER).select(*columns).collect()
    assert sorted(map(tuple, found)) == [tuple(x) for x in expected]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    if "doc_id" in rows[0]:
        documents = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
        assert {r.doc_id for r in rows} == documents


def test_pipeline_on_planted_documents(spark, tmp_path):
    rows = [(i, prose(i, 80), "en", "src0", 1) for i in range(30)]
    rows += [(30 + i, prose(i, 80), "en", "src1", 1) for i in range(5)]
    rows += [(40, prose(7, 78) + " new words", "fr", "src1", 1), (41, "", "en", "src1", 0), (42, None, "en", None, None)]
    rows += [(50 + i, " ".join(f"{w}$$$" for w in prose(i, 60).split()), "en", "src2", 1) for i in range(30)]
    rows += [(90, prose(90, 60) + " mail hein.19@mail5.example.com now", "en", "src0", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1) for i in range(25)] + [(50 + i, 0) for i in range(25)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert result.columns == docs.columns
            result.write.parquet(f"{tmp_path}/{name}.parquet")
            docs = spark.read.parquet(f"{tmp_path}/{name}.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/quality.parquet").collect()}
    assert good == {*range(35), 40, 90}
    unique = {r.doc_id for r in spark.read.parquet(f"{tmp_path}/near_duplicates.parquet").collect()}
    assert unique == {*range(30), 90}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert "hein.19" not in texts[90]
    assert texts[3] == prose(3, 80)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == unique
