from __future__ import annotations

import corpus_pipeline
from tests.llm.conftest import prose


def test_near_duplicates_are_removed_by_row(spark):
    rows = [
        (3, prose(3, 80), "a"), (7, prose(7, 80), "b"), (7, prose(3, 78) + " new words", "c"),  # one id, one copy
        (8, prose(8, 80), "d"), (8, prose(9, 80), "e"),  # one id, unrelated texts
        (5, prose(5, 80), "f"), (5, prose(5, 80), "g"),  # repeated rows
        *[(None, prose(11, 80), "h") for _ in range(40)],  # copies without an id
        (None, prose(12, 80), "i"), (None, prose(8, 80), "j"),
        (20, "", "k"), (20, "", "k"), (21, "", "l"), (None, "", "m"), (None, None, "n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert found.columns == docs.columns
    kept = found.collect()
    assert sorted(r.source for r in kept if r.source not in "fg") == sorted("abdehiklmn")
    assert sum(r.source in "fg" for r in kept) == 1
