from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from saleloom.llm import head_tail, line_dedup

BLANK = " \t\n\x0b\f\r"


def brute(rows, min_chars=1, min_docs=10):
    """(id, text, lines, dropped) of every row, in plain Python."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    keys = [[line.strip(BLANK).translate(lower) for line in (text or "").split("\n")] for _, text in rows]
    count = Counter(k for ks in keys for k in set(ks) if len(k) >= min_chars)
    out = []
    for (i, text), ks in zip(rows, keys, strict=True):
        lines = (text or "").split("\n")
        kept = [line for line, k in zip(lines, ks, strict=True) if count[k] < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def rows_of(df, **options):
    return sorted((tuple(r) for r in line_dedup.drop_shared_lines(df, **options).collect()), key=str)


def corpus():
    rows = [(i, f"Shared LINE\nown {i}\n  shared line\t\n\nÄrger {i % 3}\nlicense Ä {i % 2}") for i in range(24)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "shared line"), (None, "shared line"), (103, "SHARED LINE"),
             (104, "\n".join(["shared line", "x"] * 5000)), (105, " shared line"), (7, "again\nshared line")]
    return rows


@pytest.mark.parametrize("options", [{}, {"min_docs": 1}, {"min_docs": 8, "min_chars": 12}, {"min_docs": 2, "min_chars": 0}])
def test_equals_brute_force(spark, options):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(df, **options) == brute(rows, **options)


def test_tail_keys_take_the_shuffle(spark, monkeypatch):
    """With few head keys the rest is found by the shuffled join, with the same result."""
    monkeypatch.setattr(line_dedup, "look_up", lambda *a: head_tail.look_up(*a, head_keys=2))
    rows = corpus()
    assert rows_of(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_edge_rows(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    named = edge_docs.withColumn("text.x", F.lit(1)).withColumn("h1", F.lit(2)).withColumn("dropped", F.lit(3))
    assert rows_of(named, min_docs=2) == brute(rows, min_docs=2)
    assert rows_of(no_docs) == []


def test_copies_are_documents(spark):
    rows = [(1, "a copy\nof one")] * 3000 + [(2, "something else")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert rows_of(df) == brute(rows)
