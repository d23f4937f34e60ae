"""Column, duplicate, join, key and quantile operators against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleloom import schemas
from saleloom.operators import columns, dedup, joins, quantiles, work
from saleloom.operators.keys import dense_keys


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["  Số   lượng ", "b"])
    assert columns.normalize_columns(df).columns == ["Số lượng", "b"]
    with pytest.raises(ValueError, match="collide"):
        columns.normalize_columns(spark.createDataFrame([(1, 2)], ["a ", " a"]))


def test_accent_free_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["Đơn  giá", "Số lượng (KG )"])
    assert columns.accent_free_columns(df).columns == ["Don gia", "So luong (KG )"]


def test_require_and_existing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, x int")
    got = columns.require(df, {"b": T.StringType(), "a": T.IntegerType()})
    assert got.columns == ["b", "a"]
    assert got.schema["b"].dataType == T.StringType()
    assert got.first() == (None, 1)
    assert columns.existing(df, ["x", "nope", "a"]).columns == ["x", "a"]


def test_business_names_round_trip(spark):
    for source, layout in (("historical", schemas.HISTORICAL), ("current", schemas.CURRENT), ("cost", schemas.COST)):
        df = spark.createDataFrame([], schemas.struct(layout))
        business = schemas.to_business(df, source)
        assert business.columns == [b for b, _, _ in layout]
        assert schemas.to_canonical(business, layout).columns == df.columns
    assert len(schemas.SALES) == 38


@pytest.mark.parametrize("chunk", [2, 3, 100_000])
def test_flag_duplicates(spark, chunk):
    data = [(1, "a", 0.0)] * 7 + [(1, "a", None)] * 2 + [(None, None, None)] * 3 + [(2, "b", 1.5)] + [(3, "c", -0.0), (3, "c", 0.0)]
    got = rows(dedup.flag_duplicates(spark.createDataFrame(data, "a int, b string, c double"), chunk=chunk))
    expected = Counter()
    for row, n in Counter(data).items():
        expected[(*row, False)] += 1
        if n > 1:
            expected[(*row, True)] += n - 1
    assert got == expected


def test_hot_copies_are_spread_over_tasks(spark):
    df = spark.range(4000).select(F.lit("same").alias("a"))
    flagged = dedup.flag_duplicates(df, chunk=100)
    sizes = [r[1] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000
    assert max(sizes) <= 1500


def test_keep_last(spark):
    data = [("x", 1, "old"), ("x", 3, "new"), ("x", 2, None), (None, 5, "n2"), (None, 1, "n1")]
    got = dedup.keep_last(spark.createDataFrame(data, "k string, o int, v string"), "k", ["o"])
    assert rows(got) == Counter([("x", 3, "new"), (None, 5, "n2")])


def test_keep_first(spark):
    data = [("x", "2026", 1, "late"), ("x", "2025", 9, "early"), ("x", "2025", None, "undated"), ("y", "2026", 2, None), ("y", "2026", 2, "b")]
    df = spark.createDataFrame(data, "k string, s string, o int, v string")
    assert rows(dedup.keep_first(df, "k", ["v"], ["s", "o"])) == Counter([("x", "early"), ("y", None)])
    known = dedup.keep_first(df, "k", ["v"], ["s", "o"], prefer=F.coalesce(F.col("v") == "late", F.lit(False)))
    assert rows(known)[("x", "late")] == 1


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 10}])
def test_lookup_join(spark, limits):
    data = [("hot", i) for i in range(95)] + [(None, i) for i in range(40)] + [("rare", 1), ("missing", 2)]
    left = spark.createDataFrame(data, "k string, i int").repartition(5)
    right = spark.createDataFrame([("hot", 1), ("rare", 2), (None, 3), ("unused", 4)], "k string, v int")
    got = joins.lookup_join(left, right, "k", **limits)
    assert got.columns == ["k", "i", "v"]
    values = {"hot": 1, "rare": 2, None: 3}
    assert rows(got) == Counter((k, i, values.get(k)) for k, i in data)


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "hot_rows": 5}])
def test_lookup_join_on_two_keys(spark, limits):
    data = [("a", None, i) for i in range(30)] + [("a", 1, 0), ("b", 1, 0)]
    left = spark.createDataFrame(data, "k string, j int, i int")
    right = spark.createDataFrame([("a", None, 7), ("a", 1, 8)], "k string, j int, v int")
    values = {("a", None): 7, ("a", 1): 8}
    got = joins.lookup_join(left, right, ["k", "j"], **limits)
    assert rows(got) == Counter((k, j, i, values.get((k, j))) for k, j, i in data)


def test_salting_spreads_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.range(8000).select(F.lit("hot").alias("k"), "id").repartition(8)
        right = spark.createDataFrame([("hot", 1)], "k string, v int")
        got = joins.lookup_join(left, right, "k", broadcast_bytes=0, hot_rows=250).hint("merge")
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 8000
    assert max(sizes) <= 3000


def test_dense_keys_equal_row_number(spark):
    names = [f"n{(i * 37) % 500:03d}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string").repartition(7)
    got = dense_keys(df, "id", ["n"]).collect()
    expected = {n: i + 1 for i, n in enumerate(sorted(names))} | {None: 501}
    assert {r["n"]: r["id"] for r in got} == expected


def test_dense_keys_with_ties_and_without_order(spark):
    df = spark.range(1000).select(F.lit(1).alias("c"), "id").repartition(6)
    for order in (["c"], []):
        keys = [r[0] for r in dense_keys(df, "key", order).select("key").collect()]
        assert sorted(keys) == list(range(1, 1001))


def test_freeze_uses_the_shared_folder(spark):
    assert work.work_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    frozen = work.freeze(spark.range(5), "t")
    assert frozen.count() == 5
    assert work.work_folder(spark) in frozen.inputFiles()[0]


@pytest.mark.parametrize("small_rows", [10**9, 0])
@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_exact_quantiles(spark, small_rows, by):
    rng = np.random.default_rng(5)
    n = 4000
    data = [
        (
            None if i % 5 == 0 else f"g{i % 3}",
            int(i % 2),
            None if i % 11 == 0 else float(rng.lognormal(3, 2)),
            float("nan") if i % 7 == 0 else float(rng.integers(0, 4)),
            None,
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "g string, h int, x double, y double, z double").repartition(6)
    probabilities = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = quantiles.exact_quantiles(df, ["x", "y", "z"], probabilities, by, small_rows=small_rows)
    positions = {"g": 0, "h": 1}
    groups = {}
    for row in data:
        groups.setdefault(tuple(row[positions[b]] for b in by), []).append(row)
    result = {tuple(r[b] for b in by): r for r in got.collect()}
    assert set(result) == set(groups)
    for group, members in groups.items():
        for name, position in (("x", 2), ("y", 3)):
            valid = [m[position] for m in members if m[position] is not None and m[position] == m[position]]
            assert result[group][name] == pytest.approx(np.quantile(valid, probabilities), rel=1e-12)
        assert result[group]["z"] is None


def test_quantiles_recover_from_a_missed_bracket(spark, monkeypatch):
    # Brackets that lie outside the data force the pass over the whole range.
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *a, **k: F.array(*[F.lit(1e9)] * 4))
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    got = quantiles.exact_quantiles(df, ["x"], (0.25, 0.75), small_rows=0).first()
    assert got["x"] == [25.0, 75.0]
