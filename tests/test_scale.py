"""What is shuffled, stored and read again, and that results do not depend on it."""

from __future__ import annotations

import pytest

from saleloom.checks import queries, tables
from saleloom.operators import dedup, kpi, quality
from saleloom.plans import marts

FOLDER = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark):
    """Lines with missing grain values, missing members and members in several cells."""
    grain = ("year", "month", "quarter", "year_month", "period", "channel", "product_group", "region", "customer_group")
    rows = []
    for i in range(60):
        month = i % 5 + 1
        cell = (None if i % 7 == 0 else 2020 + i % 2, month, (month + 2) // 3, f"2020-{month:02d}", "p", None if i % 11 == 0 else f"c{i % 3}", f"g{i % 4}", None, f"k{i % 2}")
        rows.append((*cell, None if i % 13 == 0 else f"d{i // 3}", f"u{i % 9}", f"a{i % 6}", *[float(i + m) for m in range(len(kpi.MEASURES))]))
    dtypes = {"year": "int", "month": "int", "quarter": "int"}
    names = [*grain, *kpi.COUNTS.values()]
    schema = ", ".join([*[f"{c} {dtypes.get(c, 'string')}" for c in names], *[f"{m} double" for m in kpi.MEASURES]])
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("bits", [kpi._CELL_BITS, 0])
def test_marts_count_members_in_one_shuffle(lines, monkeypatch, bits):
    monkeypatch.setattr(kpi, "_CELL_BITS", bits)
    built = marts.kpi_marts(lines)
    for name in ("mart_overview_year", "mart_channel_product"):
        grain = kpi.GRAINS[name]
        want = sorted(map(tuple, kpi.aggregate_kpi(lines, grain).collect()), key=str)
        assert sorted(map(tuple, built[name].collect()), key=str) == want
        assert ("kpi-members" in "".join(built[name].inputFiles())) == (bits == 0)


@pytest.mark.parametrize("bits", [dedup._WORD_BITS, 0])
def test_stored_rows_are_flagged_like_others(spark, monkeypatch, bits):
    """With one word for all hashes some single rows are taken for candidates; the flags stay the same."""
    monkeypatch.setattr(dedup, "_WORD_BITS", bits)
    monkeypatch.setattr(dedup, "_WORDS", 1 << bits)
    data = [(i % 40, None if i % 8 == 0 else f"t{i % 40}", i) for i in range(60)] + [(100 + i, "x", i) for i in range(200)]
    df = spark.createDataFrame(data, "k int, t string, at long")
    rows = df.drop("at")
    assert sorted(dedup.flag_duplicates(rows, stored=True).collect(), key=str) == sorted(dedup.flag_duplicates(rows).collect(), key=str)
    later = {r["at"] for r in dedup.flag_later_copies(df, "at").where("is_duplicate").collect()}
    assert later == set(range(40, 60))


def test_rows_without_copies_are_not_compared(spark):
    df = spark.range(1000).selectExpr("id % 990 AS k", "'x' AS t")
    again, once = dedup.split_by_hash(df.select("*", *dedup.row_hash(df.columns)))
    assert (again.count() + once.count(), once.select("k").distinct().count() - once.count()) == (1000, 0)
    assert 20 <= again.count() < 40


def test_stored_tables_count_duplicates_by_hash(spark):
    df = spark.createDataFrame([(1, True), (1, False), (1, False), (2, None)], "x int, is_duplicate boolean")
    assert quality.duplicate_counts({"t": df}, stored=True).collect() == quality.duplicate_counts({"t": df}).collect()


def test_customers_nations_and_regions_meet_orders(spark, monkeypatch):
    """Without small tables all are joined by shuffles, but lines take part in just those for parts, orders and suppliers."""
    monkeypatch.setattr(tables, "SMALL_LOOKUP_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(tables.sales_view(spark, FOLDER, ["branch", "region", "product_type", "channel", "customer_name"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x]
    assert len(joins) == 6 and sum("l_" in x.split("SortMergeJoin")[1] for x in joins) == 3


def test_small_tables_are_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(tables.raw_current(spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1


def test_outlier_flags_read_a_stored_view(spark):
    assert not any("lineitem" in f for f in queries.QUERIES["outlier_flags"](spark, FOLDER).inputFiles())


def test_flags_are_set_before_other_columns_are_derived(spark):
    """The shuffle for the flags carries the source's columns alone."""
    plan = _plan(queries._historical(spark, FOLDER, True))
    shuffled = [x for x in plan.splitlines() if "Exchange hashpartitioning(doc_date" in x]
    assert shuffled and not any("year_month" in x for x in shuffled)


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """The small tables with rows that come twice, lines and orders without keys or dates, and a supplier that is missing."""
    folder = str(tmp_path_factory.mktemp("odd"))
    for name in ("customer", "supplier", "part", "orders", "lineitem", "nation", "region"):
        df = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        first = df.columns[0]
        some = df.limit(3)
        more = some.unionByName(some.withColumn(first, spark_lit_null(df.schema[first].dataType)))
        if name == "orders":
            more = more.unionByName(df.limit(6).withColumn("o_orderdate", spark_lit_null(df.schema["o_orderdate"].dataType)))
        if name == "supplier":
            df = df.where("s_suppkey <> 5")
        df.unionByName(more).write.parquet(f"{folder}/{name}.parquet")
    return folder


def spark_lit_null(kind):
    return queries.F.lit(None).cast(kind)


def test_sales_in_portions_are_the_same(spark, odd_tables, monkeypatch):
    """Portions are parsed and stored one by one, and what is left to shuffle are rows whose hash occurs again."""
    want = sorted(map(str, queries.QUERIES["unified_sales"](spark, odd_tables).collect()))
    monkeypatch.setattr(tables, "PORTION_BYTES", 40_000)
    assert len(list(tables.portions(spark, odd_tables))) > 2
    found = queries.QUERIES["unified_sales"](spark, odd_tables)
    files = "".join(found.inputFiles())
    assert "/parsed-" in files and "lineitem" not in files
    assert sorted(map(str, found.collect())) == want


def test_overview_of_portions_is_the_same(spark, odd_tables, monkeypatch):
    """Neither raw nor historical sales are stored at full width; both are made of the stored lines or parsed rows."""
    want = sorted(queries.QUERIES["quality_overview"](spark, odd_tables).collect())
    monkeypatch.setattr(tables, "PORTION_BYTES", 40_000)
    found = queries.QUERIES["quality_overview"](spark, odd_tables)
    files = "".join(found.inputFiles())
    assert "/lines-" in files and "/parsed-" in files and "/raw-" not in files and "/historical-" not in files
    assert sorted(found.collect()) == want


def test_copies_are_counted_in_passes(spark, monkeypatch):
    df = spark.createDataFrame([(i % 70, None if i % 7 == 0 else "t") for i in range(100)] + [(1000 + i, "x") for i in range(50)], "k int, t string")
    want = df.count() - df.distinct().count()
    stored, freeze = [], dedup.freeze
    monkeypatch.setattr(dedup, "freeze", lambda df, name, **more: stored.append(name) or freeze(df, name, **more))
    monkeypatch.setattr(dedup, "COMPARED", 10)
    assert want > 10 and dedup.count_copies(df, df.columns) == want
    assert stored.count("again") > 1
    assert dedup.count_copies(df.where("k < 0"), df.columns) == 0
