"""Cleaning, unification, marts and reports on small inline tables and on the derived test data."""

from __future__ import annotations

import datetime
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from saleloom import schemas, vocab
from saleloom.checks import tables
from saleloom.operators import kpi, outliers, quality, reports, star
from saleloom.operators import forecast as fc
from saleloom.operators.joins import lookup_join
from saleloom.plans import cleaning, marts, stages, unify
from saleloom.plans.stages import sheet_paths

FOLDER = "/root/testdata/sf0.001"
DAY = datetime.datetime


@pytest.fixture(scope="module")
def sales(spark):
    """Unified sales from the derived raw sources, cached for the properties below."""
    historical = cleaning.clean_historical(tables.raw_historical(spark, FOLDER))
    cost = cleaning.clean_cost(tables.raw_cost(spark, FOLDER))
    current = cleaning.clean_current(tables.raw_current(spark, FOLDER), cost)
    return unify.unify_sales(historical, current).cache()


def raw(spark, layout, *records):
    schema = ", ".join(f"{c} string" for c in schemas.columns(layout))
    return spark.createDataFrame([tuple(r.get(c) for c in schemas.columns(layout)) for r in records], schema)


def test_clean_historical(spark):
    line = {"doc_date": "2024-03-05", "doc_no": " A1 ", "month": "11", "channel": "horeca", "profit": "x", "net_revenue": "10", "returned": "CO", "source_sheet": "2024"}
    got = cleaning.clean_historical(raw(spark, schemas.HISTORICAL, line, line, {**line, "source_sheet": "copy"}))
    assert set(got.columns) == {*schemas.columns(schemas.HISTORICAL), "year", "quarter", "year_month", "period", "data_source", "unit_cost", "total_cost", "profit_recomputed", "has_cost", "is_duplicate"}
    assert len(got.columns) == 29
    found = got.collect()
    assert Counter(r["is_duplicate"] for r in found) == {False: 2, True: 1}
    first = found[0]
    assert (first["doc_no"], first["month"], first["quarter"], first["year_month"]) == ("A1", 3, 1, "2024-03")
    assert (first["channel"], first["returned"], first["profit"], first["quantity"]) == ("HORECA", "Có", 0.0, 0.0)
    assert first["total_cost"] is None and first["has_cost"] is False
    assert first["period"] == vocab.PERIOD_BEFORE


def _cost(spark, *records):
    names = schemas.columns(schemas.COST)
    data = [(*[r.get(c) for c in names], i) for i, r in enumerate(records)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in names) + ", row_order int")


def test_cost_enrichment(spark):
    cost = cleaning.clean_cost(
        _cost(spark, {"product_code": "P1", "unit_cost": "1"}, {"product_code": " P1", "unit_cost": "2", "std_name": "One", "std_group": "HOA TAN"}, {"product_code": "", "unit_cost": "5"})
    )
    assert cost.count() == 2
    lines = [
        {"product_code": "P1", "quantity": "3", "net_revenue": "10", "return_value": "-4"},
        {"product_code": None, "quantity": "1", "net_revenue": "10", "return_value": "4"},
        {"product_code": "P9", "quantity": "2", "net_revenue": "10", "product_name": "Own"},
    ]
    got = cleaning.clean_current(raw(spark, schemas.CURRENT, *lines), cost)
    assert len(got.columns) == 39
    found = {r["product_code"]: r for r in got.collect()}
    assert (found["P1"]["total_cost"], found["P1"]["profit"], found["P1"]["has_cost"], found["P1"]["returned"]) == (6.0, 4.0, True, "Không")
    assert (found[None]["total_cost"], found[None]["returned"]) == (5.0, "Có")
    assert (found["P9"]["total_cost"], found["P9"]["profit"], found["P9"]["has_cost"]) == (0.0, 10.0, False)
    unified = unify.unify_sales(cleaning.clean_historical(raw(spark, schemas.HISTORICAL)), got)
    names = {r["product_code"]: (r["product_name"], r["product_group"]) for r in unified.collect()}
    assert names == {"P1": ("One", "Hòa tan"), vocab.UNKNOWN: (vocab.NO_DATA, vocab.UNKNOWN), "P9": ("Own", vocab.UNKNOWN)}


def test_unified_history_back_fills_cost(spark):
    lines = [
        {"net_revenue": "100", "profit": "30", "quantity": "7", "gross_sales": "0"},
        {"net_revenue": "0", "profit": "-5", "quantity": "0", "gross_sales": "10"},
    ]
    got = unify.align_historical(cleaning.clean_historical(raw(spark, schemas.HISTORICAL, *lines)))
    found = {r["net_revenue"]: r for r in unify.add_analysis_columns(got).collect()}
    a, b = found[100.0], found[0.0]
    assert (a["total_cost"], a["unit_cost"], a["profit_recomputed"], a["margin"]) == (70.0, 10.0, 30.0, 0.3)
    assert a["discount_rate"] is None and a["return_rate"] is None
    assert (b["total_cost"], b["unit_cost"], b["margin"], b["discount_rate"]) == (5.0, None, None, 0.0)
    assert (a["customer_name"], a["branch"], a["customer_code"]) == (vocab.NO_DATA, vocab.NOT_APPLICABLE, vocab.UNKNOWN)


def test_row_conservation(spark, sales):
    inputs = tables.raw_historical(spark, FOLDER).count() + tables.raw_current(spark, FOLDER).count()
    assert sales.count() == inputs
    assert sales.columns == schemas.columns(schemas.SALES)
    assert sales.filter(" OR ".join(f"{c} IS NULL" for c in vocab.LABEL_DEFAULTS)).count() == 0


def test_flagged_duplicates_of_sources(spark):
    source = tables.raw_historical(spark, FOLDER)
    flagged = cleaning.clean_historical(source)
    distinct = flagged.drop("is_duplicate").distinct().count()
    assert flagged.filter("is_duplicate").count() == flagged.count() - distinct


def test_profit_consistency(sales):
    gap = F.abs(F.col("profit_recomputed") - (F.col("net_revenue") - F.col("total_cost")))
    assert sales.filter(gap > 1e-9).count() == 0
    for value, base in (("margin", "net_revenue"), ("discount_rate", "gross_sales"), ("return_rate", "gross_sales")):
        assert sales.filter(F.col(value).isNull() != (F.coalesce(F.col(base), F.lit(0.0)) == 0)).count() == 0


def test_star_schema(sales):
    tables_ = star.star_schema(sales)
    fact = tables_["fact_sales"].cache()
    n = sales.count()
    assert fact.columns == list(star.FACT_COLUMNS)
    assert (fact.count(), fact.agg(F.min("sales_id"), F.max("sales_id"), F.count_distinct("sales_id")).first()) == (n, (1, n, n))
    for dim, key, natural in (("dim_customer", "customer_key", "customer_code"), ("dim_product", "product_key", "product_code"), ("dim_channel", "channel_key", "channel")):
        members = tables_[dim].orderBy(key).collect()
        assert [m[key] for m in members] == list(range(1, len(members) + 1))
        assert [m[natural] for m in members] == sorted(r[0] for r in sales.select(natural).distinct().collect())
        assert fact.filter(f"{key} IS NULL").count() == 0
    assert fact.filter("date_key IS NULL").count() == sales.filter("doc_date IS NULL").count()
    total = sales.agg(F.sum("net_revenue")).first()[0]
    assert fact.agg(F.sum("net_revenue")).first()[0] == pytest.approx(total)


def test_dimension_prefers_first_or_known(spark):
    data = [("2023-2025", 1, "c1", vocab.NO_DATA, "g"), ("2026", 2, "c1", "Real", "g2"), ("2026", 1, None, "Nobody", None), ("2026", 9, vocab.UNKNOWN, "x", None)]
    df = spark.createDataFrame(data, "data_source string, doc_date int, customer_code string, customer_name string, customer_group string")
    first = {r["customer_code"]: tuple(r) for r in star.dim_customer(df).collect()}
    assert first == {vocab.UNKNOWN: (1, vocab.UNKNOWN, "Nobody", None), "c1": (2, "c1", vocab.NO_DATA, "g")}
    known = {r["customer_code"]: r["customer_name"] for r in star.dim_customer(df, prefer="known").collect()}
    assert known["c1"] == "Real"


def test_kpi_edge_values(spark):
    data = [(None, None, None, "d1"), (None, 2.0, float("nan"), "d1"), (2024, 0.0, 5.0, None)]
    df = spark.createDataFrame(data, "year int, net_revenue double, profit double, doc_no string")
    for m in kpi.MEASURES:
        if m not in df.columns:
            df = df.withColumn(m, F.lit(None).cast("double"))
    df = df.withColumns({"customer_code": F.lit("c"), "product_code": F.lit(None).cast("string")})
    got = {r["year"]: r for r in kpi.aggregate_kpi(df, ["year"]).collect()}
    assert (got[None]["net_revenue"], got[None]["profit"], got[None]["orders"], got[None]["products"]) == (2.0, 0.0, 1, 0)
    assert (got[2024]["margin"], got[2024]["avg_order_value"], got[2024]["discount_rate"]) == (None, None, None)
    approximate = kpi.aggregate_kpi(df, ["year"], approximate=True)
    assert {r["year"]: r["orders"] for r in approximate.collect()} == {None: 1, 2024: 0}


def test_marts_like_pandas_and_one_pass(sales):
    pdf = sales.toPandas()
    built = marts.kpi_marts(sales)
    assert set(built) == {*kpi.GRAINS, "mart_pareto_customer_group"}
    for name, grain in kpi.GRAINS.items():
        direct = kpi.aggregate_kpi(sales, grain).toPandas().sort_values(list(grain)).reset_index(drop=True)
        shared = built[name].toPandas().sort_values(list(grain)).reset_index(drop=True)
        pd.testing.assert_frame_equal(shared[direct.columns], direct, check_dtype=False, rtol=1e-12)
        groups = pdf.groupby(list(grain), dropna=False)
        expected = groups.agg(net_revenue=("net_revenue", "sum"), orders=("doc_no", "nunique"), products=("product_code", "nunique")).reset_index()
        expected = expected.sort_values(list(grain)).reset_index(drop=True)
        for c in ("net_revenue", "orders", "products"):
            np.testing.assert_allclose(direct[c].astype(float), expected[c].astype(float), rtol=1e-9)
        for m in kpi.MEASURES:
            assert direct[m].sum() == pytest.approx(pdf[m].sum(), rel=1e-9)


def test_pareto(spark):
    data = [(2024, "a", 50.0), (2024, "b", 30.0), (2024, "c", 10.0), (2024, "d", 10.0), (2025, "x", 0.0), (2026, "solo", 3.0), (None, "n", 9.0)]
    df = spark.createDataFrame(data, "year int, customer_group string, net_revenue double")
    got = {(r["year"], r["customer_group"]): r for r in reports.pareto(df, "net_revenue", ["customer_group"]).collect()}
    running = [got[2024, g]["cumulative_share"] for g in "abcd"]
    assert running == pytest.approx([0.5, 0.8, 0.9, 1.0])
    assert [got[2024, g]["pareto_class"] for g in "abcd"] == ["Top 80%", "Top 80%", "Còn lại", "Còn lại"]
    assert got[2025, "x"]["revenue_share"] is None and got[None, "n"]["cumulative_share"] is None
    assert (got[2026, "solo"]["revenue_share"], got[2026, "solo"]["pareto_class"]) == (1.0, "Còn lại")
    assert got[None, "n"]["pareto_class"] == "Còn lại"


def test_growth_like_pct_change(spark):
    data = [(2021, 10.0), (2022, 15.0), (2023, None), (2024, 0.0), (2025, 4.0)]
    got = reports.growth(spark.createDataFrame(data, "year int, v double"), ["v"]).orderBy("year").collect()
    assert [r["v_yoy"] for r in got] == [None, 0.5, 0.0, -1.0, None]


def test_reports(sales):
    pdf = sales.toPandas()
    early = pdf[pdf["doc_date"].dt.month <= 5]
    yearly = reports.ytd_kpi(sales).toPandas().set_index("year").sort_index()
    expected = early.groupby("year")["net_revenue"].sum()
    np.testing.assert_allclose(yearly["net_revenue"], expected, rtol=1e-9)
    np.testing.assert_allclose(yearly["net_revenue_yoy"].iloc[1:], expected.pct_change().iloc[1:], rtol=1e-9)
    by_channel = reports.ytd_channel(sales)
    wide = reports.channel_pivot(by_channel).toPandas().set_index("year").sort_index()
    pivot = early.groupby(["year", "channel"])["net_revenue"].sum().unstack().fillna(0)
    assert list(wide.columns) == list(pivot.columns)
    np.testing.assert_allclose(wide, pivot, rtol=1e-9)
    ordered = [(r["year"], -r["net_revenue"]) for r in reports.ranked(by_channel, "net_revenue", ties=["channel"]).collect()]
    assert ordered == sorted(ordered)
    shares = reports.ytd_pareto(sales).groupBy("year").agg(F.max("cumulative_share").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in shares)
    trend = reports.monthly_trend(kpi.aggregate_kpi(sales, kpi.GRAINS["mart_time_month"]))
    assert trend.filter("year IS NOT NULL").first()["period_key"][4] == "-"


def test_quality(spark):
    data = [(1, "a", True), (1, "a", False), (1, None, False), (1, None, None), (None, None, False)]
    df = spark.createDataFrame(data, "x int, y string, is_duplicate boolean")
    assert quality.overview(df, "t").first() == ("t", 5, 3, 5, 2, 1)
    assert quality.overview(df, "t", exclude=()).first()["duplicate_rows"] == 0
    assert quality.overview(df.drop("is_duplicate").limit(0), "e").first() == ("e", 0, 2, 0, 0, None)
    assert [tuple(r) for r in quality.null_profile(df).collect()] == [("y", 3, 0.6), ("is_duplicate", 1, 0.2), ("x", 1, 0.2)]
    assert quality.null_profile(df, top=1).count() == 1
    assert quality.flag_rate(df, "is_duplicate", "r").first()["r"] == 0.25


def test_nan_counts_as_null_cell(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert quality.overview(df, "t").first()["null_cells"] == 2


def test_column_profile_like_pandas(spark):
    pdf = pd.DataFrame({"n": [1.0, 2.0, 2.0, 10.0, None], "s": ["b", "a", "b", None, "a"]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "n double, s string")
    got = {(r["column_name"], r["metric"]): r["value"] for r in quality.column_profile(df).collect()}
    expected = pdf.describe(include="all")
    for metric in ("count", "mean", "std", "min", "25%", "50%", "75%", "max"):
        assert float(got["n", metric]) == pytest.approx(expected.loc[metric, "n"])
    assert (got["s", "count"], got["s", "unique"], got["s", "top"], got["s", "freq"]) == ("4", "2", "a", "2")


def brute_outliers(values, factor):
    valid = pd.Series([v for v in values if v is not None and np.isfinite(v)], dtype=float)
    q1, q3 = valid.quantile(0.25), valid.quantile(0.75)
    low, high = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
    return low, high, sum(v < low or v > high for v in valid)


def test_outliers(spark):
    rng = np.random.default_rng(1)
    data = []
    for i in range(400):
        value = float(rng.normal(10, 2)) if i % 20 else float(rng.choice([-80, 90, np.nan, np.inf]))
        data.append((DAY(2024, 1, 1) + datetime.timedelta(days=i), None if i % 3 == 0 else f"g{i % 3}", value, 1.0, None))
    df = spark.createDataFrame(data, "doc_date timestamp, g string, net_revenue double, profit double, quantity double")
    for by in (None, "g"):
        flagged = outliers.flag_outliers(df, ["net_revenue", "profit", "nope"], by=by).collect()
        summary = {(r["metric"], r["group_name"]): r for r in outliers.outlier_summary(df, by=by, factor=1.5).collect()}
        groups = {None} if by is None else {None, "g1", "g2"}
        for g in groups:
            members = [r for r in flagged if by is None or r["g"] == g]
            low, high, count = brute_outliers([r["net_revenue"] for r in members], 1.5)
            assert sum(r["net_revenue_outlier"] for r in members) == count > 0
            levels = Counter(r["net_revenue_level"] for r in members)
            assert levels["Cao bat thuong"] == sum(r["net_revenue"] > high and np.isfinite(r["net_revenue"]) for r in members)
            row = summary["net_revenue", "Toan bo" if by is None else g]
            assert (row["total_rows"], row["outlier_rows"]) == (len(members), count)
            assert (row["lower_bound"], row["upper_bound"]) == pytest.approx((low, high))
            dates = [r["doc_date"] for r in members if r["net_revenue_outlier"]]
            assert (row["first_outlier_date"], row["last_outlier_date"]) == (min(dates), max(dates))
            empty = summary["quantity", "Toan bo" if by is None else g]
            assert (empty["valid_rows"], empty["q1"], empty["outlier_rate"], empty["first_outlier_date"]) == (0, None, None, None)
            constant = summary["profit", "Toan bo" if by is None else g]
            assert (constant["iqr"], constant["outlier_rows"]) == (0.0, 0)


def test_box_stats(spark):
    data = [("a", float(v)) for v in (1, 10, 12, 14, 100, 1000, 10**7)] + [("a", -5.0), ("b", 3.0)]
    df = spark.createDataFrame(data, "product_group string, net_revenue double").withColumn("net_revenue_outlier", F.lit(False))
    got = {r["product_group"]: r for r in outliers.box_stats(df).collect()}
    logs = np.log10([1, 10, 12, 14, 100, 1000, 10**7])
    q1, median, q3 = np.quantile(logs, (0.25, 0.5, 0.75))
    inside = [x for x in logs if q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1)]
    row = got["a"]
    assert (row["q1"], row["median"], row["q3"]) == pytest.approx((q1, median, q3))
    assert (row["whisker_low"], row["whisker_high"], row["fliers"]) == pytest.approx((min(inside), max(inside), 7 - len(inside)))
    assert outliers.decade_range(outliers.log_revenue(df)).first() == (0, 7)


def test_monthly_base_fills_gaps(spark):
    data = [(DAY(2024, 1, 5), 1.0), (DAY(2024, 1, 9), 2.0), (DAY(2024, 4, 1), 4.0), (None, 9.0)]
    base = fc.monthly_base(spark.createDataFrame(data, "doc_date timestamp, net_revenue double"))
    assert [(r["month"], r["net_revenue"]) for r in base.orderBy("month_start").collect()] == [(1, 3.0), (2, 0.0), (3, 0.0), (4, 4.0)]


def test_forecast_of_a_seasonal_line(spark):
    months = [(DAY(2022 + i // 12, i % 12 + 1, 1), 100.0 + 10 * i) for i in range(24)]
    base = fc.monthly_base(spark.createDataFrame(months, "doc_date timestamp, net_revenue double"))
    features = fc.monthly_features(base)
    last = features.orderBy(F.desc("trend")).first()
    assert (last["trend"], last["lag_1"], last["lag_12"], last["trailing_mean"]) == (24, 320.0, 210.0, 310.0)
    predicted = fc.forecast(base, horizon=3).orderBy("month_start").collect()
    assert [r["forecast"] for r in predicted] == pytest.approx([340.0, 350.0, 360.0])
    metrics = {r["model"]: r for r in fc.model_metrics(fc.backtest(features)).collect()}
    assert metrics["linear_trend"]["mae"] == pytest.approx(0, abs=1e-6)
    assert (metrics["seasonal_naive"]["months"], metrics["seasonal_naive"]["mae"]) == (12, 120.0)
    actual = spark.createDataFrame([(DAY(2024, 1, 7), 340.0)], "doc_date timestamp, net_revenue double")
    compared = fc.forecast_vs_actual(fc.forecast(base, horizon=2), actual).orderBy("month_start").collect()
    assert compared[0]["error"] == pytest.approx(0, abs=1e-6) and compared[1]["actual"] is None


def test_correlations(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 1.0), (3.0, 6.0, float("nan"))], "a double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in fc.correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0)
    assert got["a", "c"] == pytest.approx(-1.0)


def test_sheet_names_keep_inner_dots():
    found = sheet_paths("h", ["2024.H1.parquet", "2024.H2.parquet", "2025", "_SUCCESS", ".x.crc"])
    assert found == {"2024.H1": "h/2024.H1.parquet", "2024.H2": "h/2024.H2.parquet", "2025": "h/2025"}
    with pytest.raises(ValueError, match="2025"):
        sheet_paths("h", ["2025.parquet", "2025.csv"])


def test_pivot_keeps_every_channel(spark):
    df = spark.createDataFrame([(2024, "a", 1.0), (2024, "b", 2.0), (2025, None, 3.0)], "year int, channel string, net_revenue double")
    rows = {r.year: (r.a, r.b) for r in reports.channel_pivot(df.where("channel is not null")).collect()}
    assert rows == {2024: (1.0, 2.0)}
    assert reports.channel_pivot(df).columns == ["year", "a", "b"]
    with pytest.raises(ValueError, match="missing"):
        reports.channel_pivot(df, ["a"])
    with pytest.raises(ValueError, match="more than 1"):
        reports.channel_pivot(df, most=1)


def test_every_hot_key_is_salted(spark):
    rows = spark.range(12_000).selectExpr("id % 1500 AS k", "id AS v")
    lookup = spark.range(1500).selectExpr("id AS k", "id * 2 AS w")
    joined = lookup_join(rows, lookup, "k", broadcast_bytes=0, hot_rows=3)
    assert joined.count() == 12_000
    assert joined.where("w <> k * 2 OR w IS NULL").count() == 0
    assert joined.columns == ["k", "v", "w"]


def test_history_ends_where_the_current_source_begins(spark):
    rows = [(vocab.SOURCE_HISTORICAL, "2025-11-30"), (vocab.SOURCE_CURRENT, "2026-01-17"), (vocab.SOURCE_CURRENT, None)]
    df = spark.createDataFrame(rows, "data_source string, d string").withColumn("doc_date", F.to_timestamp("d"))
    assert stages.first_current_month(df) == datetime.date(2026, 1, 1)
    assert stages.first_current_month(df.where(F.col("data_source") == vocab.SOURCE_CURRENT)) is None


def test_dates_are_in_order(spark, sales):
    dates = [r["doc_date"] for r in star.dim_date(sales).collect()]
    assert dates == sorted(dates, key=lambda d: (d is None, d or datetime.datetime.min))
