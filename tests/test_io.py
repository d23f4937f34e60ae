"""Readers, writers and the stage runners, in temporary folders."""

from __future__ import annotations

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from saleloom import schemas
from saleloom.checks import tables
from saleloom.operators import kpi
from saleloom.plans import stages
from saleloom.plans.reports import ORDERS
from saleloom.sources import files, readers, writers

FOLDER = "/root/testdata/sf0.001"


def test_require_inputs_names_all_missing(spark, tmp_path):
    (tmp_path / "a").mkdir()
    assert files.require_inputs(spark, {"a": str(tmp_path / "a")}) == {"a": str(tmp_path / "a")}
    with pytest.raises(FileNotFoundError) as error:
        files.require_inputs(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b"), "c": str(tmp_path / "c")})
    assert "b: " in str(error.value) and "c: " in str(error.value) and "a: " not in str(error.value)


def test_csv_has_byte_order_mark_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("Đồ uống", 1.5, 'say "hi", ok'), (None, None, "x")], "name string, v double, note string")
    path = str(tmp_path / "deep" / "t")
    writers.write_table(df.coalesce(1), path, "csv")
    part = next(Path(path).glob("part-*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfname,v,note\n")
    back = readers.read_table(spark, path, "csv")
    assert back.columns == ["name", "v", "note"]
    assert sorted(back.collect(), key=str) == sorted([("Đồ uống", "1.5", 'say "hi", ok'), (None, None, "x")], key=str)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    df = spark.range(5).withColumn("t", F.lit("x"))
    writers.write_table(df, str(tmp_path / fmt), fmt)
    assert readers.read_table(spark, str(tmp_path / fmt), fmt, df.schema).count() == 5


def test_partitioned_write_with_a_null_partition(spark, tmp_path):
    df = spark.createDataFrame([(1, 2024), (2, None), (3, 2024)], "v int, year int")
    writers.write_table(df, str(tmp_path / "t"), partition_by=["year"], business_names=True)
    assert {p.name for p in (tmp_path / "t").glob("*=*")} == {"Năm=2024", "Năm=__HIVE_DEFAULT_PARTITION__"}
    assert readers.read_table(spark, str(tmp_path / "t")).count() == 3


def test_publish_drops_stale_tables_of_its_own_folder_only(spark, tmp_path):
    root = str(tmp_path / "out")
    one = spark.range(1)
    writers.publish(spark, root, {"a": one, "b": one})
    writers.publish(spark, root, {"b": one, "c": one})
    assert [n for n in files.children(spark, root) if not n.startswith(("_", "."))] == ["b", "c"]
    foreign = tmp_path / "foreign"
    foreign.mkdir()
    (foreign / "mine.txt").write_text("keep")
    with pytest.raises(ValueError, match="did not write"):
        writers.publish(spark, str(foreign), {"a": one})
    with pytest.raises(ValueError, match="not an output folder"):
        files.drop_stale(spark, str(foreign), [])
    assert (foreign / "mine.txt").read_text() == "keep"


def test_bundle_names():
    long = "a_very_long_table_name_that_exceeds_the_limit"
    assert writers.bundle_names([long, "b"]) == {long: long[:31], "b": "b"}
    assert writers.bundle_names([long], short=False) == {long: long}
    with pytest.raises(ValueError, match="collide"):
        writers.bundle_names([long, long + "_2"])


def test_historical_partitions_are_tagged(spark, tmp_path):
    writers.write_table(spark.createDataFrame([("1", " A ")], ["Số   chứng từ", "Kênh"]), str(tmp_path / "2023"), "json")
    writers.write_table(spark.createDataFrame([("2", "5")], ["Số chứng từ", "Lợi nhuận"]), str(tmp_path / "2024"), "json")
    df = readers.load_historical(spark, {n: str(tmp_path / n) for n in ("2023", "2024")}, "json")
    found = {r["doc_no"]: r for r in df.collect()}
    assert (found["1"]["channel"], found["1"]["profit"], found["1"]["source_sheet"]) == (" A ", None, "2023")
    assert (found["2"]["channel"], found["2"]["profit"], found["2"]["source_sheet"]) == (None, "5", "2024")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_row_order_follows_the_file(spark, tmp_path, fmt):
    df = spark.range(200).select(F.col("id").cast("string").alias("Mã Sản phẩm")).coalesce(1)
    writers.write_table(df, str(tmp_path / "c"), fmt)
    got = readers.load_cost(spark, str(tmp_path / "c"), fmt).orderBy("row_order").collect()
    assert [r["product_code"] for r in got] == [str(i) for i in range(200)]


def test_load_sales_needs_the_cleaning_stage(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="cleaning stage"):
        readers.load_sales(spark, str(tmp_path / "none"))


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Raw inputs with business names, historical sales split into one folder per year."""
    root = tmp_path_factory.mktemp("raw")
    historical = tables.raw_historical(spark, FOLDER)
    for year in range(1995, 2001):
        part = historical.filter(F.col("source_sheet") == f"sheet {year}").drop("source_sheet")
        schemas.to_business(part, "historical").write.parquet(f"{root}/historical/{year}")
    schemas.to_business(tables.raw_current(spark, FOLDER), "current").write.parquet(f"{root}/current")
    cost = tables.raw_cost(spark, FOLDER).orderBy("row_order").drop("row_order").coalesce(1)
    schemas.to_business(cost, "cost").write.parquet(f"{root}/cost")
    return root


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_whole_run(spark, inputs, tmp_path, fmt):
    layout = stages.Layout(f"{inputs}/historical", f"{inputs}/current", f"{inputs}/cost", str(tmp_path / "out"), output_format=fmt)
    result = stages.run_all(spark, layout, history_end=datetime.date(2001, 1, 1))

    def published(name):
        return {n for n in files.children(spark, f"{layout.output}/{name}") if not n.startswith(("_", "."))}

    star = {"fact_sales", "dim_date", "dim_customer", "dim_product", "dim_channel"}
    marts = {*star, *kpi.GRAINS, "mart_pareto_customer_group"}
    assert len(marts) == 15 and set(result["marts"]) == marts
    assert published("staging") == {"raw_sales_historical", "raw_sales_current", "raw_cost", "sales_historical_clean", "sales_current_clean", "cost_clean"}
    assert published("clean") == {"sales_final", "data_quality_overview"}
    assert published("mart") == {*marts, "forecast_vs_actual"}
    assert published("model") == {"monthly_model_base", "monthly_model_data", "backtest_revenue", "model_revenue_metrics", "forecast_revenue"}
    assert "fact_sales" not in published("bundle") and len(published("bundle")) == 22

    assert published("report") == set(ORDERS)
    for name, order in {"report_kpi": ["year"], "report_month_trend": ["year", "month"], "report_pareto": ["year"]}.items():
        rows = sorted(result["reports"][name].collect(), key=lambda r: int(r["position"]))
        assert [int(r["position"]) for r in rows] == list(range(1, len(rows) + 1))
        values = [tuple(r[c] for c in order) for r in rows if r["year"] is not None]
        assert values == sorted(values) and rows[-1]["year"] in (None, max(v[0] for v in values))
    facts = readers.load_mart(spark, layout.mart, "fact_sales", fmt).select(F.col("sales_id").cast("long"), "doc_no")
    lines = result["cleaning"]["sales_final"].select((F.col("ingest_order") + 1).alias("sales_id"), "doc_no")
    assert facts.exceptAll(lines).count() == 0 and lines.exceptAll(facts).count() == 0

    quality = {r["table_name"]: r for r in result["cleaning"]["data_quality_overview"].collect()}
    assert len(quality) == 7
    final = quality["sales_final"]
    assert final["row_count"] == quality["raw_sales_historical"]["row_count"] + quality["raw_sales_current"]["row_count"]
    assert final["column_count"] == 38
    assert quality["sales_historical_clean"]["duplicate_rows"] == quality["sales_historical_clean"]["flagged_duplicates"] > 0

    assert result["model"]["forecast_vs_actual"].count() == 5
    # Entry from disk gives the same marts as the run in memory.
    reloaded = readers.load_sales(spark, f"{layout.clean}/sales_final", fmt)
    assert reloaded.columns == schemas.columns(schemas.SALES)
    assert reloaded.count() == final["row_count"]
    compared = ("mart_overview_year", "dim_customer", "mart_channel_product")
    before = {name: sorted(result["marts"][name].collect(), key=str) for name in compared}
    again = stages.run_marts(spark, layout)
    assert {name: sorted(again[name].collect(), key=str) for name in compared} == before
    mart = readers.load_mart(spark, layout.mart, "mart_time_month", fmt, columns=["year", "net_revenue", "nope"])
    assert mart.columns == ["year", "net_revenue"]
