"""Input order: positions, later copies, first attributes and line numbers do not depend on cores or splits."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from saleloom import schemas
from saleloom.operators import dedup, quality, star
from saleloom.operators.keys import INGEST, is_dense
from saleloom.plans.unify import unify_sales
from saleloom.sources import readers, writers


def _write(spark, path, fmt, first, rows, files):
    df = spark.range(first, first + rows, numPartitions=files).select(F.col("id").cast("string").alias("doc_no"))
    writers.write_table(df, path, fmt)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_positions_follow_sheets_files_and_rows(spark, tmp_path, fmt):
    _write(spark, f"{tmp_path}/b", fmt, 0, 300, 3)
    _write(spark, f"{tmp_path}/a", fmt, 300, 100, 2)
    sheets = {"late": f"{tmp_path}/b", "early": f"{tmp_path}/a"}
    got = {}
    for split in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            rows = readers.load_historical(spark, sheets, fmt, ingest=True)
            got[split] = {r["doc_no"]: (r[INGEST], r["source_sheet"]) for r in rows.select("doc_no", INGEST, "source_sheet").collect()}
            assert is_dense(rows)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["1k"] == got["128m"] == {str(i): (i, "late" if i < 300 else "early") for i in range(400)}
    assert INGEST not in readers.load_historical(spark, sheets, fmt).columns


def _rows():
    data = [(i, ["x", "y", None][i % 3], [0.0, -0.0, 1.5, None][i % 4]) for i in range(60)]
    return data + [(60 + i, "hot", 2.0) for i in range(500)] + [(560, "once", 1.0)]


def expected_flags(data):
    seen, flags = set(), {}
    for at, *row in sorted(data):
        key = tuple(v + 0.0 if isinstance(v, float) else v for v in row)
        flags[at] = key in seen
        seen.add(key)
    return flags


def test_later_copies_are_flagged(spark):
    data = _rows()
    df = spark.createDataFrame(data, f"{INGEST} long, a string, c double")
    for partitions in (1, 7):
        flagged = dedup.flag_later_copies(df.repartition(partitions, F.rand(3)), INGEST)
        assert flagged.columns == [INGEST, "a", "c", "is_duplicate"]
        assert {r[INGEST]: r["is_duplicate"] for r in flagged.collect()} == expected_flags(data)
    assert dedup.flag_later_copies(df.limit(0), INGEST).count() == 0


def test_contents_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(dedup, "row_hash", lambda columns: [F.lit(1).cast("long").alias("__h1"), F.lit(2).cast("long").alias("__h2")])
    data = _rows()
    flagged = dedup.flag_later_copies(spark.createDataFrame(data, f"{INGEST} long, a string, c double"), INGEST)
    assert {r[INGEST]: r["is_duplicate"] for r in flagged.collect()} == expected_flags(data)


def test_overview_of_a_stored_table(spark):
    df = spark.createDataFrame([(a, c, c is None) for _, a, c in _rows()], "a string, c double, is_duplicate boolean")
    for exclude in ((), ("is_duplicate",)):
        assert quality.overview(df, "t", exclude, stored=True).first() == quality.overview(df, "t", exclude).first()
    assert quality.overview(df.limit(0), "t", stored=True).first() == ("t", 0, 3, 0, 0, 0)
    assert quality.overview(df, "t", flagged_exactly=True).first()["duplicate_rows"] == df.where("is_duplicate").count()


def _sales(spark, layout, rows):
    df = spark.createDataFrame(rows, f"{INGEST} long, doc_no string, customer_code string, customer_name string")
    present = set(df.columns)
    types = schemas.types(layout) | {"period": schemas.STR, "data_source": schemas.STR, "has_cost": schemas.BOOL, "is_duplicate": schemas.BOOL,
                                     "std_name": schemas.STR, "std_group": schemas.STR, "std_type": schemas.STR}
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in present])


def test_sales_id_and_first_attributes_in_input_order(spark):
    hist = _sales(spark, schemas.CURRENT, [(i, f"h{i}", "c1", f"old {i}") for i in range(20)]).repartition(3)
    current = _sales(spark, schemas.CURRENT, [(i, f"n{i}", "c2" if i else "c1", f"new {9 - i}") for i in range(10)]).repartition(4)
    sales = unify_sales(hist, current)
    assert sales.columns == [*schemas.columns(schemas.SALES), INGEST]
    tables = star.star_schema(sales)
    wanted = {f"h{i}": i + 1 for i in range(20)} | {f"n{i}": 21 + i for i in range(10)}
    assert {r["doc_no"]: r["sales_id"] for r in tables["fact_sales"].collect()} == wanted
    assert {r["customer_code"]: r["customer_name"] for r in tables["dim_customer"].collect()} == {"c1": "old 0", "c2": "new 8"}
    part = sales.where("doc_no <> 'h3'")
    assert not is_dense(part)
    found = {r["doc_no"]: r["sales_id"] for r in star.star_schema(part)["fact_sales"].collect()}
    assert found == {d: n - (n > 4) for d, n in wanted.items() if d != "h3"}
    assert Counter(found.values()).most_common(1)[0][1] == 1
