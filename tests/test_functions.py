from __future__ import annotations

import datetime
import math
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleloom import vocab
from saleloom.functions import dates, numbers, text

MESSY = ["  a   b ", "a\u001cb", " x　y\t", "", "   ", "nan", " nan ", "NaN", "None", "<NA>", "none", None, "ok"]


def python_clean(value):
    if value is None:
        return None
    value = " ".join(value.split())
    return None if value in text.NULL_TOKENS else value


def test_clean_text(values):
    assert values(MESSY, "string", text.clean_text) == [python_clean(v) for v in MESSY]


def test_clean_text_of_numbers(values):
    assert values([7, None], "long", text.clean_text) == ["7", None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", categories=("L", "M", "N", "P", "Z", "Cc"))), min_size=1, max_size=40))
def test_clean_text_like_python_and_idempotent(values, items):
    # NUL cannot be passed through every text layer; it is no white space either.
    items = [i.replace("\0", "") for i in items]
    once = values(items, "string", text.clean_text)
    assert once == [python_clean(i) for i in items]
    assert values(once, "string", text.clean_text) == once


def test_fold_accents(values):
    items = ["Đồ uống", "HÒA TAN", "nhóm khách hàng nội đia", "á", "ß", "plain", "naïve Ångström", None]
    expected = ["Do uong", "HOA TAN", "nhom khach hang noi dia", "a", "ß", "plain", "naive Angstrom", None]
    assert values(items, "string", text.fold_accents) == expected


def test_match_key(values):
    items = ["  Đồ  UỐNG ", None, "F&B"]
    keys = values(items, "string", text.match_key)
    assert keys == ["do uong", "", "f&b"]
    assert values(keys, "string", text.match_key) == keys


def test_map_labels(values):
    items = [" hòa  TAN", "Khác", "  Trà  sữa ", None, "nan", "DO UONG"]
    mapped = values(items, "string", lambda c: text.map_labels(c, vocab.PRODUCT_GROUPS))
    assert mapped == ["Hòa tan", "Khác", "Trà sữa", None, None, "Đồ uống"]


def test_vocabulary_keys_are_match_keys():
    for name in ("CHANNELS", "PRODUCT_GROUPS", "CUSTOMER_GROUPS", "RETURNED"):
        assert all(text.key_of(k) == k for k in getattr(vocab, name))


NUMBERS = ["1,234", "1e3", " 12 ", "inf", "-Infinity", "nan", "", "1d", "1f", "0x1p3", "+5", "5.", ".5", "-.5e-2", "abc", None, "1 2"]


def test_parse_number_like_pandas(values):
    expected = pd.to_numeric(pd.Series(NUMBERS, dtype="object"), errors="coerce").fillna(0).tolist()
    assert values(NUMBERS, "string", numbers.parse_number) == expected


def test_parse_number_typed(values):
    assert values([1.5, float("nan"), None], "double", lambda c: numbers.parse_number(c, T.DoubleType())) == [1.5, 0.0, 0.0]
    assert values([True, None], "boolean", lambda c: numbers.parse_number(c, T.BooleanType())) == [1.0, 0.0]


def test_finite_or_null(values):
    items = [1.0, float("nan"), float("inf"), float("-inf"), None]
    assert values(items, "double", numbers.finite_or_null) == [1.0, None, None, None, None]


def test_ratio(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.ratio(df.a, df.b)).collect()] == [0.25, None, None, None]


@pytest.mark.parametrize(
    ("items", "expected"),
    [
        ([], 0.0),
        ([None, float("nan")], 0.0),
        ([0.1] * 10, 1.0),
        ([1e15, 0.25, -1e15], 0.25),
        ([1.0, float("inf")], float("inf")),
        ([-0.000001, -2.5], -2.500001),
    ],
)
def test_stable_sum(spark, items, expected):
    df = spark.createDataFrame([(i,) for i in items], "v double")
    assert df.agg(numbers.stable_sum("v")).first()[0] == pytest.approx(expected, abs=0)


@pytest.mark.parametrize(
    "items",
    [
        [4e-7] * 10_000,
        [9.1e12 + i / 7 for i in range(999)],
        [-0.1, 2.0**55, -(2.0**55)],
        [1e-15, -1e-15, 3e-16, -0.3, 1e10 / 3],
        [(-1) ** i * 1.1**i for i in range(400)],
        [-5.5, -1e-9],
        [2.0**55, 1.0, 2.0**-60, -(2.0**55)],
    ],
)
def test_stable_sum_is_exact(spark, items):
    """The sum of the same doubles to 15 digits, in any order."""
    exact = float(f"{math.fsum(items):.14e}")
    sums = set()
    for seed in (1, 2, 3):
        random.Random(seed).shuffle(items)
        df = spark.createDataFrame([(i,) for i in items], "v double").repartition(2 * seed)
        sums.add(df.agg(numbers.stable_sum("v")).first()[0])
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(exact, rel=2e-16, abs=1e-20)


def test_stable_sum_ignores_order(spark):
    rng = random.Random(3)
    items = [round(rng.uniform(-1e6, 1e6), 4) for _ in range(5000)]
    exact = math.fsum(items)
    for seed in (1, 2):
        rng.seed(seed)
        rng.shuffle(items)
        df = spark.createDataFrame([(i,) for i in items], "v double").repartition(3 + seed)
        assert df.agg(numbers.stable_sum("v")).first()[0] == pytest.approx(exact, rel=1e-15)


def test_parse_date(values):
    items = ["2024-02-29", " 03/12/2023 ", "2024-01-02 03:04:05", "2023-02-29", "garbage", "", None]
    got = values(items, "string", dates.parse_date)
    day = datetime.datetime
    assert got == [day(2024, 2, 29), day(2023, 12, 3), day(2024, 1, 2, 3, 4, 5), None, None, None, None]


def test_parse_date_of_typed_and_numeric_columns(values):
    day = datetime.date(2024, 5, 6)
    assert values([day], "date", lambda c: dates.parse_date(c, T.DateType())) == [datetime.datetime(2024, 5, 6)]
    assert values([20240506], "long", lambda c: dates.parse_date(c, T.LongType())) == [None]


def test_parse_date_with_month_names(values):
    assert values(["06 May 2024"], "string", lambda c: dates.parse_date(c, formats=["dd MMM yyyy"])) == [datetime.datetime(2024, 5, 6)]


def test_date_labels(values):
    day = datetime.date(2024, 5, 6)
    assert values([day, None], "date", dates.date_key) == [20240506, None]
    assert values([5, None], "int", dates.month_label) == ["Tháng 5", None]
    assert values([5, 11], "int", lambda c: dates.period_key(F.lit(2024), c)) == ["2024-05", "2024-11"]
    parts = {n: values([day, None], "date", lambda c, n=n: dates.date_parts(c)[n]) for n in dates.date_parts(F.lit(1))}
    assert parts == {"year": [2024, None], "month": [5, None], "quarter": [2, None], "year_month": ["2024-05", None]}
