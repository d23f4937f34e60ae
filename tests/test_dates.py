"""Date formats: the forms that are read without options, and the order of day and month that a column elects."""

from __future__ import annotations

import datetime

import pytest

from saleloom.functions import dates
from saleloom.operators.date_formats import elect, election_report

READ = {
    "5/1/2024": (2024, 1, 5),
    "05/01/2024": (2024, 1, 5),
    "2024-01-05 10:30": (2024, 1, 5, 10, 30),
    "2024-01-05 10:30:15.5": (2024, 1, 5, 10, 30, 15, 500000),
    "2024-01-05T10:30:15.123456": (2024, 1, 5, 10, 30, 15, 123456),
    "2024-01-05T10:30:15Z": (2024, 1, 5, 10, 30, 15),
    "2024-01-05T10:30:15.25+07:00": (2024, 1, 5, 3, 30, 15, 250000),
    "2024/01/05": (2024, 1, 5),
    "2024/1/5 7:30": None,
    "31/12/2023 23:59:01": (2023, 12, 31, 23, 59, 1),
    "1/13/2024": None,
    "2024-13-01": None,
    "20240105": None,
    "45296": None,
}


def test_forms(values):
    found = values(list(READ), "string", dates.parse_date)
    assert found == [t and datetime.datetime(*t) for t in READ.values()]


@pytest.mark.parametrize(
    ("texts", "day_first", "counts"),
    [
        (["5/1/2024", "13/1/2024", "2024-01-05", "x", None, " "], True, (4, 1, 0, 1, 1)),
        (["5/1/2024", "1/13/2024", "2/28/2024", "13/1/2024"], False, (4, 1, 2, 1, 0)),
        (["5/1/2024", "6/1/2024"], True, (2, 0, 0, 2, 0)),
        ([], True, (0, 0, 0, 0, 0)),
    ],
)
def test_election(spark, texts, day_first, counts):
    df = spark.createDataFrame([(t, 1) for t in texts], "`a.b` string, n int")
    elected = elect(df, ["a.b", "n"])
    assert list(elected) == ["a.b"]
    assert tuple(elected["a.b"][1:]) == counts
    row = election_report(df, elected).first()
    assert row["day_first"] is day_first
    parsed = df.select(dates.parse_date(df["`a.b`"], formats=elected["a.b"].formats).alias("d")).collect()
    if "5/1/2024" in texts:
        month, day = (1, 5) if day_first else (5, 1)
        assert parsed[0]["d"] == datetime.datetime(2024, month, day)
    assert sum(r["d"] is not None for r in parsed) == counts[0] - counts[4]
