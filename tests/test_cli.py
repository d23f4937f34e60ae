from __future__ import annotations

import datetime

import pytest

from saleloom import __main__ as cli
from saleloom import session as sessions

ARGUMENTS = ["--historical", "h", "--current", "c", "--cost", "k", "--output", "o"]


def test_stages_are_dispatched(monkeypatch):
    calls = []
    monkeypatch.setattr(cli, "session", lambda: "spark")
    for name in ("run_cleaning", "run_marts", "run_forecast", "run_all"):
        monkeypatch.setattr(cli.stages, name, lambda *a, name=name, **k: calls.append((name, a, k)))
    for stage in ("clean", "mart", "forecast", "all"):
        cli.main([*ARGUMENTS, "--stage", stage, "--history-end", "2026-01-01", "--output-format", "csv"])
    assert [c[0] for c in calls] == ["run_cleaning", "run_marts", "run_forecast", "run_all"]
    layout = calls[0][1][1]
    assert (layout.mart, layout.output_format) == ("o/mart", "csv")
    assert calls[2][2] == {"history_end": datetime.date(2026, 1, 1)}


def test_missing_argument():
    with pytest.raises(SystemExit):
        cli.parse(ARGUMENTS[:-2])


def test_session_reuses_the_running_one(spark):
    assert sessions.session().sparkContext is spark.sparkContext
