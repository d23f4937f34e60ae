"""Run all stages: ``python -m saleloom --historical ... --current ... --cost ... --output ...``."""

from __future__ import annotations

import argparse
import datetime
from collections.abc import Sequence

from saleloom.plans import stages
from saleloom.session import session


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="saleloom", description="Clean sales, build marts, forecast, publish.")
    parser.add_argument("--historical", required=True, help="folder with one table per partition (sheet, year)")
    parser.add_argument("--current", required=True, help="current sales table")
    parser.add_argument("--cost", required=True, help="product cost table")
    parser.add_argument("--output", required=True, help="output folder")
    parser.add_argument("--input-format", default="parquet")
    parser.add_argument("--output-format", default="parquet")
    parser.add_argument("--history-end", type=datetime.date.fromisoformat, help="first month to forecast, YYYY-MM-DD")
    parser.add_argument("--date-format", action="append", help="format of dates, may be repeated; by default the data decide")
    parser.add_argument("--stage", choices=("all", "clean", "mart", "forecast", "report"), default="all")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    options = parse(argv)
    layout = stages.Layout(
        options.historical, options.current, options.cost, options.output, options.input_format, options.output_format
    )
    spark = session()
    if options.stage == "clean":
        stages.run_cleaning(spark, layout, options.date_format)
    elif options.stage == "mart":
        stages.run_marts(spark, layout)
    elif options.stage == "forecast":
        stages.run_forecast(spark, layout, history_end=options.history_end)
    elif options.stage == "report":
        stages.run_reports(spark, layout)
    else:
        stages.run_all(spark, layout, options.history_end, options.date_format)


if __name__ == "__main__":
    main()
