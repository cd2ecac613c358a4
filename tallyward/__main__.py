"""Run the daily stages from the command line, e.g. ``spark-submit -m tallyward`` or ``python -m tallyward run``."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace
from datetime import date

from tallyward.config import Config
from tallyward.plans.daily_run import DailyRun
from tallyward.session import build_session

STAGES = ("extract", "load", "freshness_gate", "models", "column_tests", "expectations", "report")


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tallyward", description="Settings come from TALLYWARD_* variables.")
    parser.add_argument("stage", choices=("run", *STAGES), help="all stages in order, or a single one")
    parser.add_argument("--as-of", type=date.fromisoformat, help="day to take as today")
    parser.add_argument("--run-id", help="name of the run in the history; give stages run one by one the same")
    options = parser.parse_args(arguments)
    config = Config.from_env()
    if options.as_of:
        config = replace(config, as_of=options.as_of)
    spark = build_session("tallyward")
    named = {"run_id": options.run_id} if options.run_id else {}
    run = DailyRun(spark, config, **named).execute(None if options.stage == "run" else [options.stage])
    run.log_frame().show(truncate=False)
    if run.error is not None:
        print(run.error, file=sys.stderr)
    return 0 if run.error is None else 1


if __name__ == "__main__":
    sys.exit(main())
