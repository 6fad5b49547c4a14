"""Command line: ``python -m qualis --landing DIR --root DIR [--subscriptions PATH] [--incremental]``."""

from __future__ import annotations

import argparse
import json

from qualis.plans.daily import run_daily
from qualis.session import build_session


def main() -> None:
    ap = argparse.ArgumentParser(prog="qualis", description="Daily QA warehouse run on Spark.")
    ap.add_argument("--landing", required=True, help="folder with the landed CSV exports")
    ap.add_argument("--root", required=True, help="warehouse root (shared storage)")
    ap.add_argument("--subscriptions", help="subscription export (whole-document JSON files)")
    ap.add_argument("--json-lines", action="store_true", help="subscription export is valid JSON lines")
    ap.add_argument("--incremental", action="store_true", help="incremental build instead of full refresh")
    ap.add_argument("--master", help="Spark master (default: from the environment)")
    a = ap.parse_args()
    spark = build_session(a.master)
    out = run_daily(spark, a.landing, a.root, a.subscriptions, full_refresh=not a.incremental,
                    json_lines=a.json_lines)
    print(json.dumps(out, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
