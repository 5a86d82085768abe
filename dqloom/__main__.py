"""``spark-submit``-able job: derive rules, run them, keep results, print the alerts.

python -m dqloom --tables /data/shop --store /data/quality \
    --key orders.o_custkey=customer.c_custkey
"""

from __future__ import annotations

import argparse
import datetime as dt

from .plans import reports
from .plans.pipeline import generate_into, run_stored
from .session import build_session
from .sources.dataset import load_database, load_dataset


def foreign_key(text: str) -> tuple[str, str, str, str]:
    child, parent = text.split("=")
    return (*child.rsplit(".", 1), *parent.rsplit(".", 1))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="dqloom")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables", help="folder of parquet tables")
    source.add_argument("--database", help="catalog database")
    parser.add_argument("--store", required=True, help="folder for rules, results, samples and models")
    parser.add_argument("--key", action="append", default=[], type=foreign_key, help="child.column=parent.column")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="first day to check for anomalies")
    parser.add_argument("--keep-rules", action="store_true", help="run the stored rules as they are")
    options = parser.parse_args(argv)

    spark = build_session()
    if options.tables:
        dataset = load_dataset(spark, options.tables, footer_counts=True)
    else:
        dataset = load_database(spark, options.database)
    if not options.keep_rules:
        generate_into(dataset, options.store, options.key, options.as_of)
    outcome = run_stored(dataset, options.store, options.as_of)
    for row in reports.alert_lines(outcome.results).collect():
        print(row.alert)
    for row in reports.error_alerts(outcome.results).collect():
        print(f"{row.source_table_id}.{row.metric_column}: {row.error_message}")


if __name__ == "__main__":
    main()
