"""Run the whole pipeline over CSV files.

    spark-submit ... -m tradewind --file customers=/data/customers.csv --file orders=... --output /data/out

Each ``--file`` names a table of ``schemas.py`` and a CSV file or folder; ``--input``
takes a folder with one ``<table>.csv`` per table instead.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from tradewind.plans.pipeline import run_pipeline
from tradewind.schemas import TABLES
from tradewind.session import configure, get_session
from tradewind.sources.tables import load_tables


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tradewind", description="Load, clean and analyse retail order tables.")
    parser.add_argument("--input", help="folder with <table>.csv files")
    parser.add_argument("--file", action="append", default=[], metavar="TABLE=PATH", help="one table's CSV path")
    parser.add_argument("--output", required=True, help="folder for all results")
    parser.add_argument("--input-bytes", type=int, help="size of the input, to set the shuffle width")
    options = parser.parse_args(argv)

    paths = {t: f"{options.input.rstrip('/')}/{t}.csv" for t in TABLES} if options.input else {}
    paths |= dict(pair.split("=", 1) for pair in options.file)

    spark = get_session()
    configure(spark, options.input_bytes)
    tables, missing = load_tables(spark, paths, row_order=True)
    for name in missing:
        print(f"not found: {name} ({paths[name]})")
    run_pipeline(spark, tables, options.output).show(200, truncate=False)


if __name__ == "__main__":
    main()
