"""Command line: `python -m addrloom.cli run --input FILE --masters FOLDER --layouts JSON --output FOLDER` writes every stage's table as CSV;
`bench` times the resolution of the first rows of a Parquet folder's addresses."""

from __future__ import annotations

import argparse
import json
import time
from pathlib import Path

from pyspark.sql import SparkSession

from .operators.resolve import Reference, answered, keys_of, resolved
from .plans.pipeline import run
from .plans.ship import ship
from .plans.tables import table
from .sources.files import first_input, write_csv


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="addrloom")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="all stages over one customer file")
    r.add_argument("--input", required=True, help="a file, or a folder whose first table is taken")
    r.add_argument("--masters", required=True)
    r.add_argument("--layouts", required=True, help="JSON file: layout name to signature, lan, current, office, alternate columns")
    r.add_argument("--output", required=True)
    r.add_argument("--respect-clean-city", action="store_true")
    b = sub.add_parser("bench", help="seconds to resolve a sample of addresses")
    b.add_argument("--input", required=True, help="folder of Parquet tables")
    b.add_argument("--sample", type=int, default=2000)
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    ship(spark)
    if a.command == "bench":
        rows = keys_of(table(spark, a.input, "cleaned_address_data").orderBy("row_id").limit(a.sample), "ulb")
        begin = time.time()
        n = answered(rows, resolved(rows, "ulb", Reference(spark, a.input))).count()
        print(json.dumps({"rows": n, "seconds": round(time.time() - begin, 2)}))
        return
    path = first_input(a.input) if Path(a.input).is_dir() else a.input
    if not path:
        raise SystemExit(f"no table in {a.input}")
    for name, df in run(spark, path, a.masters, json.loads(Path(a.layouts).read_text()), a.respect_clean_city).items():
        write_csv(df, f"{a.output}/{name}")


if __name__ == "__main__":
    main()
