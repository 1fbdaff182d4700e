"""python -m groundmill.cli QUERY SF_DIR [--out DIR] | --list | --scorecard SF_DIR"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from groundmill.plans import enrichment, general
from groundmill.reports import scorecard_table

QUERIES = enrichment.QUERIES | general.QUERIES


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="groundmill")
    p.add_argument("query", nargs="?")
    p.add_argument("sf_dir", nargs="?")
    p.add_argument("--out", help="folder for the result as parquet; else its first rows are shown")
    p.add_argument("--list", action="store_true")
    p.add_argument("--scorecard", metavar="SF_DIR")
    a = p.parse_args(argv)
    if a.list:
        print("\n".join(sorted(QUERIES)))
        return 0
    if not a.scorecard and (a.query not in QUERIES or not a.sf_dir):
        print(f"no such query: {a.query}", file=sys.stderr)
        return 2
    spark = SparkSession.builder.appName("groundmill").getOrCreate()
    if a.scorecard:
        print(scorecard_table({"run": enrichment.scorecard(spark, a.scorecard)}))
        return 0
    df = QUERIES[a.query](spark, a.sf_dir)
    df.write.parquet(a.out) if a.out else df.show(20, truncate=80)
    return 0


if __name__ == "__main__":
    sys.exit(main())
