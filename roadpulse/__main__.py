"""``spark-submit`` entry: convert a CSV, or show a report over an incident table.

    python -m roadpulse convert <csv> <out>
    python -m roadpulse <report> <parquet>
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from roadpulse.plans.reports import REPORTS
from roadpulse.sources.csv_ingest import convert_csv
from roadpulse.sources.shared_dir import remove_path
from roadpulse.sources.tables import read_incidents


def print_rows(df: DataFrame) -> None:
    """Every row, tab-separated under the column names, a partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("NULL" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="roadpulse")
    parser.add_argument("task", choices=["convert", *REPORTS])
    parser.add_argument("path", help="CSV to convert, or Parquet table to report on")
    parser.add_argument("out", nargs="?", help="folder of the converted table")
    args = parser.parse_args(argv)
    if args.task == "convert" and not args.out:
        parser.error("convert needs an output folder")
    spark = SparkSession.builder.appName("roadpulse").getOrCreate()
    if args.task == "convert":
        converted = convert_csv(spark, args.path, args.out, infer=True)
        print_rows(converted.rejects.groupBy("reject_reason").count())
        remove_path(spark, converted.staged)
    else:
        print_rows(REPORTS[args.task](read_incidents(spark, args.path)))


if __name__ == "__main__":
    main()
