"""``spark-submit`` entry: one full refresh, for any scheduler to call."""

import argparse
import logging

from pyspark.sql import SparkSession

from tillbook.operators.cleaning import DATE_PATTERN
from tillbook.plans.daily_load import run
from tillbook.schema import RAW_TABLE, SCALE, WAREHOUSE_TABLE


def main() -> None:
    parser = argparse.ArgumentParser(prog="tillbook", description=run.__doc__)
    parser.add_argument("source", help="CSV file, or folder of CSV files with the same header")
    parser.add_argument("root", help="folder for the tables, shared by all executors")
    parser.add_argument("--raw-table", default=RAW_TABLE)
    parser.add_argument("--warehouse-table", default=WAREHOUSE_TABLE)
    parser.add_argument("--multi-line", action="store_true", help="allow line breaks inside quotes")
    parser.add_argument("--date-pattern", default=DATE_PATTERN, help="auto: the one that fits most dates")
    parser.add_argument("--encoding", default="UTF-8", help="of the source files")
    parser.add_argument("--scale", default=str(SCALE), help="decimals of money and ratings; auto: as many as the numbers need")
    parser.add_argument("--round-digits", action="store_true", help="round further decimals and count them")
    parser.add_argument("--growth", type=float, default=1.0, help="size of the source by that of its files")
    parser.add_argument("--keep", type=int, default=2, help="versions of each table that stay; 0 keeps all")
    parser.add_argument("--replace-definition", action="store_true", help="replace tables of another schema")
    parser.add_argument("--buckets", type=int, help="store the warehouse by key, in so many files")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("tillbook").getOrCreate()
    result = run(
        spark, args.source, args.root, args.raw_table, args.warehouse_table, args.multi_line,
        None if args.date_pattern == "auto" else args.date_pattern, args.encoding, None if args.scale == "auto" else int(args.scale), args.round_digits, args.growth, args.keep or None, args.replace_definition, args.buckets,
    )
    for name, count in result.metrics.asDict().items():
        print(f"{name}: {count}")
    print(f"raw table: {result.raw_path}\nwarehouse table: {result.warehouse_path}")
    result.branch_sample.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
