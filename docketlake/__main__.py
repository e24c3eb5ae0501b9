"""Command line: ``python -m docketlake STAGE --base DIR ...``."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession

from docketlake.plans import stages
from docketlake.schemas import FIRST_YEAR, LAST_YEAR


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="docketlake")
    parser.add_argument("--base", required=True, help="folder of the tables, shared by the cluster")
    sub = parser.add_subparsers(dest="stage", required=True)

    plan = sub.add_parser("plan", help="register days and list the addresses to fetch")
    plan.add_argument("--url-root", required=True)
    plan.add_argument("--raw", default="raw")
    plan.add_argument("--first", type=int, default=FIRST_YEAR)
    plan.add_argument("--last", type=int, default=LAST_YEAR)
    plan.add_argument("--out", required=True, help="where to write the work list")

    record = sub.add_parser("record", help="enter a log of fetch attempts into the manifest")
    record.add_argument("--log", required=True, help="parquet folder of the log")

    parse = sub.add_parser("parse", help="turn the raw files of a year into text")
    parse.add_argument("--raw", default="raw")
    parse.add_argument("--year", type=int, required=True)

    extract = sub.add_parser("extract", help="call an extractor for the pending digests")
    extract.add_argument("--client", required=True, help="module:function that returns prompt -> answer")
    extract.add_argument("--year", type=int)
    extract.add_argument("--limit", type=int, help="digests per year")
    extract.add_argument("--concurrency", type=int)
    extract.add_argument("--store-negative", action="store_true", help="also record digests without a section")

    load = sub.add_parser("load", help="load records into the relational tables")
    load.add_argument("--year", type=int)
    load.add_argument("--full-reload", action="store_true")

    report = sub.add_parser("report", help="write every report, whole, as parquet")
    report.add_argument("--out", required=True, help="folder; each report goes below it by its name")
    return parser.parse_args()


def main() -> None:
    a = arguments()
    spark = SparkSession.builder.appName("docketlake").getOrCreate()
    if a.stage == "plan":
        work = stages.plan_downloads(spark, a.base, a.url_root, a.first, a.last, a.raw)
        work.write.mode("overwrite").parquet(a.out)
    elif a.stage == "record":
        stages.record_downloads(spark, a.base, spark.read.parquet(a.log)).show()
    elif a.stage == "parse":
        stages.parse_year(spark, a.base, a.raw, a.year).show()
    elif a.stage == "extract":
        module, function = a.client.split(":")
        make_client = getattr(importlib.import_module(module), function)
        outcomes = stages.extract_texts(spark, a.base, make_client, a.year, a.limit,
                                        concurrency=a.concurrency, store_negative=a.store_negative)
        for row in outcomes.groupBy("year", "outcome").count().orderBy("year", "outcome").toLocalIterator():
            print(row["year"], row["outcome"], row["count"])
    elif a.stage == "load":
        stages.load_extractions(spark, a.base, a.year, a.full_reload).show()
    else:
        for name, report in stages.dashboard(spark, a.base).items():
            report.write.mode("overwrite").parquet(f"{a.out}/{name}")
            print(f"{a.out}/{name}")


if __name__ == "__main__":
    main()
