"""python -m sessionvol ingest FEEDS CSV | build CSV [--prefix P] [--location FOLDER]"""

from __future__ import annotations

import argparse

from sessionvol import pipeline
from sessionvol.plans.layers import MARTS, Layers
from sessionvol.session import spark_session


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sessionvol")
    steps = parser.add_subparsers(dest="step", required=True)
    ingest = steps.add_parser("ingest", help="vendor files to raw CSV datasets")
    ingest.add_argument("feeds", help="folder with metadata, intraday and daily")
    ingest.add_argument("csv", help="folder for the datasets")
    build = steps.add_parser("build", help="raw CSV datasets to raw, staging and mart tables")
    build.add_argument("csv")
    build.add_argument("--prefix", default="", help="put before the database names")
    build.add_argument("--location", help="folder for the databases")
    build.add_argument("--partitions", type=int, help="range partitions of the large tables")
    build.add_argument("--buckets", type=int, help="buckets of the marts that are joined by day")
    options = parser.parse_args(arguments)
    spark = spark_session()
    if options.step == "ingest":
        for name, report in pipeline.ingest(spark, options.feeds, options.csv).items():
            print(name)
            report.orderBy(*report.columns).show(100, truncate=False)
        return
    built = pipeline.build(spark, options.csv, Layers(
        spark, prefix=options.prefix, location=options.location,
        partitions=options.partitions, buckets=options.buckets,
    ))
    for mart, order in MARTS.items():
        print(mart)
        built.table("marts", mart).orderBy(*order).show(5)


if __name__ == "__main__":
    main()
