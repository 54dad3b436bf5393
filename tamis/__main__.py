"""Command line for the two batch runs; prints the result as JSON.

    python -m tamis extract --url jdbc:mysql://host/db --bronze s3a://bronze
    python -m tamis transform --bronze s3a://bronze --silver s3a://silver

Under `spark-submit`, pass this file and the package with `--py-files`.
Secrets stay out of the arguments: `JDBC_USER`, `JDBC_PASSWORD`,
`S3_ACCESS_KEY` and `S3_SECRET_KEY` are read from the environment.
"""

from __future__ import annotations

import argparse
import json
import os
from collections.abc import Sequence
from dataclasses import asdict
from datetime import date

from tamis.plans.bronze import extract
from tamis.plans.silver import transform
from tamis.session import get_spark_session
from tamis.sources.lake import WRITE_MODES
from tamis.spec import INSPECTION


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--bronze", required=True, help="root of the Bronze layer")
    common.add_argument("--layout", choices=("ingest_date", "ymd"), default="ingest_date")
    common.add_argument("--versioned", action="store_true", help="publish a version of the table instead of swapping it")
    common.add_argument("--s3-endpoint")
    common.add_argument("--hive", action="store_true", help="use the Hive catalog")
    common.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="a Spark setting")

    top = argparse.ArgumentParser(prog="tamis")
    commands = top.add_subparsers(dest="command", required=True)

    bronze = commands.add_parser("extract", parents=[common], help="database table to today's Bronze snapshot")
    bronze.add_argument("--url", required=True, help="JDBC URL")
    bronze.add_argument("--table", default=INSPECTION.name)
    bronze.add_argument("--partition-column", default="id", help="'' reads in a single query")
    bronze.add_argument("--num-partitions", type=int, default=16)
    bronze.add_argument("--split", choices=("even", "equi_depth"), default="even", help="how the partition column is cut into ranges")
    bronze.add_argument("--high-water", action="store_true", help="stop all ranges at the highest key found first")
    bronze.add_argument("--day", type=date.fromisoformat, help="snapshot date, today in UTC by default")

    silver = commands.add_parser("transform", parents=[common], help="latest Bronze snapshot to Silver")
    silver.add_argument("--silver", required=True, help="root of the Silver layer")
    silver.add_argument("--mode", choices=WRITE_MODES, type=str.lower, default="overwrite")
    silver.add_argument("--partition-by", nargs="*", default=[])
    return top


def credentials() -> dict[str, str]:
    named = {"user": os.environ.get("JDBC_USER"), "password": os.environ.get("JDBC_PASSWORD")}
    return {key: value for key, value in named.items() if value}


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = get_spark_session(
        f"tamis {args.command}",
        hive=args.hive,
        s3_endpoint=args.s3_endpoint,
        s3_access_key=os.environ.get("S3_ACCESS_KEY"),
        s3_secret_key=os.environ.get("S3_SECRET_KEY"),
        options=dict(setting.split("=", 1) for setting in args.conf),
    )
    if args.command == "extract":
        result = extract(
            spark,
            args.url,
            args.table,
            args.bronze,
            day=args.day,
            layout=args.layout,
            partition_column=args.partition_column or None,
            num_partitions=args.num_partitions,
            split=args.split,
            high_water=args.high_water,
            versioned=args.versioned,
            properties=credentials(),
        )
    else:
        result = transform(
            spark, args.bronze, args.silver, layout=args.layout, mode=args.mode, partition_by=args.partition_by, versioned=args.versioned
        )
    print(json.dumps(asdict(result)))


if __name__ == "__main__":
    main()
