"""Run the daily batch, or one stage of it: ``spark-submit ... marquee/__main__.py --root /data``."""

from __future__ import annotations

import argparse
import sys
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from marquee.plans.daily import Batch, raw_paths  # noqa: E402
from marquee.sources.jdbc import JdbcTarget  # noqa: E402
from marquee.specs import TABLES  # noqa: E402

STAGES = {
    "all": Batch.run,
    "check-inputs": Batch.check_inputs,
    "land": Batch.land,
    "cleanse": Batch.cleanse,
    "aggregate": Batch.aggregate,
    "publish-run-log": Batch.publish_run_log,
}


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="marquee", description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the zones, on storage that all executors share")
    parser.add_argument("--date", type=date.fromisoformat, default=date.today(), help="batch date, today if not given")
    parser.add_argument("--run-id", help="name of the run; one that broke off goes on when it is named again")
    parser.add_argument("--stage", choices=STAGES, default="all")
    parser.add_argument(
        "--input",
        action="append",
        default=[],
        metavar="TABLE=PATH",
        help=f"raw input, instead of <root>/cache/<table>.tsv.gz; tables: {', '.join(TABLES)}",
    )
    parser.add_argument("--jdbc-url", help="serving store; nothing is published without it")
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password-file", type=Path)
    return parser.parse_args(given)


def batch(spark: SparkSession, args: argparse.Namespace) -> Batch:
    inputs = raw_paths(args.root) | dict(item.split("=", 1) for item in args.input)
    unknown = set(inputs) - set(TABLES)
    if unknown:
        raise ValueError(f"unknown tables: {', '.join(sorted(unknown))}")
    publish = None
    if args.jdbc_url:
        password = args.jdbc_password_file.read_text().strip() if args.jdbc_password_file else None
        publish = JdbcTarget(args.jdbc_url, args.jdbc_driver, args.jdbc_user, password).overwrite
    return Batch(spark, inputs, args.root, args.date, publish, run_id=args.run_id)


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName("marquee").getOrCreate()
    STAGES[args.stage](batch(spark, args))
    spark.stop()


if __name__ == "__main__":
    main()
