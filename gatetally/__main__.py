"""Run a batch job from the command line: ``curate`` or ``analyse``."""

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gatetally.plans import jobs
from gatetally.session import SETTINGS
from gatetally.sources.relational import connection_options


def parsed(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gatetally")
    commands = parser.add_subparsers(dest="job", required=True)
    curate, analyse = commands.add_parser("curate"), commands.add_parser("analyse")
    for command in (curate, analyse):
        command.add_argument("--base", required=True, help="folder holding raw, curated and analytics")
        command.add_argument("--replace", choices=["all", "days"], default="all", help="whole layers, or days with rows")
    curate.add_argument("--tenant", required=True)
    curate.add_argument("--strict", action="store_true", help="also drop copies and sales of unknown events")
    curate.add_argument("--open-fields", action="store_true", help="keep fields outside the contract")
    analyse.add_argument("--days", nargs="+", help="compute and replace these days only")
    analyse.add_argument("--jdbc-url", help="publish the metrics to this database as well")
    analyse.add_argument("--keep-tables", action="store_true", help="refill existing tables")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Run the chosen job and return its row counts."""
    if args.job == "curate":
        return jobs.curate_all(spark, args.base, args.tenant, args.strict, args.replace, args.open_fields)
    database = None
    if args.jdbc_url:
        database = jobs.Database(args.jdbc_url, connection_options(), args.keep_tables)
    return jobs.analyse_all(spark, args.base, database, args.replace, args.days)


def main() -> None:
    args = parsed()
    builder = SparkSession.builder.appName(f"gatetally-{args.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    run(spark, args).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
