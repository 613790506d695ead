"""Command line of the jobs.

    python -m salesloom.jobs ingest    --paths DIR_OR_GLOB --target STORE
    python -m salesloom.jobs snowflake --source STORE --target STORE [--dense]
    python -m salesloom.jobs star      --source STORE --target STORE [--dense | --pack]
    python -m salesloom.jobs months    --source STORE --target FOLDER [--replace]
    python -m salesloom.jobs marts     --source STORE --target STORE
    python -m salesloom.jobs load      --paths DIR_OR_GLOB --feed NAME --target FOLDER [--content-keys]

``months`` writes the star fact in a folder per month; with ``--replace`` only the months of the
staged sales, each whole. ``load`` adds a named feed to a folder of versioned tables of both models and publishes them
together if the audit is clean; records that cannot be read go to the table ``rejects``. Its exit code
is 1 if the load was rejected, with the violations on the output.

A store is a folder of parquet tables, ``catalog:SCHEMA`` for tables of the session's catalog,
``versions:FOLDER`` for the current version of what ``load`` has written (to read only),
or a ``jdbc:`` URL. Properties of a database connection are given as ``--jdbc name=value``,
its driver jar to spark-submit. ``--jdbc-splits N`` reads each table over N connections.
"""

from __future__ import annotations

import argparse

from salesloom.jobs import loads, warehouse
from salesloom.session import build_session, remove_materialized
from salesloom.sources.csv_feed import read_csv_with_rejects
from salesloom.sources.tables import CatalogStore, FileStore, JdbcStore, Store
from salesloom.sources.versions import VersionedStore


def store(name: str, properties: dict[str, str], splits: int = 1, split_by: str = "id") -> Store:
    """The store that a command-line name stands for."""
    if name.startswith("jdbc:"):
        return JdbcStore(name, properties, splits=splits, split_by=split_by)
    if name.startswith("versions:"):
        return VersionedStore(name.removeprefix("versions:"))
    if name.startswith("catalog:"):
        return CatalogStore(name.removeprefix("catalog:"))
    return FileStore(name)


def add_feed(spark, args) -> bool:
    """Load, report, publish; False if the load was rejected."""
    good, bad = read_csv_with_rejects(spark, args.paths)
    target = VersionedStore(args.target)
    dense = not args.content_keys
    outcome = loads.load_feed(spark, target, good.drop("file", "record"), args.feed, {
        "snowflake": lambda *a: loads.add_to_snowflake(*a, dense=dense),
        "star": lambda *a: loads.add_to_star(*a, dense=dense),
    }, rejects=bad)
    if outcome is None:
        print(f"{args.feed}\tloaded before")
        return True
    if outcome.published:
        print(f"{args.feed}\tversion {outcome.version}")
        return True
    for line in outcome.report.where("violations > 0").collect():  # a line per rule at most
        print("\t".join(map(str, line)))
    return False


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="salesloom.jobs")
    parser.add_argument("job", choices=("ingest", "snowflake", "star", "months", "marts", "load"))
    parser.add_argument("--paths", nargs="+", help="CSV files, folders or globs (ingest, load)")
    parser.add_argument("--feed", help="name of the feed (load); a name is loaded once")
    parser.add_argument("--content-keys", action="store_true", help="hashed ids (load)")
    parser.add_argument("--source", help="store of the input tables")
    parser.add_argument("--target", required=True, help="store of the output tables")
    parser.add_argument("--dense", action="store_true", help="number ids 1..n")
    parser.add_argument("--pack", action="store_true", help="hashed ids of 16 bytes (star)")
    parser.add_argument("--replace", action="store_true", help="replace the staged months (months)")
    parser.add_argument("--jdbc", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--jdbc-splits", type=int, default=1, help="connections per table read")
    parser.add_argument("--jdbc-split-by", default="id", help="text column that deals the rows")
    parser.add_argument("--master", help="Spark master, if not set by spark-submit")
    args = parser.parse_args(arguments)
    if args.job in ("ingest", "load") and not args.paths:
        parser.error(f"{args.job} needs --paths")
    if args.job == "load" and not args.feed:
        parser.error("load needs --feed")
    if args.job not in ("ingest", "load") and not args.source:
        parser.error(f"{args.job} needs --source")

    spark = build_session(f"salesloom {args.job}", args.master)
    if args.job == "load":
        done = add_feed(spark, args)
        remove_materialized(spark)
        spark.stop()
        if not done:
            raise SystemExit(1)
        return
    properties = dict(p.split("=", 1) for p in args.jdbc)
    target = store(args.target, properties)
    if args.job == "ingest":
        counts = warehouse.ingest(spark, args.paths, target)
    else:
        source = store(args.source, properties, args.jdbc_splits, args.jdbc_split_by)
        if args.job == "marts":
            counts = warehouse.build_marts(spark, source, target)
        elif args.job == "months":
            if not isinstance(target, FileStore):
                parser.error("months are written to a folder")
            counts = warehouse.build_months(spark, source, target, args.replace)
        elif args.job == "star":
            counts = warehouse.build_star(spark, source, target, args.dense, args.pack)
        else:
            counts = warehouse.build_snowflake(spark, source, target, args.dense)
    for table, rows in counts.items():
        print(f"{table}\t{rows}")
    remove_materialized(spark)
    spark.stop()


if __name__ == "__main__":
    main()
