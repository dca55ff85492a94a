"""The jobs, to be started with ``spark-submit`` or ``python -m tripmart.jobs``."""

import argparse
import time
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmart.operators.filters import rejected_trips
from tripmart.operators.sinks import publish, write_parquet
from tripmart.plans import ledger, marts, models
from tripmart.plans.warehouse import Warehouse, backfill, init_warehouse, load_batch, vacuum
from tripmart.schemas import GREEN_RENAMES
from tripmart.sources.normalise import read_files
from tripmart.sources.trips import (
    SOURCE_FILE,
    batch_path,
    parse_year,
    read_trips,
    read_zones,
    with_source_row,
)
from tripmart.streaming.landing import load_landed


def _normalise(spark: SparkSession, args: argparse.Namespace) -> None:
    renames = GREEN_RENAMES if args.fleet == "green" else None
    if args.ledger is None:
        write_parquet(read_files(spark, args.files, renames), args.out)
        return
    scan = spark.read.option("recursiveFileLookup", True).option("mergeSchema", False)
    files = ledger.to_normalise(scan.parquet(*args.files), args.ledger, args.year, args.fleet)
    for row in ledger.period_states(files).orderBy("year", "month", "state").collect():
        print(f"{row['year']}-{row['month']:02d}: {row['state']}, {row['rows']} rows of {row['files']} files")
    todo = files.filter(F.col("state") != ledger.LOADED)
    paths = [unquote(row[SOURCE_FILE]) for row in todo.select(SOURCE_FILE).toLocalIterator()]
    if paths:
        run = f"{args.out.rstrip('/')}/{uuid.uuid4().hex}"
        write_parquet(read_files(spark, paths, renames), run)
        ledger.enter(todo, args.ledger)


def _rejects(spark: SparkSession, args: argparse.Namespace) -> None:
    rejected = rejected_trips(with_source_row(read_trips(spark, args.area)))
    write_parquet(rejected, args.out, partition_by=["reason"])
    found = spark.read.parquet(args.out).groupBy("reason").count().orderBy("reason")
    for row in found.collect():
        print(f"{row['reason']}: {row['count']} trips")


def _zone_history(spark: SparkSession, args: argparse.Namespace) -> None:
    stored = Warehouse(spark, args.warehouse).require_loaded()
    publish(marts.trips_per_pickup_version(stored), args.marts, "trips_per_pickup_version")
    publish(marts.trips_per_dropoff_version(stored), args.marts, "trips_per_dropoff_version")


def _vacuum(spark: SparkSession, args: argparse.Namespace) -> None:
    deleted = vacuum(spark, args.warehouse, time.time() - args.older_than_hours * 3600)
    print(f"{deleted} attempts deleted")


def _init(spark: SparkSession, args: argparse.Namespace) -> None:
    path = batch_path(args.area, args.year, args.folder)
    init_warehouse(
        with_source_row(read_trips(spark, path)),
        read_zones(spark, args.zones),
        args.warehouse,
        (args.year, args.year),
        args.known_zones_only,
    )


def _batch(spark: SparkSession, args: argparse.Namespace) -> None:
    stored = Warehouse(spark, args.warehouse)
    following = 0 if stored.last_load is None else stored.last_load + 1
    path = batch_path(args.area, args.year, args.folder)
    load_batch(
        with_source_row(read_trips(spark, path)),
        read_zones(spark, args.zones),
        args.warehouse,
        following if args.load is None else args.load,
        (args.year, args.year),
    )


def _backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    years = range(args.first, args.last + 1)
    paths = [batch_path(args.area, year, args.folder) for year in years]
    backfill(
        with_source_row(read_trips(spark, *paths)),
        read_zones(spark, args.zones),
        args.warehouse,
        args.first,
        args.last,
    )


def _landed(spark: SparkSession, args: argparse.Namespace) -> None:
    load_landed(
        spark,
        args.area,
        read_zones(spark, args.zones),
        args.warehouse,
        args.checkpoint,
        args.first_load,
        args.files_per_batch,
        None if args.year is None else (args.year, args.year),
    )


def _reports(spark: SparkSession, args: argparse.Namespace) -> None:
    marts.publish_all(Warehouse(spark, args.warehouse).require_loaded(), args.marts)


def _clusters(spark: SparkSession, args: argparse.Namespace) -> None:
    stored = Warehouse(spark, args.warehouse).require_loaded()
    pickup = models.cluster_zones(stored.dim_pickup_location(), "pickup")
    dropoff = models.cluster_zones(stored.dim_dropoff_location(), "dropoff")
    publish(pickup, args.marts, "kmean_pickup_location")
    publish(dropoff, args.marts, "kmean_dropoff_location")


def _correlation(spark: SparkSession, args: argparse.Namespace) -> None:
    facts = models.trip_features(Warehouse(spark, args.warehouse).require_loaded())
    publish(models.correlation_matrix(facts), args.marts, "feature_correlation")


def _scores(spark: SparkSession, args: argparse.Namespace) -> None:
    facts = models.trip_features(
        Warehouse(spark, args.warehouse).require_loaded(), args.year
    )
    models.publish_scores(models.assemble(facts, models.FEATURES), args.marts)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, run, about: str, *groups: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=about)
        sub.set_defaults(run=run)
        if "load" in groups:
            sub.add_argument("--area", required=True, help="folder of raw trips")
            sub.add_argument("--zones", required=True, help="zone lookup CSV")
        if "years" in groups:
            sub.add_argument("--folder", default="{year}", help="folder of a year in the area")
        if "out" not in groups:
            sub.add_argument("--warehouse", required=True, help="root of the stored tables")
        if "marts" in groups:
            sub.add_argument("--marts", required=True, help="folder of the result tables")
        return sub

    sub = job("normalise", _normalise, "bring monthly files to the raw contract", "out")
    sub.add_argument("--files", nargs="+", required=True, help="areas of any layouts")
    sub.add_argument("--fleet", choices=["yellow", "green"], default="yellow")
    sub.add_argument("--out", required=True)
    sub.add_argument("--ledger", help="folder of the record of files done; those in it are skipped")
    sub.add_argument("--year", type=parse_year, help="with a ledger, files of one year only")

    sub = job("rejects", _rejects, "write the trips that loads leave out, by reason", "out")
    sub.add_argument("--area", required=True, help="folder of raw trips")
    sub.add_argument("--out", required=True)

    sub = job("init", _init, "build all tables from one year", "load", "years")
    sub.add_argument("--year", type=parse_year, required=True)
    sub.add_argument("--known-zones-only", action="store_true")

    sub = job("batch", _batch, "append one year", "load", "years")
    sub.add_argument("--year", type=parse_year, required=True)
    sub.add_argument("--load", type=int, help="number of a load to run again")

    sub = job("backfill", _backfill, "append a range of years in one pass", "load", "years")
    sub.add_argument("--first", type=parse_year, required=True)
    sub.add_argument("--last", type=parse_year, required=True)

    sub = job("landed", _landed, "append the files that landed since the last run", "load")
    sub.add_argument("--checkpoint", required=True)
    sub.add_argument("--first-load", type=int, default=0, help="lowest number of a load")
    sub.add_argument("--year", type=parse_year, help="keep trips of one pickup year")
    sub.add_argument("--files-per-batch", type=int)

    job("reports", _reports, "replace the eight report tables", "marts")
    job("zone-history", _zone_history, "replace the tables of trips per zone version", "marts")
    job("clusters", _clusters, "replace the two zone cluster tables", "marts")
    job("correlation", _correlation, "replace the correlation table", "marts")
    sub = job("scores", _scores, "train the models and replace the score table", "marts")
    sub.add_argument("--year", type=parse_year)
    sub = job("vacuum", _vacuum, "delete the files of attempts that died or were replaced")
    sub.add_argument("--older-than-hours", type=float, default=168.0)
    return parser


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    args.run(spark, args)


def main() -> None:
    args = _parser().parse_args()
    builder = SparkSession.builder.appName(f"tripmart {args.job}")
    # Timestamps of files that are stored in UTC are read as UTC wherever the job runs.
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
