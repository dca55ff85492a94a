"""Every operator as a query over the driver's tables."""

import datetime
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.checks.fixtures import YEAR_FOLDER, land, land_green, land_mixed_layouts
from tripmart.functions.calendar import (
    calendar_parts,
    code_label,
    fractional_hour,
    weekday_name,
    year_start,
)
from tripmart.operators import changes, filters, keys, sinks
from tripmart.operators.joins import broadcast_up_to, join_unique
from tripmart.plans import ledger, marts, models
from tripmart.plans import warehouse as wh
from tripmart.sources import normalise, trips
from tripmart.storage import new_folder, remove_folder
from tripmart.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]

# A year of the test data that parts early trips from late ones.
SPLIT_YEAR = 1997
# When the zones of the test history change, and from when its first lookup holds.
ZONES_FROM, REFORM = datetime.date(1995, 1, 1), datetime.date(1999, 1, 1)

_WAREHOUSES: dict[tuple[str, str], wh.Warehouse] = {}
QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# Inputs


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.read_trips(spark, land(spark, sf_dir).area)


def _years(spark: SparkSession, sf_dir: str) -> list[int]:
    """The years trips were picked up in, as the area has folders for them."""
    found = _raw(spark, sf_dir).select(F.year(wh.PAIR[0]).alias("year")).distinct()
    return sorted(row["year"] for row in found.collect())


def _raw_years(spark: SparkSession, sf_dir: str, years: list[int]) -> DataFrame:
    area = land(spark, sf_dir).area
    return trips.read_trips(spark, *(trips.batch_path(area, year, YEAR_FOLDER) for year in years))


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.read_zones(spark, land(spark, sf_dir).zones)


def _build(spark: SparkSession, sf_dir: str) -> wh.Warehouse:
    scan = trips.with_source_row(_raw(spark, sf_dir))
    return wh.init_warehouse(scan, _zones(spark, sf_dir), new_folder(spark, "warehouse"))


def stored_warehouse(spark: SparkSession, sf_dir: str) -> wh.Warehouse:
    """The warehouse of one set of tables, built once per application as the jobs build it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = _build(spark, sf_dir)
    return _WAREHOUSES[key]


def _keyed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = trips.with_source_row(_raw(spark, sf_dir))
    folder = new_folder(spark, "offsets")
    return keys.number_rows(filters.valid_trips(scan), scan, "trip_id", 0, folder)[0]


# Scans and sources


@_register
def scan_trips(spark, sf_dir):
    return _raw(spark, sf_dir)


@_register
def scan_zones_csv(spark, sf_dir):
    return _zones(spark, sf_dir)


@_register
def scan_warehouse(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).fact_trip()


@_register
def scan_partition_pruned(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).dim_datetime().filter(F.col("pick_year") == SPLIT_YEAR)


@_register
def scan_batch_year(spark, sf_dir):
    path = trips.batch_path(land(spark, sf_dir).area, str(SPLIT_YEAR), YEAR_FOLDER)
    return trips.read_trips(spark, path)


@_register
def ingest_landing(spark, sf_dir):
    area = land(spark, sf_dir).area
    target, checkpoint = new_folder(spark, "ingested"), new_folder(spark, "ingest-checkpoint")
    for _ in range(2):  # the second run finds nothing new
        landing.ingest_landing(spark, area, target, checkpoint)
    return spark.read.schema(schemas.RAW_TRIP).parquet(target)


@_register
def last_key(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    last_date = keys.last_key(stored.dim_datetime(), "datetime_id").scalar()
    return keys.last_key(stored.fact_trip(), "trip_id").withColumn("datetime_id", last_date)


# Normalisation


@_register
def normalize_project(spark, sf_dir):
    return normalise.keep_contract_columns(spark.read.parquet(land(spark, sf_dir).area))


@_register
def normalize_dropna(spark, sf_dir):
    return normalise.normalise(spark.read.parquet(land(spark, sf_dir).area))


@_register
def normalize_cast(spark, sf_dir):
    older, newer = land_mixed_layouts(spark, _raw(spark, sf_dir))
    cast = normalise.cast_to_contract
    return cast(spark.read.parquet(older)).unionByName(cast(spark.read.parquet(newer)))


@_register
def normalize_write(spark, sf_dir):
    staging = new_folder(spark, "normalised")
    areas = land_mixed_layouts(spark, _raw(spark, sf_dir))
    sinks.write_parquet(normalise.read_files(spark, areas), staging)
    for area in areas:
        remove_folder(spark, area)
    return trips.read_trips(spark, staging)


@_register
def normalize_fleet(spark, sf_dir):
    area = land_green(spark, _raw(spark, sf_dir))
    return normalise.read_files(spark, [area], schemas.GREEN_RENAMES)


@_register
def file_period(spark, sf_dir):
    return normalise.landed_periods(_raw(spark, sf_dir))


@_register
def new_periods(spark, sf_dir):
    landed = normalise.landed_periods(_raw(spark, sf_dir))
    loaded = landed.filter(F.col("year") * 100 + F.col("month") < SPLIT_YEAR * 100 + 7)
    return normalise.new_periods(landed, loaded, SPLIT_YEAR)


@_register
def period_floor(spark, sf_dir):
    return normalise.after_year(normalise.landed_periods(_raw(spark, sf_dir)), SPLIT_YEAR)


# Projections and filters


@_register
def filter_dropna(spark, sf_dir):
    return filters.complete_trips(_raw(spark, sf_dir))


@_register
def filter_year(spark, sf_dir):
    return filters.picked_up_in(_raw(spark, sf_dir), SPLIT_YEAR)


@_register
def filter_valid_trips(spark, sf_dir):
    return filters.valid_trips(_raw(spark, sf_dir), (SPLIT_YEAR, SPLIT_YEAR))


@_register
def filter_not_in(spark, sf_dir):
    return filters.paid(_raw(spark, sf_dir))


@_register
def project_prune(spark, sf_dir):
    fact = stored_warehouse(spark, sf_dir).fact_trip()
    return fact.select("trip_id", "datetimestamp_id", "pu_location_id")


@_register
def project_rename(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        F.col("VendorID").alias("vendor_id"),
        F.col("PULocationID").alias("pu_location_id"),
        F.col("DOLocationID").alias("do_location_id"),
        F.col("RatecodeID").alias("ratecode_id"),
        F.col("payment_type").alias("payment_id"),
        "total_amount",
    )


@_register
def project_with_renamed(spark, sf_dir):
    zones = stored_warehouse(spark, sf_dir).dim_pickup_location()
    return zones.withColumnRenamed("X", "pickup_x").withColumnRenamed("Y", "pickup_y")


@_register
def project_derive(spark, sf_dir):
    pair = _raw(spark, sf_dir).select(*wh.PAIR)
    return pair.withColumns(
        calendar_parts(F.col(wh.PAIR[0]), "pick") | calendar_parts(F.col(wh.PAIR[1]), "drop")
    )


@_register
def project_drop(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    unused = set(schemas.DIM_DATETIME.names) - set(models.FEATURES)
    return stored.facts_with_dates().drop("datetimestamp_id", *unused)


@_register
def alias_qualified(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    fact = stored.fact_trip().alias("fact")
    payments = F.broadcast(stored.dim_payment()).alias("pay")  # a row per known code at most
    return fact.join(payments, F.col("fact.payment_id") == F.col("pay.payment_type")).select(
        F.col("fact.trip_id").alias("trip_id"), F.col("pay.payment_type_name").alias("payment_name")
    )


@_register
def cast_long(spark, sf_dir):
    narrow = _raw(spark, sf_dir).select(
        F.col("RatecodeID").cast("int"), F.col("payment_type").cast("int")
    )
    return narrow.select(
        F.col("RatecodeID").cast("long").alias("ratecode_id"),
        F.col("payment_type").cast("long").alias("payment_id"),
    )


@_register
def cast_hour_int(spark, sf_dir):
    dates = stored_warehouse(spark, sf_dir).dim_datetime()
    return dates.select("datetime_id", F.col("pick_hour").cast("int").alias("hour"))


@_register
def case_label(spark, sf_dir):
    code = F.col("payment_type")
    return _raw(spark, sf_dir).select(
        "payment_type", code_label(code, schemas.PAYMENT_NAMES).alias("payment_type_name")
    )


# Joins


@_register
def join_fact_datetime(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).facts_with_dates().select(
        "trip_id", "datetime_id", "pick_year", "pick_hour", "pick_weekday", "pick_weekday_id"
    )


@_register
def join_composite(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    dates = stored.dim_datetime().select(*wh.PAIR, "datetime_id")
    hot = stored.hot_pairs().select(*wh.PAIR, "salts")
    clean = filters.valid_trips(trips.with_source_row(_raw(spark, sf_dir)))
    joined = join_unique(clean, dates, wh.PAIR, hot, trips.SOURCE_ROW)
    return joined.select(*schemas.RAW_TRIP.names, "datetime_id")


@_register
def join_broadcast(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    payments = F.broadcast(filters.paid(stored.dim_payment()))  # a row per known code at most
    joined = stored.fact_trip().join(payments, F.col("payment_id") == F.col("payment_type"))
    return joined.select("trip_id", "payment_id", "payment_type_name")


def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stored_warehouse(spark, sf_dir)
    zones = broadcast_up_to(stored.dim_pickup_location(), wh.MAX_BROADCAST_ZONES)
    return stored.facts_with_dates().join(zones, F.col("pu_location_id") == F.col("PULocationID"))


@_register
def join_star(spark, sf_dir):
    return _star(spark, sf_dir).select(
        "trip_id", F.col("pick_year").alias("year"), F.col("PULocationID").alias("LocationID"),
        "zone", "borough",
    )


@_register
def join_lookup(spark, sf_dir):
    return wh.build_dim_location(_raw(spark, sf_dir), _zones(spark, sf_dir), wh.PICKUP)


@_register
def fact_known_zone(spark, sf_dir):
    known = wh.known_zones(_keyed_trips(spark, sf_dir), _zones(spark, sf_dir))
    stored = stored_warehouse(spark, sf_dir)
    facts = wh.build_fact(known, stored.dim_datetime(), stored.hot_pairs())
    return facts.select(*schemas.FACT_TRIP.names)


@_register
def fact_all_zone(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    keyed = _keyed_trips(spark, sf_dir)
    facts = wh.build_fact(keyed, stored.dim_datetime(), stored.hot_pairs())
    return facts.select(*schemas.FACT_TRIP.names)


@_register
def join_key_widen(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    # Read without a schema the partition column comes back as int.
    payments = spark.read.parquet(f"{stored.root}/{wh.PAYMENT.name}").select(
        F.col("payment_type").cast("long"), "payment_type_name"
    )
    return (
        stored.fact_trip()
        .join(F.broadcast(payments), F.col("payment_id") == F.col("payment_type"))
        .select("trip_id", "payment_type", "payment_type_name")
    )


# Aggregations


@_register
def agg_total(spark, sf_dir):
    return marts.agg_total(stored_warehouse(spark, sf_dir))


@_register
def agg_per_year(spark, sf_dir):
    return marts.agg_per_year(marts.paid_totals(stored_warehouse(spark, sf_dir)))


@_register
def agg_wide_key(spark, sf_dir):
    stored = stored_warehouse(spark, sf_dir)
    return marts.trips_per_year_and_zone(stored, "pu_location_id", stored.dim_pickup_location())


@_register
def agg_max(spark, sf_dir):
    names = ("passenger_count", "trip_distance", "fare_amount", "total_amount")
    return _raw(spark, sf_dir).agg(*(F.max(name).alias(f"max_{name}") for name in names))


@_register
def distinct_pairs(spark, sf_dir):
    return wh.distinct_pairs(filters.valid_trips(_raw(spark, sf_dir)))


@_register
def head_rows(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).dim_datetime().orderBy("datetime_id").limit(5)


# Set operations


@_register
def dim_new_rows(spark, sf_dir):
    clean = filters.valid_trips(_raw(spark, sf_dir))
    stored = wh.distinct_pairs(clean.filter(_early()))
    return changes.new_rows(wh.distinct_pairs(clean), stored)


@_register
def append_union(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return changes.append_rows(raw, filters.valid_trips(raw))


# Scalar functions


@_register
def fn_date_parts(spark, sf_dir):
    pickup = F.col(wh.PAIR[0])
    return _raw(spark, sf_dir).select(
        pickup,
        F.year(pickup).alias("year"),
        F.month(pickup).alias("month"),
        F.dayofmonth(pickup).alias("day"),
    )


@_register
def fn_fractional_hour(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        wh.PAIR[0], fractional_hour(F.col(wh.PAIR[0])).alias("pick_hour")
    )


@_register
def fn_dayofweek(spark, sf_dir):
    dropoff = F.col(wh.PAIR[1])
    return _raw(spark, sf_dir).select(dropoff, F.dayofweek(dropoff).alias("drop_weekday_id"))


@_register
def fn_weekday_name(spark, sf_dir):
    dropoff = F.col(wh.PAIR[1])
    return _raw(spark, sf_dir).select(
        dropoff, weekday_name(F.dayofweek(dropoff)).alias("drop_weekday")
    )


# Sinks


@_register
def sink_overwrite(spark, sf_dir):
    path = new_folder(spark, "overwrite")
    raw = _raw(spark, sf_dir)
    sinks.write_parquet(raw, path)
    sinks.write_parquet(filters.valid_trips(raw), path)
    return trips.read_trips(spark, path)


@_register
def sink_append(spark, sf_dir):
    path = new_folder(spark, "append")
    raw = _raw(spark, sf_dir)
    sinks.write_parquet(raw, path)
    sinks.write_parquet(filters.valid_trips(raw), path, "append")
    return trips.read_trips(spark, path)


@_register
def sink_partition_one(spark, sf_dir):
    path = new_folder(spark, "by-payment")
    sinks.write_parquet(_raw(spark, sf_dir), path, partition_by=["payment_type"])
    return spark.read.schema(schemas.RAW_TRIP).parquet(path).select(*schemas.RAW_TRIP.names)


@_register
def sink_partition_two(spark, sf_dir):
    path = new_folder(spark, "by-month")
    dates = stored_warehouse(spark, sf_dir).dim_datetime()
    sinks.write_parquet(dates, path, partition_by=["pick_year", "pick_month"])
    names = schemas.DIM_DATETIME.names
    return spark.read.schema(schemas.DIM_DATETIME).parquet(path).select(*names)


@_register
def sink_bucketed(spark, sf_dir):
    path = new_folder(spark, "bucketed")
    table = "fact_" + path.rsplit("-", 1)[1]
    sinks.write_bucketed(stored_warehouse(spark, sf_dir).fact_trip(), table, path, "trip_id", 24)
    spark.sql(f"drop table {table}")  # the files stay at their path
    return spark.read.schema(schemas.FACT_TRIP).parquet(path)


@_register
def sink_coalesce(spark, sf_dir):
    path = new_folder(spark, "coalesced")
    sinks.write_parquet(_raw(spark, sf_dir), path, files=12)
    return trips.read_trips(spark, path)


@_register
def mart_publish(spark, sf_dir):
    area = new_folder(spark, "marts")
    marts.publish_all(stored_warehouse(spark, sf_dir), area)
    return sinks.read_published(spark, area, "trips_per_hour")


@_register
def mart_append(spark, sf_dir):
    area = new_folder(spark, "scores")
    facts = stored_warehouse(spark, sf_dir).fact_trip()
    for mode, prediction in (("overwrite", "fare_amount"), ("append", "tip_amount")):
        scores = models.regression_metrics(facts, prediction, prediction)
        sinks.publish(scores, area, "scores", mode)
    return _rounded(sinks.read_published(spark, area, "scores"))


# Warehouse


@_register
def dim_datetime(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).dim_datetime()


@_register
def dim_pickup_location(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).dim_pickup_location()


@_register
def dim_dropoff_location(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).dim_dropoff_location()


@_register
def dim_rate_code(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).dim_rate_code()


@_register
def dim_payment(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).dim_payment()


@_register
def dim_vendor(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).dim_vendor()


@_register
def fact_trip(spark, sf_dir):
    return stored_warehouse(spark, sf_dir).fact_trip()


def _early() -> Column:
    """Trips picked up in the split year or before, however early."""
    return F.col(wh.PAIR[0]) < year_start(SPLIT_YEAR + 1)


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wh.distinct_pairs(filters.valid_trips(_raw(spark, sf_dir)))


@_register
def surrogate_key(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    return keys.assign_key(pairs, wh.PAIR, "datetime_id", 0, new_folder(spark, "keys"))[0]


@_register
def surrogate_key_next(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    early, late = pairs.filter(_early()), pairs.filter(~_early())
    stored, _ = keys.assign_key(early, wh.PAIR, "datetime_id", 0, new_folder(spark, "keys"))
    start = keys.next_key(stored, "datetime_id")
    return keys.assign_key(late, wh.PAIR, "datetime_id", start, new_folder(spark, "keys"))[0]


@_register
def warehouse_init(spark, sf_dir):
    return _build(spark, sf_dir).fact_trip()


@_register
def warehouse_batch(spark, sf_dir):
    zones, root = _zones(spark, sf_dir), new_folder(spark, "warehouse")
    *before, last = _years(spark, sf_dir)
    wh.init_warehouse(trips.with_source_row(_raw_years(spark, sf_dir, before)), zones, root)
    late = trips.with_source_row(_raw_years(spark, sf_dir, [last]))
    for _ in range(2):  # the second run replaces the first
        stored = wh.load_batch(late, zones, root, 1, (last, last))
    return stored.fact_trip()


@_register
def warehouse_backfill(spark, sf_dir):
    zones, root = _zones(spark, sf_dir), new_folder(spark, "warehouse")
    first, *rest = _years(spark, sf_dir)
    early = trips.with_source_row(_raw_years(spark, sf_dir, [first]))
    wh.init_warehouse(early, zones, root, (first, first))
    late = trips.with_source_row(_raw_years(spark, sf_dir, rest))
    return wh.backfill(late, zones, root, rest[0], rest[-1]).fact_trip()


@_register
def incremental_load(spark, sf_dir):
    root, checkpoint = new_folder(spark, "warehouse"), new_folder(spark, "load-checkpoint")
    area, zones = land(spark, sf_dir).area, _zones(spark, sf_dir)
    for _ in range(2):  # the second run finds nothing new
        stored = landing.load_landed(spark, area, zones, root, checkpoint, 0, files_per_batch=50)
    # Keys follow the order in which files arrive; everything else equals a full rebuild.
    measures = schemas.FACT_TRIP.names[3:]
    return stored.facts_with_dates().select("vendor_id", *measures, *wh.PAIR)


def _rezoned(zones: DataFrame) -> DataFrame:
    """The same zones after a reform of one borough."""
    reformed = F.when(F.col("borough") == "ASIA", "SZ9").otherwise(F.col("service_zone"))
    return zones.withColumn("service_zone", reformed)


_HISTORIES: dict[tuple[str, str], wh.Warehouse] = {}


def _reformed_warehouse(spark: SparkSession, sf_dir: str) -> wh.Warehouse:
    """Two loads: early trips with a lookup that lacks a borough, and late ones after a reform."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _HISTORIES:
        zones, root = _zones(spark, sf_dir), new_folder(spark, "warehouse")
        scan = trips.with_source_row(_raw(spark, sf_dir))
        reform = F.lit(REFORM.isoformat()).cast("timestamp_ntz")
        old = zones.filter(F.col("borough") != "EUROPE")
        early, late = (scan.filter(F.col(wh.PAIR[0]) < reform), scan.filter(F.col(wh.PAIR[0]) >= reform))
        wh.load_batch(early, old, root, 0, zones_from=ZONES_FROM)
        _HISTORIES[key] = wh.load_batch(late, _rezoned(zones), root, 1, zones_from=REFORM)
    return _HISTORIES[key]


@_register
def scd_type1(spark, sf_dir):
    return _reformed_warehouse(spark, sf_dir).dim_pickup_location()


@_register
def scd_type2(spark, sf_dir):
    versions = _reformed_warehouse(spark, sf_dir).versions(wh.DROPOFF)
    return versions.select(*wh.DROPOFF.schema.names, "valid_from", "valid_to", "is_current")


@_register
def scd_upsert(spark, sf_dir):
    stored = wh.build_dim_location(_raw(spark, sf_dir), _zones(spark, sf_dir), wh.PICKUP)
    incoming = _rezoned(stored).filter(F.col("borough").isin("ASIA", "EUROPE"))
    kept = stored.filter(F.col("borough") != "EUROPE")
    return changes.upsert(kept, incoming, "PULocationID")


@_register
def scd_add_versions(spark, sf_dir):
    incoming = wh.build_dim_location(_raw(spark, sf_dir), _zones(spark, sf_dir), wh.DROPOFF)
    history = incoming.filter(F.col("borough") != "EUROPE").withColumns(
        {
            "valid_from": F.lit("1995-01-01").cast("date"),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )
    key, *attributes = schemas.DIM_DROPOFF_LOCATION.names
    changed_on = F.lit("1999-01-01").cast("date")
    return changes.add_versions(history, _rezoned(incoming), key, attributes, changed_on)


@_register
def trips_per_pickup_version(spark, sf_dir):
    return marts.trips_per_pickup_version(_reformed_warehouse(spark, sf_dir))


@_register
def trips_per_dropoff_version(spark, sf_dir):
    return marts.trips_per_dropoff_version(_reformed_warehouse(spark, sf_dir))


@_register
def trips_per_current_zone(spark, sf_dir):
    return marts.trips_per_pu_location(_reformed_warehouse(spark, sf_dir))


@_register
def period_ledger(spark, sf_dir):
    folder, scan = new_folder(spark, "ledger"), _raw(spark, sf_dir)
    done = ledger.landed_files(scan).filter(F.col("year") <= SPLIT_YEAR)
    ledger.enter(done, folder)
    files = ledger.judged(ledger.landed_files(scan), ledger.read_ledger(spark, folder))
    return ledger.period_states(files).drop("files")


@_register
def rejected_rows(spark, sf_dir):
    return filters.rejected_trips(_raw(spark, sf_dir)).select("reason", *schemas.RAW_TRIP.names)


# Reports


@_register
def payment_per_year(spark, sf_dir):
    return marts.payment_per_year(marts.paid_totals(stored_warehouse(spark, sf_dir)))


@_register
def agg_per_payment(spark, sf_dir):
    return marts.agg_per_payment(marts.paid_totals(stored_warehouse(spark, sf_dir)))


@_register
def trips_per_pu_location(spark, sf_dir):
    return marts.trips_per_pu_location(stored_warehouse(spark, sf_dir))


@_register
def trips_per_do_location(spark, sf_dir):
    return marts.trips_per_do_location(stored_warehouse(spark, sf_dir))


@_register
def trips_per_day(spark, sf_dir):
    return marts.trips_per_day(stored_warehouse(spark, sf_dir))


@_register
def trips_per_hour(spark, sf_dir):
    return marts.trips_per_hour(stored_warehouse(spark, sf_dir))


# Models


def _rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round statistics, which two engines add up in different order."""
    return df.select(
        *(
            F.round(field.name, digits).alias(field.name)
            if field.dataType.typeName() == "double"
            else F.col(field.name)
            for field in df.schema
        )
    )


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.trip_features(stored_warehouse(spark, sf_dir))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.assemble(_features(spark, sf_dir), models.FEATURES)


@_register
def ml_assemble(spark, sf_dir):
    values = vector_to_array("features")
    return _vectors(spark, sf_dir).select(
        "trip_id", *(values[i].alias(name) for i, name in enumerate(models.FEATURES))
    )


@_register
def ml_scale(spark, sf_dir):
    zones = stored_warehouse(spark, sf_dir).dim_pickup_location()
    values = vector_to_array("scaledFeatures")
    scaled = models.standardise(models.assemble(zones, ["X", "Y"])).select(
        "PULocationID", values[0].alias("scaled_x"), values[1].alias("scaled_y")
    )
    return _rounded(scaled, 6)


@_register
def kmeans_pickup(spark, sf_dir):
    return models.cluster_zones(stored_warehouse(spark, sf_dir).dim_pickup_location(), "pickup")


@_register
def kmeans_dropoff(spark, sf_dir):
    return models.cluster_zones(stored_warehouse(spark, sf_dir).dim_dropoff_location(), "dropoff")


@_register
def feature_correlation(spark, sf_dir):
    return _rounded(models.label_correlations(_features(spark, sf_dir)), 6)


@_register
def correlation_matrix(spark, sf_dir):
    return _rounded(models.correlation_matrix(_features(spark, sf_dir)), 6)


@_register
def ml_features(spark, sf_dir):
    return models.trip_features(stored_warehouse(spark, sf_dir), SPLIT_YEAR)


@_register
def ml_split(spark, sf_dir):
    train, test = models.split(stored_warehouse(spark, sf_dir).fact_trip().select("trip_id"))
    return train.withColumn("training", F.lit(True)).unionByName(
        test.withColumn("training", F.lit(False))
    )


@_register
def model_linear(spark, sf_dir):
    return models.score_model(_vectors(spark, sf_dir), "Linear Regression")


@_register
def model_tree(spark, sf_dir):
    return models.score_model(_vectors(spark, sf_dir), "Decision Tree")


@_register
def model_forest(spark, sf_dir):
    return models.score_model(_vectors(spark, sf_dir), "Random Forest")


@_register
def regression_metrics(spark, sf_dir):
    facts = stored_warehouse(spark, sf_dir).fact_trip()
    return _rounded(models.regression_metrics(facts, "fare only", "fare_amount"))


@_register
def model_evaluation(spark, sf_dir):
    area = new_folder(spark, "scores")
    models.publish_scores(_vectors(spark, sf_dir), area)
    return sinks.read_published(spark, area, "model_evaluation")


@_register
def kmeans_pickup_certificate(spark, sf_dir):
    return models.cluster_certificate(kmeans_pickup(spark, sf_dir))


@_register
def kmeans_dropoff_certificate(spark, sf_dir):
    return models.cluster_certificate(kmeans_dropoff(spark, sf_dir))


@_register
def linear_certificate(spark, sf_dir):
    return models.linear_certificate(_vectors(spark, sf_dir))


@_register
def tree_certificate(spark, sf_dir):
    return models.tree_certificate(_vectors(spark, sf_dir))


@_register
def forest_certificate(spark, sf_dir):
    return models.forest_certificate(_vectors(spark, sf_dir))


@_register
def evaluation_certificate(spark, sf_dir):
    return models.evaluation_certificate(_vectors(spark, sf_dir), model_evaluation(spark, sf_dir))
