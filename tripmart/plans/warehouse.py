"""The star schema: how it is built, extended and read.

Every load writes to folders of its own attempt, and one commit makes them all visible at once
(``tripmart.plans.commits``). The commit also tells the next load where its keys start.
"""

import datetime
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart import schemas
from tripmart.functions.calendar import calendar_parts, code_label
from tripmart.operators.changes import in_effect, latest_versions, new_rows, with_intervals
from tripmart.operators.filters import valid_trips
from tripmart.operators.joins import broadcast_up_to, hot_keys, join_unique
from tripmart.operators.keys import assign_key, number_rows
from tripmart.operators.sinks import write_parquet
from tripmart.plans import commits
from tripmart.plans.commits import Commit
from tripmart.plans.pairs import KEYED_PAIR, PAIR, month_span, stored_pairs, with_stored_keys, write_pairs
from tripmart.schemas import check_contract
from tripmart.sources.trips import require_unique
from tripmart.storage import remove_folder, shuffles_deleted

LOAD_ID, ATTEMPT, VALID_FROM = "load_id", "attempt", "valid_from"
# Calendar columns kept on the fact beside its contract columns. They take few values and
# pack into some bits per row, and spare readers a join with a dimension that has about
# as many rows as the fact.
FACT_CALENDAR = schemas.struct(
    "pick_year int, pick_date date, pick_hour double, pick_weekday_id int, drop_hour double, "
    "drop_weekday_id int"
)
# Pairs with a share of a load's trips worth adding up over loads, and how many trips they have.
HOT_PAIRS = schemas.struct(
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "datetime_id bigint, trips bigint"
)
# A load keeps pairs of this part of the share from which on a pair is hot.
KEPT_PART = 10


@dataclass(frozen=True, eq=False)
class Table:
    """A stored table. A dated one keeps from which day each row of a key holds."""

    name: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    dated: bool = False

    @property
    def columns(self) -> T.StructType:
        since = [T.StructField(VALID_FROM, T.DateType())] if self.dated else []
        return T.StructType([*self.schema.fields, *since])


FACT = Table(
    "fact_trip", T.StructType(schemas.FACT_TRIP.fields + FACT_CALENDAR.fields), ("pick_year",)
)
DATETIME = Table("dim_datetime", schemas.DIM_DATETIME, ("pick_year", "pick_month"))
PICKUP = Table("dim_pickup_location", schemas.DIM_PICKUP_LOCATION, ("service_zone",), dated=True)
DROPOFF = Table("dim_dropoff_location", schemas.DIM_DROPOFF_LOCATION, ("service_zone",), dated=True)
RATE_CODE = Table("dim_rate_code", schemas.DIM_RATE_CODE, ("RatecodeID",))
PAYMENT = Table("dim_payment", schemas.DIM_PAYMENT, ("payment_type",))
VENDOR = Table("dim_vendor", schemas.DIM_VENDOR, ("VendorID",))
HOT = Table("hot_pairs", HOT_PAIRS)
PAIRS = Table("datetime_pairs", KEYED_PAIR)
TABLES = (FACT, DATETIME, PICKUP, DROPOFF, RATE_CODE, PAYMENT, VENDOR, HOT, PAIRS)
# A lookup up to this size is broadcast.
MAX_BROADCAST_ZONES = 1_000_000

CODE_NAMES = {
    RATE_CODE.name: schemas.RATE_CODE_NAMES,
    PAYMENT.name: schemas.PAYMENT_NAMES,
    VENDOR.name: schemas.VENDOR_NAMES,
}


class Warehouse:
    """Reader of the tables below ``root``, as of the last finished load."""

    def __init__(self, spark: SparkSession, root: str, before_load: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        found = commits.read_commits(spark, self.root)
        self.version = found[-1].version if found else -1
        self.loads = [
            commit
            for _, commit in sorted(commits.effective(found).items())
            if before_load is None or commit.load_id < before_load
        ]
        self.last_load = self.loads[-1].load_id if self.loads else None
        self.next_trip_id = max((load.next_trip_id for load in self.loads), default=0)
        self.next_datetime_id = max((load.next_datetime_id for load in self.loads), default=0)

    def load_of(self, source: str, batch: int) -> int | None:
        """The number of the load that a stream's batch was stored as."""
        own = [load.load_id for load in self.loads if (load.source, load.batch) == (source, batch)]
        return max(own, default=None)

    def require_loaded(self) -> "Warehouse":
        """Itself; raises where nothing was ever loaded, as below a mistyped root."""
        if self.last_load is None:
            raise ValueError(f"no load below {self.root}")
        return self

    def folders(self, table: Table) -> list[str]:
        """The folder of every load's attempt that counts."""
        return [
            attempt_folder(self.root, table, load.load_id, load.attempt)
            for load in self.loads
            if table is not HOT or load.has_hot_pairs  # written only when there are any
        ]

    def history(self, table: Table) -> DataFrame:
        """All stored rows with the load that wrote them; types as in the contract."""
        schema = T.StructType([*table.columns.fields, T.StructField(LOAD_ID, T.LongType())])
        folders = self.folders(table)
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = T.StructType([*schema.fields, T.StructField(ATTEMPT, T.StringType())])
        reader = self.spark.read.schema(found).option("basePath", f"{self.root}/{table.name}")
        return reader.parquet(*folders).select(*schema.names)

    def versions(self, table: Table) -> DataFrame:
        """The rows of a dated table with the days between which each holds."""
        return with_intervals(self.history(table), table.schema.names[0], VALID_FROM, LOAD_ID)

    def current(self, table: Table) -> DataFrame:
        """The newest version of every key."""
        if table.dated:
            return self.versions(table).filter("is_current").select(*table.schema.names)
        return latest_versions(self.history(table), table.schema.names[0], LOAD_ID)

    def as_of(self, table: Table, day: datetime.date) -> DataFrame:
        """The version of every key that held on a day; of a table without dates the newest."""
        if not table.dated:
            return self.current(table)
        return self.versions(table).filter(in_effect(_date(day))).select(*table.schema.names)

    def fact_trip(self) -> DataFrame:
        return self.history(FACT).select(*schemas.FACT_TRIP.names)

    def fact_with_calendar(self) -> DataFrame:
        """Facts with the calendar columns of their pickup and dropoff, without a join."""
        return self.history(FACT).drop(LOAD_ID)

    def dim_datetime(self) -> DataFrame:
        return self.history(DATETIME).drop(LOAD_ID)

    def hot_pairs(self) -> DataFrame:
        """The pairs that are hot over all loads, with the parts that joins split them into.

        Each load keeps its frequent pairs; their sums tell which are hot by now, those included
        that were hot in no load.
        """
        keys = [*PAIR, "datetime_id"]
        counted = self.history(HOT).groupBy(*keys).agg(F.sum("trips").alias("trips"))
        return hot_keys(counted, keys, "trips", total=sum(load.trips for load in self.loads))

    def facts_with_dates(self) -> DataFrame:
        """Facts joined with the datetime dimension on its key."""
        facts = self.fact_trip().withColumn("datetime_id", F.col("datetimestamp_id"))
        hot = self.hot_pairs().select("datetime_id", "salts")
        return join_unique(facts, self.dim_datetime(), ["datetime_id"], hot, "trip_id")

    def dim_pickup_location(self) -> DataFrame:
        return self.current(PICKUP)

    def dim_dropoff_location(self) -> DataFrame:
        return self.current(DROPOFF)

    def dim_rate_code(self) -> DataFrame:
        return self.current(RATE_CODE)

    def dim_payment(self) -> DataFrame:
        return self.current(PAYMENT)

    def dim_vendor(self) -> DataFrame:
        return self.current(VENDOR)


def _date(day: datetime.date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def attempt_folder(root: str, table: Table, load_id: int, attempt: str) -> str:
    return f"{root}/{table.name}/{LOAD_ID}={int(load_id)}/{ATTEMPT}={attempt}"


def distinct_pairs(trips: DataFrame) -> DataFrame:
    return trips.select(*PAIR).distinct()


def counted_pairs(trips: DataFrame) -> DataFrame:
    """Distinct pairs with their number of trips."""
    return trips.groupBy(*PAIR).agg(F.count("*").alias("trips"))


def build_dim_datetime(keyed_pairs: DataFrame) -> DataFrame:
    """Calendar columns of keyed (pickup, dropoff) pairs."""
    parts = calendar_parts(F.col(PAIR[0]), "pick") | calendar_parts(F.col(PAIR[1]), "drop")
    return keyed_pairs.withColumns(parts).select(*schemas.DIM_DATETIME.names)


def build_dim_location(ids: DataFrame, zones: DataFrame, table: Table) -> DataFrame:
    """Zone attributes of the location ids that occur; ids without a zone are left out.

    The ids are made distinct before the join, so both sides have at most a row per zone.
    """
    key = table.schema.names[0]
    distinct = ids.select(F.col(key).alias("LocationID")).distinct()
    found = distinct.join(zones, "LocationID")
    return found.withColumnRenamed("LocationID", key).select(*table.schema.names)


def build_dim_code(codes: DataFrame, table: Table) -> DataFrame:
    """Labels of the codes that occur; unknown codes are left out."""
    key, label = table.schema.names
    named = codes.select(key).distinct().withColumn(label, code_label(F.col(key), CODE_NAMES[table.name]))
    return named.dropna()


def known_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose pickup and dropoff zones are both in the lookup."""
    ids = broadcast_up_to(zones.select("LocationID"), MAX_BROADCAST_ZONES)
    for side in ("PULocationID", "DOLocationID"):
        trips = trips.join(ids, trips[side] == ids["LocationID"], "left_semi")
    return trips


def build_fact(trips: DataFrame, dates: DataFrame, hot_pairs: DataFrame) -> DataFrame:
    """Facts of keyed trips: one shuffle of the trips on the pair, in which hot pairs are split.

    The pair's key is all that a trip is looked up for; its calendar comes from its own times.
    """
    names = {
        "VendorID": "vendor_id",
        "datetime_id": "datetimestamp_id",
        "PULocationID": "pu_location_id",
        "DOLocationID": "do_location_id",
        "RatecodeID": "ratecode_id",
        "payment_type": "payment_id",
    }
    facts = join_unique(
        trips, dates.select(*KEYED_PAIR.names), PAIR, hot_pairs.select(*PAIR, "salts"), "trip_id"
    )
    pickup = F.col(PAIR[0])
    calendar = calendar_parts(pickup, "pick") | calendar_parts(F.col(PAIR[1]), "drop")
    calendar["pick_date"] = pickup.cast("date")
    own = {name: calendar[name] for name in FACT_CALENDAR.names}
    return facts.withColumns(own).withColumnsRenamed(names).select(*FACT.schema.names)


def load_batch(
    trips: DataFrame,
    zones: DataFrame,
    root: str,
    load_id: int,
    years: tuple[int, int] | None = None,
    require_known_zone: bool = False,
    source: str | None = None,
    batch: int | None = None,
    zones_from: datetime.date | None = None,
) -> Warehouse:
    """Append one batch: facts, pairs not stored yet, and new or changed dimension rows.

    ``trips`` is a scan of raw files with its source row (``with_source_row``). Loads are
    numbered upwards. The last load may be run again, which replaces it when it is complete; an
    earlier one may not, as the keys after it are taken, nor may one that another stream batch
    wrote. If another load is committed meanwhile, ``ConcurrentLoad`` is raised.

    The zone lookup holds from ``zones_from``, by default the day of the earliest pickup.
    """
    root = root.rstrip("/")
    before = Warehouse(trips.sparkSession, root, before_load=load_id)
    _require_free(Warehouse(trips.sparkSession, root), load_id, source, batch)
    load = _Load(trips, zones, root, load_id, before)
    return load.run(years, require_known_zone, source, batch, zones_from)


class _Load:
    """One attempt of one load."""

    def __init__(
        self,
        trips: DataFrame,
        zones: DataFrame,
        root: str,
        load_id: int,
        before: Warehouse,
        reset: bool = False,
    ):
        check_contract(trips, schemas.RAW_TRIP)
        check_contract(zones, schemas.ZONE_LOOKUP)
        self.spark = trips.sparkSession
        self.trips = trips
        self.zones = require_unique(zones, "LocationID")
        self.root = root
        self.load_id = load_id
        self.reset = reset
        self.version = before.version + 1
        self.before = before
        self.loads = [] if reset else before.loads
        self.attempt = commits.new_attempt()
        self.staging = f"{root}/staging/{self.attempt}"

    def folder(self, table: Table) -> str:
        return attempt_folder(self.root, table, self.load_id, self.attempt)

    def store(self, df: DataFrame, table: Table) -> None:
        write_parquet(df, self.folder(table), "overwrite", table.partition_by)

    def stored(self, table: Table) -> DataFrame:
        found = self.spark.read.schema(table.schema).parquet(self.folder(table))
        return found.select(*table.schema.names)

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        write_parquet(df, f"{self.staging}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.staging}/{name}")

    def run(
        self,
        years: tuple[int, int] | None,
        require_known_zone: bool,
        source: str | None,
        batch: int | None,
        zones_from: datetime.date | None,
    ) -> Warehouse:
        valid = valid_trips(self.trips, years)
        next_trip = max((load.next_trip_id for load in self.loads), default=0)
        next_datetime = max((load.next_datetime_id for load in self.loads), default=0)
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = self.loads[0].pair_buckets if self.loads else partitions

        # Of a batch that meets stored pairs all are written with the keys some have; else the
        # pairs are only counted and numbered.
        pairs = known = None
        fresh = counted_pairs(valid)
        if self.loads:
            pairs = self.staged(fresh, "pairs")
            months = month_span(pairs)
            known = self._known(pairs, months, buckets)
            fresh = known.filter("datetime_id is null").drop("datetime_id")
            known = known.filter("datetime_id is not null")
        keyed, next_datetime = assign_key(
            fresh, PAIR, "datetime_id", next_datetime, f"{self.staging}/keys"
        )
        self.store(build_dim_datetime(keyed), DATETIME)
        write_pairs(keyed, self.folder(PAIRS), buckets)
        own = self.stored(PAIRS)
        dates = own if known is None else own.unionByName(known.select(*KEYED_PAIR.names))

        counted = keyed if pairs is None else pairs
        trips = counted.agg(F.coalesce(F.sum("trips"), F.lit(0))).first()[0]
        hot = hot_keys(counted, PAIR, "trips", total=trips)
        frequent = hot_keys(counted, PAIR, "trips", total=trips, finer=KEPT_PART)
        has_hot = not frequent.isEmpty()
        if has_hot:
            self.store(dates.join(F.broadcast(frequent), PAIR).select(*HOT.schema.names), HOT)

        numbered, next_trip = number_rows(
            valid, self.trips, "trip_id", next_trip, f"{self.staging}/files"
        )
        if require_known_zone:
            numbered = known_zones(numbered, self.zones)
        first_day, last_day = (own if pairs is None else pairs).agg(
            F.min(F.to_date(PAIR[0])), F.max(F.to_date(PAIR[0]))
        ).first()
        facts = build_fact(numbered, dates, hot)
        if first_day is not None and first_day.year != last_day.year:
            facts = by_year_folders(facts)
        with shuffles_deleted(self.spark):  # the widest, which would lie beside all that reads the facts
            self.store(facts, FACT)

        # Codes come from the stored fact, whose columns are read one by one, unless the fact
        # has lost trips whose codes count.
        occurring = valid if require_known_zone else self.stored(FACT)
        self._store_dimensions(_occurring_codes(occurring, f"{self.staging}/codes"), zones_from or first_day)
        first_month, last_month = month_span(own)
        commit = Commit(
            self.version, self.load_id, self.attempt, self.reset, next_trip, next_datetime,
            source, batch, first_month, last_month, has_hot, buckets, trips,
        )
        try:
            commits.publish_commit(self.spark, self.root, commit)
        except commits.ConcurrentLoad:
            for table in TABLES:
                remove_folder(self.spark, self.folder(table))
            raise
        finally:
            remove_folder(self.spark, self.staging)
        return Warehouse(self.spark, self.root)

    def _known(
        self, pairs: DataFrame, months: tuple[int | None, int | None], buckets: int
    ) -> DataFrame:
        """The batch's pairs, with the keys of those that loads of its months have stored."""
        folders = [
            attempt_folder(self.root, PAIRS, load.load_id, load.attempt)
            for load in self.loads
            if None not in (months[0], load.first_month)
            and load.first_month <= months[1]
            and load.last_month >= months[0]
        ]
        if not folders:
            return pairs.withColumn("datetime_id", F.lit(None).cast("long"))
        with stored_pairs(self.spark, folders, buckets) as stored:
            return self.staged(with_stored_keys(pairs, stored), "known")

    def _store_dimensions(self, codes: dict[Table, DataFrame], day: datetime.date | None) -> None:
        """New and changed rows: what differs from the version that holds on the day."""
        locations = {t: build_dim_location(codes[t], self.zones, t) for t in (PICKUP, DROPOFF)}
        found = locations | {t: build_dim_code(codes[t], t) for t in (RATE_CODE, PAYMENT, VENDOR)}
        day = day or datetime.date.min
        if self.loads:
            found = {t: new_rows(rows, self.before.as_of(t, day)) for t, rows in found.items()}
        found |= {t: found[t].withColumn(VALID_FROM, _date(day)) for t in locations}
        with ThreadPoolExecutor(len(found)) as jobs:
            list(jobs.map(lambda table: self.store(found[table], table), found))


def by_year_folders(facts: DataFrame) -> DataFrame:
    """Facts of several years dealt out by year, in parts of the session's advisory size.

    Else every task would write a file of its own for every year.
    """
    return facts.sparkSession.sql("select /*+ rebalance(pick_year) */ * from {facts}", facts=facts)


def _require_free(stored: Warehouse, load_id: int, source: str | None, batch: int | None) -> None:
    if stored.last_load is None or stored.last_load < load_id:
        return
    last = stored.loads[-1]
    if last.load_id > load_id:
        raise ValueError(f"load {load_id} is followed by load {last.load_id}")
    if (last.source, last.batch) != (source, batch):
        raise ValueError(f"load {load_id} was written from {last.source}")


def _occurring_codes(rows: DataFrame, folder: str) -> dict[Table, DataFrame]:
    """Distinct values of the five code columns, found in one pass and written once."""
    sources = {
        PICKUP: ("PULocationID", "pu_location_id"),
        DROPOFF: ("DOLocationID", "do_location_id"),
        RATE_CODE: ("RatecodeID", "ratecode_id"),
        PAYMENT: ("payment_type", "payment_id"),
        VENDOR: ("VendorID", "vendor_id"),
    }
    # Numbers as tags keep the grouping keys of fixed width.
    tagged = [
        F.struct(
            F.lit(tag).alias("tag"),
            F.col(raw if raw in rows.columns else stored).alias("code"),
        )
        for tag, (raw, stored) in enumerate(sources.values())
    ]
    codes = rows.select(F.inline(F.array(*tagged))).distinct()
    write_parquet(codes, folder)
    found = rows.sparkSession.read.schema("tag int, code bigint").parquet(folder)
    return {
        table: found.filter(F.col("tag") == tag).select(
            F.col("code").alias(table.schema.names[0])
        )
        for tag, table in enumerate(sources)
    }


def init_warehouse(
    trips: DataFrame,
    zones: DataFrame,
    root: str,
    years: tuple[int, int] | None = None,
    require_known_zone: bool = False,
) -> Warehouse:
    """Build all tables anew. What is stored below ``root`` stays readable until they are complete."""
    root = root.rstrip("/")
    before = Warehouse(trips.sparkSession, root)
    return _Load(trips, zones, root, 0, before, reset=True).run(years, require_known_zone, None, None, None)


def vacuum(spark: SparkSession, root: str, before: float) -> int:
    """Delete attempts that died or were replaced, last changed before a time in seconds."""
    return commits.vacuum(spark, root, [table.name for table in TABLES], before)


def backfill(
    trips: DataFrame, zones: DataFrame, root: str, first_year: int, last_year: int
) -> Warehouse:
    """Load a closed range of years as one batch after those already stored.

    The tables are partitioned by year, so one pass gives what a job per year would.
    """
    last_load = Warehouse(trips.sparkSession, root).last_load
    load_id = 0 if last_load is None else last_load + 1
    return load_batch(trips, zones, root, load_id, (first_year, last_year))
