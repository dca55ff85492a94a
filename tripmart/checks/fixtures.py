"""Raw trips and zones derived from the driver's tables, landed as monthly files."""

from dataclasses import dataclass
from math import prod

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.joins import broadcast_up_to
from tripmart.schemas import GREEN_RENAMES, RAW_TRIP, check_contract
from tripmart.storage import new_folder, shuffles_deleted

RAW_SQL = """
    with b as (
      select l.*, o.o_orderdate, c.c_nationkey, s.s_nationkey,
             (l.l_partkey*7 + l.l_linenumber*61 + l.l_suppkey*13) % 1440 as m
      from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
      join {customer} c on o.o_custkey = c.c_custkey
      join {supplier} s on l.l_suppkey = s.s_suppkey)
    select 1 + l_suppkey % 3                                   as VendorID,
           {pickup}                                            as tpep_pickup_datetime,
           {dropoff}                                           as tpep_dropoff_datetime,
           cast(l_linenumber % 7 as bigint)                    as passenger_count,
           l_quantity - 1.0e0                                  as trip_distance,
           1 + l_partkey % 7                                   as RatecodeID,
           nullif(l_returnflag, 'R')                           as store_and_fwd_flag,
           cast(c_nationkey + 1 as bigint)                     as PULocationID,
           cast(s_nationkey + 1 as bigint)                     as DOLocationID,
           1 + l_orderkey % 7                                  as payment_type,
           l_extendedprice as fare_amount, l_discount as extra, l_tax as mta_tax,
           cast(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)) as double) as tip_amount,
           cast(l_suppkey % 5 as double)                       as tolls_amount,
           cast(cast(l_extendedprice as decimal(12,2)) + cast(l_discount as decimal(4,2))
              + cast(l_tax as decimal(4,2))
              + cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))
              + cast(l_suppkey % 5 as decimal(20,0)) as double) as total_amount
    from b
"""

ZONES_SQL = """
    select cast(n_nationkey + 1 as bigint) as LocationID,
           cast((n_nationkey * 37) % 101 as double) as X,
           cast((n_nationkey * 53) % 97  as double) as Y,
           n_name as zone, r_name as borough,
           concat('SZ', cast(n_regionkey as varchar(4))) as service_zone
    from {nation} join {region} on n_regionkey = r_regionkey
    where n_nationkey < 24
"""

# What RAW_SQL makes of the joined rows ``b``.
MEASURES_SQL = RAW_SQL[RAW_SQL.index("select 1 +") :]
MINUTE = "(l_partkey*7 + l_linenumber*61 + l_suppkey*13) % 1440"
PICKUP = "o_orderdate + make_dt_interval(0, 0, cast({m} as int))"
DROPOFF = "o_orderdate + make_dt_interval(0, 0, cast({m} + cast(l_quantity as bigint) + 1 as int))"

# Order of trips in the landed files: pickup and dropoff first, then the other columns.
TRIP_ORDER = ["tpep_pickup_datetime", "tpep_dropoff_datetime"] + [
    name for name in RAW_TRIP.names if not name.startswith("tpep_")
]
# How TRIP_ORDER begins, in columns of the joined rows.
JOINED_ORDER = [text.format(m=MINUTE) for text in (PICKUP, DROPOFF)] + [
    "l_suppkey % 3", "l_linenumber % 7", "l_quantity", "l_partkey % 7"
]
# What MEASURES_SQL reads of these columns are remainders by 1440, by 3 and 5, and by 7; a ``code`` holds them all,
# each in a range of twice its divisor, where 0 stands for null.
REMAINDERS = {"m": 1440, "l_suppkey": 15, "l_partkey": 7, "l_linenumber": 7, "l_orderkey": 7}


def _remainder(name: str) -> str:
    """The SQL of a column's remainder in a code."""
    names = list(REMAINDERS)
    below = prod(2 * REMAINDERS[other] for other in names[names.index(name) + 1 :])
    found = f"code div {below} % {2 * REMAINDERS[name]}"
    # nullif would make a column of its own, which would be moved too
    return f"(case when {found} <> 0 then {found} - {REMAINDERS[name]} end)"


# JOINED_ORDER in columns of packed rows.
PACKED_ORDER = [text.format(m=_remainder("m")) for text in (PICKUP, DROPOFF)] + [
    f"{_remainder('l_suppkey')} % 3", f"{_remainder('l_linenumber')} % 7", "l_quantity", _remainder("l_partkey")
]
# Suppliers that are broadcast; more are shuffled.
MAX_BROADCAST_SUPPLIERS = 1_000_000
YEAR_FOLDER = "year={year}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows ``b`` of RAW_SQL with the columns it reads, but for ``m``.

    Orders meet their customers first and suppliers are broadcast, so that items are shuffled once,
    by order, however many there are.
    """
    items = _table(spark, sf_dir, "lineitem").drop("l_linestatus", "l_shipdate")
    suppliers = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    suppliers = broadcast_up_to(suppliers, MAX_BROADCAST_SUPPLIERS)
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    sold = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    # an order is a few columns, so its side is hashed and the items are not sorted
    joined = items.join(sold.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.drop("o_orderkey", "s_suppkey")


def packed(joined: DataFrame) -> DataFrame:
    """Joined rows with a code in place of the columns it is made of, so that a row takes less to move."""
    code = F.lit(0).cast("long")
    for name, divisor in REMAINDERS.items():
        code = code * (2 * divisor) + F.coalesce(F.col(name) % divisor + divisor, F.lit(0))
    return joined.withColumn("m", F.expr(MINUTE)).withColumn("code", code).drop(*REMAINDERS)


def unpacked(rows: DataFrame) -> DataFrame:
    """Packed rows as joined rows again, with remainders in place of what the code was made of."""
    return rows.withColumns({name: F.expr(_remainder(name)) for name in REMAINDERS}).drop("code")


def measured(joined: DataFrame) -> DataFrame:
    """Raw trips of joined rows, one by one."""
    if "m" not in joined.columns:
        joined = joined.withColumn("m", F.expr(MINUTE))
    text = MEASURES_SQL.replace("{pickup}", PICKUP).replace("{dropoff}", DROPOFF).replace("{m}", "m")
    text = text.replace("from b\n", "from {joined}\n")
    return check_contract(joined.sparkSession.sql(text, joined=joined), RAW_TRIP)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(joined_rows(spark, sf_dir))


def zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: _table(spark, sf_dir, n) for n in ("nation", "region")}
    return spark.sql(ZONES_SQL.replace("varchar(4)", "string"), **tables)


@dataclass(frozen=True)
class Landed:
    """Raw area and zone lookup of one set of driver tables."""

    area: str
    zones: str


_LANDED: dict[tuple[str, str], Landed] = {}


def land(spark: SparkSession, sf_dir: str) -> Landed:
    """Write raw trips as monthly files below a folder per year, once per application.

    Rows are range partitioned and sorted, so files in path order hold trips in
    ``TRIP_ORDER``, as releases in time order do. What moves are the joined rows, packed; a trip's
    columns and its file are made where it is written.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        folder = new_folder(spark, "landed")
        pickup = F.col("tpep_pickup_datetime")
        moved = packed(joined_rows(spark, sf_dir)).repartitionByRange(*map(F.expr, PACKED_ORDER))
        filed = (
            measured(unpacked(moved))
            .withColumns(
                {
                    "year": F.year(pickup),
                    "file": F.concat(F.lit("yellow_tripdata_"), F.date_format(pickup, "yyyy-MM")),
                }
            )
            .sortWithinPartitions("year", "file", *TRIP_ORDER)
        )
        with shuffles_deleted(spark):
            filed.write.partitionBy("year", "file").parquet(f"{folder}/trips")
        zone_rows(spark, sf_dir).write.option("header", True).csv(f"{folder}/zones")
        _LANDED[key] = Landed(f"{folder}/trips", f"{folder}/zones")
    return _LANDED[key]


def land_mixed_layouts(spark: SparkSession, trips: DataFrame) -> list[str]:
    """The same trips as two areas: older files with double counts and extra columns."""
    folder = new_folder(spark, "layouts")
    old = F.col("tpep_pickup_datetime") < F.lit("1998-01-01").cast("timestamp_ntz")
    older = trips.filter(old).withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("double"),
            "RatecodeID": F.col("RatecodeID").cast("double"),
            "VendorID": F.col("VendorID").cast("int"),
            "airport_fee": F.lit(None).cast("double"),
        }
    )
    newer = trips.filter(~old).withColumn("congestion_surcharge", F.lit(2.5))
    paths = [f"{folder}/older", f"{folder}/newer"]
    older.write.parquet(paths[0])
    newer.write.parquet(paths[1])
    return paths


def land_green(spark: SparkSession, trips: DataFrame) -> str:
    """The same trips with the column names and an extra column of the second fleet."""
    path = new_folder(spark, "green")
    back = {new: old for old, new in GREEN_RENAMES.items()}
    trips.withColumnsRenamed(back).withColumn("trip_type", F.lit(1.0)).write.parquet(path)
    return path
