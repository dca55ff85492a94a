"""Column contracts of the raw files and of the stored tables."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(columns: str) -> T.StructType:
    """A struct of nullable columns given as ``name type, ...``; needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Names and types of the input files.
RAW_TRIP = struct("""
    VendorID bigint,
    tpep_pickup_datetime timestamp_ntz,
    tpep_dropoff_datetime timestamp_ntz,
    passenger_count bigint,
    trip_distance double,
    RatecodeID bigint,
    store_and_fwd_flag string,
    PULocationID bigint,
    DOLocationID bigint,
    payment_type bigint,
    fare_amount double,
    extra double,
    mta_tax double,
    tip_amount double,
    tolls_amount double,
    total_amount double
""")
ZONE_LOOKUP = struct("""
    LocationID bigint,
    X double,
    Y double,
    zone string,
    borough string,
    service_zone string
""")

# Names and types of the stored tables.
FACT_TRIP = struct("""
    trip_id bigint,
    vendor_id bigint,
    datetimestamp_id bigint,
    pu_location_id bigint,
    do_location_id bigint,
    ratecode_id bigint,
    payment_id bigint,
    passenger_count bigint,
    trip_distance double,
    fare_amount double,
    extra double,
    mta_tax double,
    tip_amount double,
    tolls_amount double,
    total_amount double
""")
DIM_DATETIME = struct("""
    tpep_pickup_datetime timestamp_ntz,
    tpep_dropoff_datetime timestamp_ntz,
    datetime_id bigint,
    pick_hour double,
    pick_day int,
    pick_month int,
    pick_year int,
    pick_weekday string,
    pick_weekday_id int,
    drop_hour double,
    drop_day int,
    drop_month int,
    drop_year int,
    drop_weekday string,
    drop_weekday_id int
""")
DIM_PICKUP_LOCATION = struct(
    "PULocationID bigint, X double, Y double, zone string, borough string, service_zone string"
)
DIM_DROPOFF_LOCATION = struct(
    "DOLocationID bigint, X double, Y double, zone string, borough string, service_zone string"
)
DIM_RATE_CODE = struct("RatecodeID bigint, rate_code_name string")
DIM_PAYMENT = struct("payment_type bigint, payment_type_name string")
DIM_VENDOR = struct("VendorID bigint, vendor_name string")

# Code labels. Codes outside these tables are unknown.
RATE_CODE_NAMES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}
PAYMENT_NAMES = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
VENDOR_NAMES = {
    1: "Create Mobile Technologies, LLC",
    2: "VeriFone Inc",
}

# Fixed value: payment codes the year and payment reports leave out.
UNPAID_CODES = (4, 6)

# Columns a second fleet names differently.
GREEN_RENAMES = {
    "lpep_pickup_datetime": "tpep_pickup_datetime",
    "lpep_dropoff_datetime": "tpep_dropoff_datetime",
}


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return the contract's columns in order; raise when one is missing or of another type."""
    found = {field.name: field.dataType for field in df.schema}
    wrong = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"found {found[field.name].simpleString() if field.name in found else 'nothing'}"
        for field in contract
        if found.get(field.name) != field.dataType
    ]
    if wrong:
        raise ValueError("input does not meet its contract: " + "; ".join(wrong))
    return df.select(*contract.names)
