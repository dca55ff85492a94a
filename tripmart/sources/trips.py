"""Scans of raw trips, of the zone lookup, and of areas laid out by year."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import RAW_TRIP, ZONE_LOOKUP

SOURCE_FILE = "src_file"
SOURCE_ROW = "src_row"


def parse_year(argument: str | int) -> int:
    """A batch year given on the command line or in code; anything else raises."""
    year = int(str(argument).strip())
    if not 1 <= year <= 9998:
        raise ValueError(f"not a year: {argument!r}")
    return year


def batch_path(area: str, year: str | int, folder: str = "{year}") -> str:
    """Where the trips of one year lie below the raw area."""
    return f"{area.rstrip('/')}/{folder.format(year=parse_year(year))}"


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw trips under the given folders, whatever the folders below them are called."""
    return (
        spark.read.schema(RAW_TRIP)
        .option("recursiveFileLookup", True)
        .parquet(*paths)
    )


def with_source_row(scan: DataFrame) -> DataFrame:
    """Add the file and the row number in it, which name a row of a file scan for good.

    Unlike ``monotonically_increasing_id`` the pair stays the same when a task is run
    again, when the files are split differently and when the plan is evaluated twice.
    """
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.row_index").alias(SOURCE_ROW),
    )


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV; a header that differs from the contract raises."""
    return (
        spark.read.schema(ZONE_LOOKUP)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
        .dropna()
    )


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Raise when a key occurs twice; a lookup with repeated keys would multiply trips."""
    repeated = df.groupBy(key).count().filter("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"{key} is not unique: {[row[key] for row in repeated]}")
    return df
