"""Which landed files were normalised, by file and by month.

The normalise job writes a row per source file after its output is complete. A file is known by its
path, size and time; one that comes again under its path with another size or time is a
re-delivery and is read again, in place of the old.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators.sinks import write_parquet
from tripmart.sources.normalise import with_period
from tripmart.sources.trips import SOURCE_FILE
from tripmart.storage import new_folder, read_or_empty

LEDGER = schemas.struct(
    "src_file string, bytes bigint, changed bigint, year int, month int, rows bigint, run bigint"
)
# States of a landed file.
NEW, LOADED, REDELIVERED = "new", "loaded", "redelivered"


def landed_files(scan: DataFrame, fleet: str = "yellow") -> DataFrame:
    """A row per file of a scan with its size, time in microseconds, period and rows.

    No data column is read. Files of another kind have no period.
    """
    files = scan.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_size").alias("bytes"),
        F.unix_micros("_metadata.file_modification_time").alias("changed"),
    )
    counted = files.groupBy(SOURCE_FILE, "bytes", "changed").agg(F.count("*").alias("rows"))
    return with_period(counted, fleet=fleet).select(*LEDGER.names[:-1])


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The newest entry of every file that was normalised."""
    entries = read_or_empty(spark, f"{folder.rstrip('/')}/run=*", LEDGER)
    newest = F.max_by(F.struct("bytes", "changed", "year", "month", "rows", "run"), "run").alias("newest")
    return entries.groupBy(SOURCE_FILE).agg(newest).select(SOURCE_FILE, "newest.*")


def judged(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed files with their state: new, loaded, or redelivered under a known path."""
    known = ledger.select(
        SOURCE_FILE, F.col("bytes").alias("known_bytes"), F.col("changed").alias("known_changed")
    )
    same = (F.col("bytes") == F.col("known_bytes")) & (F.col("changed") == F.col("known_changed"))
    state = F.when(F.col("known_bytes").isNull(), NEW).when(same, LOADED).otherwise(REDELIVERED)
    return landed.join(known, SOURCE_FILE, "left").select(*landed.columns, state.alias("state"))


def period_states(files: DataFrame) -> DataFrame:
    """Rows and files per month and state; files without a period are left out."""
    return (
        files.filter(F.col("year").isNotNull())
        .groupBy("year", "month", "state")
        .agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))
    )


def enter(files: DataFrame, folder: str) -> None:
    """Add files to the ledger as one run, numbered after those before it."""
    spark = files.sparkSession
    last = read_ledger(spark, folder).agg(F.max("run")).first()[0]
    run = 0 if last is None else last + 1
    entries = files.withColumn("run", F.lit(run).cast("long")).select(*LEDGER.names)
    write_parquet(entries, f"{folder.rstrip('/')}/run={run}")


def to_normalise(scan: DataFrame, folder: str, year: int | None = None, fleet: str = "yellow") -> DataFrame:
    """The files of a scan that are new or came again, of one year if it is given, written once."""
    spark = scan.sparkSession
    files = judged(landed_files(scan, fleet), read_ledger(spark, folder))
    if year is not None:
        files = files.filter(F.col("year") == year)
    path = new_folder(spark, "judged")
    write_parquet(files, path)
    return spark.read.schema(files.schema).parquet(path)
