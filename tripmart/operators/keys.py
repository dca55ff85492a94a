"""Surrogate keys that stay the same when tasks are run again."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.sources.trips import SOURCE_FILE, SOURCE_ROW, with_source_row

# Largest number of files whose offsets are broadcast: about 150 bytes each.
MAX_BROADCAST_FILES = 500_000


def last_key(table: DataFrame, key: str) -> DataFrame:
    """One row with the largest stored key, NULL for an empty table."""
    return table.agg(F.max(key).alias(key))


def next_key(table: DataFrame, key: str, first: int = 0) -> int:
    """The key that follows the largest stored one, or ``first`` for an empty table."""
    largest = last_key(table, key).first()[0]
    return first if largest is None else largest + 1


def _file_order() -> list[Column]:
    """Folder, then the task number Spark puts into a file name, then the name."""
    return [
        F.regexp_extract(SOURCE_FILE, r"^(.*)/[^/]*$", 1),
        F.regexp_extract(SOURCE_FILE, r"/part-(\d+)[^/]*$", 1).try_cast("bigint"),
        F.col(SOURCE_FILE),
    ]


def file_offsets(scan: DataFrame) -> DataFrame:
    """Rows of every file, and the number of rows in the files before it.

    The scan reads no data column. The running sum orders one row per file, never rows
    of the table itself.
    """
    per_file = scan.groupBy(SOURCE_FILE).agg((F.max(SOURCE_ROW) + 1).alias("rows"))
    before = Window.orderBy(*_file_order()).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("rows").over(before), F.lit(0))
    return per_file.select(SOURCE_FILE, "rows", offset.alias("offset"))


def number_rows(
    rows: DataFrame, scan: DataFrame, key: str, start: int, offsets_folder: str
) -> tuple[DataFrame, int]:
    """Number rows of a file scan by file order and position, without a shuffle of the rows.

    ``scan`` is the unfiltered scan with its source columns and ``rows`` any rows of it, so
    numbers of filtered rows are left unused. The offsets are written once and read back.
    Returns the numbered rows and the number to go on with.
    """
    file_offsets(scan).write.mode("overwrite").parquet(offsets_folder)
    stored = rows.sparkSession.read.parquet(offsets_folder)
    files, scanned = stored.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    offsets = stored.select(SOURCE_FILE, "offset")
    if files <= MAX_BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    numbered = rows.join(offsets, SOURCE_FILE).select(
        (F.lit(start) + F.col("offset") + F.col(SOURCE_ROW)).alias(key),
        *(name for name in rows.columns if name not in (SOURCE_FILE, SOURCE_ROW)),
    )
    return numbered, start + scanned


def assign_key(
    df: DataFrame, order: list[str], key: str, start: int, folder: str
) -> tuple[DataFrame, int]:
    """Number rows from ``start`` in the global order of ``order``, without gaps.

    The rows are range partitioned and sorted once and written to ``folder``; a row's key
    is then its place in the ordered files. That equals a ``row_number`` over the whole
    table, yet no task sorts more than its own range. ``order`` should be unique, as
    equal rows cannot be split between ranges. ``folder`` must outlive the result.
    Returns the keyed rows and the key to go on with.
    """
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", 0)
        .parquet(f"{folder}/rows")
    )
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")
    ordered = with_source_row(stored)
    return number_rows(ordered, ordered, key, start, f"{folder}/offsets")
