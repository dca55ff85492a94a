"""Bring monthly files of differing layout to the raw trip contract."""

from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import RAW_TRIP
from tripmart.sources.trips import SOURCE_FILE

# Fixed value: file naming of the monthly releases, after the name of the fleet.
PERIOD_PATTERN = r"_tripdata_(\d{4})-(\d{2})"
# Fixed value: releases up to this year have no zone ids.
LAST_YEAR_WITHOUT_ZONES = 2010


def keep_contract_columns(df: DataFrame) -> DataFrame:
    return df.select(*RAW_TRIP.names)


def rename_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(renames)


def cast_to_contract(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_TRIP))


def read_files(
    spark: SparkSession, paths: Iterable[str], renames: dict[str, str] | None = None
) -> DataFrame:
    """Trips of several areas in one frame, each file read with the types it has.

    A long schema cannot read a double file, and a column of another name would read as
    null, so tasks look up each file's layout in its footer. Files of equal layout share one
    scan, which keeps the plan as small as the number of layouts. A layout without a column
    of the contract raises.
    """
    frames = [
        normalise(spark.read.option("recursiveFileLookup", True).parquet(*files), renames)
        for files in _files_by_layout(spark, paths).values()
    ]
    if not frames:
        raise ValueError("no area to read")
    return reduce(DataFrame.unionByName, frames)


def file_layouts(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """(path, layout): the columns and types in the footer of every file of some areas.

    Tasks read the footers, and no other part of a file. The layout is null where they cannot: a
    file system that only Spark knows, or a file that is no parquet.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            layouts = []
            for path in batch.column(0).to_pylist():
                try:
                    where = urlsplit(path)
                    system, name = (
                        (fs.LocalFileSystem(), path.removeprefix("file:"))
                        if where.scheme in ("", "file")
                        else fs.FileSystem.from_uri(path)
                    )
                    with system.open_input_file(name) as file:
                        columns = pq.ParquetFile(file).schema
                        found = [columns.column(i) for i in range(len(columns))]
                    layouts.append("; ".join(f"{c.path} {c.physical_type} {c.logical_type}" for c in found))
                except (pa.ArrowException, OSError, ValueError):
                    layouts.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(layouts, pa.string())], names=["path", "layout"]
            )

    return files.select("path").mapInArrow(footers, "path string, layout string")


def _files_by_layout(spark: SparkSession, paths: Iterable[str]) -> dict[str, list[str]]:
    """The files of all areas by their layout; Spark looks up those that tasks cannot open."""
    by_layout: dict[str, list[str]] = {}
    paths = list(paths)
    if not paths:
        return by_layout
    for name, layout in file_layouts(spark, paths).orderBy("path").toLocalIterator():
        if layout is None:
            layout = spark.read.parquet(name).schema.json()
        by_layout.setdefault(layout, []).append(name)
    return by_layout


def normalise(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Contract columns only, no row with a null, contract types."""
    return cast_to_contract(keep_contract_columns(rename_columns(df, renames or {})).dropna())


def with_period(df: DataFrame, path: str = SOURCE_FILE, fleet: str = "yellow") -> DataFrame:
    """Add the year and month named in the file path; NULL for files of another kind."""
    year, month = (
        F.nullif(F.regexp_extract(path, fleet + PERIOD_PATTERN, group), F.lit("")).cast("int")
        for group in (1, 2)
    )
    return df.withColumns({"year": year, "month": month})


def landed_periods(scan: DataFrame, fleet: str = "yellow") -> DataFrame:
    """Year, month and row count of every landed period of a scan."""
    files = scan.select(F.col("_metadata.file_path").alias(SOURCE_FILE))
    per_file = files.groupBy(SOURCE_FILE).agg(F.count("*").alias("rows"))
    return (
        with_period(per_file, fleet=fleet)
        .filter(F.col("year").isNotNull())
        .groupBy("year", "month")
        .agg(F.sum("rows").alias("rows"))
    )


def after_year(periods: DataFrame, year: int = LAST_YEAR_WITHOUT_ZONES) -> DataFrame:
    return periods.filter(F.col("year") > year)


def new_periods(landed: DataFrame, loaded: DataFrame, year: int) -> DataFrame:
    """Periods of the wanted year that are newer than the newest loaded one.

    Year and month are compared together, so a December that is loaded does not hide
    the next January.
    """
    ordinal = F.col("year") * 100 + F.col("month")
    newest = loaded.agg(F.coalesce(F.max(ordinal), F.lit(0))).scalar()
    return landed.filter((F.col("year") == year) & (ordinal > newest))
