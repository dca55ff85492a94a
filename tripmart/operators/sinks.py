"""Parquet sinks and published result tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Write parquet, optionally into partition folders and from at most ``files`` tasks.

    An overwrite replaces the whole table whatever the session's partition overwrite mode.
    """
    if files is not None:
        df = df.coalesce(files)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str | Sequence[str], buckets: int, mode: str = "append"
) -> None:
    """Hash rows into sorted buckets of a catalog table, one file per bucket and write."""
    keys = [key] if isinstance(key, str) else list(key)
    (
        df.repartition(buckets, *keys)
        .write.mode(mode)
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )


def publish(
    df: DataFrame,
    area: str,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    """Replace or extend a result table; another connector takes a format and its options."""
    df.write.format(fmt).options(**(options or {})).mode(mode).save(f"{area.rstrip('/')}/{name}")


def read_published(spark: SparkSession, area: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{area.rstrip('/')}/{name}")
