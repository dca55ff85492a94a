"""The stored (pickup, dropoff) pairs and their keys, bucketed by pair.

A batch is dealt to the same buckets and meets the stored pairs where they lie: they are scanned
once and not shuffled, however many there are. Loads whose months lie apart from the batch's are
not read.
"""

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators.sinks import write_bucketed

PAIR = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
KEYED_PAIR = schemas.struct(
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, datetime_id bigint"
)


def write_pairs(keyed: DataFrame, folder: str, buckets: int) -> None:
    """Store keyed pairs in sorted buckets. The catalog's entry is dropped, the files stay."""
    table = f"pairs_{uuid.uuid4().hex}"
    try:
        write_bucketed(keyed.select(*KEYED_PAIR.names), table, folder, PAIR, buckets, "overwrite")
    finally:
        keyed.sparkSession.sql(f"drop table if exists {table}")


@contextmanager
def stored_pairs(spark: SparkSession, folders: Sequence[str], buckets: int) -> Iterator[DataFrame]:
    """The pairs of several loads as one bucketed table, while the block runs."""
    table = f"pairs_{uuid.uuid4().hex}"
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in KEYED_PAIR)
    spark.sql(
        f"create table {table} ({columns}, part string) using parquet partitioned by (part) "
        f"clustered by ({', '.join(PAIR)}) sorted by ({', '.join(PAIR)}) into {int(buckets)} buckets "
        f"location '{folders[0]}'"
    )
    try:
        for number, folder in enumerate(folders):
            spark.sql(f"alter table {table} add partition (part = '{number}') location '{folder}'")
        yield spark.table(table).select(*KEYED_PAIR.names)
    finally:
        spark.sql(f"drop table if exists {table}")


def with_stored_keys(pairs: DataFrame, stored: DataFrame) -> DataFrame:
    """A batch's pairs with their stored ``datetime_id``, null for pairs that are new."""
    return pairs.join(stored, PAIR, "left")


def month_span(pairs: DataFrame) -> tuple[int | None, int | None]:
    """First and last pickup month of pairs, counted from year 0; two nulls without pairs."""
    month = F.year(PAIR[0]) * 12 + F.month(PAIR[0]) - 1
    return tuple(pairs.agg(F.min(month), F.max(month)).first())
