"""Monthly files as a stream: every landed file is loaded exactly once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripmart.plans.warehouse import Warehouse, load_batch
from tripmart.schemas import RAW_TRIP
from tripmart.sources.trips import with_source_row


# Files are known by their path alone, so that one dated before others still counts as new.
# The stream's log keeps a path and a time for each file ever seen, some 200 bytes.
MAX_FILE_AGE = "36500d"


def landing_stream(spark: SparkSession, area: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream over the files of a landing area and the folders below it."""
    reader = spark.readStream.schema(RAW_TRIP).option("recursiveFileLookup", True)
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(area)


def _finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def ingest_landing(
    spark: SparkSession,
    area: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append the files that landed since the last run to ``target``, then stop.

    The checkpoint remembers which files are done and the sink which batches are complete,
    so neither a second run nor a failed one repeats rows.
    """
    return _finish(
        landing_stream(spark, area, files_per_batch)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


def load_landed(
    spark: SparkSession,
    area: str,
    zones: DataFrame,
    root: str,
    checkpoint: str,
    first_load: int = 0,
    files_per_batch: int | None = None,
    years: tuple[int, int] | None = None,
) -> Warehouse:
    """Load the files that landed since the last run into the warehouse, then stop.

    A batch takes the number after the last load, ``first_load`` at least, and is stored
    under the checkpoint's name and its own number. A batch that is run again after a failure
    finds itself there, so it takes the same number, and other loads in between keep theirs.
    ``years`` keeps the trips of a range of pickup years.
    """

    def load(trips: DataFrame, batch: int) -> None:
        stored = Warehouse(spark, root)
        number = stored.load_of(checkpoint, batch)
        if number is None:
            last = -1 if stored.last_load is None else stored.last_load
            number = max(first_load, last + 1)
        load_batch(trips, zones, root, number, years, source=checkpoint, batch=batch)

    _finish(
        with_source_row(landing_stream(spark, area, files_per_batch))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return Warehouse(spark, root)
