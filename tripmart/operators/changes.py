"""New rows and versions of small keyed tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def new_rows(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct incoming rows that are not stored; columns are matched by name."""
    return incoming.subtract(stored.select(*incoming.columns))


def append_rows(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept; columns are matched by name."""
    return stored.unionByName(incoming)


def latest_versions(history: DataFrame, key: str, version: str) -> DataFrame:
    """Per key the row of the highest version, without the version column."""
    columns = [name for name in history.columns if name not in (key, version)]
    newest = F.max_by(F.struct(*columns), F.col(version)).alias("newest")
    return history.groupBy(key).agg(newest).select(key, "newest.*")


def upsert(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Type I change: an incoming row replaces the stored row of its key.

    ``incoming`` holds each key once.
    """
    kept = stored.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming)


def add_versions(
    history: DataFrame, incoming: DataFrame, key: str, attributes: Sequence[str], at: Column
) -> DataFrame:
    """Type II change: close the versions whose attributes changed and open new ones.

    ``history`` has ``valid_from``, ``valid_to`` and ``is_current`` beside the key and the
    attributes. Nulls compare as equal. Keys missing from ``incoming`` stay as they are;
    ``incoming`` holds each key once.
    """
    incoming = incoming.select(key, *attributes)
    current = history.filter("is_current").select(key, *attributes).alias("cur")
    same = F.col(f"inc.{key}") == F.col(f"cur.{key}")
    for name in attributes:
        same = same & F.col(f"inc.{name}").eqNullSafe(F.col(f"cur.{name}"))
    opened = incoming.alias("inc").join(current, same, "left_anti")

    superseded = opened.select(key, F.lit(True).alias("superseded"))
    closing = F.col("is_current") & F.coalesce(F.col("superseded"), F.lit(False))
    closed = (
        history.join(superseded, key, "left")
        .withColumns(
            {
                "valid_to": F.when(closing, at).otherwise(F.col("valid_to")),
                "is_current": F.col("is_current") & ~closing,
            }
        )
        .drop("superseded")
    )
    validity = {
        "valid_from": at,
        "valid_to": F.lit(None).cast(history.schema["valid_to"].dataType),
        "is_current": F.lit(True),
    }
    return closed.unionByName(opened.withColumns(validity))


def with_intervals(history: DataFrame, key: str, since: str, load: str) -> DataFrame:
    """Type II intervals of an append-only history: ``valid_from``, ``valid_to``, ``is_current``.

    A version holds from its day until the next of its key. Of versions that begin on one day
    the one of the last load counts; the others never held and are left out. ``since`` becomes
    ``valid_from``; the first version of a key has ``is_first``.
    """
    order = Window.partitionBy(key).orderBy(since, load)
    found = history.withColumns(
        {"valid_to": F.lead(since).over(order), "is_first": F.min(since).over(Window.partitionBy(key))}
    )
    found = found.filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col(since)))
    return (
        found.withColumn("is_first", F.col("is_first") == F.col(since))
        .withColumn("is_current", F.col("valid_to").isNull())
        .withColumnRenamed(since, "valid_from")
        .drop(load)
    )


def in_effect(day: Column) -> Column:
    """Whether a version of ``with_intervals`` holds on a day; before all versions the first does."""
    begun = F.col("is_first") | (F.col("valid_from") <= day)
    return begun & (F.col("valid_to").isNull() | (F.col("valid_to") > day))


def join_as_of(rows: DataFrame, versions: DataFrame, key: str, day: str) -> DataFrame:
    """Rows with the version of their key that held on their day; rows of unknown keys are left out.

    An equi join by key with a range of days, so a row meets the few versions of its own key.
    """
    return rows.join(versions, key).filter(in_effect(F.col(day))).drop("is_first")
