"""Joins whose keys may be very unevenly used."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one part in this many of all rows, so there are
# fewer hot keys than parts however the rows are spread.
PARTS = 10_000
# Keys below this number of rows are never worth splitting.
MIN_HOT_ROWS = 100_000
# A list of hot keys up to this length is broadcast; those of many loads may be longer.
MAX_BROADCAST_HOT = 100_000


def broadcast_up_to(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a frame after counting that it is small; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hot_keys(
    counted: DataFrame,
    keys: Sequence[str],
    rows: str,
    parts: int = PARTS,
    min_rows: int = MIN_HOT_ROWS,
    total: int | None = None,
    finer: int = 1,
) -> DataFrame:
    """The hot keys of a frame of keys and row counts, and the ``salts`` each is split into.

    No split of a hot key holds more rows than a key that just is not hot. ``total`` is the
    number of all rows where ``counted`` lacks some keys. With ``finer`` keys of a so much
    smaller share are found too: kept for every load, they make a summary that can be added up. A key
    that none of the loads kept has at most that share of their total, so one that is hot
    over all loads by this margin is found, even where it is hot in none.
    """
    found, largest = counted.agg(F.sum(rows), F.max(rows)).first()
    total = (found or 0) if total is None else total
    limit = max(max(total // parts, min_rows) // finer, 1)
    salts = F.ceil(F.col(rows) / limit).cast("int").alias("salts")
    hot = counted.filter(F.col(rows) > limit).select(*keys, rows, salts)
    return hot if (largest or 0) > limit else hot.limit(0)


def join_unique(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], hot: DataFrame, spread_by: str
) -> DataFrame:
    """Inner join with a lookup that is unique by ``keys``, with hot keys split by a salt.

    Rows of a hot key are spread by a hash of ``spread_by``, a column that tells them
    apart, and its lookup row is copied once per salt. ``hot`` comes from ``hot_keys``, which
    bounds its length for one load; a list of many loads is counted before it is broadcast.
    Without hot keys this is the plain join.
    """
    if hot.isEmpty():
        return rows.join(lookup, list(keys))
    hot = broadcast_up_to(hot, MAX_BROADCAST_HOT)
    salt = F.pmod(F.xxhash64(spread_by), F.col("salts")).cast("int")
    salted = rows.join(hot, list(keys), "left").withColumn("salt", F.coalesce(salt, F.lit(0)))
    last = F.coalesce(F.col("salts"), F.lit(1)) - 1
    copies = lookup.join(hot, list(keys), "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), last))
    )
    return (
        salted.drop("salts").join(copies.drop("salts"), [*keys, "salt"]).drop("salt")
    )
