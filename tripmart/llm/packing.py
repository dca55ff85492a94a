"""Packing by optimal length buckets.

The histogram of all lengths is counted; dynamic programming over it chooses the bucket
boundaries that waste least on padding; inside a bucket rows follow each other into batches
whose padded size stays within a token budget.
"""

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import stored

BUCKETS = 16
TOKEN_BUDGET = 16_384
# Rows of a bucket are numbered apart by this many leading hexadecimal digits of their md5.
SLOT_DIGITS = 3


def boundaries(tops: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Ends of at most ``buckets`` buckets over ascending lengths with the least padding.

    Every row is padded to the end of its bucket, so the sum of count times end is least;
    among equal sums fewer buckets win. What a last bucket from some length on costs is a line in
    its end, so each level of the dynamic programming keeps the lower hull of these lines and goes through
    the lengths once. Whole numbers only.
    """
    size = len(tops)
    if not size:
        return []
    total = [0, *accumulate(counts)]
    best = [end * total[place + 1] for place, end in enumerate(tops)]
    choice, costs = [[-1] * size], [best[-1]]
    for _ in range(min(buckets, size) - 1):
        following, chosen = best.copy(), [-2] * size
        hull: list[tuple[int, int, int]] = []  # slope, height, where the bucket before it ends
        low = 0
        for end in range(1, size):
            line = (-total[end], best[end - 1], end - 1)
            while len(hull) - low > 1 and _hidden(hull[-2], hull[-1], line):
                hull.pop()
            hull.append(line)
            x = tops[end]
            while low + 1 < len(hull) and (
                hull[low + 1][0] * x + hull[low + 1][1] < hull[low][0] * x + hull[low][1]
            ):
                low += 1
            cost = hull[low][0] * x + hull[low][1] + x * total[end + 1]
            if cost < following[end]:
                following[end], chosen[end] = cost, hull[low][2]
        best = following
        choice.append(chosen)
        costs.append(best[-1])
    level, at, found = costs.index(min(costs)), size - 1, []
    while at >= 0:
        while choice[level][at] == -2:
            level -= 1
        found.append(int(tops[at]))
        at, level = choice[level][at], level - 1
    return found[::-1]


def _hidden(one: tuple[int, int, int], two: tuple[int, int, int], three: tuple[int, int, int]) -> bool:
    """Whether the middle of three lines of falling slope is nowhere below both others."""
    return (two[1] - one[1]) * (two[0] - three[0]) >= (three[1] - two[1]) * (one[0] - two[0])


def pack(
    rows: DataFrame,
    key: str = "doc_id",
    length: str = "n_tokens",
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """Every row's place in a batch: key, length, bucket_length, batch_id, position.

    A batch holds as many rows as fit the budget when each is padded to its bucket's
    length, and one row at least, so a row above the budget is a batch by itself. Rows of
    a bucket follow each other by the md5 of their key, which spreads sources over batches,
    then by key and length; equal rows may change places with each other. A null length
    counts as 0, as a negative one does, and a null key comes first. Only key and length are moved. The
    histogram has a number for every length that occurs, and a bucket ends with its longest row, so no
    other boundaries waste less. The driver sees the histogram, at most as many numbers as the
    longest row has tokens. Row numbers come from counts per bucket and
    leading digits of the md5, so no task orders a bucket; those counts are broadcast and
    number buckets * 4096 at most.
    """
    lengths = rows.select(
        F.col(key).alias("key"), F.greatest(F.col(length).cast("long"), F.lit(0)).alias("length")
    )
    # read three times, while a length may take a pass over a text
    lengths = stored(lengths, "lengths")
    histogram = sorted(lengths.groupBy("length").agg(F.count("*").alias("n")).collect())
    ends = boundaries([row["length"] for row in histogram], [row["n"] for row in histogram], buckets)
    end = F.lit(None).cast("long")
    for value in reversed(ends):
        end = F.when(F.col("length") <= value, F.lit(value).cast("long")).otherwise(end)
    mark = F.md5(F.coalesce(F.col("key").cast("string"), F.lit("")))
    placed = lengths.select("key", "length", end.alias("bucket_length"), mark.alias("mark"))
    placed = placed.withColumn("slot", F.substring("mark", 1, SLOT_DIGITS))
    before = Window.partitionBy("bucket_length").orderBy("slot")
    offsets = (
        placed.groupBy("bucket_length", "slot")
        .agg(F.count("*").alias("n"))
        .withColumn("offset", F.sum("n").over(before) - F.col("n"))
        .drop("n")
    )
    within = Window.partitionBy("bucket_length", "slot").orderBy("mark", "key", "length")
    per_batch = F.greatest(
        F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_length"), F.lit(1))), F.lit(1)
    )
    numbered = (
        placed.withColumn("row", F.row_number().over(within) - 1)
        .join(F.broadcast(offsets), ["bucket_length", "slot"])
        .withColumn("row", F.col("row") + F.col("offset"))
    )
    return numbered.select(
        F.col("key").alias(key),
        F.col("length").alias(length),
        "bucket_length",
        F.concat_ws("-", "bucket_length", F.floor(F.col("row") / per_batch)).alias("batch_id"),
        F.pmod(F.col("row"), per_batch).alias("position"),
    )
