"""MinHash near-dedup: one permutation, optimal densification, bands, star-shaped candidates.

The word shingles of a text are hashed once; the hashes' leading bits deal them to bins and
a bin's least hash is its value. An empty bin borrows from a bin chosen by a hash of its
number and the attempt, the same for every text, until one has a value. Rows of bins are
bands; texts that agree in a band share a bucket. In a bucket, texts are not paired with each
other but with two of its members, so candidates grow with the members of buckets: the member
found in the largest buckets, which in a family of edited copies is the one they were made
from, and one drawn by a hash that differs from band to band. Candidates are confirmed on
their whole shingle sets.

Two members of a bucket that no centre brought into one component are left over. The texts of
such buckets are compared once more, exactly: of two sets at the threshold each holds one of
the rarest shingles of the other, as many as the sets may differ by and one more, so only
texts of different components that meet in one of these are confirmed.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import components, process_cache, released, stored, words_of

SHINGLE_WORDS = 5
BINS = 128
BAND_BINS = 4
BANDS = BINS // BAND_BINS
THRESHOLD_PERCENT = 80
# Longs of a parity bitmap, with 64 bits each.
BITMAP_LONGS = 8
# Words whose hash a worker remembers.
MAX_REMEMBERED = 200_000
# Shingles that a worker sends on in one batch, about.
BATCH_SHINGLES = 1 << 19

_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MAX_REMEMBERED:
            self.clear()
        self[word] = value
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text.

    A text of fewer words than a shingle has is one shingle; one without words has none.
    """
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(words) < SHINGLE_WORDS:
        short = (own * _FACTORS[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
        return _mixed(np.array([short], np.uint64))
    count = len(own) - SHINGLE_WORDS + 1
    rolled = own[:count] * _FACTORS[0]
    for place in range(1, SHINGLE_WORDS):
        rolled += own[place : place + count] * _FACTORS[place]
    return np.unique(_mixed(rolled))


def _attempts(count: int) -> np.ndarray:
    """For each bin the bins it tries to borrow from, in order."""
    bins = np.arange(BINS, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    tries = np.arange(1, count + 1, dtype=np.uint64)[None, :] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (_mixed(bins + tries) >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)


_TRIES = _attempts(1024)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The value of every bin of a sorted set that is not empty."""
    shift = np.uint64(64 - (BINS.bit_length() - 1))
    edges = np.searchsorted(hashes, np.arange(BINS, dtype=np.uint64) << shift)
    filled = np.append(edges[1:], len(hashes)) > edges
    values = hashes[np.minimum(edges, len(hashes) - 1)]
    empty = np.flatnonzero(~filled)
    if empty.size:
        source = np.arange(BINS)
        for attempt in range(_TRIES.shape[1]):
            chosen = _TRIES[empty, attempt]
            good = filled[chosen]
            source[empty[good]] = chosen[good]
            empty = empty[~good]
            if not empty.size:
                break
        source[empty] = np.flatnonzero(filled)[0]
        values = values[source]
    return values


def band_keys(values: np.ndarray) -> np.ndarray:
    """One bucket key for each band of a sketch; keys of different bands differ."""
    rows = values.reshape(BANDS, BAND_BINS)
    mixed = (rows * _FACTORS[:BAND_BINS]).sum(axis=1, dtype=np.uint64)
    return _mixed(mixed + np.arange(BANDS, dtype=np.uint64) * _FACTORS[4])


def set_digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = process_cache("word hashes", WordHashes)
    for batch in batches:
        sizes, digests, bands, ends = [], [], [], [0]
        for value in batch.column(1):
            own = shingles(value.as_py(), hashes)
            sizes.append(len(own))
            digests.append(set_digest(own) if len(own) else None)
            if len(own):
                bands.append(band_keys(sketch(own)))
            ends.append(BANDS * len(bands))
        keys = np.concatenate(bands).view(np.int64) if bands else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys)),
            ],
            names=["doc_id", "mark", "n_shingles", "digest", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, hashes) of rows (doc_id, text, digest) whose text has that digest.

    Rows that repeat each other come one after the other and are taken once.
    """
    hashes = process_cache("word hashes", WordHashes)
    last = None
    digests, sets, waiting = [], [], 0

    def made() -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, sets)])
        values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)),
            ],
            names=["digest", "hashes"],
        )

    for batch in batches:
        for value, found in zip(batch.column(1), batch.column(2)):
            wanted = found.as_py()
            if wanted == last:
                continue
            own = shingles(value.as_py(), hashes)
            if set_digest(own) != wanted:
                continue
            last = wanted
            digests.append(wanted)
            sets.append(own.view(np.int64))
            waiting += len(own)
            if waiting >= BATCH_SHINGLES:
                yield made()
                digests, sets, waiting = [], [], 0
    yield made()


def _in_buckets(classes: DataFrame) -> DataFrame:
    """(bucket, digest, n, size) of the classes in buckets of two or more."""
    members = classes.select("digest", "n", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    return stored(members.join(stored(sizes, "buckets"), "bucket"), "members")


def _candidates(shared: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each class beside the chosen members of its buckets."""
    weights = shared.groupBy("digest").agg(F.sum("size").alias("weight"))
    weighed = shared.join(weights, "digest")
    hub = F.max(F.struct("weight", "digest", "n")).alias("hub")
    drawn = F.min(F.struct(F.xxhash64("digest", "bucket").alias("mark"), "digest", "n")).alias("drawn")
    chosen = stored(weighed.groupBy("bucket").agg(hub, drawn), "hubs")
    pairs = shared.join(chosen, "bucket").select(
        F.col("digest").alias("a"),
        F.col("n").alias("n_a"),
        F.explode(
            F.array(
                F.struct(F.col("hub.digest").alias("b"), F.col("hub.n").alias("n_b")),
                F.struct(F.col("drawn.digest").alias("b"), F.col("drawn.n").alias("n_b")),
            )
        ).alias("other"),
    )
    return pairs.select("a", "n_a", "other.b", "other.n_b").filter("a <> b")


def _unordered(pairs: DataFrame, threshold_percent: int) -> DataFrame:
    """Distinct (a, b) of the pairs (a, n_a, b, n_b) whose sizes allow a link."""
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    a, b = F.least("a", "b"), F.greatest("a", "b")
    close = pairs.filter(100 * least >= threshold_percent * most)
    return close.select(a.alias("a"), b.alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold_percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    one = sets.select(F.col("digest").alias("a"), F.col("hashes").alias("set_a"))
    two = sets.select(F.col("digest").alias("b"), F.col("hashes").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    linked = 100 * common >= threshold_percent * union
    return pairs.join(one, "a").join(two, "b").filter(linked).select("a", "b")


def _unsettled(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(digest, root) of the classes in buckets whose members are in several components.

    In a bucket of two the only pair has been confirmed or refused.
    """
    named = shared.filter("size > 2").join(
        roots.withColumnRenamed("node", "digest"), "digest", "left"
    )
    named = named.select("bucket", "digest", F.coalesce("root", "digest").alias("root"))
    several = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    several = several.filter("low <> high").select("bucket")
    return stored(
        named.join(several, "bucket").groupBy("digest").agg(F.first("root").alias("root")),
        "unsettled",
    )


def _parity_bits() -> list[Column]:
    """The bitmap of a set ``hashes``: of a bit, whether an odd number of its hashes fall on it."""
    return [
        F.expr(
            f"aggregate(hashes, 0L, (bits, x) -> bits ^ if((x & {BITMAP_LONGS - 1}) = {place}, "
            f"shiftleft(1L, cast((x >> {BITMAP_LONGS.bit_length() - 1}) & 63 as int)), 0L))"
        ).alias(f"bits{place}")
        for place in range(BITMAP_LONGS)
    ]


def _may_link(one: str, two: str, threshold_percent: int) -> Column:
    """Whether two sets, known by size ``n`` and bitmap, may reach the threshold.

    What is in both sets falls out of the bitmaps' difference, so the bits that differ are no
    more than the hashes in one set only. Linked sets have at most a share
    (1 - threshold) / (1 + threshold) of both sizes in one only.
    """
    n, m = F.col(f"{one}.n"), F.col(f"{two}.n")
    differing = sum(
        F.bit_count(F.col(f"{one}.bits{i}").bitwiseXOR(F.col(f"{two}.bits{i}")))
        for i in range(BITMAP_LONGS)
    )
    return (100 * F.least(n, m) >= threshold_percent * F.greatest(n, m)) & (
        (100 + threshold_percent) * differing <= (100 - threshold_percent) * (n + m)
    )


def _leftover_pairs(unsettled: DataFrame, sets: DataFrame, threshold_percent: int) -> DataFrame:
    """(a, b), the lower first, of different components that may reach the threshold.

    Sets of n shingles that link share ceil(threshold * n) or more, so in any order that all
    sets follow they meet within the first n - ceil(threshold * n) + 1 shingles of each.
    Here the rarest come first. Shingles of one set only come before all others and meet
    nothing; they are counted and not moved. Of the texts that meet in a shingle, those of
    the most frequent component are not compared with each other, and a meeting counts only
    if sizes and bitmaps allow a link: in a family of edited copies all texts meet in what few
    of them have edited, and the bitmaps part those that differ too much. What two sets share
    beyond their first shingles is at most ceil(threshold * n) - 1 of the larger n, so the
    number of shingles they meet in tells most pairs that cannot link.
    """
    held = sets.join(unsettled, "digest")
    shingle = F.explode("hashes").alias("shingle")
    common = held.select(shingle).groupBy("shingle").agg(F.count("*").alias("texts"))
    common = stored(common.filter("texts > 1"), "shingles")
    places = held.select("digest", shingle).join(common, "shingle")
    ordered = places.groupBy("digest").agg(
        F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("common")
    )
    sized = held.select("digest", "root", F.size("hashes").alias("n"), *_parity_bits())
    bits = [f"bits{place}" for place in range(BITMAP_LONGS)]
    needed = f"({{}} * {int(threshold_percent)}L + 99) div 100"
    first = (F.size("common") - F.expr(needed.format("n")) + 1).cast("int")
    leading = (
        ordered.join(sized, "digest")
        .withColumn("first", first)
        .filter("first > 0")
        .select(
            "digest", "root", "n", *bits, F.explode(F.slice("common", 1, F.col("first"))).alias("at")
        )
    )
    leading = stored(leading.select("at.shingle", "digest", "root", "n", *bits), "leading")
    per_root = leading.groupBy("shingle", "root").agg(F.count("*").alias("texts"))
    met = per_root.groupBy("shingle").agg(
        F.max(F.struct("texts", "root"))["root"].alias("main"), F.count("*").alias("roots")
    )
    met = stored(met.filter("roots > 1").select("shingle", "main"), "met")
    others = leading.join(met, "shingle").filter("root <> main")
    others = others.select(
        "shingle",
        "main",
        F.col("root").alias("other_root"),
        F.struct("digest", "n", *bits).alias("one"),
    )
    every = leading.select("shingle", "root", F.struct("digest", "n", *bits).alias("two"))
    each_once = (F.col("root") == F.col("main")) | (F.col("one.digest") < F.col("two.digest"))
    meetings = (
        others.join(every, "shingle")
        .filter("root <> other_root")
        .filter(each_once)
        .filter(_may_link("one", "two", threshold_percent))
        .select(F.struct("one.digest", "one.n").alias("one"), F.struct("two.digest", "two.n").alias("two"))
    )
    counted = meetings.groupBy(
        F.least("one", "two").alias("low"), F.greatest("one", "two").alias("high")
    ).agg(F.count("*").alias("met"))
    larger, smaller = F.greatest("low.n", "high.n"), F.least("low.n", "high.n")
    most = F.col("met") + F.expr(needed.format("greatest(low.n, high.n)")) - 1
    return counted.filter(
        (100 * smaller >= threshold_percent * larger)
        & ((100 + threshold_percent) * most >= threshold_percent * (larger + smaller))
    ).select(F.col("low.digest").alias("a"), F.col("high.digest").alias("b"))


def _joined_roots(links: DataFrame, unsettled: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) after links between components; a class without links is its own root."""
    one = unsettled.select(F.col("digest").alias("a"), F.col("root").alias("root_a"))
    two = unsettled.select(F.col("digest").alias("b"), F.col("root").alias("root_b"))
    edges = links.join(one, "a").join(two, "b")
    merged = components(edges.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    merged = stored(merged.select(F.col("node").alias("root"), F.col("root").alias("last")), "merged")
    ends = merged.select(F.col("root").alias("node"), "last")
    below = roots.join(merged, "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    alone = ends.join(roots, "node", "left_anti").select("node", F.col("last").alias("root"))
    return below.union(alone)


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold_percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """One row per row: the key as a long, n_shingles, component_id, kept.

    Texts are linked when 100 * intersection >= threshold * union of their shingle sets.
    component_id is the smallest key in reach of links and kept tells whether it is the
    row's own. Texts with equal sets are one class and are never paired. Texts without words
    are linked with nothing. A null key is never the smallest unless alone; its component may
    be null, and it is kept then. Rows that repeat a key are each linked by their own text.

    A pair at the threshold agrees in a given band with chance 0.8 ** 4, so it shares none
    of the 32 buckets once in 10 million; one that shares a bucket is not missed. Sets travel
    for candidates and for texts of buckets of three or more only; a class with very many
    candidates is one row, met by a join that can be split.
    """
    rooted = _rooted(docs, key, text, threshold_percent)
    found = rooted.filter("root is not null")
    smallest = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return (
        found.join(smallest, "root")
        .select("doc_id", "n_shingles", "component_id")
        .union(
            rooted.filter("root is null").select(
                "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
            )
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .withColumnRenamed("doc_id", key)
    )


def drop_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold_percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """One row of each group of near duplicates, with all columns; links are those of ``near_duplicates``.

    The row with the smallest key stays, one without key only if all are. Rows are told apart
    by key and text, so of rows that share a key only those linked to others go. Of
    rows that repeat key and text one stays. Texts without words are linked with
    nothing and all stay. An empty table gives an empty one.
    """
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    own_key, own_text = (f"c{names.index(name)}" for name in (key, text))
    rooted = stored(_rooted(plain, own_key, own_text, threshold_percent).filter("root is not null"), "rooted")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    first = rooted.groupBy("root").agg(F.min(place).alias("first"))
    gone = rooted.join(first, "root").filter(place != F.col("first"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    marked = plain.withColumns({"doc_id": F.col(own_key).cast("long"), "mark": F.xxhash64(own_text)})
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark"))
    kept = marked.join(gone, same, "left_anti")
    repeated = rooted.groupBy("doc_id", "mark").count().filter("count > 1")
    repeated = stored(repeated.select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")), "repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "mark"])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return kept.select(*plain.columns).toDF(*names)


def _rooted(docs: DataFrame, key: str, text: str, threshold_percent: int) -> DataFrame:
    """(doc_id, mark, n_shingles, root): every row with the class that names its component.

    ``mark`` is a hash of the text; ``root`` is null for texts without words.
    """
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark")
    )
    sketches = stored(
        rows.mapInArrow(
            released(_sketched, keeps=True),
            "doc_id bigint, mark bigint, n_shingles bigint, digest binary, bands array<bigint>",
        ),
        "sketches",
    )
    known = sketches.filter("digest is not null")
    grouped = known.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"),
        F.coalesce(F.min_by("mark", "doc_id"), F.min("mark")).alias("mark"),
        F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"),
    )
    classes = stored(grouped, "classes")
    shared = _in_buckets(classes)
    pairs = stored(_unordered(_candidates(shared), threshold_percent), "candidates")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("digest"))
    wanted = wanted.union(shared.filter("size > 2").select("digest")).distinct()
    wanted = stored(classes.select("digest", "doc_id", "mark").join(wanted, "digest"), "wanted")
    wanted = wanted.withColumnsRenamed({"doc_id": "_wanted", "mark": "_mark"})
    # merged at any size: texts are to move alike however few are wanted; the text tells rows
    # apart that share a key or have none
    same = F.col("doc_id").eqNullSafe(F.col("_wanted")) & (F.col("mark") == F.col("_mark"))
    texts = rows.join(wanted.hint("merge"), same)
    sets = stored(
        texts.select("doc_id", "text", "digest").mapInArrow(
            released(_sets, keeps=True), "digest binary, hashes array<bigint>"
        ),
        "sets",
    )
    roots = components(_confirmed(pairs, sets, threshold_percent))
    unsettled = _unsettled(shared, roots)
    left = _leftover_pairs(unsettled, sets, threshold_percent)
    left = stored(left.join(pairs, ["a", "b"], "left_anti"), "leftover")
    roots = _joined_roots(_confirmed(left, sets, threshold_percent), unsettled, roots)
    return sketches.join(roots.withColumnRenamed("node", "digest"), "digest", "left").select(
        "doc_id", "mark", "n_shingles", F.coalesce("root", "digest").alias("root")
    )
