"""Embedding near-dedup by NN-descent.

Each vector keeps a list of its nearest others. The lists start from the leaves of trees of
random hyperplanes and are refined in rounds: for every vector, all on its list and all that
have it on theirs meet and are compared, and who is nearer than what a list has enters it. A
list whose entries all reach the threshold is saturated; it is enlarged. Rounds end when few
entries change. An audit then compares a bounded number of vectors, some of each size of
component and some of none, with all others and starts further trees and rounds while too few
of their links are in reach; when these end, all vectors are compared in blocks. Edges at the
threshold are kept; vectors connected by them are compared exactly in double precision.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripmart.llm.common import components, parallel, stored, whole_groups

THRESHOLD = 0.93
# Entries of a list, and of one that is saturated.
LIST = 8
ENLARGED = 24
# Others that have a vector on their list and meet at it, the nearest of them.
REVERSE = 8
TREES = 8
# Vectors of one leaf, about; a larger leaf is split by chance, differently for each tree.
LEAF = 64
MAX_ROUNDS = 6
# Rounds end when fewer than this share of the entries are new.
STILL = 0.002
# Audited vectors, about, of components of like size and of those without a component.
AUDITED = 200
AUDITED_ALONE = 1000
RECALL = 0.97
MAX_ATTEMPTS = 3
# Members of a component that are compared in one go.
TILE = 512

_PAIRS = "src bigint, dst bigint, cos float"


def _vectors(table: pa.Table | pa.RecordBatch, name: str = "vector") -> np.ndarray:
    """A matrix from a column of binary float32 vectors of one length."""
    column = table.column(name)
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.float32).reshape(len(column), -1)


def _unit(values: np.ndarray) -> np.ndarray:
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _classes(embeddings: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(cls, room, vec_id, copies, embedding): equal vectors of a label as one row.

    Vectors that cannot link are left out: null label, vector or component, a component that
    is not finite, or nothing but zeros. ``room`` stands for label and length, between
    whose values nothing links.
    """
    values = F.col(vector).cast("array<double>")
    good = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(values, lambda x: x != 0)
    rows = embeddings.select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(label).alias("label"),
        F.when(good & nonzero, values).alias("embedding"),
    ).filter("label is not null and embedding is not null")
    return _with_class(rows).groupBy("cls", "room", "embedding").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")
    )


def _with_class(rows: DataFrame) -> DataFrame:
    room = F.xxhash64("label", F.size("embedding"))
    return rows.withColumns({"room": room, "cls": F.xxhash64("label", "embedding")})


def _to_binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, room, vector): unit vectors as float32 bytes."""
    for batch in batches:
        found = []
        for value in batch.column(2):
            own = np.array(value.as_py(), np.float64)
            # scaled first, so that squares neither overflow nor vanish
            own /= np.abs(own).max()
            found.append((own / np.linalg.norm(own)).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.binary())],
            names=["cls", "room", "vector"],
        )


def _planted(batches: Iterator[pa.RecordBatch], trees: range) -> Iterator[pa.RecordBatch]:
    """(cls, room, tree, leaf, vector) for each tree: the sides of its hyperplanes.

    Rows are (cls, room, vector, depth).
    """
    for batch in batches:
        depths = batch.column(3).to_numpy()
        vectors = batch.column(2).to_pylist()
        for length in {len(x) for x in vectors}:
            rows = np.array([i for i, x in enumerate(vectors) if len(x) == length])
            values = np.frombuffer(b"".join(vectors[i] for i in rows), np.float32)
            values = values.reshape(len(rows), -1)
            depth = depths[rows]
            taken = pa.array(rows)
            for tree in trees:
                random = np.random.default_rng((tree, values.shape[1]))
                planes = random.standard_normal((values.shape[1], 40)).astype(np.float32)
                sides = (values @ planes > 0).astype(np.int64) << np.arange(40)
                leaf = sides.sum(axis=1) & ((1 << depth) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(taken),
                        batch.column(1).take(taken),
                        pa.array(np.full(len(rows), tree, np.int32)),
                        pa.array(leaf),
                        batch.column(2).take(taken),
                    ],
                    names=["cls", "room", "tree", "leaf", "vector"],
                )


def _pair_batch(sources: list, others: list, cosines: list) -> pa.RecordBatch:
    empty = np.zeros(0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(sources) if sources else empty.astype(np.int64), pa.int64()),
            pa.array(np.concatenate(others) if others else empty.astype(np.int64), pa.int64()),
            pa.array(np.concatenate(cosines) if cosines else empty.astype(np.float32), pa.float32()),
        ],
        names=["src", "dst", "cos"],
    )


def _in_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest of each vector's leaf, from rows (place, cls, vector) sorted by place."""
    for table in whole_groups(batches, "place"):
        places = table.column("place").to_numpy()
        cuts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        sources, others, cosines = [], [], []
        for start, end in zip(cuts, [*cuts[1:], len(places)]):
            if end - start < 2:
                continue
            part = table.slice(start, end - start)
            cls, values = part.column("cls").to_numpy(), _vectors(part)
            cos = values @ values.T
            np.fill_diagonal(cos, -2)
            width = min(LIST // 2, len(cls) - 1)
            best = np.argpartition(-cos, width - 1, axis=1)[:, :width]
            sources.append(np.repeat(cls, width))
            others.append(cls[best].ravel())
            cosines.append(np.take_along_axis(cos, best, axis=1).ravel())
        yield _pair_batch(sources, others, cosines)


def _trimmed(pairs: DataFrame, threshold: float) -> DataFrame:
    """The lists: the LIST nearest of every vector, ENLARGED while they reach the threshold."""
    nearest = Window.partitionBy("src").orderBy(F.desc("cos"), "dst")
    ranked = pairs.withColumn("rank", F.row_number().over(nearest))
    return ranked.filter(
        (F.col("rank") <= LIST) | (F.col("cos") >= threshold) & (F.col("rank") <= ENLARGED)
    ).drop("rank")


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Who is nearer than what a list has, from rows (pivot, cls, fresh, radius, vector).

    Rows are sorted by pivot. Two old members of a pivot have met before and are skipped.
    """
    for table in whole_groups(batches, "pivot"):
        pivots = table.column("pivot").to_numpy()
        cuts = np.flatnonzero(np.r_[True, pivots[1:] != pivots[:-1]])
        ids, fresh = table.column("cls").to_numpy(), table.column("fresh").to_numpy(zero_copy_only=False)
        radius, values = table.column("radius").to_numpy(), table.column("vector").to_pylist()
        sources, others, cosines = [], [], []
        for start, end in zip(cuts, [*cuts[1:], len(pivots)]):
            own, new = ids[start:end], fresh[start:end]
            if end - start < 2 or not new.any():
                continue
            matrix = np.frombuffer(b"".join(values[start:end]), np.float32).reshape(end - start, -1)
            cos = matrix @ matrix.T
            wanted = (new[:, None] | new[None, :]) & (cos > radius[start:end, None])
            wanted &= own[:, None] != own[None, :]
            at, to = np.nonzero(wanted)
            sources.append(own[at])
            others.append(own[to])
            cosines.append(cos[at, to])
        yield _pair_batch(sources, others, cosines)


def _refined(lists: DataFrame, vectors: DataFrame, threshold: float) -> tuple[DataFrame, int, int]:
    """Lists after one round, how many entries are new, and how many there are."""
    spark = lists.sparkSession
    # a list that still takes entries has no radius
    full = F.when(F.col("n") >= F.when(F.col("worst") >= threshold, ENLARGED).otherwise(LIST), F.col("worst"))
    radius = lists.groupBy("src").agg(F.count("*").alias("n"), F.min("cos").alias("worst"))
    radius = radius.select("src", F.coalesce(full, F.lit(-2.0)).cast("float").alias("radius"))
    back = Window.partitionBy("dst").orderBy(F.desc("cos"), "src")
    reverse = lists.withColumn("rank", F.row_number().over(back)).filter(F.col("rank") <= REVERSE)
    members = lists.select(F.col("src").alias("pivot"), F.col("dst").alias("cls"), "fresh").union(
        reverse.select(F.col("dst").alias("pivot"), F.col("src").alias("cls"), "fresh")
    )
    members = members.groupBy("pivot", "cls").agg(F.max("fresh").alias("fresh"))
    dressed = vectors.join(radius.withColumnRenamed("src", "cls"), "cls").select(
        "cls", "radius", "vector"
    )
    met = (
        members.join(dressed, "cls")
        .select("pivot", "cls", "fresh", "radius", "vector")
        .repartition(parallel(spark), "pivot")
        .sortWithinPartitions("pivot")
        .mapInArrow(_meet, _PAIRS)
    )
    both = lists.select("src", "dst", "cos", F.lit(False).alias("fresh")).union(
        met.select("src", "dst", "cos", F.lit(True))
    )
    merged = both.groupBy("src", "dst").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"))
    following = stored(_trimmed(merged, threshold), "lists")
    new, total = following.agg(F.coalesce(F.sum(F.col("fresh").cast("int")), F.lit(0)), F.count("*")).first()
    return following, new, total


def _grown(vectors: DataFrame, trees: range) -> DataFrame:
    """Pairs (src, dst, cos) near each other in a leaf of one of the trees."""
    spark = vectors.sparkSession
    planted = vectors.mapInArrow(
        partial(_planted, trees=trees),
        "cls bigint, room bigint, tree int, leaf bigint, vector binary",
    )
    leaf = ["room", "tree", "leaf"]
    sizes = planted.groupBy(*leaf).agg(F.count("*").alias("size"))
    # a large leaf is dealt out by a hash; small ones are one place each
    chunk = F.pmod(F.xxhash64("cls", "tree"), F.ceil(F.col("size") / (2 * LEAF))).alias("chunk")
    placed = planted.join(sizes.filter(F.col("size") > 2 * LEAF), leaf, "left").select(
        F.xxhash64(*leaf, F.coalesce(chunk, F.lit(0))).alias("place"), "cls", "vector"
    )
    return (
        placed.repartition(parallel(spark), "place")
        .sortWithinPartitions("place")
        .mapInArrow(_in_leaves, _PAIRS)
        .groupBy("src", "dst")
        .agg(F.max("cos").alias("cos"))
    )


def _audit(vectors: DataFrame, links: DataFrame, threshold: float) -> float:
    """Least mean share of a linked vector's links, found by brute force, that stay in a component.

    The mean is over all vectors that have links, and over those outside the components of at
    least 2, 4, 8, ... vectors, so that large components do not hide what others have lost.
    """
    sizes = links.groupBy("root").agg(F.count("*").alias("size"))
    # the number of binary digits of a component's size; 0 without a component
    kinds = links.join(sizes, "root").select(
        F.col("node").alias("cls"), "root", F.length(F.bin("size")).alias("kind")
    )
    kinds = stored(kinds, "kinds")
    counts = {row["kind"]: row["count"] for row in kinds.groupBy("kind").count().collect()}
    counts[0] = vectors.count() - sum(counts.values())
    placed = vectors.join(kinds, "cls", "left").select(
        "cls", "room", "vector", "root", F.coalesce("kind", F.lit(0)).alias("kind")
    )
    share = F.lit(1.0)
    for kind, count in counts.items():
        wanted = AUDITED if kind else AUDITED_ALONE
        share = F.when(F.col("kind") == kind, min(1.0, wanted / max(1, count))).otherwise(share)
    mark = F.pmod(F.xxhash64("cls", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    chosen = placed.filter(mark < share).collect()
    rooms: dict[int, list[int]] = {}
    for place, row in enumerate(chosen):
        rooms.setdefault(row["room"], []).append(place)
    queries = [(row["cls"], row["root"], bytes(row["vector"])) for row in chosen]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own_rooms = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            values = batch.column(2).to_pylist()
            alone = batch.column(3).is_null().to_numpy(zero_copy_only=False)
            roots = batch.column(3).fill_null(0).to_numpy()
            places, totals, founds = [], [], []
            for room in rooms.keys() & set(own_rooms.tolist()):
                rows = np.flatnonzero(own_rooms == room)
                right = np.frombuffer(b"".join(values[i] for i in rows), np.float32).reshape(len(rows), -1)
                for place in rooms[room]:
                    cls, root, vector = queries[place]
                    # a link by less than single precision errs is not counted
                    linked = rows[right @ np.frombuffer(vector, np.float32) >= threshold + 1e-5]
                    linked = linked[ids[linked] != cls]
                    if not len(linked):
                        continue
                    places.append(place)
                    totals.append(len(linked))
                    founds.append(0 if root is None else int(((roots[linked] == root) & ~alone[linked]).sum()))
            columns = [pa.array(column, pa.int64()) for column in (places, totals, founds)]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "total", "found"])

    counted = placed.select("cls", "room", "vector", "root").mapInArrow(
        tasks, "place bigint, total bigint, found bigint"
    )
    audited = counted.groupBy("place").agg(F.sum("total"), F.sum("found")).collect()
    sampled: dict[int, int] = {}
    for row in chosen:
        sampled[row["kind"]] = sampled.get(row["kind"], 0) + 1
    recalls: dict[int, list[float]] = {kind: [] for kind in counts}
    for place, total, found in audited:
        recalls[chosen[place]["kind"]].append(found / total)
    weight = kept = 0.0
    least = 1.0
    for kind in sorted(recalls):
        each = counts[kind] / max(1, sampled.get(kind, 0))
        weight += each * len(recalls[kind])
        kept += each * sum(recalls[kind])
        # vectors without a component have lost all links; they count among those with one
        if weight and (kind or len(recalls) == 1):
            least = min(least, kept / weight)
    return least


def _compared(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of the left members of each tile pair, from rows sorted by ``tiles``.

    Rows are (tiles, side, cls, copies, embedding); side 2 is both sides. Columns of the
    result: cls, n_links (copies of other classes that link).
    """
    for table in whole_groups(batches, "tiles"):
        places = table.column("tiles").to_numpy()
        cuts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        found_ids, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, end in zip(cuts, [*cuts[1:], len(places)]):
            part = table.slice(start, end - start)
            side, ids = part.column("side").to_numpy(), part.column("cls").to_numpy()
            copies = part.column("copies").to_numpy()
            values = np.array(part.column("embedding").to_pylist(), np.float64)
            values = _unit(values / np.abs(values).max(axis=1, keepdims=True))
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            linked = values[left] @ values[right].T >= threshold
            linked &= ids[left][:, None] != ids[right][None, :]
            found_ids.append(ids[left])
            found.append(linked @ copies[right])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(found_ids)), pa.array(np.concatenate(found).astype(np.int64))],
            names=["cls", "n_links"],
        )


def _dealt(roots: DataFrame) -> DataFrame:
    """(tiles, side, cls) for each pair of tiles of the nodes of each root."""
    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    placed = roots.join(sizes, "root").select(
        F.col("node").alias("cls"),
        "root",
        tiles.alias("tiles"),
        F.pmod(F.xxhash64("node", F.lit(5)), tiles).cast("int").alias("tile"),
    )
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    sides = F.when(
        F.col("tiles") == 1,
        F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(2).alias("side"))),
    ).otherwise(
        F.concat(
            F.transform(
                every,
                lambda i: F.struct(
                    F.col("tile").alias("a"),
                    i.alias("b"),
                    F.when(F.col("tile") == i, 2).otherwise(0).alias("side"),
                ),
            ),
            F.transform(
                F.filter(every, lambda i: i != F.col("tile")),
                lambda i: F.struct(i.alias("a"), F.col("tile").alias("b"), F.lit(1).alias("side")),
            ),
        )
    )
    return placed.select("cls", "root", F.explode(sides).alias("at")).select(
        F.xxhash64("root", "at.a", "at.b").alias("tiles"), F.col("at.side").alias("side"), "cls"
    )


def _exact_links(classes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(cls, n_links): links of each class with others of its component, compared in tiles."""
    return (
        _dealt(roots)
        .join(classes.select("cls", "copies", "embedding"), "cls")
        .select("tiles", "side", "cls", "copies", "embedding")
        .repartition(parallel(classes.sparkSession), "tiles")
        .sortWithinPartitions("tiles")
        .mapInArrow(partial(_compared, threshold=threshold), "cls bigint, n_links bigint")
        .groupBy("cls")
        .agg(F.sum("n_links").alias("n_links"))
    )


def _apart(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of roots that a link joins, from rows (tiles, side, root, embedding).

    Rows are sorted by ``tiles``; side 2 is both sides.
    """
    for table in whole_groups(batches, "tiles"):
        places = table.column("tiles").to_numpy()
        cuts = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        found = [np.zeros((0, 2), np.int64)]
        for start, end in zip(cuts, [*cuts[1:], len(places)]):
            part = table.slice(start, end - start)
            side, roots = part.column("side").to_numpy(), part.column("root").to_numpy()
            values = np.array(part.column("embedding").to_pylist(), np.float64)
            values = _unit(values / np.abs(values).max(axis=1, keepdims=True))
            left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            linked = values[left] @ values[right].T >= threshold
            linked &= roots[left][:, None] < roots[right][None, :]
            at, to = np.nonzero(linked)
            found.append(np.unique(np.c_[roots[left][at], roots[right][to]], axis=0))
        pairs = np.concatenate(found)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _joined(classes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Components (node, root) after all vectors of each room were compared in tiles."""
    named = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", F.coalesce("root", "cls").alias("root"), "embedding"
    )
    met = (
        _dealt(classes.select(F.col("cls").alias("node"), F.col("room").alias("root")))
        .join(named, "cls")
        .select("tiles", "side", "root", "embedding")
        .repartition(parallel(classes.sparkSession), "tiles")
        .sortWithinPartitions("tiles")
        .mapInArrow(partial(_apart, threshold=threshold), "a bigint, b bigint")
    )
    return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(met))


def neighbour_lists(vectors: DataFrame, threshold: float, trees: range, lists: DataFrame | None) -> DataFrame:
    """Lists (src, dst, cos, fresh) of (cls, room, vector) by trees and rounds.

    ``lists`` are those of earlier trees to go on from.
    """
    leaves = F.expr(f"count(*) div {LEAF}")
    depth = F.when(leaves > 0, F.length(F.bin(leaves))).otherwise(0).cast("long")
    rooms = vectors.groupBy("room").agg(depth.alias("depth"))
    sized = vectors.join(rooms, "room").select("cls", "room", "vector", "depth")
    pairs = _grown(sized, trees).withColumn("fresh", F.lit(True))
    if lists is not None:
        pairs = pairs.union(lists.withColumn("fresh", F.lit(False)))
        pairs = pairs.groupBy("src", "dst").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"))
    lists = stored(_trimmed(pairs, threshold), "lists")
    for _ in range(MAX_ROUNDS):
        lists, new, total = _refined(lists, vectors, threshold)
        if new <= STILL * total:
            break
    return lists


def near_duplicates(
    embeddings: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row: the key as a long, n_links, component_id, kept.

    Vectors link when their labels are equal and not null and their cosine is at least the
    threshold; one that is null, zero, or holds a null or non-finite component links with
    nothing, nor do vectors of different lengths. Equal vectors of a label are one class
    with a count, so copies are never paired. component_id is the smallest key in reach,
    null if no row in reach has a key, and kept says that it is the row's own. Rows that
    repeat a key are vectors of their own.
    """
    classes = stored(_classes(embeddings, key, vector, label), "classes")
    vectors = stored(
        classes.select("cls", "room", "embedding").mapInArrow(
            _to_binary, "cls bigint, room bigint, vector binary"
        ),
        "vectors",
    )
    lists: DataFrame | None = None
    for attempt in range(MAX_ATTEMPTS):
        trees = range(attempt * TREES, (attempt + 1) * TREES)
        lists = neighbour_lists(vectors, threshold, trees, lists)
        # single precision errs by less than this
        near = lists.filter(F.col("cos") >= threshold - 1e-5)
        exact = _confirmed(near, classes, threshold)
        roots = components(exact.select(F.col("src").alias("a"), F.col("dst").alias("b")))
        if _audit(vectors, roots, threshold) >= RECALL:
            break
    else:
        roots = _joined(classes, roots, threshold)
    links = _exact_links(classes, roots, threshold)
    grouped = (
        classes.select("cls", "vec_id", "copies")
        .join(links, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select("cls", "vec_id", "copies", "n_links", F.coalesce("root", "cls").alias("root"))
    )
    smallest = grouped.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    named = grouped.join(smallest, "root").select(
        "cls", (F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"), "component_id"
    )
    values = F.col(vector).cast("array<double>")
    rows = embeddings.select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), values.alias("embedding")
    )
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull()
    keyed = rows.withColumn("cls", F.when(usable, F.xxhash64("label", "embedding")))
    linked = F.col("n_links").isNotNull()
    return (
        keyed.select("vec_id", "cls")
        .join(named, "cls", "left")
        .select(
            F.col("vec_id").alias(key),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            F.when(linked, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
    )


def _confirmed(near: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs of ``near`` whose cosine in double precision reaches the threshold."""
    one = classes.select(F.col("cls").alias("src"), F.col("embedding").alias("left"))
    two = classes.select(F.col("cls").alias("dst"), F.col("embedding").alias("right"))
    pairs = near.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    pairs = pairs.distinct().join(one, "src").join(two, "dst")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for place, (a, b) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                pair = np.array([a, b], np.float64)
                pair = _unit(pair / np.abs(pair).max(axis=1, keepdims=True))
                if pair[0] @ pair[1] >= threshold:
                    rows.append(place)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken)], names=["src", "dst"]
            )

    return pairs.select("src", "dst", "left", "right").mapInArrow(tasks, "src bigint, dst bigint")
