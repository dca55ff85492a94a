"""The trie of conversation prefixes, by fingerprints that compose.

A sequence of turns has a length and a polynomial hash, the sum of its turns' numbers times powers
of a base. These pairs form a monoid: (n, f) before (m, g) gives (n + m, f + base**n * g), and
since the base has an inverse, a part in the middle is the difference of two prefixes, shifted.
So the prefixes of a rebuilt conversation (the head of its base conversation, then a suffix of its
own) are put together from the stored prefix hashes of two conversations; no rebuilt text is ever
made. Four primes of 31 bits make up a fingerprint.

Equal fingerprints are verified, not trusted: every turn is named by the first stored turn with the same
role and text, and in each group all last turns must have one name and all prefixes before them
one group. By induction the members then agree in all turns. If a check fails, other bases are taken.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.operators.keys import assign_key
from tripmart.storage import new_folder

# The four largest primes below 2**31.
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587, 2_147_483_579)
# A conversation takes its head from the first of this many, and so many turns of it, less one, at most.
FAMILY = 100
HEADS = 6
# Turns that running sums take together in one task, and ids that are written as one text.
BLOCK = 1_024
IDS = 4_096
ATTEMPTS = 4

_LANES = range(len(PRIMES))


def bases(seed: int) -> list[int]:
    random = np.random.default_rng(11 + seed)
    return [int(random.integers(1 << 20, prime - 1)) for prime in PRIMES]


def powers(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """base**exponent modulo a prime of 31 bits, for exponents that are not negative."""
    result = np.ones(len(exponents), np.int64)
    rest, factor = exponents.astype(np.int64), base
    while len(rest) and rest.max() > 0:
        result = np.where(rest & 1, result * factor % prime, result)
        factor = factor * factor % prime
        rest = rest >> 1
    return result


def _terms(seed: int):
    """Each turn's part of the hashes of its conversation; rows (conv, pos, name, chars, digest)."""
    own = bases(seed)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = np.frombuffer(b"".join(batch.column(4).to_pylist()), ">u4").reshape(-1, 8)
            places = batch.column(1).to_numpy()
            parts = [
                digests[:, lane].astype(np.int64) % PRIMES[lane] * powers(own[lane], places, PRIMES[lane])
                % PRIMES[lane]
                for lane in _LANES
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *(pa.array(part) for part in parts)],
                names=["conv", "pos", "name", "chars", *(f"a{lane}" for lane in _LANES)],
            )

    return tasks


_TERMS = "conv bigint, pos bigint, name bigint, chars bigint, a0 bigint, a1 bigint, a2 bigint, a3 bigint"


def running_sums(rows: DataFrame, key: str, place: str, values: list[str]) -> DataFrame:
    """Sums of the values of a key up to each place, as ``<value>_sum``; places count from 0.

    A window orders BLOCK rows of a key, or the totals of its blocks, and never all its rows.
    """
    blocked = rows.withColumn("block", F.expr(f"{place} div {BLOCK}"))
    totals = blocked.groupBy(key, "block").agg(*(F.sum(v).alias(f"{v}_total") for v in values))
    before = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        key, "block", *(F.coalesce(F.sum(f"{v}_total").over(before), F.lit(0)).alias(f"{v}_total") for v in values)
    )
    inside = Window.partitionBy(key, "block").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.withColumns({f"{v}_sum": F.sum(v).over(inside) for v in values})
    return (
        summed.join(totals, [key, "block"])
        .withColumns({f"{v}_sum": F.col(f"{v}_sum") + F.col(f"{v}_total") for v in values})
        .drop("block", *(f"{v}_total" for v in values))
    )


def named_turns(turns: DataFrame) -> DataFrame:
    """(conv, pos, name, chars, digest) of stored turns; ``name`` is the first with the same text.

    The turns are sorted once, by ranges, and a turn's reference is its place among all.
    """
    spark = turns.sparkSession
    keyed, _ = assign_key(turns, ["conv", "turn", "digest"], "ref", 0, new_folder(spark, "turns"))
    first = keyed.groupBy("conv").agg(F.min("ref").alias("start"))
    names = keyed.groupBy("role", "text").agg(F.min("ref").alias("name"))
    named = keyed.select("conv", "ref", "role", "text", "digest").join(names, ["role", "text"])
    return (
        named.select("conv", "ref", "name", F.length("text").cast("long").alias("chars"), "digest")
        .join(first, "conv")
        .select("conv", (F.col("ref") - F.col("start")).alias("pos"), "name", "chars", "digest")
    )


def _packed(lanes: list[Column]) -> list[Column]:
    """Four numbers of 31 bits as two of 62."""
    return [lanes[i] * F.lit(1 << 31) + lanes[i + 1] for i in (0, 2)]


def prefix_members(turns: DataFrame, seed: int) -> DataFrame:
    """(conv, depth, x, y, px, py, name, chars, length): every prefix of every rebuilt conversation.

    (x, y) is the prefix's fingerprint and (px, py) that of the prefix without its last turn.
    """
    own = bases(seed)
    parts = stored(turns.mapInArrow(_terms(seed), _TERMS), "terms")
    sums = running_sums(parts, "conv", "pos", [f"a{lane}" for lane in _LANES])
    sums = sums.select(
        "conv",
        "pos",
        "name",
        "chars",
        *((F.col(f"a{lane}_sum") % PRIMES[lane]).alias(f"f{lane}") for lane in _LANES),
        *(((F.col(f"a{lane}_sum") - F.col(f"a{lane}")) % PRIMES[lane]).alias(f"p{lane}") for lane in _LANES),
    )
    sums = stored(sums, "sums")
    fields = ["pos", "name", "chars", *(f"f{lane}" for lane in _LANES), *(f"p{lane}" for lane in _LANES)]
    heads = F.when(F.col("pos") < HEADS - 1, F.struct(*fields))
    convs = sums.groupBy("conv").agg(
        (F.max("pos") + 1).alias("n"), F.array_sort(F.collect_list(heads)).alias("own")
    )
    convs = stored(convs, "heads")
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    of_base = convs.select(F.col("conv").alias("base"), F.col("own").alias("given"))
    joined = (
        convs.withColumns({"base": F.col("conv") - F.col("conv") % FAMILY, "h": head})
        .join(of_base, "base", "left")
        .withColumn("given", F.slice(F.coalesce("given", F.expr("array()")), F.lit(1), F.col("h")))
        .withColumn("hb", F.size("given"))
    )
    # prefix hashes of the own part's beginning and of the head, 0 where they are empty
    last = {
        f"o{lane}": F.when((F.col("h") > 0) & (F.col("n") >= F.col("h")), F.expr(f"own[h - 1].f{lane}"))
        for lane in _LANES
    }
    last |= {f"g{lane}": F.when(F.col("hb") > 0, F.expr(f"given[hb - 1].f{lane}")) for lane in _LANES}
    joined = joined.withColumns({name: F.coalesce(value, F.lit(0)).cast("long") for name, value in last.items()})
    joined = joined.withColumn(
        "length", F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    ).drop("own", "base")
    joined = stored(joined, "rebuilt")

    root = joined.select(
        "conv", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(c) for c in ("x", "y")),
        *(F.lit(None).cast("long").alias(c) for c in ("px", "py", "name")),
        F.lit(0).cast("long").alias("chars"), "length",
    )
    given = joined.select("conv", "length", F.explode("given").alias("turn")).select(
        "conv", (F.col("turn.pos") + 1).alias("depth"),
        *(c.alias(n) for c, n in zip(_packed([F.col(f"turn.f{lane}") for lane in _LANES]), ("x", "y"))),
        *(c.alias(n) for c, n in zip(_packed([F.col(f"turn.p{lane}") for lane in _LANES]), ("px", "py"))),
        "turn.name", "turn.chars", "length",
    )

    def shifted(column: str, lane: int) -> Column:
        """The head's hash, then that of the own part, moved by as many turns as its place changed."""
        prime = PRIMES[lane]
        back = pow(own[lane], -1, prime)
        factors = F.array(*(F.lit(pow(back, steps, prime)).cast("long") for steps in range(HEADS)))
        moved = F.element_at(factors, (F.col("h") - F.col("hb") + 1).cast("int"))
        part = (F.col(f"{column}{lane}") - F.col(f"o{lane}") + prime) % prime
        return (F.col(f"g{lane}") + part * moved % prime) % prime

    # the numbers of a conversation go to its blocks, so that a long one is not one key
    spread = joined.filter("n > h").drop("given")
    spread = spread.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {BLOCK})")))
    rest = (
        sums.withColumn("block", F.expr(f"pos div {BLOCK}"))
        .join(spread.drop("n"), ["conv", "block"])
        .filter("pos >= h")
        .select(
            "conv", (F.col("hb") + F.col("pos") - F.col("h") + 1).alias("depth"),
            *(c.alias(n) for c, n in zip(_packed([shifted("f", lane) for lane in _LANES]), ("x", "y"))),
            *(c.alias(n) for c, n in zip(_packed([shifted("p", lane) for lane in _LANES]), ("px", "py"))),
            "name", "chars", "length",
        )
    )
    return root.unionByName(given).unionByName(rest)


NODE = ["depth", "x", "y"]


def _groups(members: DataFrame) -> DataFrame:
    return members.groupBy(*NODE).agg(
        F.count("*").alias("n_convs"),
        F.min("conv").alias("conv_id"),
        *(F.min(c).alias(c) for c in ("px", "py", "name")),
        F.max("chars").alias("chars"),
        (
            F.coalesce(F.min("name") != F.max("name"), F.lit(False))
            | F.coalesce(F.min("px") != F.max("px"), F.lit(False))
            | F.coalesce(F.min("py") != F.max("py"), F.lit(False))
        ).alias("mixed"),
    )


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of each node as texts of IDS ids; rows (depth, x, y, conv) are sorted."""
    for batch in batches:
        columns = [column.to_numpy() for column in batch.columns]
        change = np.zeros(batch.num_rows, bool)
        change[:1] = True
        for column in columns[:3]:
            change[1:] |= column[1:] != column[:-1]
        edges = np.append(np.flatnonzero(change), batch.num_rows)
        edges = [
            at for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) for at in range(a, b, IDS)
        ] + [batch.num_rows]
        texts = [",".join(map(str, columns[3][a:b].tolist())) for a, b in zip(edges, edges[1:])]
        firsts = pa.array(edges[:-1], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i).take(firsts) for i in range(4)), pa.array(texts, pa.string())],
            names=[*NODE, "first", "ids"],
        )


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts in order, which go through one after another."""
    node, digest = None, None
    for batch in batches:
        done = []
        for *own, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
            if own != node:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = own, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _digest_batch(done)
    if node is not None:
        yield _digest_batch([(*node, digest.hexdigest())])


def _digest_batch(done: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    arrays = [pa.array([row[i] for row in done], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=[*NODE, "ends_sha256"])


def _ends(members: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at each node, in ascending order.

    Ranges of ids are written as texts by many tasks, so that the one that hashes a node
    with very many gets few rows.
    """
    ends = members.filter("depth = length").select(*NODE, "conv")
    texts = (
        ends.repartitionByRange(*NODE, "conv")
        .sortWithinPartitions(*NODE, "conv")
        .mapInArrow(_id_texts, "depth bigint, x bigint, y bigint, first bigint, ids string")
    )
    return (
        texts.repartition(*NODE)
        .sortWithinPartitions(*NODE, "first")
        .mapInArrow(_id_digests, "depth bigint, x bigint, y bigint, ends_sha256 string")
    )


def prefix_trie(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt: the first h turns of the first conversation of the family of FAMILY (as many as it has),
    then the own turns after the first h, with h = crc32 of the id as text modulo HEADS. A node is
    a distinct sequence of first turns; its members are the rebuilt conversations that begin with
    it, and ``conv_id`` the smallest. ``saved_tokens`` sums, below a node and with it, the code points
    of each node's last text for all members but one. ``ends_sha256`` is the digest of the ids, in
    ascending order and joined by commas, of the members that end there.

    Null role and text are empty. Turns without a number come first; turns of one number go by the
    SHA-256 of role and text, so repeated rows are turns after each other. Rows without
    an id belong to no conversation and are left out. An empty table has no nodes, not even a root.
    Only the four columns named are read.
    """
    turns = conversations.select(
        F.col(key).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).filter("conv is not null")
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turns = turns.withColumn("digest", F.unhex(F.sha2(content.cast("binary"), 256)))
    named = stored(named_turns(turns), "named")
    for seed in range(ATTEMPTS):
        members = stored(prefix_members(named, seed), "members")
        groups = stored(_groups(members), "groups")
        if groups.filter("mixed").isEmpty():
            return _tree(members, groups)
    raise ArithmeticError("the fingerprints of different prefixes are equal under all bases")


def _tree(members: DataFrame, groups: DataFrame) -> DataFrame:
    above = [(F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")]
    children = groups.filter("depth > 0").select(*above).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    saved = (F.col("n_convs") - 1) * F.col("chars")
    nodes = stored(
        groups.withColumn("saved", saved).join(children, NODE, "left").fillna(0, ["n_children"]), "nodes"
    )
    # The nodes whose smallest member is one conversation end its path, so what a subtree saves is
    # summed along the paths of its members, each node once. A leaf counts for its smallest member.
    leaf = F.max(F.when(F.col("n_children") == 0, 1).otherwise(0))
    paths = nodes.groupBy("conv_id").agg(
        F.sum("saved").alias("path_saved"), leaf.alias("leaf"), F.max("depth").alias("bottom")
    )
    paths = stored(paths, "paths")
    sums = (
        members.join(paths.select(F.col("conv_id").alias("conv"), "path_saved", "leaf"), "conv", "left")
        .groupBy(*NODE)
        .agg(
            F.coalesce(F.sum("path_saved"), F.lit(0)).alias("all_saved"),
            F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        )
    )
    from_below = nodes.join(paths, "conv_id").withColumn("place", F.col("bottom") - F.col("depth"))
    below = running_sums(from_below, "conv_id", "place", ["saved"])
    parents = nodes.select(
        F.col("depth").alias("pd"), F.col("x").alias("pkx"), F.col("y").alias("pky"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    is_parent = (
        (F.col("depth") - 1 == F.col("pd")) & (F.col("px") == F.col("pkx")) & (F.col("py") == F.col("pky"))
    )
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        below.join(sums, NODE)
        .join(_ends(members), NODE, "left")
        .join(parents, is_parent, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("n_leaves").cast("long").alias("n_leaves"),
            (F.col("all_saved") - F.col("path_saved") + F.col("saved_sum")).alias("saved_tokens"),
            F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
