"""Context-triggered piecewise hashing of documents.

A rolling hash over the last bytes decides where chunks end, so an insertion moves only the
boundaries near it. Each chunk gives one symbol of the signature, a 12-bit digest written as
two base64 characters. The block size, a power of two, follows from the length of the text;
a fingerprint has the signatures for its block size and for twice that, so texts whose block
sizes are equal or differ by one step can be compared, by the edit distance (insertions and
deletions) of the signatures they have at a common block size.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import slices, with_field

WINDOW = 7
# A text has some 32 to 64 chunks, and never more than 128.
CHUNKS = 64
# A chunk longer than so many blocks, as of text that repeats itself, is cut by finer boundaries.
LONGEST = 4
# Bytes of text of one task, about.
TASK_BYTES = 24 << 20

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SYMBOLS = [a + b for a in _ALPHABET for b in _ALPHABET]
_FACTOR = 0x01000193
_MIX = 0x9E3779B1


def _rolling(data: np.ndarray) -> np.ndarray:
    """For each byte a mixed 32-bit hash of the WINDOW bytes that end there."""
    wide = np.zeros(len(data) + WINDOW - 1, np.uint32)
    wide[WINDOW - 1 :] = data
    rolled = wide[: len(data)].copy()
    for step in range(1, WINDOW):
        rolled *= np.uint32(_FACTOR)
        rolled += wide[step : step + len(data)]
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(_MIX)
    return rolled


def block_step(length: int) -> int:
    """Binary logarithm of the block size for so many bytes."""
    return max(0, (max(1, length) - 1) // CHUNKS).bit_length()


def _thinned(cuts: np.ndarray, start: int, end: int, least: int) -> list[int]:
    """The cuts between start and end that lie ``least`` bytes or more after the one before."""
    found: list[int] = []
    while True:
        place = int(np.searchsorted(cuts, start + least))
        if place == len(cuts) or cuts[place] >= end:
            return found
        start = int(cuts[place])
        found.append(start)


def _cuts(rolled: np.ndarray, step: int) -> list[int]:
    """Where chunks end, before the end of the text, at a block size.

    Chunks are half a block at least. What is chosen follows from the text near by, so an
    edit elsewhere does not change it.
    """
    block, length = 1 << step, len(rolled)
    cuts = _thinned(np.flatnonzero(rolled < (1 << (32 - step))) + 1, 0, length, max(1, block >> 1))
    for finer in range(step - 1, -1, -1):
        gaps = [(a, b) for a, b in zip([0, *cuts], [*cuts, length]) if b - a > LONGEST * block]
        if not gaps:
            break
        for start, end in gaps:
            found = np.flatnonzero(rolled[start:end] < (1 << (32 - finer))) + start + 1
            cuts += _thinned(found, start, end, block)
        cuts.sort()
    return cuts


def _signature(data: memoryview, rolled: np.ndarray, step: int) -> str:
    cuts = _cuts(rolled, step)
    digest = xxhash.xxh32_intdigest
    return "".join([_SYMBOLS[digest(data[a:b]) >> 20] for a, b in zip([0, *cuts], [*cuts, len(data)])])


def fingerprint(data: bytes) -> str:
    """``step:signature:signature of twice the block size``; equal bytes give equal ones."""
    step = block_step(len(data))
    if not data:
        return "0::"
    view = memoryview(data)
    rolled = _rolling(np.frombuffer(data, np.uint8))
    return f"{step}:{_signature(view, rolled, step)}:{_signature(view, rolled, step + 1)}"


def _common(one: str, other: str) -> int:
    """Length of the longest common subsequence of two signatures, a bit per symbol."""
    places: dict[str, int] = {}
    for place in range(0, len(one), 2):
        symbol = one[place : place + 2]
        places[symbol] = places.get(symbol, 0) | (1 << (place >> 1))
    full = (1 << (len(one) >> 1)) - 1
    open_ = full
    for place in range(0, len(other), 2):
        matched = open_ & places.get(other[place : place + 2], 0)
        open_ = ((open_ + matched) | (open_ - matched)) & full
    return (len(one) >> 1) - open_.bit_count()


def _closeness(one: str, other: str) -> float:
    """1 less the edit distance as a share of the most it can be."""
    total = (len(one) + len(other)) >> 1
    return 2 * _common(one, other) / total if total else 1.0


def likeness(one: str, other: str) -> float:
    """How alike two texts are by their fingerprints, 0 to 1; 1 for equal fingerprints.

    Fingerprints whose block sizes differ by more than one step have likeness 0.
    """
    if one == other:
        return 1.0
    step, narrow, wide = one.split(":")
    other_step, other_narrow, other_wide = other.split(":")
    apart = int(step) - int(other_step)
    if apart == 0:
        return max(_closeness(narrow, other_narrow), _closeness(wide, other_wide))
    if apart == 1:
        return _closeness(narrow, other_wide)
    if apart == -1:
        return _closeness(wide, other_narrow)
    return 0.0


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", name: str = "fingerprint"
) -> DataFrame:
    """The key of every row and the fingerprint of its whole text; null counts as empty."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((x.as_py() or "").encode()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=[key, name])

    rows = docs.select(key, text)
    return rows.mapInArrow(tasks, with_field(rows.select(key).schema, (name, "string")))


def edited(text: str, following: str) -> str:
    """A text whose last third is replaced by the beginning of another."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_COMPARED = (
    "key bigint, n_chars bigint, edited string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(key: int | None, text: str, following: tuple[str, str], own: str) -> tuple:
    changed = edited(text, following[0])
    changed_print = own if changed == text else fingerprint(changed.encode())
    return (
        key,
        len(text),
        changed,
        own,
        changed_print,
        likeness(own, changed_print),
        likeness(own, following[1]),
    )


def _batch_of(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in _COMPARED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names
    )


def _against_themselves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch.column(0):
            text = value.as_py()
            own = fingerprint(text.encode())
            rows.append(_compared(None, text, (text, own), own))
        yield _batch_of(rows)


def _against_previous(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (task, kind, key, hash, text) in that order; kind 0 comes before a task's range."""
    task, key, current, previous = None, None, ("", ""), ("", "")
    for batch in batches:
        rows = []
        tasks, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keys = batch.column(2).to_pylist()
        for place, value in enumerate(batch.column(4)):
            text = value.as_py()
            own = fingerprint(text.encode())
            if tasks[place] != task or keys[place] != key or kinds[place] == 0:
                previous, current = current, (text, own)
                task, key = tasks[place], keys[place] if kinds[place] else None
            if kinds[place]:
                rows.append(_compared(key, text, previous, own))
        yield _batch_of(rows)


def _ranges(known: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Where ranges of keys begin, and into how many tasks each is split.

    The starts are quantiles. A key that many rows share is several quantiles; it then has
    a range of its own, which is split by text.
    """
    sized = known.select("key", F.octet_length("text").alias("size"))
    total = sized.agg(F.sum("size")).first()[0]
    parts = slices(total, TASK_BYTES, known.sparkSession)
    at = [i / parts for i in range(1, parts)]
    starts = {-(1 << 63): 1}
    for value in map(int, sized.approxQuantile("key", at, 0.25 / parts)):
        starts[value] = starts.get(value, 0) + 1
    for value, copies in list(starts.items()):
        if copies > 1:
            starts.setdefault(value + 1, 1)
    ordered = sorted(starts)
    return np.array(ordered, np.int64), np.array([starts[x] for x in ordered], np.int64)


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The next document is that of the next smaller key, and for the smallest key that of the
    largest. Columns: the key as a long, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next. Null texts are empty. Rows that repeat a key share a next
    document; as the next of others, the row with the smallest 64-bit hash of its text
    stands for them. A row without key stands outside the order and is its own next
    document, as the only row of a table is. An empty table gives an empty one.

    The texts are moved once, to ranges of keys read in ascending order, so a task holds
    two documents at a time. Only the document before each range is looked up first, one
    for each task; no more than the bounds of the tasks reach the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    known, outside = rows.filter("key is not null"), rows.filter("key is null")
    starts, copies = _ranges(known)
    offsets, total = np.cumsum(copies) - copies, int(copies.sum())

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy()
            order = np.argsort(keys, kind="stable")
            part = np.searchsorted(starts, keys[order], "right") - 1
            for place in np.flatnonzero(np.r_[part[1:] != part[:-1], True][: len(part)]):
                value = int(keys[order[place]])
                found[int(part[place])] = max(found.get(int(part[place]), value), value)
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array(list(found), pa.int32()), "key": pa.array(list(found.values()), pa.int64())}
        )

    tops = known.select("key").mapInArrow(largest, "part int, key bigint")
    ends = sorted(map(tuple, tops.groupBy("part").agg(F.max("key")).collect()))
    # The largest key of a range comes before the next range that has rows, the last one
    # of all before the first.
    before = [
        (ends[place - 1][1], int(offsets[part] + split))
        for place, (part, _) in enumerate(ends)
        for split in range(int(copies[part]))
    ]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = np.searchsorted(starts, batch.column(0).to_numpy(), "right") - 1
            task = offsets[part]
            split = np.flatnonzero(copies[part] > 1)
            if split.size:
                hashes = [xxhash.xxh3_64_intdigest(batch.column(1)[int(i)].as_py()) for i in split]
                task[split] += [h % int(c) for h, c in zip(hashes, copies[part[split]])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(task, pa.int32()), *batch.columns], names=["task", "key", "text"]
            )

    bounds = F.broadcast(spark.createDataFrame(before, "key bigint, task int"))
    first = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    ends_only = known.join(bounds.select("key").distinct(), "key").groupBy("key").agg(first)
    looked_up = ends_only.join(bounds, "key").select(
        "task", F.lit(0).alias("kind"), "key", F.lit(0).cast("long").alias("hash"), "text"
    )
    moved = known.mapInArrow(dealt, "task int, key bigint, text string").select(
        "task", F.lit(1).alias("kind"), "key", F.xxhash64("text").alias("hash"), "text"
    )
    compared = (
        moved.union(looked_up)
        .repartition(total, "task")
        .sortWithinPartitions("task", "kind", "key", "hash", "text")
        .mapInArrow(_against_previous, _COMPARED)
    )
    alone = outside.select("text").mapInArrow(_against_themselves, _COMPARED)
    return compared.union(alone).withColumnRenamed("key", key)
