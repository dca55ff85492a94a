"""Line dedup that can be taken back: reference counts behind sharded cuckoo filters.

The exact table is a log of references: each insertion or deletion of documents appends
(key, doc_id, +1 or -1) for the distinct lines of every document, so counts after a
deletion are those of never having inserted. Lines held by enough documents are *dense*.
Their keys are also in cuckoo filters, one per shard of keys. A line meets its shard's
filter first and only those the filter may hold are joined with the exact counts.
"""

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import SPACES, parallel, released, remove_stored, slices, stored, with_field
from tripmart.operators.joins import hot_keys
from tripmart.storage import create_once, new_folder, read_or_empty, remove_folder

MIN_CODE_POINTS = 40
MIN_DOCS = 5
# Dense keys of one shard, about; a shard's filter takes some 2.5 bytes a key.
KEYS_PER_SHARD = 100_000
# A key with more than one part in this many of all references is looked up by broadcast.
HOT_PARTS = 2_000
MIN_HOT_REFERENCES = 1_000
# Batches of references that are read beside those summed up before.
COMPACT_AFTER = 8


def line_key(line: bytes) -> bytes | None:
    """128-bit key of a lower-cased line, None for one too short to count."""
    line = line.strip(SPACES)
    if len(line) < MIN_CODE_POINTS:
        return None
    if len(line) < 4 * MIN_CODE_POINTS and len(line.decode()) < MIN_CODE_POINTS:
        return None
    return xxhash.xxh3_128_digest(line)


def line_keys(text: str | None) -> list[bytes | None]:
    """Key of every line of a text; null and empty texts are one empty line."""
    return [line_key(line) for line in (text or "").encode().lower().split(b"\n")]


class CuckooFilter:
    """A set of 16-byte keys that may err by holding more, never by holding less.

    Buckets of four 16-bit fingerprints; a fingerprint's other bucket follows from either
    one, so it can move, and a key can be removed again. What finds no room after
    ``MOVES`` moves is kept in a stash.
    """

    SLOTS = 4
    MOVES = 500

    def __init__(self, table: np.ndarray, stash: list[tuple[int, int]]):
        self.table = table
        self.stash = stash

    @classmethod
    def sized(cls, keys: int) -> "CuckooFilter":
        buckets = 1 << max(4, (max(1, keys) * 10 // 8 // cls.SLOTS).bit_length())
        return cls(np.zeros((buckets, cls.SLOTS), np.uint16), [])

    def _places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        halves = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        prints = (halves[:, 0] & np.uint64(0xFFFF)).astype(np.int64)
        prints[prints == 0] = 1
        first = (halves[:, 1] & np.uint64(len(self.table) - 1)).astype(np.int64)
        return prints, first, self._other(prints, first)

    def _other(self, prints, place):
        return place ^ ((prints * 0x5BD1E995) & (len(self.table) - 1))

    def contains(self, keys: list[bytes]) -> np.ndarray:
        prints, first, second = self._places(keys)
        found = (self.table[first] == prints[:, None]).any(axis=1)
        found |= (self.table[second] == prints[:, None]).any(axis=1)
        for mark, place in self.stash:
            found |= (prints == mark) & ((first == place) | (second == place))
        return found

    def add(self, keys: list[bytes]) -> None:
        """Add keys that it does not hold yet."""
        if not keys:
            return
        table = self.table
        for mark, first, second in zip(*(x.tolist() for x in self._places(keys))):
            for place in (first, second):
                room = np.flatnonzero(table[place] == 0)
                if room.size:
                    table[place, room[0]] = mark
                    break
            else:
                place = second
                for move in range(self.MOVES):
                    slot = (mark + move) % self.SLOTS
                    mark, table[place, slot] = int(table[place, slot]), mark
                    place = int(self._other(mark, place))
                    room = np.flatnonzero(table[place] == 0)
                    if room.size:
                        table[place, room[0]] = mark
                        break
                else:
                    self.stash.append((mark, place))

    def remove(self, keys: list[bytes]) -> None:
        """Take out keys that it holds."""
        if not keys:
            return
        for mark, first, second in zip(*(x.tolist() for x in self._places(keys))):
            for place in (first, second):
                if (mark, place) in self.stash:
                    self.stash.remove((mark, place))
                    break
                slot = np.flatnonzero(self.table[place] == mark)
                if slot.size:
                    self.table[place, slot[0]] = 0
                    break

    def to_bytes(self) -> bytes:
        stash = np.array(self.stash, np.int64).reshape(-1).tobytes()
        return len(self.table).to_bytes(8, "little") + self.table.tobytes() + stash

    @classmethod
    def from_bytes(cls, blob: bytes) -> "CuckooFilter":
        buckets = int.from_bytes(blob[:8], "little")
        end = 8 + buckets * cls.SLOTS * 2
        table = np.frombuffer(blob[8:end], np.uint16).reshape(buckets, cls.SLOTS).copy()
        stash = np.frombuffer(blob[end:], np.int64).reshape(-1, 2).tolist()
        return cls(table, [(mark, place) for mark, place in stash])


_REFERENCES = "key binary, doc_id bigint, delta bigint"
_DENSE = "key binary, n_docs bigint, last_doc bigint"
_FILTERS = "shard int, filter binary"


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")


def _distinct_keys(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, doc_id) for the distinct lines of every row that count."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for row, value in enumerate(batch.column(1)):
                found = set(line_keys(value.as_py()))
                found.discard(None)
                keys.extend(found)
                rows.extend([row] * len(found))
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), ids], names=["key", "doc_id"]
            )

    rows = docs.select(F.col(key).cast("long").alias(key), text)
    return rows.mapInArrow(released(tasks), "key binary, doc_id bigint")


def _updated_filters(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """One filter per shard from rows (shard, kind, key, filter, keys), sorted by both.

    Kind 0 is the stored filter, 1 a key to take out, 2 a key to add.
    """
    shard, blob, size, gone, came = None, None, 0, [], []

    def made() -> pa.RecordBatch:
        held = CuckooFilter.from_bytes(blob) if blob is not None else CuckooFilter.sized(size)
        held.remove(gone)
        held.add(came)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([held.to_bytes()], pa.binary())],
            names=["shard", "filter"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard:
                if shard is not None:
                    yield made()
                shard, blob, size, gone, came = row["shard"], None, row["size"], [], []
            if row["kind"] == 0:
                blob = row["filter"]
            else:
                (gone if row["kind"] == 1 else came).append(row["key"])
    if shard is not None:
        yield made()


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 1 that the filter of their shard, a row of kind 0 before them, may hold."""
    shard, held = None, None
    for batch in batches:
        shards, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        starts = np.flatnonzero(np.r_[True, (shards[1:] != shards[:-1]) | (kinds[1:] != kinds[:-1])])
        taken = []
        for start, end in zip(starts, [*starts[1:], len(shards)] if len(shards) else []):
            if shards[start] != shard:
                shard, held = shards[start], None
            if kinds[start] == 0:
                held = CuckooFilter.from_bytes(batch.column(4)[int(start)].as_py())
            elif held is not None:
                keys = batch.column(2).slice(start, end - start).to_pylist()
                taken.append(start + np.flatnonzero(held.contains(keys)))
        rows = pa.array(np.concatenate(taken) if taken else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(2).take(rows), batch.column(3).take(rows)], names=["key", "doc_id"]
        )


class LineIndex:
    """The lines of a changing set of documents, stored below a shared folder.

    A document is named by its doc_id: rows that repeat a doc_id are one document with the
    lines of all of them, and all null ids together are one document, which is never the
    last to hold a line unless nobody else does. A line is referenced as often as it was
    inserted; ``delete`` takes the same rows and takes one insertion back. Rows whose lines are
    not referenced raise, and nothing is deleted then.

    The folder holds all there is: an index opened on it again goes on where the last change ended.
    One writer at a time is assumed. A log of COMPACT_AFTER batches is summed up into one.
    """

    def __init__(self, spark: SparkSession, folder: str, min_docs: int = MIN_DOCS):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.min_docs = min_docs
        # each is named by a file that is made when it is complete
        done = self._done()
        self._base = max((number for kind, number, _ in done if kind == "base"), default=0)
        self._batches = max((number for kind, number, _ in done if kind == "batch"), default=0)
        self._version, self._shards = max(
            ((number, shards) for kind, number, shards in done if kind == "version"), default=(0, 0)
        )

    def _done(self) -> list[tuple[str, int, int]]:
        log = read_or_empty(self.spark, f"{self.folder}/done", "kind string, number int, shards int", "json")
        return [(row["kind"], row["number"], row["shards"]) for row in log.collect()]

    def _finish(self, kind: str, number: int, shards: int = 0) -> None:
        text = json.dumps({"kind": kind, "number": number, "shards": shards})
        create_once(self.spark, f"{self.folder}/done/{kind}-{number}.json", text)

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> None:
        self._append(_distinct_keys(docs, key, text), 1)

    def delete(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> None:
        lines = stored(_distinct_keys(docs, key, text), "deleted")
        taken = lines.groupBy("key", "doc_id").agg(F.count("*").alias("n"))
        known = self._summed().withColumnsRenamed({"key": "known_key", "doc_id": "known_doc"})
        same = (F.col("key") == F.col("known_key")) & F.col("doc_id").eqNullSafe(F.col("known_doc"))
        same &= F.col("delta") >= F.col("n")
        missing = taken.join(known, same, "left_anti").limit(3).collect()
        if missing:
            raise ValueError(f"lines that were not inserted, of documents {[row['doc_id'] for row in missing]}")
        self._append(lines, -1)
        remove_stored(lines)

    def _append(self, lines: DataFrame, delta: int) -> None:
        lines = lines.withColumn("delta", F.lit(delta).cast("long"))
        lines.write.mode("overwrite").parquet(f"{self.folder}/references/batch={self._batches + 1}")
        self._batches += 1
        self._finish("batch", self._batches)
        if self._batches - self._base >= COMPACT_AFTER:
            self._summed().write.mode("overwrite").parquet(f"{self.folder}/base={self._batches}")
            self._finish("base", self._batches)
            self._base = self._batches

    def _summed(self) -> DataFrame:
        """Every (key, doc_id) with how often it is referenced."""
        paths = [f"{self.folder}/references/batch={i}" for i in range(self._base + 1, self._batches + 1)]
        if self._base:
            paths.append(f"{self.folder}/base={self._base}")
        if not paths:
            return self.spark.createDataFrame([], _REFERENCES)
        log = self.spark.read.schema(_REFERENCES).parquet(*paths)
        alive = log.groupBy("key", "doc_id").agg(F.sum("delta").alias("delta"))
        return alive.filter("delta > 0")

    def references(self) -> DataFrame:
        """Every (key, doc_id) that is referenced now."""
        return self._summed().select("key", "doc_id")

    def counts(self) -> DataFrame:
        """Exact number of documents per key, and the largest doc_id."""
        return self.references().groupBy("key").agg(
            F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")
        )

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}={self._version}")

    def refresh(self) -> None:
        """Bring dense keys and filters up to the references.

        Filters change by the keys that became dense or ceased to be; only a changed
        number of shards builds them anew.
        """
        version = self._version + 1
        before = self._read("dense", _DENSE) if self._version else None
        old = self._read("filters", _FILTERS) if self._version else None
        dense = self.counts().filter(F.col("n_docs") >= self.min_docs)
        dense.write.mode("overwrite").parquet(f"{self.folder}/dense={version}")
        dense = self.spark.read.schema(_DENSE).parquet(f"{self.folder}/dense={version}")
        shards = slices(dense.count(), KEYS_PER_SHARD, self.spark)
        if shards != self._shards or before is None:
            came, gone, old = dense.select("key"), None, None
        else:
            came = dense.select("key").join(before.select("key"), "key", "left_anti")
            gone = before.select("key").join(dense.select("key"), "key", "left_anti")
        blank = F.lit(None).cast("binary")
        size = F.lit(2 * KEYS_PER_SHARD).alias("size")

        def change(keys: DataFrame, kind: int) -> DataFrame:
            row = [_shard(shards), F.lit(kind).alias("kind"), "key", blank.alias("filter"), size]
            return keys.select(*row)

        rows = change(came, 2)
        if gone is not None:
            rows = rows.union(change(gone, 1))
        if old is not None:
            rows = rows.union(
                old.select("shard", F.lit(0), blank.alias("key"), "filter", size)
            )
        (
            rows.repartition(shards, "shard")
            .sortWithinPartitions("shard", "kind")
            .mapInArrow(released(_updated_filters), _FILTERS)
            .write.mode("overwrite")
            .parquet(f"{self.folder}/filters={version}")
        )
        self._finish("version", version, shards)
        self._version, self._shards = version, shards

    def drops(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Per doc_id the keys of the lines it loses, for documents that lose any.

        Keys with a large share of the references are few; they are found by broadcast, so
        that no shard gets a large share of the lines.
        """
        dense = self._read("dense", _DENSE)
        hot = hot_keys(dense, ["key"], "n_docs", HOT_PARTS, MIN_HOT_REFERENCES)
        hot = F.broadcast(hot.select("key", F.lit(True).alias("hot")))
        lines = _distinct_keys(docs, key, text).join(hot, "key", "left")
        probes = lines.filter("hot is null").select(
            _shard(self._shards),
            F.lit(1).alias("kind"),
            "key",
            "doc_id",
            F.lit(None).cast("binary").alias("filter"),
        )
        filters = self._read("filters", _FILTERS).select(
            "shard",
            F.lit(0),
            F.lit(None).cast("binary"),
            F.lit(None).cast("long"),
            "filter",
        )
        maybe = (
            probes.union(filters)
            .repartition(max(self._shards, parallel(self.spark)), "shard")
            .sortWithinPartitions("shard", "kind")
            .mapInArrow(released(_probe), "key binary, doc_id bigint")
        )
        lost = ~F.col("last_doc").eqNullSafe(F.col("doc_id"))
        cold = maybe.join(dense, "key").filter(lost)
        hot_dense = F.broadcast(dense.join(hot, "key", "left_semi"))
        warm = lines.filter("hot").select("key", "doc_id").join(hot_dense, "key").filter(lost)
        both = cold.select("doc_id", "key").union(warm.select("doc_id", "key"))
        return both.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def clean(docs: DataFrame, drops: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, the text without dropped lines, then n_lines and n_dropped.

    Kept lines stay as they are, joined by newlines. A null text stays null and counts as
    one empty line. Columns that the input has of the two names are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    schema = with_field(docs.schema, ("n_lines", "bigint"), ("n_dropped", "bigint"))
    names = docs.columns
    place = names.index(text)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, dropped = [], [], []
            for value, lost in zip(batch.column(place), batch.column(len(names))):
                value = value.as_py()
                lost = lost.as_py()
                if not lost:
                    texts.append(value)
                    lines.append(value.count("\n") + 1 if value else 1)
                    dropped.append(0)
                    continue
                lost, parts = set(lost), value.split("\n")
                kept = [x for x, k in zip(parts, line_keys(value)) if k not in lost]
                texts.append("\n".join(kept))
                lines.append(len(parts))
                dropped.append(len(parts) - len(kept))
            columns = list(batch.columns[: len(names)])
            columns[place] = pa.array(texts, columns[place].type)
            columns += [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    # named by place, as the input may have columns of any names
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    same = F.col(f"c{names.index(key)}").cast("long").eqNullSafe(F.col("doc_id"))
    joined = plain.join(drops.select("doc_id", "keys"), same, "left").select(*plain.columns, "keys")
    return joined.mapInArrow(released(tasks), schema)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Insert all documents into a fresh index and drop the lines it finds dense."""
    index = LineIndex(docs.sparkSession, new_folder(docs.sparkSession, "line-index"))
    index.insert(docs, key, text)
    index.refresh()
    return clean(docs, index.drops(docs, key, text), key, text)


def forget(index: LineIndex) -> None:
    """Remove an index's folder."""
    remove_folder(index.spark, index.folder)
