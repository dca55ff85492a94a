"""What the corpus operators share."""

import ctypes
import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.storage import CLEANUP, new_folder, remove_folder, shuffles_deleted  # noqa: F401

# Fixed value: what separates words and is stripped from lines, [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it back.

    The files cut lineage: a lost executor costs the tasks that read them, not the work
    before them. What was shuffled for them is deleted as soon as they are written.
    """
    path = new_folder(df.sparkSession, label)
    with shuffles_deleted(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stored(*frames: DataFrame) -> None:
    """Delete the files of frames that ``stored`` gave and nothing reads any more."""
    for frame in frames:
        for folder in {path.rsplit("/", 1)[0] for path in frame.inputFiles()}:
            remove_folder(frame.sparkSession, folder)


_CACHE = "tripmart_llm_process_cache"
Tasks = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def process_cache(name: str, build: Callable[[], Any]) -> Any:
    """A value kept by a Python worker from one task to the next."""
    module = sys.modules.setdefault(_CACHE, ModuleType("cache"))
    if name not in module.__dict__:
        module.__dict__[name] = build()
    return module.__dict__[name]


def released(tasks: Tasks, keeps: bool = False) -> Tasks:
    """The same tasks, each giving back the memory it is done with when it ends.

    A Python worker outlives its stage, and Arrow and the C library hold on to what was freed, beside the
    stages that follow. What other stages left in ``process_cache`` goes too, unless the tasks
    keep values there themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            sys.modules.pop(_CACHE, None)
        try:
            yield from tasks(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
            if trim:
                trim(0)

    return run


def parallel(spark: SparkSession) -> int:
    """The number of partitions the session gives a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(total: int | None, target: int, spark: SparkSession) -> int:
    """Partitions for so many bytes or rows, as many as the session's at least."""
    return max(parallel(spark), -(-(total or 0) // target))


def crc_rest(key: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo a divisor; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def words_of(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of a text with A-Z lower-cased, in UTF-8."""
    return text.encode().lower().split() if text else []


def with_field(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    """A schema with more fields, given by name and DDL type; a field of a name goes first."""
    names = [name for name, _ in fields]
    kept = [field for field in schema.fields if field.name not in names]
    more = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in fields]
    return T.StructType(kept + more)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole groups of a sorted key only; a group is to be small."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        keys = table.column(key).to_numpy()
        start = int((keys != keys[-1]).nonzero()[0][-1]) + 1 if (keys != keys[-1]).any() else 0
        if start:
            yield table.slice(0, start)
        held = table.slice(start).combine_chunks()
    if held is not None:
        yield held


def components(edges: DataFrame) -> DataFrame:
    """Connected components: each node of ``edges`` (a, b) with the smallest node it reaches.

    Labels go to neighbours as minima, which tasks pre-aggregate, and jump to the label of
    their label, so the number of rounds follows the logarithm of the longest path. A node
    with very many edges is one row of the label table, and the join that reads it can be
    split. Each round is written. Without edges the result is empty.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "edges")
    nodes = both.groupBy("a").agg(F.min("b").alias("near"))
    labels = stored(
        nodes.select(F.col("a").alias("node"), F.least("a", "near").alias("root")), "labels"
    )
    while True:
        named = labels.select(F.col("node").alias("b"), "root")
        near = both.join(named, "b").groupBy("a").agg(F.min("root").alias("near"))
        lowered = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "root", F.least("root", "near").alias("lower")
        )
        jump = labels.select(F.col("node").alias("lower"), F.col("root").alias("jump"))
        following = stored(
            lowered.join(jump, "lower").select(
                "node",
                F.least("lower", "jump").alias("root"),
                (F.least("lower", "jump") < F.col("root")).alias("changed"),
            ),
            "labels",
        )
        labels = following.select("node", "root")
        if following.filter("changed").isEmpty():
            return labels
