"""Folders the jobs write to."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LOCAL_FOLDERS: dict[str, str] = {}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an execution are deleted when it ends, not when its plan is collected."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    A machine-local folder stands in for it only on a local master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tripmart-")
    return _LOCAL_FOLDERS[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name under the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files this package wrote."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.delete(hadoop_path, True)


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a file with its whole content; raise FileExistsError if there is one of that name.

    The text is written beside it first and renamed without overwriting, so readers see the
    file complete or not at all, and of two writers one is refused.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    final = hadoop.Path(path)
    file_system = final.getFileSystem(conf)
    final = file_system.makeQualified(final)
    beside = hadoop.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}")
    stream = file_system.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        hadoop.FileContext.getFileContext(file_system.getUri(), conf).rename(beside, final, options)
    except Py4JJavaError as error:
        file_system.delete(beside, False)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        raise FileExistsError(path) from None


def folders_below(spark: SparkSession, path: str, levels: int) -> list[tuple[str, float]]:
    """Folders so many levels below a path, with the time in seconds each was last changed."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path + "/*" * levels)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return [
        (status.getPath().toString(), status.getModificationTime() / 1000)
        for status in found or ()
        if status.isDirectory()
    ]


def file_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Size of files together."""
    found = (spark._jvm.org.apache.hadoop.fs.Path(path) for path in paths)
    conf = spark._jsc.hadoopConfiguration()
    return sum(path.getFileSystem(conf).getFileStatus(path).getLen() for path in found)


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet"
) -> DataFrame:
    """Read a stored table, or an empty frame of the same schema before its first write."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
