"""Which attempts of which loads a warehouse consists of.

Every load writes to folders of an attempt of its own (``<table>/load_id=<n>/attempt=<a>``). It
becomes part of the warehouse by one small file, ``loads/<version>.json``, that names the attempt
and must not exist before. Readers go by the newest file of each load, so a load that is run
again leaves the rows of its earlier attempt readable until the new ones are complete, and an attempt that dies
at any point changes nothing. A writer takes the version after the one it began with; of two
writers that began with the same, one finds the file taken and is refused.
"""

import json
import uuid
from dataclasses import asdict, dataclass, fields

from pyspark.sql import SparkSession

from tripmart import schemas
from tripmart.storage import create_once, folders_below, read_or_empty, remove_folder

# A reset forgets all loads before it. Months are counted from year 0 and say where the load's
# pairs lie; a load without pairs has none.
COMMIT = schemas.struct(
    "version bigint, load_id bigint, attempt string, reset boolean, next_trip_id bigint, "
    "next_datetime_id bigint, source string, batch bigint, first_month int, last_month int, "
    "has_hot_pairs boolean, pair_buckets int, trips bigint"
)


@dataclass(frozen=True)
class Commit:
    version: int
    load_id: int
    attempt: str
    reset: bool
    next_trip_id: int
    next_datetime_id: int
    source: str | None
    batch: int | None
    first_month: int | None
    last_month: int | None
    has_hot_pairs: bool
    pair_buckets: int
    trips: int


class ConcurrentLoad(RuntimeError):
    """Another load was committed since this one began; nothing of this one is visible."""


def new_attempt() -> str:
    return "a" + uuid.uuid4().hex


def read_commits(spark: SparkSession, root: str) -> list[Commit]:
    """All commits of a warehouse in their order; one per finished attempt."""
    rows = read_or_empty(spark, f"{root}/loads", COMMIT, "json").collect()
    names = [field.name for field in fields(Commit)]
    return sorted((Commit(*(row[name] for name in names)) for row in rows), key=lambda c: c.version)


def effective(commits: list[Commit]) -> dict[int, Commit]:
    """The attempt that counts for each load: the newest since the last reset."""
    found: dict[int, Commit] = {}
    for commit in commits:
        if commit.reset:
            found.clear()
        found[commit.load_id] = commit
    return found


def publish_commit(spark: SparkSession, root: str, commit: Commit) -> None:
    """Make an attempt part of the warehouse, or raise ``ConcurrentLoad``."""
    try:
        create_once(spark, f"{root}/loads/{commit.version:012d}.json", json.dumps(asdict(commit)))
    except FileExistsError:
        raise ConcurrentLoad(f"load {commit.load_id}: another load of {root} was committed meanwhile") from None


def unreferenced_attempts(
    spark: SparkSession, root: str, tables: list[str], before: float
) -> list[str]:
    """Folders of attempts that no commit in effect names, last changed before a time in seconds.

    A load that is still running is one of them, so the time is to leave out what is recent.
    """
    named = {(c.load_id, c.attempt) for c in effective(read_commits(spark, root)).values()}
    found = []
    for table in tables:
        for path, changed in folders_below(spark, f"{root}/{table}", 2):
            load, attempt = (part.split("=", 1)[-1] for part in path.rsplit("/", 2)[1:])
            if load.isdigit() and (int(load), attempt) not in named and changed < before:
                found.append(path)
    return found


def vacuum(spark: SparkSession, root: str, tables: list[str], before: float) -> int:
    """Delete the attempts of ``unreferenced_attempts``; returns how many there were."""
    paths = unreferenced_attempts(spark, root.rstrip("/"), tables, before)
    for path in paths:
        remove_folder(spark, path)
    return len(paths)
