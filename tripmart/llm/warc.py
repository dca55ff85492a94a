"""WARC archives: written a gzip member per record, read back by byte range.

Archives are files below a folder that all executors share, reached through pyarrow's file
systems, so any task can write one and open one anywhere. A reading task owns the records
that begin in its range: it looks for gzip magic, takes a place for a member only if a WARC
header decodes there and the whole member checks out, and follows the members from there on
until one begins past its range.
"""

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import parallel, stored
from tripmart.storage import new_folder

MAGIC = b"\x1f\x8b\x08"
LEVEL = 4
# Bytes of an archive that one task reads.
RANGE_BYTES = 16 << 20
# Bytes fetched at once.
FETCH = 1 << 20
# Payloads smaller than this are never revisits.
MIN_PAYLOAD = 0
_ID = "<urn:page:{}>"
# Profile of records that repeat a payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool
) -> bytes:
    """One WARC record. A revisit has the HTTP header of the payload but not the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    header = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_ID.format('' if page_id is None else page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_one_line(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        header += [
            f"WARC-Refers-To: {_ID.format('' if refers_to is None else refers_to)}",
            f"WARC-Profile: {REVISIT_PROFILE}",
        ]
    header.append(f"Content-Length: {len(block)}")
    return "\r\n".join(header).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields by lower-case name and block of a whole record; None if it is not one."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/1."):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = fields.get("content-length", "")
    if not length.isdigit() or rest[int(length) :] != b"\r\n\r\n":
        return None
    return fields, rest[: int(length)]


class Source:
    """Reads of a file at any place, a bounded piece at a time."""

    def __init__(self, file, size: int):
        self._file = file
        self.size = size
        self._start, self._held = 0, b""

    def at(self, place: int) -> bytes:
        """Some bytes from a place on, none at the end of the file."""
        inside = place - self._start
        if not 0 <= inside < len(self._held):
            self._file.seek(place)
            self._start, self._held = place, self._file.read(min(FETCH, self.size - place))
            inside = 0
        return self._held[inside:]


def member_at(source: Source, start: int) -> tuple[bytes, int] | None:
    """Content and end of the gzip member of a record at a place, None where there is none."""
    inflate, parts, place, known = zlib.decompressobj(31), [], start, 0
    try:
        while not inflate.eof:
            data = source.at(place)
            if not data:
                return None
            # what does not begin like a record is not decoded further
            data = data if known >= 7 else data[:256]
            parts.append(inflate.decompress(data))
            known += len(parts[-1])
            if known >= 7 and len(parts) < 9 and not b"".join(parts).startswith(b"WARC/1."):
                return None
            place += len(data) - len(inflate.unused_data)
    except zlib.error:
        return None
    return b"".join(parts), place


def records_from(source: Source, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, header and block of each record whose member begins in [start, end).

    Bytes that are no record, such as a damaged member, are passed over to the next one.
    """
    place = start
    while place < end:
        data = source.at(place)
        if not data:
            return
        found = data.find(MAGIC)
        if found < 0:
            # magic may lie across two pieces
            place += max(1, len(data) - len(MAGIC) + 1)
            continue
        place += found
        if place >= end:
            return
        member = member_at(source, place)
        parsed = parse(member[0]) if member else None
        if parsed is None:
            place += 1
            continue
        yield place, *parsed
        place = member[1]


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write rows (page_id, url, payload, refers_to, revisit); the result lists the files.

    Columns: path, bytes, records. Each attempt of a task writes a file of its own name,
    and only files in the result count, so a task that runs twice does no harm. The result
    is stored. No rows give no files.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, count = None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system, base = fs.FileSystem.from_uri(folder)
                    system.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, out = f"{folder}/{name}", system.open_output_stream(
                        f"{base}/{name}", compression=None
                    )
                payload = (row["payload"] or "").encode()
                digest = payload_digest(payload)
                data = record(
                    row["page_id"], row["url"], payload, digest, row["refers_to"], row["revisit"]
                )
                deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                out.write(deflate.compress(data) + deflate.flush())
                count += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

    rows = records.select("page_id", "url", "payload", "refers_to", "revisit")
    return stored(rows.mapInArrow(tasks, "path string, bytes bigint, records bigint"), "archives")


_READ = (
    "path string, offset bigint, page_id bigint, url string, record_type string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
)


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def read_archives(
    spark: SparkSession, archives: DataFrame, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Every record of archives listed as (path, bytes): one row with its parts.

    payload is null for a revisit; payload_bytes and payload_digest are those of the whole
    payload, for a response computed from it. A response whose payload does not have the
    digest in its header raises.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes))
    ranges = archives.filter("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    ranges = ranges.repartition(parallel(spark), "path", "start")
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    kinds += [pa.string(), pa.int64(), pa.binary()]
    names = [field.split()[0] for field in _READ.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(row["path"])
                rows, held = [], 0
                with system.open_input_file(path) as file:
                    source = Source(file, row["bytes"])
                    end = min(row["bytes"], row["start"] + range_bytes)
                    for place, fields, block in records_from(source, row["start"], end):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind = fields["warc-type"]
                        digest = fields["warc-payload-digest"].removeprefix("sha1:")
                        size = len(payload)
                        if kind == "revisit":
                            payload = None
                            size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        elif payload_digest(payload) != digest:
                            raise ValueError(f"{row['path']} at {place}: payload and digest differ")
                        rows.append(
                            (
                                row["path"],
                                place,
                                _page(fields["warc-record-id"]),
                                fields["warc-target-uri"],
                                kind,
                                size,
                                digest,
                                _page(fields.get("warc-refers-to")),
                                payload,
                            )
                        )
                        held += len(payload or b"")
                        if held > FETCH:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return ranges.select("path", "bytes", "start").mapInArrow(tasks, _READ)


def with_revisits(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit): which pages repeat an earlier payload.

    Of equal payloads of at least ``min_payload`` bytes the smallest page_id is a response
    and the others revisit it. Rows that repeat that page_id are responses too. A null
    page_id comes last: it is a response only if nobody else has the payload or all
    that have it are null. A null html is an empty payload. Payloads are compared by their
    128-bit hashes and length; hash collisions aside that is equality.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).withColumns(
        {
            "size": F.octet_length("payload"),
            "one": F.xxhash64("payload"),
            "two": F.xxhash64(F.lit(1), "payload"),
        }
    )
    first = keyed.filter(F.col("size") >= min_payload).groupBy("size", "one", "two")
    first = first.agg(F.min("page_id").alias("first"))
    joined = keyed.join(first, ["size", "one", "two"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, F.col("first")).alias("refers_to"),
        revisit.alias("revisit"),
    )


def archive(pages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write all pages to archives in the shared folder and read the archives back."""
    spark = pages.sparkSession
    archives = write_archives(with_revisits(pages), new_folder(spark, "warc"))
    return read_archives(spark, archives, range_bytes)
