"""Byte-level BPE: encode whole texts by merge ranks, and decode ids.

A piece is merged with a rank queue. Ranks with pairs waiting are set bits of a bitmap of
256-way words; a bit one level up says that a word below has bits, so the lowest rank is
found by a find-first-set on each level. A rank's bucket is a heap of positions in the linked
list of tokens, which yields equal ranks from left to right. Entries are never removed when
a merge makes them invalid; they are skipped when popped. The work is in proportion to
the number of pairs ever queued, so a piece of a million bytes is no problem.
"""

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tripmart.llm.common import process_cache, with_field

# Pieces whose ids a worker remembers in each half of its memory.
MAX_REMEMBERED = 320_000
# Bytes of ids after which a task hands on what it has.
BATCH_BYTES = 8 << 20
# Pieces beyond this length are not remembered.
MAX_REMEMBERED_LENGTH = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a tiktoken file; the path is one of the driver's own files."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def vocabulary_digest(ranks: dict[bytes, int]) -> str:
    """Names a vocabulary by all its tokens and ranks, for what workers keep of it."""
    found = hashlib.sha256()
    for token, rank in sorted(ranks.items()):
        found.update(b"%d %d " % (rank, len(token)) + token)
    return found.hexdigest()


class RankQueue:
    """The buckets and the bitmap; both are empty between two pieces.

    ``words`` has a bit for each rank that has positions, and a bit of a top word says that
    a word below has bits. ``pairs`` has the rank that two tokens next to each other merge to, ``first``
    the same for two single bytes.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.buckets: dict[int, list[int]] = {}
        self.size = max(ranks.values()) + 1
        self.words = [0] * ((self.size - 1 >> 8) + 1)
        self.bytes = [ranks[bytes((a,))] for a in range(256)]
        self.first = [ranks.get(bytes((a, b))) for a in range(256) for b in range(256)]
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.size + right] = rank


_BITS = [1 << place for place in range(4096)]
# Neighbours in a list of tokens nothing was merged in; longer pieces make their own.
_NEXT = list(range(1, 257))
_LAST = list(range(-1, 255))


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """Ids of one piece.

    The queue's steps are written out in the loop, as a call for each would cost as much as
    the step itself.
    """
    known = ranks.get(piece)
    if known is not None:
        return [known]
    size = len(piece)
    rank_of, base, buckets, words, bits = queue.pairs.get, queue.size, queue.buckets, queue.words, _BITS
    first = queue.first
    if size <= 256:
        following, before = _NEXT[:size], _LAST[:size]
    else:
        following, before = list(range(1, size + 1)), list(range(-1, size - 1))
    own = [queue.bytes[byte] for byte in piece]
    pair = [first[a << 8 | b] for a, b in zip(piece, piece[1:])]
    pair.append(None)
    top = 0
    for at, rank in enumerate(pair):
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(at)
            else:
                buckets[rank] = [at]
                word = rank >> 8
                words[word] |= bits[rank & 255]
                top |= bits[word]
    while top:
        word = (top & -top).bit_length() - 1
        held = words[word]
        rank = (word << 8) + (held & -held).bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            at = heappop(bucket)
        else:
            at = bucket[0]
            del buckets[rank]
            words[word] = held = held & (held - 1)
            if not held:
                top &= top - 1
        if pair[at] != rank:
            continue
        gone = following[at]
        end = following[at] = following[gone]
        own[at] = rank
        pair[gone] = None
        if end < size:
            before[end] = at
            found = pair[at] = rank_of(rank * base + own[end])
            if found is not None:
                if found in buckets:
                    heappush(buckets[found], at)
                else:
                    buckets[found] = [at]
                    word = found >> 8
                    words[word] |= bits[found & 255]
                    top |= bits[word]
        else:
            pair[at] = None
        left = before[at]
        if left >= 0:
            found = pair[left] = rank_of(own[left] * base + rank)
            if found is not None:
                if found in buckets:
                    heappush(buckets[found], left)
                else:
                    buckets[found] = [left]
                    word = found >> 8
                    words[word] |= bits[found & 255]
                    top |= bits[word]
    ids, at = [], 0
    while at < size:
        ids.append(own[at])
        at = following[at]
    return ids


class PieceIds(dict):
    """Ids of pieces as bytes of int32, made when a piece is first asked for.

    When it is full, what it holds becomes the older half of its memory, from which pieces
    that are asked for again come back; the rest is forgotten the next time.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self._older: dict[str, bytes] = {}
        self._ranks = ranks
        self._queue = RankQueue(ranks)

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            ids = array("i", merge(piece.encode(), self._ranks, self._queue)).tobytes()
        if len(piece) <= MAX_REMEMBERED_LENGTH:
            if len(self) >= MAX_REMEMBERED:
                self._older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    ids: str = "ids",
) -> DataFrame:
    """The key of every row and the ids of its whole text, as array<int>.

    Each match of ``pattern`` is encoded by itself; there are no special tokens. A null or
    empty text has no ids. Rows are independent: repeated rows and null keys come out as
    they went in, and an empty table gives an empty one. ``ranks`` is a vocabulary with all
    256 single bytes; its size is fixed, so it is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    name = f"pieces {vocabulary_digest(ranks)} {pattern}"

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        piece_ids = process_cache(name, lambda: PieceIds(shared.value)).__getitem__

        def made(keys: pa.Array, found: list[bytes]) -> pa.RecordBatch:
            ends = np.cumsum([0, *(len(x) // 4 for x in found)])
            values = pa.array(np.frombuffer(b"".join(found), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            return pa.RecordBatch.from_arrays([keys, lists], names=[key, ids])

        for batch in batches:
            found, first, held = [], 0, 0
            for place, value in enumerate(batch.column(1)):
                found.append(b"".join(map(piece_ids, split(value.as_py() or ""))))
                held += len(found[-1])
                if held >= BATCH_BYTES:
                    yield made(batch.column(0).slice(first, len(found)), found)
                    found, first, held = [], place + 1, 0
            yield made(batch.column(0).slice(first), found)

    rows = docs.select(key, text)
    return rows.mapInArrow(tasks, with_field(rows.select(key).schema, (ids, "array<int>")))


def decode(
    tokens: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """All rows with the bytes their ids stand for; null ids give null, no ids no bytes.

    An id outside the vocabulary raises.
    """
    shared = tokens.sparkSession.sparkContext.broadcast(ranks)
    name = f"tokens {vocabulary_digest(ranks)}"
    place = tokens.columns.index(ids)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = process_cache(name, lambda: {i: t for t, i in shared.value.items()}).__getitem__
        for batch in batches:
            column = batch.column(place)
            ends, values = column.offsets.to_pylist(), column.values.to_numpy()
            found = [
                b"".join(map(token, values[a:b].tolist())) if known else None
                for a, b, known in zip(ends, ends[1:], column.is_valid().to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())],
                names=[*batch.schema.names, decoded],
            )

    if decoded in tokens.columns:
        raise ValueError(f"{decoded} is already a column")
    return tokens.mapInArrow(tasks, with_field(tokens.schema, (decoded, "binary")))
