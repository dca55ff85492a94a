"""Substring dedup by sliding spans of sentences.

Each run of consecutive sentences, as many as it takes to reach a number of sentences and of
words, is hashed. A span that occurs more than once anywhere keeps its first occurrence, in
order of document and place; sentences covered by any other occurrence are removed.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import released, remove_stored, stored, with_field

# A span is the shortest run with so many sentences and words.
MIN_SENTENCES = 2
MIN_WORDS = 20
# A sentence with this many words or more is cut further, after each word whose hash is the least of
# some WINDOW words in a row, so that a passage without full stops is cut alike wherever it stands.
# Pieces are of WINDOW words at most, and which words inside a passage are cut after depends on
# the passage alone from WINDOW words within it. In 51 shared words a span therefore begins after
# 15 at most and ends with the 43rd at most, or where a sentence does.
LONG_SENTENCE = 16
WINDOW = 8

# A sentence ends after full stops and the like before white space, or at a line break.
_END = re.compile(rb"[.!?]+[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
# Steps by which minima of two words become minima of WINDOW words.
_DOUBLINGS = (1, 2, 4)
# The order of a document without id: after all others.
_LAST = (1 << 63) - 1


def _cut_after(words: list[bytes], lengths: list[int]) -> list[bool]:
    """For each word of some long sentences, given their lengths, whether a piece ends with it."""
    hashes = np.array([xxhash.xxh3_64_intdigest(word) for word in words], np.uint64) | np.uint64(1)
    ends = np.cumsum(lengths)
    least, most = hashes, np.zeros(len(words) + WINDOW - 1, np.uint64)
    for step in _DOUBLINGS:
        least = np.minimum(least[:-step], least[step:])
    most[WINDOW - 1 : len(words)] = least
    # no window reaches over the end of a sentence
    most[(ends[:-1, None] + np.arange(WINDOW - 1)).ravel()] = 0
    for step in _DOUBLINGS:
        most = np.maximum(most[:-step], most[step:])
    cut = hashes == most
    cut[ends - 1] = True
    return cut.tolist()


def sentences(data: bytes) -> list[tuple[int, int, list[bytes]]]:
    """Start, end and lower-cased words of the sentences, which cover a text without gaps.

    Long sentences are in pieces. White space goes with the sentence before it; a text without
    words has no sentence.
    """
    whole: list[tuple[int, int, list[bytes]]] = []
    start = 0
    for end in [*(match.end() for match in _END.finditer(data)), len(data)]:
        words = data[start:end].lower().split()
        if words:
            whole.append((start, end, words))
            start = end
        elif whole and end > start:
            whole[-1] = (whole[-1][0], end, whole[-1][2])
            start = end
    long = [words for _, _, words in whole if len(words) >= LONG_SENTENCE]
    if not long:
        return whole
    cut = iter(_cut_after([word for words in long for word in words], [len(words) for words in long]))
    found: list[tuple[int, int, list[bytes]]] = []
    for start, end, words in whole:
        if len(words) < LONG_SENTENCE:
            found.append((start, end, words))
            continue
        since = 0
        for place, match in enumerate(_WORD.finditer(data, start, end), 1):
            if next(cut):
                found.append((start, match.end(), words[since:place]))
                start, since = match.end(), place
        found[-1] = (found[-1][0], end, found[-1][2])
    return found


def span_ends(counts: list[int]) -> list[int]:
    """For the sentence each span begins with, the one after its last, given word counts.

    Sentences too near the end of a text to begin a span are left out.
    """
    ends: list[int] = []
    end = words = 0
    for start, own in enumerate(counts):
        while end < len(counts) and (end - start < MIN_SENTENCES or words < MIN_WORDS):
            words += counts[end]
            end += 1
        if end - start < MIN_SENTENCES or words < MIN_WORDS:
            break
        ends.append(end)
        words -= own
    return ends


_SPANS = "one bigint, two bigint, document bigint, mark bigint, place int"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of every span of rows (document, mark, text)."""
    for batch in batches:
        digests, rows, places = [], [], []
        for row, value in enumerate(batch.column(2)):
            words = [own for _, _, own in sentences((value.as_py() or "").encode())]
            joined = [b" ".join(own) for own in words]
            ends = span_ends([len(own) for own in words])
            digests += [
                xxhash.xxh3_128_digest(b" ".join(joined[start:end])) for start, end in enumerate(ends)
            ]
            rows += [row] * len(ends)
            places += range(len(ends))
            if len(rows) > 200_000:
                yield _span_batch(batch, digests, rows, places)
                digests, rows, places = [], [], []
        yield _span_batch(batch, digests, rows, places)


def _span_batch(batch, digests: list[bytes], rows: list[int], places: list[int]) -> pa.RecordBatch:
    halves = pa.py_buffer(b"".join(digests))
    both = pa.Array.from_buffers(pa.int64(), 2 * len(digests), [None, halves])
    index = pa.array(range(0, 2 * len(digests), 2), pa.int64())
    taken = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            both.take(index),
            both.take(pa.compute.add(index, 1)),
            batch.column(0).take(taken),
            batch.column(1).take(taken),
            pa.array(places, pa.int32()),
        ],
        names=["one", "two", "document", "mark", "place"],
    )


def covered_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(document, mark, places): where each text has spans that are not the first of theirs.

    ``mark`` is a hash of the text, so that rows which share a key are told apart by it. Where no
    rows do, it is 0, and so costs nothing to move.
    """
    document = F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("document")
    shared = docs.groupBy(document).agg(F.count("*").alias("n")).filter("n > 1")
    mark = F.lit(0).cast("long") if shared.isEmpty() else F.xxhash64(text)
    rows = docs.select(document, mark.alias("mark"), F.col(text).alias("text"))
    every = stored(rows.mapInArrow(released(_spans), _SPANS), "spans")
    # counted by half a digest first: few spans that do not repeat go on from there
    repeated = every.groupBy("one").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = stored(repeated.select("one"), "repeated")
    spans = stored(every.join(repeated, "one"), "spans")
    remove_stored(every, repeated)
    first = F.min(F.struct("document", "mark", "place")).alias("first")
    # stored, so that a hot span is split in the join
    firsts = stored(spans.groupBy("one", "two").agg(first), "firsts")
    later = spans.join(firsts, ["one", "two"]).filter(
        F.struct("document", "mark", "place") != F.col("first")
    )
    return later.groupBy("document", "mark").agg(F.collect_set("place").alias("places"))


def dedup_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, the text without repeated spans, then n_sentences and n_removed.

    What stays of a text is as it was. A text may become empty; its row stays. Null and
    empty texts and texts too short for a span stay as they are. Rows that repeat key and
    text are one document and end up alike; documents without key come after all others.
    Columns that the input has of the two names are replaced.
    """
    docs = docs.drop("n_sentences", "n_removed")
    names = docs.columns
    where = names.index(text)
    schema = with_field(docs.schema, ("n_sentences", "bigint"), ("n_removed", "bigint"))
    covered = covered_spans(docs, key, text)
    # named by place, as the input may have columns of any names
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    own_key, own_text = f"c{names.index(key)}", f"c{where}"
    same = (F.coalesce(F.col(own_key).cast("long"), F.lit(_LAST)) == F.col("document")) & (
        (F.col("mark") == 0) | (F.xxhash64(own_text) == F.col("mark"))
    )
    joined = plain.join(covered, same, "left").select(*plain.columns, "places")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [], [], []
            for value, places in zip(batch.column(where), batch.column(len(names))):
                value, places = value.as_py(), places.as_py()
                data = (value or "").encode()
                parts = sentences(data)
                counts.append(len(parts))
                if not places:
                    texts.append(value)
                    removed.append(0)
                    continue
                ends = span_ends([len(words) for _, _, words in parts])
                gone = {i for place in places for i in range(place, ends[place])}
                kept = [data[a:b] for i, (a, b, _) in enumerate(parts) if i not in gone]
                texts.append(b"".join(kept).decode())
                removed.append(len(gone))
            columns = list(batch.columns[: len(names)])
            columns[where] = pa.array(texts, columns[where].type)
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(released(tasks), schema)
