"""Ranked lexical search by branch and bound over tries of documents.

Documents are restricted to the terms of the items. A task takes them in blocks: the term vectors
of a block, most frequent terms first, share the paths of a trie (an FP-tree), whose lower parts
are buckets of some documents. Every node knows the greatest number of occurrences of each term
and the least ``m`` below it, so the score it would give a document that had both is a bound for
all of them. Each item goes through the trie depth first, the best child first, and leaves out
what cannot reach the scores it has.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import remove_stored, stored

TOP = 50
# Fixed value: what separates terms, [\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F].
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_LOWER = bytes(
    0x20 if byte in _SEPARATORS else byte + 32 if 0x41 <= byte <= 0x5A else byte for byte in range(256)
)
# Bytes split into terms at a time.
_PIECE = 1 << 20
# Terms of the items searched for at a time, unless one item alone has more.
BLOCK_TERMS = 20_000
# Documents of a bucket, and of a trie at most; fewer where there are many terms.
BUCKET = 32
BLOCK = 8_192
_BLOCK_CELLS = 1 << 26
# A first search of one part in so many gives each item a score its best must reach.
PARTS = 16


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, with A-Z lower-cased, some at a time."""
    start = 0
    while start < len(text):
        end = start + _PIECE
        if end < len(text):  # a piece ends after a separator, or else with the text
            while end < len(text) and _LOWER[text[end - 1]] != 0x20:
                end += 1
        yield text[start:end].translate(_LOWER).split()
        start = end


def _vectors(index: dict[bytes, int]):
    """(doc, n, terms, counts) of rows (doc, text): how often each known term occurs."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, counts = [], [], []
            for value in batch.column(1):
                found: Counter = Counter()
                size = 0
                for words in term_lists(value.as_buffer().to_pybytes() if value.is_valid else b""):
                    found.update(map(index.get, words))
                    size += len(words)
                found.pop(None, None)
                sizes.append(size)
                terms.append(list(found.keys()))
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                names=["doc", "n", "terms", "counts"],
            )

    return tasks


def scores(weights: np.ndarray, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What terms of some weights add to the score of documents they occur in so often."""
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 20 * m))


class Trie:
    """Documents with shared paths; ``terms`` are ranks, most frequent first."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, m: np.ndarray, weights: np.ndarray):
        begin = np.cumsum(sizes) - sizes
        paths = [terms[a : a + n].astype(">u4").tobytes() for a, n in zip(begin, sizes)]
        self.order = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        self.sizes = sizes[self.order]
        entries = np.arange(self.sizes.sum()) + np.repeat(
            begin[self.order] - (np.cumsum(self.sizes) - self.sizes), self.sizes
        )
        self.terms, self.counts = terms[entries], counts[entries]
        self.m = m[self.order]
        self.begin = np.append(0, np.cumsum(self.sizes))
        own = scores(weights[self.terms], self.counts, np.repeat(self.m, self.sizes))
        self.own = own
        self.low: list[int] = []
        self.high: list[int] = []
        self.children: list[list[int] | None] = []
        self._split(0, len(paths))
        self._sum_up(weights)

    def _node(self, low: int, high: int, parent: int | None) -> int:
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        number = len(self.low) - 1
        if parent is not None:
            self.children[parent].append(number)
        return number

    def _split(self, low: int, high: int) -> None:
        """Nodes where paths part; documents after each other are a bucket when they are few."""
        waiting = [(self._node(low, high, None), 0)]
        while waiting:
            node, depth = waiting.pop()
            low, high = self.low[node], self.high[node]
            ranges: list[tuple[int, int]] = []
            while high - low > BUCKET:
                ended = int((self.sizes[low:high] == depth).sum())  # they are first in order
                if ended == high - low:
                    break
                following = self.terms[self.begin[low + ended : high] + depth]
                cuts = np.flatnonzero(following[1:] != following[:-1]) + low + ended + 1
                if len(cuts) or ended:
                    edges = [*([low] if ended else []), low + ended, *cuts.tolist(), high]
                    ranges = list(zip(edges[:-1], edges[1:]))
                    break
                depth += 1
            if not ranges:
                continue
            self.children[node] = []
            held = ranges[0]
            for part in ranges[1:]:
                if part[1] - held[0] <= BUCKET:
                    held = (held[0], part[1])
                    continue
                waiting.append((self._node(*held, node), depth))
                held = part
            waiting.append((self._node(*held, node), depth))

    def _sum_up(self, weights: np.ndarray) -> None:
        """The most that each term adds to any document below each node."""
        most = np.zeros((len(self.low), len(weights)), np.int64)
        least = np.zeros(len(self.low), np.int64)
        for node in reversed(range(len(self.low))):  # children have higher numbers
            kids = self.children[node]
            if kids is None:
                a, b = self.begin[self.low[node]], self.begin[self.high[node]]
                np.maximum.at(most[node], self.terms[a:b], self.counts[a:b])
                least[node] = self.m[self.low[node] : self.high[node]].min()
            else:
                most[node] = most[kids].max(axis=0)
                least[node] = least[kids].min()
        self.most = scores(weights, most, least[:, None])

    def bounds(self, terms: np.ndarray) -> list[int]:
        """For every node the score that no document below it exceeds."""
        return self.most[:, terms].sum(axis=1).tolist()

    def bucket(self, node: int, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of the documents of a bucket."""
        low, high = self.low[node], self.high[node]
        a, b = self.begin[low], self.begin[high]
        own = np.where(wanted[self.terms[a:b]], self.own[a:b], 0)
        return np.add.reduceat(own, self.begin[low:high] - a)


class Best:
    """The best documents of one item so far: ``floor`` is a score the best must reach."""

    def __init__(self, top: int, floor: int):
        self.top, self.floor = top, max(floor, 1)
        self.rows: list[tuple[int, bool, int]] = []

    def add(self, found: np.ndarray, docs: list[int | None]) -> None:
        for at in np.flatnonzero(found >= self.floor).tolist():
            doc = docs[at]
            self.rows.append((-int(found[at]), doc is None, doc or 0))
        if len(self.rows) >= 2 * self.top:
            self.cut()

    def cut(self) -> None:
        self.rows = sorted(self.rows)[: self.top]
        if len(self.rows) == self.top:
            self.floor = max(self.floor, -self.rows[-1][0])


def search(trie: Trie, docs: list[int | None], terms: np.ndarray, best: Best) -> int:
    """Depth-first branch and bound; gives the number of buckets it had to score."""
    bounds = trie.bounds(terms)
    wanted = np.zeros(trie.most.shape[1], bool)
    wanted[terms] = True
    waiting, scored = [0], 0
    while waiting:
        node = waiting.pop()
        if bounds[node] < best.floor:
            continue
        kids = trie.children[node]
        if kids is None:
            best.add(trie.bucket(node, wanted), docs[trie.low[node] : trie.high[node]])
            scored += 1
        else:
            waiting += sorted(kids, key=bounds.__getitem__)
    best.cut()
    return scored


_FOUND = "place int, doc bigint, score bigint"


def _searched(items: list[np.ndarray], weights: np.ndarray, ranks: np.ndarray, floors: list[int], top: int):
    """The best documents of the task for each item, from rows (doc, m, terms, counts)."""
    block = max(2 * BUCKET, min(BLOCK, _BLOCK_CELLS // len(weights)))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top, floor) for floor in floors]
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                lists = part.column(2)
                sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                terms = ranks[lists.flatten().to_numpy()]
                counts = part.column(3).flatten().to_numpy()
                # by rank inside each document
                order = np.lexsort((terms, np.repeat(np.arange(len(sizes)), sizes)))
                trie = Trie(sizes, terms[order], counts[order], part.column(1).to_numpy(), weights)
                docs = part.column(0).take(pa.array(trie.order)).to_pylist()
                for own, found in zip(items, best):
                    search(trie, docs, own, found)
        rows = [(place, *row) for place, found in enumerate(best) for row in found.rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row[0] for row in rows], pa.int32()),
                pa.array([None if row[2] else row[3] for row in rows], pa.int64()),
                pa.array([-row[1] for row in rows], pa.int64()),
            ],
            names=["place", "doc", "score"],
        )

    return tasks


def _item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items with their distinct terms, in blocks of BLOCK_TERMS terms; items without terms are left out."""
    held: list[tuple[object, list[bytes]]] = []
    known: set[bytes] = set()
    for row in items.select(F.col(item).alias("item"), F.col(text).alias("text")).toLocalIterator():
        own = {word for words in term_lists((row["text"] or "").encode()) for word in words}
        if not own:
            continue
        if held and len(known | own) > BLOCK_TERMS:
            yield held
            held, known = [], set()
        held.append((row["item"], sorted(own)))
        known |= own
    if held:
        yield held


def rank(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """(item, rank, doc, score): the ``top`` best documents of each item, under the names given.

    A term is a run of letters and digits of ASCII, with A-Z lower-cased, or of any other
    characters beyond ASCII. A term's weight w falls with the number of documents that hold it;
    a document's score sums w * (10**9 * tf div (1000 * tf + 20 * m)) over the terms of the item,
    with m from the document's length. Documents without a score above 0 are not listed. Equal
    scores are in the order of the key, documents without key last.

    A null text has no terms; an item without terms has no rows; an empty table gives an empty result.
    Rows that share a key are documents, or items, of their own. Only the two columns named are
    read of either table. Items are few and searched for in blocks of BLOCK_TERMS terms; a block's terms and the
    floors of its items are all that the driver holds and tasks are sent.
    """
    spark = docs.sparkSession
    result = None
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    kind = items.schema[item].dataType
    for block in _item_blocks(items, item, item_text):
        found = _ranked_block(rows, block, top)
        names = spark.createDataFrame(
            [(place, own) for place, (own, _) in enumerate(block)], "place int, item " + kind.simpleString()
        )
        found = found.join(F.broadcast(names), "place").select("item", "rank", "doc", "score")
        result = found if result is None else result.unionByName(found)
    if result is None:
        result = spark.createDataFrame([], f"item {kind.simpleString()}, rank int, doc bigint, score bigint")
    return result.toDF(item, "rank", key, "score")


def _ranked_block(rows: DataFrame, block: list[tuple[object, list[bytes]]], top: int) -> DataFrame:
    spark = rows.sparkSession
    index = {term: number for number, term in enumerate(sorted({t for _, own in block for t in own}))}
    schema = "doc bigint, n bigint, terms array<int>, counts array<bigint>"
    vectors = stored(rows.mapInArrow(_vectors(index), schema).filter("n > 0"), "vectors")
    documents, length = vectors.agg(F.count("*"), F.sum("n")).first()
    holding = np.zeros(len(index), np.int64)
    for number, count in (
        vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    ):  # as many rows as the block has terms
        holding[number] = count
    weights = np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.int64
    )
    by_rank = np.argsort(-holding, kind="stable")
    ranks = np.empty(len(index), np.int64)
    ranks[by_rank] = np.arange(len(index))
    wanted = [ranks[[index[term] for term in own]] for _, own in block]
    m = F.expr(f"100 - 50 + ((50 * n * {documents}L) div {length or 1}L)").alias("m")
    held = vectors.filter(F.size("terms") > 0).select("doc", m, "terms", "counts")

    def best(part: DataFrame, floors: list[int]) -> DataFrame:
        tasks = _searched(wanted, weights[by_rank], ranks, floors, top)
        found = part.mapInArrow(tasks, _FOUND)
        ordered = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        return found.withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= top)

    # Any part of the documents gives scores that the best of all must reach.
    floors = [1] * len(block)
    first = F.pmod(F.xxhash64("doc", "n"), F.lit(PARTS)) == 0
    for place, score in best(held.filter(first), floors).filter(F.col("rank") == top).select("place", "score").collect():
        floors[place] = score
    result = stored(best(held, floors), "ranked")
    remove_stored(vectors)
    return result
