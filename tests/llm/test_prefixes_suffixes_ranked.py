"""Prefix trie, suffix dedup and ranked search against brute force and on odd input."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.llm import prefixes, ranked, suffixes

TURNS = "conv_id long, turn int, role string, text string, name int, depth int"


def _trie(rows):
    """Brute force: the nodes of rebuilt conversations as prefix_trie returns them."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {conv: [turn[3:] for turn in sorted(found)] for conv, found in own.items()}
    rebuilt = {}
    for conv, found in turns.items():
        heads = zlib.crc32(str(conv).encode()) % 6
        base = conv - int(math.fmod(conv, 100))
        rebuilt[conv] = tuple(turns.get(base, [])[:heads] + found[heads:])
    members = defaultdict(list)
    for conv, path in rebuilt.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    result = []
    for path, convs in members.items():
        ends = ",".join(str(conv) for conv in sorted(convs) if len(rebuilt[conv]) == len(path))
        above = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        result.append(
            (min(convs), len(path), above, len(convs), children[path], leaves[path], saved[path], digest)
        )
    return Counter(result)


NAMES = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def _found(spark, rows):
    df = spark.createDataFrame([(*row, 1, 2) for row in rows], TURNS).repartition(3)
    return Counter(tuple(row) for row in prefixes.prefix_trie(df).select(*NAMES).collect())


def test_prefix_trie_equals_brute_force(spark, monkeypatch):
    random = np.random.default_rng(3)
    words = ["", "a", "b", "é漢", "long turn " * 40]
    rows = []
    for conv in [*range(0, 40), *range(100, 130), *range(-30, -20), 205, 350]:
        for turn in range(int(random.integers(0, 8))):
            rows.append((conv, turn, ["user", "bot"][turn % 2], words[random.integers(0, 2 + turn % 4)]))
    rows += [(7, None, None, None), (7, 3, "user", None), (7, 3, "user", "a"), (7, 3, "user", "a")]
    rows += [(None, 1, "user", "of no conversation"), (300, 0, "user", "x")]
    rows += [(400, turn, "user", "again") for turn in range(90)]  # longer than a block
    monkeypatch.setattr(prefixes, "IDS", 5)
    monkeypatch.setattr(prefixes, "BLOCK", 16)
    assert _found(spark, rows) == _trie(rows)


def test_prefix_trie_of_equal_conversations_and_of_none(spark):
    rows = [(conv, turn, "user", f"turn {turn}") for conv in range(500) for turn in range(3)]
    assert _found(spark, rows) == _trie(rows)
    assert prefixes.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_colliding_fingerprints_are_found_and_other_bases_taken(spark, monkeypatch):
    rows = [(conv, turn, "user", f"{conv} {turn}") for conv in range(100, 140) for turn in range(7)]
    asked = []

    def weak(seed):
        asked.append(seed)
        return [1, 1, 1, 1] if seed == 0 else [3 + seed] * 4

    # with base 1 the order of turns makes no difference
    rows += [(200, turn, "user", text) for turn, text in enumerate(["x", "y", "z", "v", "w", "q"])]
    rows += [(300, turn, "user", text) for turn, text in enumerate(["y", "x", "z", "v", "w", "q"])]
    monkeypatch.setattr(prefixes, "bases", weak)
    assert _found(spark, rows) == _trie(rows)
    assert 1 in asked


def test_powers_of_a_base():
    exponents = np.array([0, 1, 5, 1000, 12345678901])
    for prime, base in zip(prefixes.PRIMES, prefixes.bases(0)):
        want = [pow(base, int(e), prime) for e in exponents]
        assert prefixes.powers(base, exponents, prime).tolist() == want


DOCS = "doc_id long, text string, spans int, kept int, document int, mark int, c0 int"


def _without_repeats(docs, width):
    """Brute force over (doc_id, text): what is kept, and how many bytes and runs go, per row."""
    first = {}
    datas = [((doc if doc is not None else -(1 << 63)), (text or "").encode()) for doc, text in docs]
    for doc, data in datas:
        for at in range(len(data) - width + 1):
            string = data[at : at + width]
            first[string] = min(first.get(string, doc), doc)
    result = []
    for (doc, data), (key, _) in zip(datas, docs):
        gone, own = bytearray(len(data)), set()
        for at in range(len(data) - width + 1):
            string = data[at : at + width]
            if first[string] < doc or string in own:
                gone[at : at + width] = b"\1" * width
            own.add(string)
        kept = bytes(byte for byte, lost in zip(data, gone) if not lost)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        result.append((key, len(data), sum(gone), runs, kept))
    return Counter(result)


def _dropped(spark, docs, **options):
    df = spark.createDataFrame([(*doc, 1, 2, 3, 4, 5) for doc in docs], DOCS).repartition(5)
    found = suffixes.drop_repeated(df, **options)
    assert found.filter("document <> 3 or mark <> 4 or c0 <> 5").isEmpty()
    rows = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept", "spans").collect()
    assert all(sum(end - first for first, end in row.spans) == row.n_removed for row in rows)
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows)


def _texts(random):
    letters = np.array(list("abcdefgh é漢\n"))
    common = ["".join(random.choice(letters, size)) for size in (300, 120, 99, 100, 101, 70)]
    docs = []
    for doc in range(60):
        text = "".join(random.choice(letters, int(random.integers(0, 400))))
        for _ in range(int(random.integers(0, 4))):
            part = common[random.integers(0, len(common))]
            at = int(random.integers(0, len(text) + 1))
            text = text[:at] + part[int(random.integers(0, 40)) :] + text[at:]
        docs.append((doc, text))
    docs += [(70, docs[5][1]), (70, docs[5][1]), (71, docs[5][1][:150] + "!" + docs[5][1][151:])]
    docs += [(5, docs[9][1]), (5, docs[9][1] + "more"), (None, docs[3][1]), (None, docs[3][1])]
    docs += [(80, None), (81, ""), (82, "a" * 99), (83, "a" * 500), (84, "a" * 250), (90, "ab" * 400)]
    docs += [(-4, docs[12][1][20:])]
    return docs


@pytest.mark.parametrize("room", [2, suffixes.ROOM])
def test_repeated_strings_equal_brute_force(spark, monkeypatch, room):
    monkeypatch.setattr(suffixes, "ROOM", room)
    docs = _texts(np.random.default_rng(5))
    assert _dropped(spark, docs) == _without_repeats(docs, 100)


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 512)
    docs = _texts(np.random.default_rng(6))
    docs += [(200, "".join(text or "" for _, text in docs)), (201, "x" * 3 + "".join(t or "" for _, t in docs))]
    assert _dropped(spark, docs, width=64, gram=20) == _without_repeats(docs, 64)
    assert _dropped(spark, docs, width=64, gram=64) == _without_repeats(docs, 64)


def test_a_line_that_all_documents_share(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "ROOM", 16)
    random = np.random.default_rng(7)
    line = "every document has this line, which is not long enough by itself, in it."
    letters = list("abcdefghij klmnop")
    docs = [
        (doc, "".join(random.choice(letters, 150)) + line + "".join(random.choice(letters, 20 + doc % 40)))
        for doc in range(300)
    ]
    docs += [(1000 + doc, text) for doc, text in docs[::3]]
    assert _dropped(spark, docs) == _without_repeats(docs, 100)
    assert suffixes.drop_repeated(spark.createDataFrame([], DOCS)).count() == 0


def test_suffixes_are_sorted_in_logarithmic_comparisons():
    random = np.random.default_rng(8)
    data = np.frombuffer(b"".join(random.choice([b"abcab", b"aab", b"b" * 30], 400)), np.uint8)
    starts = random.permutation(len(data) - 100)[:700]
    groups = np.sort(random.integers(0, 9, len(starts)))
    hashes = suffixes.PrefixHashes(data)
    order, equal = suffixes.sort_suffixes(data, hashes, starts, groups)
    keys = [(groups[i], data[starts[i] : starts[i] + 100].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(starts)))
    assert equal.tolist() == [False] + [a == b for a, b in zip(keys, keys[1:])]
    one, two = starts[:300], starts[300:600]
    want = [
        next((i for i in range(100) if data[a + i] != data[b + i]), 100) for a, b in zip(one, two)
    ]
    assert suffixes.common_extension(hashes, one, two, 100).tolist() == want


def test_equal_hashes_of_unequal_strings_are_noticed(monkeypatch):
    class Blind(suffixes.PrefixHashes):
        def of(self, starts, length):
            return np.zeros(len(starts), np.uint64)

    data = np.frombuffer(b"a" * 100 + b"b" * 100, np.uint8)
    with pytest.raises(ArithmeticError):
        suffixes.sort_suffixes(data, Blind(data), np.array([0, 100]), np.array([0, 0]))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {upper: upper + 32 for upper in range(65, 91)}


def _ranked(docs, items, top):
    found = [(doc, Counter(TERM.findall((text or "").translate(ASCII_LOWER)))) for doc, text in docs]
    found = [(doc, terms, sum(terms.values())) for doc, terms in found if terms]
    total = sum(n for _, _, n in found)
    holding = Counter(term for _, terms, _ in found for term in terms)
    result = []
    for item, text in items:
        scored = []
        for doc, terms, n in found:
            m = 50 + 50 * n * len(found) // total
            score = 0
            for term in set(TERM.findall((text or "").translate(ASCII_LOWER))):
                weight = math.floor(1000 * math.log((2 * len(found) + 2) / (2 * holding[term] + 1)))
                score += weight * (10**9 * terms[term] // (1000 * terms[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort()
        result += [(item, place, row[3], -row[0]) for place, row in enumerate(scored[:top], 1)]
    return Counter(result)


def _corpus(random, count):
    words = [f"w{i}" for i in range(40)] + ["É", "é", "漢字", "UPPER", "upper", "a_b", "x9"]
    share = 1 / np.arange(1, len(words) + 1)
    share /= share.sum()
    docs = [
        (int(doc), " ".join(random.choice(words, int(random.integers(0, 60)), p=share)))
        for doc in random.permutation(count)
    ]
    docs += [(None, "w1 w2 w1"), (3, "w1 w2 w1"), (3, "w1 w2 w1"), (900, None), (901, ""), (902, "...\x1f\x7f")]
    return [*docs, (903, "w5, " * 5000 + "w39")]


def _searched(spark, docs, items, top):
    docs = spark.createDataFrame([(*doc, 1) for doc in docs], "doc_id long, text string, rank int").repartition(4)
    items = spark.createDataFrame(items, "item_id long, text string")
    return Counter(tuple(r) for r in ranked.rank(docs, items, top=top).select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("bucket, top", [(2, 7), (32, 50)])
def test_ranked_search_equals_brute_force(spark, monkeypatch, bucket, top):
    monkeypatch.setattr(ranked, "BUCKET", bucket)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", 12)  # several blocks of items
    random = np.random.default_rng(9)
    docs = _corpus(random, 400)
    items = [(i, docs[i * 7][1]) for i in range(12)]
    items += [(50, None), (51, " , "), (52, "unknown"), (53, "w0"), (54, "W1 w1 É"), (54, "w3"), (None, "漢字 x9")]
    assert _searched(spark, docs, items, top) == _ranked(docs, items, top)


def test_ranked_search_of_nothing(spark):
    docs = [(1, "a"), (2, None)]
    assert not _searched(spark, docs, [], 5)
    assert not _searched(spark, [], [(1, "a")], 5)
    assert _searched(spark, docs, [(1, "a")], 5) == _ranked(docs, [(1, "a")], 5)


def test_bounds_hold_and_spare_buckets():
    random = np.random.default_rng(10)
    rows, terms, counts = 3000, [], []
    sizes = random.integers(1, 9, rows)
    for size in sizes:
        terms.append(np.sort(random.choice(60, size, replace=False, p=None)))
        counts.append(random.integers(1, 4, size))
    weights = np.arange(60, dtype=np.int64) * 100
    m = random.integers(60, 300, rows)
    trie = ranked.Trie(sizes, np.concatenate(terms), np.concatenate(counts).astype(np.int64), m, weights)
    wanted = np.array([3, 17, 44, 58])
    exact = [
        sum(int(ranked.scores(weights[t], np.int64(c), m[i])) for t, c in zip(terms[i], counts[i]) if t in wanted)
        for i in trie.order
    ]
    bounds = trie.bounds(wanted)
    assert all(max(exact[a:b]) <= bound for a, b, bound in zip(trie.low, trie.high, bounds))
    best = ranked.Best(10, 1)
    scored = ranked.search(trie, list(range(rows)), wanted, best)
    assert [-row[0] for row in best.rows] == sorted(exact, reverse=True)[:10]
    assert scored < sum(kids is None for kids in trie.children)
    long = b"word " * 500_000 + b"x" * 3_000_000
    assert Counter(w for part in ranked.term_lists(long) for w in part) == Counter(long.split())


def test_texts_of_pages_are_whole(spark):
    """Characters beyond the basic plane count once, and bytes as UTF-8."""
    docs = [(1, "\U0001f600" * 60), (2, "\U0001f600" * 60)]
    assert _dropped(spark, docs) == _without_repeats(docs, 100)
    rows = [(0, 0, "user", "\U0001f600" * 3), (100, 0, "user", "\U0001f600" * 3)]
    assert _found(spark, rows) == _trie(rows)
    assert spark.range(1).select(F.length(F.lit("\U0001f600"))).first()[0] == 1
