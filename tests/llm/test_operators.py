"""The corpus operators against brute force, and on nulls, ties, repeats and empty tables."""

import hashlib
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from tripmart.llm import attention, bpe, fingerprints, language, lines, minhash, nndescent
from tripmart.llm import packing, queries, spans, warc
from tripmart.llm.common import components
from tripmart.storage import new_folder

DOCS = "doc_id long, text string, ids int, n_lines int, lang string"
ODD = [
    (1, None, 0, 0, None),
    (2, "", 0, 0, "en"),
    (3, "a" * 5000, 0, 0, "en"),
    (4, "Two  words\n\n here. " * 30, 0, 0, None),
    (4, "Two  words\n\n here. " * 30, 0, 0, None),
    (None, "no id é漢字 \x1f\x85 123 'll", 0, 0, "de"),
    (5, "\n\n \t\n", 0, 0, "de"),
    (6, "word " * 20000, 0, 0, "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


def test_bpe_equals_tiktoken_and_round_trips(odd, none, vocabulary):
    ranks, pattern = vocabulary
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    found = bpe.decode(bpe.encode(odd, ranks, pattern), ranks).collect()
    assert len(found) == len(ODD)
    want = Counter((d, tuple(own.encode_ordinary(t or "")), (t or "").encode()) for d, t, *_ in ODD)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in found) == want
    assert bpe.encode(none, ranks, pattern).count() == 0


def test_bpe_of_long_pieces(vocabulary):
    ranks, pattern = vocabulary
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    random = np.random.default_rng(1)
    queue = bpe.RankQueue(ranks)
    for letters, size in (("ab", 20_000), ("etaoin", 5_000), ("a", 30_000), ("éß漢", 900)):
        piece = "".join(random.choice(list(letters), size))
        assert bpe.merge(piece.encode(), ranks, queue) == own.encode_ordinary(piece)
        assert not queue.buckets and not any(queue.words)


def _padding(lengths, ends):
    return sum(min(end for end in ends if end >= x) for x in lengths)


def test_boundaries_waste_least():
    random = np.random.default_rng(2)
    for _ in range(20):
        counts = Counter(random.integers(0, 12, 30).tolist())
        tops = sorted(counts)
        for buckets in (1, 2, 3, 5):
            ends = packing.boundaries(tops, [counts[x] for x in tops], buckets)
            assert len(ends) <= buckets
            best = min(
                _padding(counts.elements(), (*chosen, tops[-1]))
                for size in range(buckets)
                for chosen in combinations(tops[:-1], min(size, len(tops) - 1))
            )
            assert _padding(counts.elements(), ends) == best


def test_batches_hold_every_row_within_the_budget(spark):
    rows = [(i, None if i % 50 == 0 else (i * 37) % 900) for i in range(2000)] + [(7, 5000), (None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens int").repartition(5)
    found = packing.pack(df, token_budget=4096).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in found) == Counter((d, n or 0) for d, n in rows)
    batches = defaultdict(list)
    for r in found:
        assert r.n_tokens <= r.bucket_length
        batches[r.batch_id].append(r)
    full = Counter()
    for members in batches.values():
        assert sorted(r.position for r in members) == list(range(len(members)))
        assert len(members) == 1 or len(members) * members[0].bucket_length <= 4096
        full[members[0].bucket_length] += len(members) < max(1, 4096 // max(1, members[0].bucket_length))
    assert max(full.values()) <= 1
    assert packing.pack(df.limit(0)).count() == 0
    assert all(r.bucket_length in {n or 0 for _, n in rows} for r in found)  # the longest row's length


def _cleaned(docs, min_docs=5):
    keys = defaultdict(set)
    for doc, text in docs:
        for key in lines.line_keys(text):
            keys[key].add(doc)
    lost = {k: max(d for d in ids if d is not None) for k, ids in keys.items() if k and len(ids) >= min_docs}
    out = Counter()
    for doc, text in docs:
        parts = (text or "").split("\n")
        kept = [p for p, k in zip(parts, lines.line_keys(text)) if lost.get(k, doc) == doc]
        out[doc, "\n".join(kept), len(parts), len(parts) - len(kept)] += 1
    return out


def test_lines_equal_brute_force_and_can_be_taken_back(spark, odd, none):
    shared = "The line that many documents have, in any CASE é."
    docs = [(i, f"{'  ' * (i % 2)}{shared.lower() if i % 3 else shared}\nown {i}\n{shared}") for i in range(9)]
    docs += [(i, f"another line that some of the documents have {i % 2}\nx") for i in range(20, 29)]
    docs += [(None, shared), (30, None), (31, ""), (8, "again " + shared + "\n" + shared)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)

    def seen(frame):
        rows = frame.collect()
        return Counter((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in rows)

    assert seen(lines.dedup_lines(df)) == _cleaned(docs)
    index = lines.LineIndex(spark, new_folder(spark, "lines"))
    more = spark.createDataFrame([(100 + i, shared + f"\nnew line number {i} of some length, not common") for i in range(3)], "doc_id long, text string")
    index.insert(df)
    index.refresh()
    before = seen(lines.clean(df, index.drops(df)))
    index.insert(more)
    index.refresh()
    assert seen(lines.clean(df, index.drops(df))) != before
    index.delete(more)
    index.refresh()
    assert seen(lines.clean(df, index.drops(df))) == before == _cleaned(docs)
    result = lines.dedup_lines(odd)
    assert result.count() == len(ODD) and result.columns[-2:] == ["n_lines", "n_dropped"]
    assert lines.dedup_lines(none).count() == 0


def test_cuckoo_filter_loses_nothing():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(6000)]
    held = lines.CuckooFilter.sized(3000)
    held.add(keys[:3000])
    assert held.contains(keys[:3000]).all()
    assert held.contains(keys[3000:]).mean() < 0.01
    held.remove(keys[:1500])
    again = lines.CuckooFilter.from_bytes(held.to_bytes())
    assert again.contains(keys[1500:3000]).all()
    assert again.contains(keys[:1500]).mean() < 0.01
    tight = lines.CuckooFilter.sized(1)
    tight.add(keys[:200])
    assert tight.stash and tight.contains(keys[:200]).all()


def _edit_distance(one, other):
    row = list(range(len(other) + 1))
    for i, a in enumerate(one, 1):
        previous, row[0] = row[0], i
        for j, b in enumerate(other, 1):
            previous, row[j] = row[j], previous if a == b else 1 + min(row[j], row[j - 1])
    return row[-1]


def test_fingerprints_equal_brute_force(spark, odd, none):
    random = np.random.default_rng(3)
    for _ in range(30):
        one, other = ("".join(fingerprints._SYMBOLS[x] for x in random.integers(0, 6, n)) for n in random.integers(1, 40, 2))
        pieces = [[s[i : i + 2] for i in range(0, len(s), 2)] for s in (one, other)]
        total = len(pieces[0]) + len(pieces[1])
        assert fingerprints._closeness(one, other) == pytest.approx(1 - _edit_distance(*pieces) / total)
    docs = [(i, "".join(random.choice(list("abc dé."), int(random.integers(0, 900))))) for i in range(0, 160, 2)]
    docs.append((40, "same id, other text"))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    found = fingerprints.compare_with_next(df).collect()
    by_id = defaultdict(list)
    for doc, text in docs:
        by_id[doc].append(text)
    order = sorted(by_id, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    assert len(found) == len(docs)
    for r in found:
        texts = {fingerprints.fingerprint(t.encode()): t for t in by_id[r.doc_id]}
        text = texts[r.fingerprint]
        nexts = by_id[following[r.doc_id]]
        assert r.n_chars == len(text) and r.edited in {fingerprints.edited(text, t) for t in nexts}
        assert r.edited_fingerprint == fingerprints.fingerprint(r.edited.encode())
        assert r.near_edited == fingerprints.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next in {fingerprints.likeness(r.fingerprint, fingerprints.fingerprint(t.encode())) for t in nexts}
    assert fingerprints.compare_with_next(odd).count() == len(ODD)
    assert fingerprints.compare_with_next(none).count() == 0
    only = spark.createDataFrame([(1, "alone é")], "doc_id long, text string")
    alone = fingerprints.compare_with_next(only).first()
    assert alone.near_next == 1.0
    assert fingerprints.fingerprints(odd).count() == len(ODD)


def test_fingerprints_of_repetitive_texts_cover_the_whole_text():
    random = np.random.default_rng(16)

    def noise(n):
        return "".join(random.choice(list("abcdefghij klmnop"), n))

    for seed in range(20):
        text = (noise(1 if seed == 0 else 2000) * 1_000_000)[:1_000_000]
        for following in (noise(1_000_000), (noise(2000) * 500)):
            changed = fingerprints.edited(text, following)
            prints = [fingerprints.fingerprint(t.encode()) for t in (text, changed)]
            assert 0.5 < fingerprints.likeness(*prints) < 0.85
            for part in prints[0].split(":")[1:]:
                assert 16 <= len(part) // 2 <= 129


def test_hot_key_is_split_for_fingerprints(spark):
    docs = [(7, f"text number {i} of a key that many rows share") for i in range(400)]
    docs += [(i, f"other {i}") for i in range(100, 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = fingerprints.compare_with_next(df).collect()
    assert len(found) == 600
    last = dict(docs)[299]
    for r in found:
        if r.doc_id == 7:
            assert r.edited.endswith(last[: r.n_chars // 3])


def test_language_on_held_out_documents(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op5_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out")
    assert held.filter("lang_pred = lang").count() / held.count() > 0.95
    assert found.filter("score < 0 or score > 1 or lang_pred is null").count() == 0
    model = language.fit(docs)
    rows = {(r.doc_id, r.text): r for r in language.identify(odd, model).collect()}
    assert rows[1, None].lang_pred == rows[2, ""].lang_pred == rows[5, "\n\n \t\n"].lang_pred == "und"
    assert rows[3, "a" * 5000].lang_pred != "und"
    unlearned = language.identify(odd, language.fit(none)).select("lang_pred", "score", "accepted").distinct()
    assert [tuple(r) for r in unlearned.collect()] == [("und", 0.0, False)]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_unlearned_languages_and_noise_are_rejected_at_any_size(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    docs = docs.filter("length(text) > 0 and lang is not null").select("doc_id", "text", "lang")
    held_out = queries.crc_rest("doc_id", 4) == 2
    model = language.fit(docs.filter(~held_out))
    random = np.random.default_rng(15)
    planted = ["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz    "), 400)) for _ in range(20)]
    planted += [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki.",
        "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek ésszel bírnak.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    ]
    strange = spark.createDataFrame(list(enumerate(planted)), "doc_id long, text string")
    assert language.identify(strange, model).filter("accepted").isEmpty()
    clean = language.identify(docs.filter(held_out), model)
    assert clean.filter("accepted and lang_pred = lang").count() > 0.97 * clean.count()


def test_rare_languages_keep_their_share_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "DOCS_PER_LANGUAGE", 100)
    monkeypatch.setattr(language, "MAX_SAMPLE", 300)
    counts = {"aa": 3000, "bb": 3000, "cc": 3000, "dd": 100}
    docs = [(f"{lang} word number {i}", lang) for lang, n in counts.items() for i in range(n)]
    sample = language.sample(spark.createDataFrame(docs, "text string, lang string"))
    taken = [row["lang"] for row in sample.collect()]
    assert len(taken) == 300 and min(Counter(taken)[lang] for lang in counts) > 50


def test_grams_do_not_depend_on_spans(monkeypatch):
    text = "Ein Wort, noch eins; und drei.  " * 40
    whole = language.bag(text)
    monkeypatch.setattr(language, "SPAN", 97)
    split = language.bag(text)
    assert abs(len(whole[0]) - len(split[0])) <= 60


def test_attention_gradients_and_windows():
    random = np.random.default_rng(4)
    ids = random.integers(0, attention.IDS, 50)
    texts = np.repeat([0, 1], [30, 20])
    padded, numbers = attention._padded(ids, texts)
    targets = random.integers(0, attention.IDS, len(padded) - attention.CONTEXT + attention.BLOCK)
    weights = attention.Weights.initial()
    for field in weights.__dataclass_fields__:
        setattr(weights, field, getattr(weights, field).astype(np.float64))
    slopes = dict(zip(weights.__dataclass_fields__, attention._gradients(weights, padded, numbers, targets)))

    def loss():
        hidden = attention.Scorer(weights, np.zeros((attention.IDS, attention.IDS))).hidden(ids, texts)
        logits = hidden @ weights.classes + weights.class_bias
        chosen = logits[np.arange(50), targets[:50] // attention.MEMBERS]
        return -(chosen - np.log(np.exp(logits).sum(axis=1))).mean()

    for field in ("query", "key", "value", "classes", "distance", "class_bias"):
        array = getattr(weights, field)
        place = tuple(random.integers(0, n) for n in array.shape)
        if field == "distance":
            place = (2,)
        array[place] += 1e-4
        up = loss()
        array[place] -= 2e-4
        down = loss()
        array[place] += 1e-4
        assert slopes[field][place] == pytest.approx((up - down) / 2e-4, rel=0.05, abs=2e-5), field


def test_slopes_are_summed_by_id_in_their_order():
    random = np.random.default_rng(6)
    ids = random.integers(0, 40, 3000)
    rows = random.standard_normal((3000, attention.WIDTH)).astype(np.float32)
    want = np.zeros((attention.IDS, attention.WIDTH), np.float32)
    np.add.at(want, ids, rows)
    assert (attention._sums_by_id(ids, rows) == want).all()


def test_attention_scores_each_text_by_itself_and_whole(vocabulary):
    scorer = attention.Scorer(attention.Weights.initial(), np.zeros((attention.IDS, attention.IDS), np.float32))
    random = np.random.default_rng(5)
    ids = random.integers(0, attention.IDS, 100)
    together = scorer.log10(ids, np.repeat([0, 1], 50), ids)
    assert np.allclose(scorer.log10(ids[:50], np.zeros(50, int), ids[:50]), together[:50], atol=1e-5)
    changed = ids.copy()
    changed[40:] = 3
    hidden = scorer.hidden(ids, np.zeros(100, int)), scorer.hidden(changed, np.zeros(100, int))
    assert np.allclose(hidden[0][:40], hidden[1][:40], atol=1e-5)
    inner = random.integers(0, 5, (attention.IDS, attention.IDS)).astype(float)
    table = attention.member_table(inner, np.ones(attention.IDS), np.ones(attention.IDS))
    sums = np.exp(table).reshape(attention.IDS, attention.CLASSES, -1).sum(axis=2)
    assert np.allclose(sums, 1, atol=1e-4)


def test_base_scores_equal_brute_force(spark, odd, none, vocabulary):
    ranks = vocabulary[0]
    rows = odd.withColumn("held", F.col("doc_id").isin(3, 5))
    found = attention.score_texts(rows, "held", ranks).collect()
    counts = Counter()
    for doc, text, *_ in ODD:
        if doc not in (3, 5) and doc is not None:
            counts.update([*(text or "").encode().lower().split(), b""])
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for doc, text, *_ in ODD:
        words = [*(text or "").encode().lower().split(), b""]
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        want[doc, len(words), sum(counts[w] > 0 for w in words), round(base, 4)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in found) == want
    assert {r.train_tokens for r in found} == {total}
    assert all(np.isfinite([r.score, r.attention_score]).all() for r in found)
    assert attention.score_texts(none.withColumn("held", F.lit(False)), "held", ranks).count() == 0


def test_model_beats_the_base_on_held_out_texts(spark):
    scores = queries.op6_attention(spark, "/root/testdata/sf0.01").filter("held_out")
    score, base = scores.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


@pytest.mark.parametrize("range_bytes", [64, 1000, 1 << 24])
def test_archives_round_trip_at_any_split(spark, range_bytes):
    pages = [(i, f"http://x/{i}", f"<p>{'payload é ' * (i % 7)}{i % 11}</p>") for i in range(60)]
    pages += [(60, None, None), (61, "u\r\nInjected: x", ""), (5, "again", pages[5][2]), (None, "n", pages[3][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    found = warc.archive(df, range_bytes).collect()
    assert len(found) == len(pages)
    first = {}
    for page, _, html in pages:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    want = Counter()
    for page, _, html in pages:
        payload = (html or "").encode()
        to = None if first[html or ""] == page else first[html or ""]
        kind = "response" if to is None else "revisit"
        want[page, len(payload), warc.payload_digest(payload), kind, to, payload if to is None else None] += 1
    assert want == Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is None or r.payload else b"")
        for r in found
    )
    assert warc.archive(df.limit(0)).count() == 0


def test_damaged_members_are_passed_over():
    import io

    good = [warc.record(i, "u", b"x" * 50, warc.payload_digest(b"x" * 50), None, False) for i in range(3)]
    packed = [zlib.compress(x, wbits=31) for x in good]
    data = packed[0] + warc.MAGIC + b"junk" + packed[1][:-9] + packed[2]
    found = list(warc.records_from(warc.Source(io.BytesIO(data), len(data)), 0, len(data)))
    assert [fields["warc-record-id"] for _, fields, _ in found] == ["<urn:page:0>", "<urn:page:2>"]


def _deduped(docs):
    seen, out = {}, []
    for doc, text in sorted(docs, key=lambda x: (x[0] is None, x[0] or 0)):
        data = (text or "").encode()
        parts = spans.sentences(data)
        gone = set()
        for start, end in enumerate(spans.span_ends([len(w) for *_, w in parts])):
            key = b" ".join(w for *_, words in parts[start:end] for w in words)
            if seen.setdefault(key, (doc, text, start)) != (doc, text, start):
                gone.update(range(start, end))
        kept = b"".join(data[a:b] for i, (a, b, _) in enumerate(parts) if i not in gone).decode()
        out.append((doc, kept if parts else text or "", len(parts), len(gone)))
    return Counter(out)


def test_spans_equal_brute_force(spark, odd, none):
    random = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]

    def prose(n):
        return ". ".join(" ".join(random.choice(words, 6)) for _ in range(n)) + ". "

    passage = prose(10)
    bare = " ".join(random.choice(words, 70))
    docs = [(i, prose(5) + (passage if i % 2 else "") + prose(3)) for i in range(12)]
    docs += [(50 + i, prose(2)[:-2] + " " + bare + " " + prose(2)) for i in range(3)]
    docs += [(90, passage + passage), (91, "Same. " * 50), (92, None), (93, ""), (3, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = spans.dedup_spans(df).collect()
    assert Counter((r.doc_id, r.text or "", r.n_sentences, r.n_removed) for r in found) == _deduped(docs)
    texts = {r.doc_id: r.text for r in found}
    middle = passage[20:-20]
    assert sum(middle in (t or "") for t in texts.values()) == 1
    assert sum(" ".join(bare.split()[30:45]) in (t or "") for t in texts.values()) == 1
    assert all(texts[i] == dict(docs)[i] for i in (0, 2, 4))
    assert spans.dedup_spans(odd).count() == len(ODD)
    assert spans.dedup_spans(none).count() == 0


def _lost(one, other, passage):
    """Whether a span of two texts is equal inside the passage they share."""
    keys = []
    for text in (one, other):
        parts = spans.sentences(text.encode())
        ends = spans.span_ends([len(words) for *_, words in parts])
        keys.append({b" ".join(w for *_, words in parts[a:b] for w in words) for a, b in enumerate(ends)})
    inside = b" ".join(passage.encode().lower().split())
    return not any(key in inside for key in keys[0] & keys[1])


@pytest.mark.parametrize("stops", [0, 0.03, 0.08, 0.3])
def test_no_passage_of_51_words_is_missed(stops):
    random = np.random.default_rng(12)

    def prose(n):
        return [f"w{i}" + "." * int(random.random() < stops) for i in random.integers(0, 3000, n)]

    missed = 0
    for length in range(51, 61):
        for _ in range(100):
            passage = prose(length)
            texts = [
                " ".join(prose(int(random.integers(0, 90))) + passage + prose(int(random.integers(0, 90))))
                for _ in range(2)
            ]
            missed += _lost(*texts, " ".join(passage))
    assert missed == 0


def test_unpunctuated_passages_go_from_later_documents(spark):
    random = np.random.default_rng(13)
    words = [f"w{i}" for i in range(3000)]
    docs, shared = [], {}
    for group in range(100):
        passage = list(random.choice(words, 51 + group % 10))
        for copy in range(2):
            lead, rest = (list(random.choice(words, int(random.integers(30, 90)))) for _ in range(2))
            docs.append((2 * group + copy, " ".join(lead + passage + rest)))
            shared[2 * group + copy] = passage
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = spans.dedup_spans(df).collect()
    assert Counter((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in found) == _deduped(docs)
    for r in found:
        assert (r.n_removed > 0) == (r.doc_id % 2 == 1)
        assert r.n_removed or r.text == dict(docs)[r.doc_id]


def test_sentences_cover_a_text():
    for text in (" lead. One two! Three?\n\nfour", "x " * 100, "\n \n", "", "a.b.c no end"):
        parts = spans.sentences(text.encode())
        assert [b for _, b, _ in parts[:-1]] == [a for a, *_ in parts[1:]]
        if parts:
            assert (parts[0][0], parts[-1][1]) == (0, len(text.encode()))


def _reach(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_brute_force(spark):
    random = np.random.default_rng(7)
    edges = [tuple(map(int, random.integers(0, 300, 2))) for _ in range(200)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 50)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.root for r in found} == _reach(nodes, edges)


def test_embeddings_equal_brute_force(spark):
    random = np.random.default_rng(8)
    centres = random.standard_normal((40, 16))
    rows = []
    for i in range(600):
        value = centres[i % 40] + random.standard_normal(16) * random.choice([0.02, 0.09, 0.5])
        rows.append((i, value.astype(np.float32).tolist(), int(i % 40 % 3)))
    rows += [(1000 + i, rows[0][1], 0) for i in range(50)]
    rows += [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, rows[0][1], None), (2003, [float("nan")] * 16, 0)]
    rows += [(2004, [None] * 16, 0), (2005, [1.0], 0), (2006, [1e-30] * 16, 1), (2007, [1e30] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    good = {}
    for vec, value, label in rows:
        if value and label is not None and None not in value:
            array = np.array(value, np.float64)
            if np.isfinite(array).all() and array.any():
                good[vec] = (label, array / np.abs(array).max() / np.linalg.norm(array / np.abs(array).max()))
    links = [
        (a, b)
        for a, b in combinations(good, 2)
        if good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.93
    ]
    degree = Counter(n for pair in links for n in pair)
    roots = _reach([r[0] for r in rows], links)
    found = nndescent.near_duplicates(df).collect()
    assert len(found) == len(rows)
    wrong = [r for r in found if (r.n_links, r.component_id) != (degree[r.vec_id], roots[r.vec_id])]
    assert len(wrong) <= 0.02 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert all(r.n_links <= degree[r.vec_id] for r in found)
    assert nndescent.near_duplicates(df.limit(0)).count() == 0


def test_links_outside_a_hot_family_are_not_lost(spark, monkeypatch):
    random = np.random.default_rng(14)
    hot, others = random.standard_normal(16), random.standard_normal((100, 16))
    values = [hot + 0.02 * random.standard_normal(16) for _ in range(200)]
    values += [centre + 0.02 * random.standard_normal(16) for centre in others for _ in range(2)]
    values += list(random.standard_normal((200, 16)))
    rows = [(i, value.tolist(), 0) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    unit = np.array(values) / np.linalg.norm(values, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.93
    np.fill_diagonal(linked, False)
    roots = _reach(range(len(rows)), zip(*map(np.ndarray.tolist, np.nonzero(linked))))
    whole = nndescent.neighbour_lists

    def hot_only(vectors, *more):
        near = F.array(*map(F.lit, hot.tolist()))
        value = F.col("embedding")
        cos = F.aggregate(F.zip_with(value, near, lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
        size = F.sqrt(F.aggregate(value, F.lit(0.0), lambda x, y: x + y * y)) * float(np.linalg.norm(hot))
        inside = df.filter(cos / size >= 0.9).select(F.xxhash64("label", "embedding").alias("src"))
        return whole(vectors, *more).join(inside, "src", "left_semi")

    monkeypatch.setattr(nndescent, "neighbour_lists", hot_only)
    found = {r.vec_id: (r.n_links, r.component_id) for r in nndescent.near_duplicates(df).collect()}
    assert found == {i: (int(linked[i].sum()), roots[i]) for i in range(len(rows))}


def test_near_duplicates_equal_brute_force(spark, odd, none):
    random = np.random.default_rng(9)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for base in range(15):
        text = list(random.choice(words, 120))
        docs.append(" ".join(text))
        for _ in range(6):
            edited = list(text)
            for place in random.integers(0, 120, int(random.integers(0, 5))):
                edited[place] = "new"
            docs.append(" ".join(edited))
    docs += ["Three short words", "three  short\nwords", "", None, "a b c d e f", "a b c d e f g"]
    rows = [(i, text) for i, text in enumerate(docs)] + [(3, docs[3])]
    sets = {}
    for i, text in enumerate(docs):
        own = (text or "").encode().lower().split()
        sets[i] = {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()
    links = [
        (a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    roots = _reach(sets, links)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = minhash.near_duplicates(df).collect()
    want = Counter((i, len(sets[i]), roots[i], roots[i] == i) for i, _ in rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == want
    assert minhash.near_duplicates(odd).count() == len(ODD)
    assert minhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("threshold", [80, 85])
def test_leftover_texts_are_compared_exactly(spark, threshold):
    """The pass over unsettled buckets finds all links between different components alone."""
    random = np.random.default_rng(11)
    sets = {}
    for family in range(3):
        base = random.integers(-(1 << 62), 1 << 62, 100)
        for member in range(60):
            edits = int(random.integers(0, 25))
            own = np.concatenate([base[edits:], random.integers(-(1 << 62), 1 << 62, edits)])
            sets[bytes([family, member])] = set(own[int(random.integers(0, 4)) :].tolist())
    sets[b"one"], sets[b"two"] = {1}, {1, 2}
    roots = {name: bytes([name[0], name[1] % 7]) for name in sets}
    want = {
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if roots[a] != roots[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])
    }
    held = spark.createDataFrame(
        [(name, sorted(own)) for name, own in sets.items()], "digest binary, hashes array<bigint>"
    )
    unsettled = spark.createDataFrame(list(roots.items()), "digest binary, root binary")
    pairs = minhash._leftover_pairs(unsettled, held, threshold)
    assert pairs.count() == pairs.distinct().count()
    links = minhash._confirmed(pairs, held, threshold)
    assert want and {(bytes(r.a), bytes(r.b)) for r in links.collect()} == want


def test_sketch_of_few_and_many_values():
    random = np.random.default_rng(10)
    for size in (1, 2, 7, 100, 5000):
        values = np.unique(random.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
        made = minhash.sketch(values)
        assert len(made) == minhash.BINS and set(made.tolist()) <= set(values.tolist())
        assert (minhash.sketch(values.copy()) == made).all()
