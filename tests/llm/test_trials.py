"""Trials that once gave wrong results: two vocabularies, reopened indexes, rows without key, odd names."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import attention, bpe, language, lines, minhash, nndescent, packing, spans
from tripmart.storage import new_folder


def test_two_vocabularies_of_one_size_in_one_session(spark):
    single = {bytes((i,)): i for i in range(256)}
    docs = spark.createDataFrame([(1, "abcd")], "doc_id long, text string").coalesce(1)
    for token, want in ((b"ab", [256, 99, 100]), (b"cd", [97, 98, 256]), (b"ab", [256, 99, 100])):
        ranks = single | {token: 256}
        found = bpe.encode(docs, ranks, r"\w+")
        assert found.first()["ids"] == want
        assert bpe.decode(found, ranks).first()["decoded"] == b"abcd"


LINE = "a line that is long enough to be counted, number {}"


def _held(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_a_reopened_line_index_goes_on(spark, monkeypatch):
    monkeypatch.setattr(lines, "COMPACT_AFTER", 3)
    folder = new_folder(spark, "index")
    first = [(i, "\n".join(LINE.format(n) for n in range(i % 3 + 1))) for i in range(6)]
    more = [(10 + i, LINE.format(0)) for i in range(4)]
    index = lines.LineIndex(spark, folder)
    index.insert(_held(spark, first))
    index.refresh()
    index = lines.LineIndex(spark, folder)  # as another session opens it
    index.insert(_held(spark, more))
    index.refresh()
    counts = Counter(row["n_docs"] for row in lines.LineIndex(spark, folder).counts().collect())
    assert counts == Counter([10, 4, 2])
    index = lines.LineIndex(spark, folder)
    index.delete(_held(spark, more))
    index.insert(_held(spark, more[:1]))  # the log was summed up meanwhile
    index = lines.LineIndex(spark, folder)
    index.refresh()
    assert Counter(row["n_docs"] for row in index.counts().collect()) == Counter([7, 4, 2])
    docs = _held(spark, first + more[:1])
    got = Counter(map(tuple, lines.clean(docs, index.drops(docs)).collect()))
    assert got == Counter(map(tuple, lines.dedup_lines(docs).collect()))
    with pytest.raises(ValueError, match="not inserted"):
        index.delete(_held(spark, more[1:]))
    with pytest.raises(ValueError, match="not inserted"):
        index.delete(_held(spark, more[:1] + more[:1]))
    assert Counter(row["n_docs"] for row in index.counts().collect()) == Counter([7, 4, 2])


def _words(seed, count=60):
    own = random.Random(seed)
    return " ".join("".join(own.choices("abcdefgh", k=6)) for _ in range(count))


def test_rows_without_key_meet_by_their_text(spark):
    base = _words(1, 120)
    near = [(None, base + f" tail{i}") for i in range(300)]
    docs = [*near, (None, base), (None, base), (7, base + " more"), (None, _words(2)), (None, None)]
    found = minhash.near_duplicates(_held(spark, docs).repartition(3)).collect()
    assert len(found) == len(docs)
    assert sum(row["component_id"] == 7 for row in found) == 303
    assert sum(row["kept"] for row in found) == 3


def test_pipeline_drops_near_duplicates_by_row(spark):
    base, clean, other = _words(3, 120), _words(4), _words(5)
    docs = [
        (1, base), (2, base + " x"), (2, clean), (None, other), (None, other), (9, _words(6)), (9, _words(6)),
        (4, ""), (4, ""), (5, None),
    ]
    rows = [(*doc, 1, 2, 3, 4) for doc in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, root int, mark int, first int, c0 int")
    kept = corpus_pipeline.dedup_near(spark, df.repartition(4), "")
    assert kept.columns == df.columns
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    assert found == Counter(
        [(1, base), (2, clean), (None, other), (9, _words(6)), (4, ""), (4, ""), (5, None)]
    )
    assert kept.filter("root <> 1 or mark <> 2 or first <> 3 or c0 <> 4").isEmpty()


NAMES = (
    "_lost_keys _span_places _span_document n_lines n_dropped n_sentences n_removed keys places document mark "
    "lang_pred score accepted _lang_pred key block"
).split()


def test_columns_of_any_name_come_along(spark):
    docs = [(i, "\n".join([LINE.format(1), _words(10 + i), _words(99)])) for i in range(12)]
    df = _held(spark, docs).withColumn("lang", F.lit("en"))
    df = df.withColumns({name: F.lit(7) for name in NAMES})
    stages = corpus_pipeline.dedup_lines, corpus_pipeline.dedup_spans, corpus_pipeline.identify_language
    for stage in stages:
        kept = stage(spark, df, "")
        assert kept.columns == df.columns
        assert kept.filter(" or ".join(f"{name} <> 7" for name in NAMES)).isEmpty(), stage
    plain = df.drop("n_lines", "n_dropped", "n_sentences", "n_removed")
    assert lines.dedup_lines(plain).filter("n_dropped > 0").count() == 11
    assert spans.dedup_spans(plain).filter("n_removed > 0").count() == 11


def test_packing_wastes_least_at_any_length():
    own = np.random.default_rng(1)
    for _ in range(15):
        counts = Counter((own.integers(1, 12, 14) ** 3 * 7).tolist())
        tops = sorted(counts)
        for buckets in (1, 2, 3, 4):
            ends = packing.boundaries(tops, [counts[x] for x in tops], buckets)
            assert set(ends) <= set(tops) and ends[-1] == tops[-1] and len(ends) <= buckets

            def cost(chosen):
                return sum(n * min(end for end in chosen if end >= x) for x, n in counts.items())

            tried = [
                cost((*some, tops[-1]))
                for size in range(min(buckets, len(tops)))
                for some in combinations(tops[:-1], size)
            ]
            assert cost(ends) == min(tried)
    tops = list(range(1, 5000))
    assert len(packing.boundaries(tops, [1] * len(tops), 16)) == 16


def test_packed_rows_are_padded_to_the_longest_of_their_bucket(spark):
    rows = [(i, 300 + 37 * (i % 50)) for i in range(500)] + [(1000, -5), (1001, None)]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, n_tokens int")).collect()
    longest = {}
    for row in found:
        longest[row.bucket_length] = max(longest.get(row.bucket_length, 0), row.n_tokens)
    assert all(length == most for length, most in longest.items())
    assert sorted(row.n_tokens for row in found)[:2] == [0, 0]


def test_few_documents_reject_nothing_lettered(spark):
    docs = [(f"some words of a text {i}", "en") for i in range(10)] + [(f"quelques mots {i}", "fr") for i in range(5)]
    model = language.fit(spark.createDataFrame(docs, "text string, lang string"))
    assert model.threshold == 0.0
    assert model.predict("zzqx vvkj")[2] and not model.predict("12 34")[2]
    assert language.fit(spark.createDataFrame([], "text string, lang string")).languages == []


def test_attention_learns_from_a_share_that_grows(spark, monkeypatch):
    monkeypatch.setattr(attention, "SHARE", 4)
    monkeypatch.setattr(attention, "LEAST_SAMPLE", 10)
    monkeypatch.setattr(attention, "PART_BYTES", 2000)
    ranks = {bytes((i,)): i for i in range(256)}
    sizes = []
    for count in (20, 400, 800):
        docs = _held(spark, [(i, _words(i, 10)) for i in range(count)] + [(5000, "hot")] * 50)
        ids, parts = attention.sampled_ids(docs, ranks)
        assert ids.count() == ids.distinct().count()
        sizes.append((ids.count(), parts))
    assert 0 < sizes[0][0] < 25 and 70 < sizes[1][0] < 130 and 160 < sizes[2][0] < 240
    assert sizes[2][1] > sizes[1][1] > 1
    docs = _held(spark, [(i, _words(i, 10)) for i in range(100)])
    one, two = attention.fit(docs.repartition(2), ranks), attention.fit(docs.repartition(7), ranks)
    assert all((x == y).all() for x, y in zip(one.arrays(), two.arrays()))
    assert any((x != y).any() for x, y in zip(one.arrays(), attention.Weights.initial().arrays()))


def test_attention_learns_from_every_training_text(spark, monkeypatch):
    monkeypatch.setattr(attention, "PART_BYTES", 20_000)
    monkeypatch.setattr(attention, "FEW_BYTES", 1_000)
    ranks = {bytes((i,)): i for i in range(256)}
    seen = spark.sparkContext.accumulator(0)
    train = attention.train

    def counted(texts, *rest):
        seen.add(sum(map(len, texts)))
        return train(texts, *rest)

    monkeypatch.setattr(attention, "train", counted)
    rows = [(i, _words(i, 10)) for i in range(3000)] + [(5000 + i, "hot") for i in range(500)] + [(None, None)]
    attention.fit(_held(spark, rows), ranks)
    subwords = attention.Subwords(ranks)
    ids = sum(len(subwords[word]) // 2 for _, text in rows for word in [*attention.words_of(text), b""])
    assert seen.value == ids


def test_scoring_learns_from_every_training_text_in_every_round(spark, monkeypatch):
    monkeypatch.setattr(attention, "PART_BYTES", 20_000)
    monkeypatch.setattr(attention, "FEW_BYTES", 1_000)
    ranks = {bytes((i,)): i for i in range(256)}
    seen = [spark.sparkContext.accumulator(0) for _ in range(attention.ROUNDS)]
    train = attention.train

    def counted(texts, weights, number):
        seen[number].add(sum(map(len, texts)))
        return train(texts, weights, number)

    monkeypatch.setattr(attention, "train", counted)
    rows = [(i, _words(i, 10)) for i in range(3000)] + [(5000 + i, "hot") for i in range(500)] + [(None, None)]
    docs = _held(spark, rows).withColumn("held", F.expr("coalesce(doc_id % 7 = 0, false)"))
    attention.score_texts(docs, "held", ranks).collect()
    learned = [text for doc, text in rows if doc is None or doc % 7]
    subwords = attention.Subwords(ranks)
    ids = sum(len(subwords[word]) // 2 for text in learned for word in [*attention.words_of(text), b""])
    assert [one.value for one in seen] == [ids] * attention.ROUNDS


def test_scoring_spells_each_word_of_a_block_once(spark, monkeypatch):
    ranks = {bytes((i,)): i for i in range(256)}
    asked = spark.sparkContext.accumulator(0)
    speller = attention.speller

    def counted(ranks):
        spell = speller(ranks)

        def one(word):
            asked.add(1)
            return spell(word)

        return one

    def again(*_):
        raise AssertionError("texts are spelled again")

    monkeypatch.setattr(attention, "speller", counted)
    monkeypatch.setattr(attention, "spelled_texts", again)
    monkeypatch.setattr(attention, "slices", lambda *_: 3)
    monkeypatch.setattr(attention, "SENT_WORDS", 30)
    rows = [(i, _words(i % 40, 10) + " common") for i in range(200)] + [(500, None), (501, ""), (None, "alone")]
    docs = _held(spark, rows).withColumn("held", F.expr("doc_id % 7 = 0"))
    blocks = docs.select(F.pmod(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), F.lit(3)), "text").collect()
    want = {(block, word) for block, text in blocks for word in [*attention.words_of(text), b""]}
    found = {row["doc_id"]: row for row in attention.score_texts(docs, "held", ranks).collect()}
    assert asked.value == len(want)
    assert {doc: row["n_tokens"] for doc, row in found.items()} == {
        doc: len(attention.words_of(text)) + 1 for doc, text in rows
    }
    assert found[1]["n_known"] == 12 and found[None]["n_known"] == 1


def test_attention_deletes_what_a_round_has_moved(spark, monkeypatch):
    monkeypatch.setattr(attention, "PART_BYTES", 20_000)
    monkeypatch.setattr(attention, "FEW_BYTES", 1_000)
    ranks = {bytes((i,)): i for i in range(256)}

    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name.split("_")[1] for name in blocks.mkString(",").split(",") if name.startswith("shuffle_")}

    docs, before = _held(spark, [(i, _words(i, 10)) for i in range(3000)]), shuffles()
    attention.fit(docs, ranks)
    assert len(shuffles() - before) <= 1  # that of the sum of all sizes
    words = spark.createDataFrame([(bytearray(b"ab"), 2), (bytearray(b"b"), 1)], "word binary, c bigint")
    before = shuffles()
    inner, first, last = attention.count_pairs(attention.spelled_words(words, ranks))
    assert not shuffles() - before
    assert inner.sum() == 5 and first.sum() == last.sum() == 3


def test_shingle_sets_are_sent_on_in_bounded_batches():
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(4000)]
    digests = [minhash.set_digest(minhash.shingles(text, minhash.WordHashes())) for text in texts]
    digests[7] = digests[6]
    names = ["doc_id", "text", "digest"]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array(digests)], names=names)
    ]
    found = list(minhash._sets(iter(batches)))
    assert [d for batch in found for d in batch.column(0).to_pylist()] == digests[:7] + digests[8:]
    assert max(batch.nbytes for batch in found) < 5 << 20 and len(found) > 2
    assert [batch.num_rows for batch in minhash._sets(iter(batches[:0]))] == [0]


def test_every_room_has_trees_of_its_own_depth(spark, monkeypatch):
    monkeypatch.setattr(nndescent, "LEAF", 2)
    seen = []
    grown = nndescent._grown
    monkeypatch.setattr(nndescent, "_grown", lambda sized, trees: seen.append(sized) or grown(sized, trees))
    own = np.random.default_rng(2)
    rows = [(i, own.standard_normal(4).tolist(), i // 8) for i in range(1200 * 8)]
    rows += [(10**6 + i, own.standard_normal(4).tolist(), 10**6) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long").repartition(4)
    values = np.array([row[1] for row in rows])
    values /= np.linalg.norm(values, axis=1)[:, None]
    found = {row["vec_id"]: row["n_links"] for row in nndescent.near_duplicates(df).collect()}
    depths = Counter(row["depth"] for row in seen[0].select("room", "depth").distinct().collect())
    assert depths == {3: 1200, 1: 1}
    want = 0
    for room in range(1200):
        cos = values[room * 8 : room * 8 + 8] @ values[room * 8 : room * 8 + 8].T
        want += int((cos >= nndescent.THRESHOLD).sum()) - 8
    links = sum(n for key, n in found.items() if key < 10**6)
    assert len(found) == len(rows) and 0.97 * want <= links <= want
