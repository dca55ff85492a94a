"""The corpus operators as queries over whole tables, and the SQL that some must equal."""

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    attention,
    bpe,
    fingerprints,
    language,
    lines,
    minhash,
    nndescent,
    packing,
    prefixes,
    ranked,
    spans,
    suffixes,
    warc,
)
from tripmart.llm.common import crc_rest

RANKS = "byte_bpe_multi_50k.tiktoken"


def vocabulary() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public vocabulary, read where the driver runs."""
    public = import_module("public_tokenizers")
    return bpe.read_ranks(public.path(RANKS)), public.PATTERN


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def word_count(text: str) -> Column:
    r"""Number of words ``[^\x20\x09-\x0D]+``, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary()
    ids = bpe.encode(_table(spark, sf_dir, "documents"), ranks, pattern)
    decoded = bpe.decode(ids, ranks)
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs.select("doc_id", word_count("text").alias("n_tokens")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", _sha256(F.col("text")).alias("kept_sha256")
    )


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprints.compare_with_next(_table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        "n_chars",
        _sha256(F.col("edited")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_rest("doc_id", 4) == 2
    model = language.fit(docs.filter(~held_out))
    found = language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op6_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_rest("doc_id", 10) == 0
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return attention.score_texts(rows, "held_out", vocabulary()[0])


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archive(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.dedup_spans(docs)


def op9_nndescent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nndescent.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), threshold_percent=85)


def op11_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.drop_repeated(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_fingerprint": op4_fingerprint,
    "op5_language": op5_language,
    "op6_attention": op6_attention,
    "op7_warc": op7_warc,
    "op8_spans": op8_spans,
    "op9_nndescent": op9_nndescent,
    "op10_minhash": op10_minhash,
    "op11_prefixes": op11_prefixes,
    "op12_suffixes": op12_suffixes,
    "op13_ranked": op13_ranked,
    "pipeline": pipeline,
}

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINES_SQL = f"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
lines as (
  select doc_id, unnest(parts) as line, unnest(range(len(parts))) as place from split),
keyed as (
  select *, {_LOWER.format(f"trim(line, {_SPACES})")} as k from lines),
dense as (
  select k, max(doc_id) as last_doc from keyed where length(k) >= 40
  group by k having count(distinct doc_id) >= 5),
marked as (
  select keyed.*, dense.k is not null and dense.last_doc <> doc_id as lost
  from keyed left join dense on keyed.k = dense.k)
select doc_id, count(*) as n_lines, cast(sum(cast(lost as int)) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not lost), ''))
         as kept_sha256
from marked group by doc_id"""

_DIGIT = " + ".join(
    f"cast(substr(bits, 5 * i + {place}, 1) as int) * {1 << (5 - place)}" for place in range(1, 6)
)
_WARC_SQL = f"""
with sized as (
  select page_id, coalesce(html, '') as payload from pages),
hashed as (
  select page_id, strlen(payload) as payload_bytes, payload,
         cast(cast(unhex(sha1(payload)) as bit) as varchar) as bits,
         min(page_id) over (partition by payload) as first_page
  from sized)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
       array_to_string(list_transform(range(32),
         lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {_DIGIT}, 1)), '')
         as payload_digest,
       case when page_id = first_page then 'response' else 'revisit' end as record_type,
       case when page_id <> first_page then first_page end as refers_to
from hashed"""

_REACH_SQL = """,
reach(node, other) as (
  select id, id from nodes
  union
  select reach.node, links.b from reach join links on reach.other = links.a)"""

_NEAREST_SQL = f"""
with recursive nodes as (select vec_id as id from embeddings),
usable as (
  select vec_id, label, cast(embedding as double[]) as v from embeddings
  where label is not null and embedding is not null),
links as (
  select one.vec_id as a, two.vec_id as b
  from usable one join usable two on one.label = two.label and one.vec_id <> two.vec_id
  where list_cosine_similarity(one.v, two.v) >= 0.93){_REACH_SQL}
select node as vec_id,
       (select count(*) from links where links.a = node) as n_links,
       min(other) as component_id, node = min(other) as kept
from reach group by node"""

_MINHASH_SQL = f"""
with recursive nodes as (select doc_id as id from documents),
worded as (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
    '[^\\x20\\x09-\\x0D]+') as w from documents),
shingled as (
  select distinct doc_id, unnest(case
    when len(w) = 0 then []
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))
    end) as s from worded),
sizes as (select doc_id, count(*) as n from shingled group by doc_id),
common as (
  select one.doc_id as a, two.doc_id as b, count(*) as n
  from shingled one join shingled two on one.s = two.s and one.doc_id <> two.doc_id
  group by one.doc_id, two.doc_id),
links as (
  select a, b from common join sizes sa on sa.doc_id = a join sizes sb on sb.doc_id = b
  where 100 * common.n >= 85 * (sa.n + sb.n - common.n)){_REACH_SQL}
select node as doc_id, coalesce((select n from sizes where sizes.doc_id = node), 0) as n_shingles,
       min(other) as component_id, node = min(other) as kept
from reach group by node"""

_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda x: ascii(x)::bigint)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), range(8)),
      lambda r, i: case when r % 2 = 1 then xor(r // 2, 3988292384) else r // 2 end)))"""
_PREFIXES_SQL = f"""
with turns as (
  select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
named as (
  select c, dense_rank() over (order by role, text) as name, length(text) as chars,
         row_number() over (partition by c order by turn nulls first,
           sha256(concat(length(role), ':', role, text))) as pos
  from turns),
seqs as (select c, list(name order by pos) as s, list(chars order by pos) as l from named group by c),
family as (select *, c - c % 100 as b, {_CRC32.format("cast(c as varchar)")} % 6 as h from seqs),
rebuilt as (
  select own.c, list_concat(coalesce(base.s[1:h], []), own.s[h + 1:]) as s,
         list_concat(coalesce(base.l[1:h], []), own.l[h + 1:]) as l
  from family own left join seqs base on base.c = own.b),
members as (
  select c, d, s[1:d] as p, case when d > 0 then l[d] else 0 end as chars, d = len(s) as ended
  from (select *, unnest(range(0, len(s) + 1)) as d from rebuilt)),
nodes as (
  select p, any_value(d) as d, min(c) as conv_id, count(*) as n_convs, any_value(chars) as chars,
         coalesce(string_agg(cast(c as varchar), ',' order by c) filter (where ended), '') as ends
  from members group by p),
kids as (select p[1:d - 1] as p, count(*) as n from nodes where d > 0 group by 1),
below as (
  select top, sum((n_convs - 1) * chars) as saved, count(*) filter (where kids.n is null) as leaves
  from (select nodes.*, unnest(list_transform(range(0, d + 1), lambda i: p[1:i])) as top from nodes) u
  left join kids on kids.p = u.p group by top)
select nodes.conv_id, cast(nodes.d as bigint) as depth, above.conv_id as parent_conv_id, nodes.n_convs,
       coalesce(kids.n, 0) as n_children, leaves as n_leaves, cast(saved as bigint) as saved_tokens,
       sha256(nodes.ends) as ends_sha256
from nodes join below on below.top = nodes.p left join kids on kids.p = nodes.p
left join nodes above on nodes.d > 0 and above.p = nodes.p[1:nodes.d - 1]"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_RANKED_SQL = f"""
with held as (
  select doc_id, row_number() over () as r,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') as w from documents),
docs as (select doc_id, r, cast(len(w) as bigint) as n, w from held where len(w) > 0),
total as (select count(*) as docs, cast(sum(n) as bigint) as words from docs),
wanted as (
  select distinct item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) as t
  from benchmark),
counted as (
  select r, t, count(*) as tf from (select r, unnest(w) as t from docs)
  where t in (select t from wanted) group by r, t),
weights as (
  select t, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double) / cast(2 * count(*) + 1 as double)))
    as bigint) as weight
  from counted, total group by t),
sized as (select r, doc_id, 50 + (50 * n * docs) // words as m from docs, total),
scored as (
  select item_id, r, any_value(doc_id) as doc_id,
         cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
  from wanted join counted using (t) join weights using (t) join sized using (r)
  group by item_id, r),
placed as (
  select item_id, doc_id, score,
         cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from placed where rank <= 50"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": _LINES_SQL,
    "op7_warc": _WARC_SQL,
    "op9_nndescent": _NEAREST_SQL,
    "op10_minhash": _MINHASH_SQL,
    "op11_prefixes": _PREFIXES_SQL,
    "op13_ranked": _RANKED_SQL,
}
