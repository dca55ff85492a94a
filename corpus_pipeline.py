"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but
the last return the columns of documents.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import language, lines, minhash, packing, spans
from tripmart.llm.common import crc_rest, stored
from tripmart.llm.queries import word_count


def _by_place(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """Documents with columns named by place, so that no operator meets a name of its own."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    return plain, f"c{names.index('doc_id')}", f"c{names.index('text')}"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted; those without a letter go too.

    The model learns from labelled documents outside the held-out fourth.
    """
    model = language.fit(docs.filter(crc_rest("doc_id", 4) != 2))
    plain, _, text = _by_place(docs)
    found = language.identify(plain, model, text)
    return found.filter("accepted").select(*plain.columns).toDF(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many documents share; every document stays."""
    plain, key, text = _by_place(docs)
    return lines.dedup_lines(plain, key, text).select(*plain.columns).toDF(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id.

    Rows are told apart by doc_id and text: a clean one stays whatever shares its doc_id.
    """
    return minhash.drop_near_duplicates(docs)


def dedup_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand earlier in the corpus; every document stays."""
    plain, key, text = _by_place(docs)
    return spans.dedup_spans(plain, key, text).select(*plain.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and the place in it of every document."""
    return packing.pack(docs.select("doc_id", word_count("text").alias("n_tokens")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("span_dedup", dedup_spans),
    ("packing", pack),
]

# Language identification and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
