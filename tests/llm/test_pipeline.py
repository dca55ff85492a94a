"""The queries against their SQL over whole tables, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    found = queries.QUERIES[name](spark, SF).toArrow()
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        connection.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = connection.sql(queries.ORACLES[name]).to_arrow_table()
    columns = sorted(want.column_names)
    kinds = {field.name: str(field.type).removeprefix("large_") for field in found.schema}
    assert kinds == {field.name: str(field.type).removeprefix("large_") for field in want.schema}

    def rows(table):
        return sorted(map(tuple, zip(*(table.column(c).to_pylist() for c in columns))), key=repr)

    assert rows(found) == rows(want)


def test_stages_keep_columns_and_act(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    odd = spark.createDataFrame([(10**6, None, "en", "s", 0), (None, "12 34", None, None, None)], docs.schema)
    docs = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == columns, name
        rows = kept.collect()
        before = docs.count()
        assert 0 < len(rows) <= before
        if name == "language":
            assert len(rows) == before - 2
        if name in ("line_dedup", "span_dedup"):
            assert len(rows) == before
        if name == "near_dedup":
            assert len(rows) < before
        docs = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.count() == docs.count() == packed.select("doc_id").distinct().count()
    assert packed.filter(F.col("n_tokens") > F.col("bucket_length")).isEmpty()


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_after = stage(spark, docs, SF)
        assert docs_after.count() == 0
