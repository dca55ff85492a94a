import datetime

import pytest
from pyspark.sql import functions as F

from tripmart.operators.changes import add_versions, append_rows, latest_versions, new_rows, upsert

HISTORY = "id long, name string, place string, valid_from date, valid_to date, is_current boolean"
START, CHANGE = datetime.date(2020, 1, 1), datetime.date(2021, 1, 1)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id long, name string, place string")


def test_versions_open_and_close(spark, zones, rows):
    empty = spark.createDataFrame([], HISTORY)
    first = add_versions(empty, zones, "id", ["name", "place"], F.lit(START))
    assert first.filter("is_current").count() == 2
    incoming = spark.createDataFrame(
        [(1, "a", None), (2, "b", "y"), (3, "c", None)], "id long, name string, place string"
    )
    second = add_versions(first, incoming, "id", ["name", "place"], F.lit(CHANGE))
    expected = [
        (1, "a", None, START, None, True),
        (2, "b", "x", START, CHANGE, False),
        (2, "b", "y", CHANGE, None, True),
        (3, "c", None, CHANGE, None, True),
    ]
    assert rows(second) == rows(spark.createDataFrame(expected, HISTORY))
    third = add_versions(second, incoming, "id", ["name", "place"], F.lit(datetime.date(2022, 1, 1)))
    assert rows(third) == rows(second)


def test_upsert_replaces_by_key(spark, zones, rows):
    incoming = spark.createDataFrame([(2, "new", None), (9, "z", "q")], zones.schema)
    expected = [(1, "a", None), (2, "new", None), (9, "z", "q")]
    assert rows(upsert(zones, incoming, "id")) == rows(spark.createDataFrame(expected, zones.schema))


def test_rows_are_matched_by_column_name(spark, zones, rows):
    turned = zones.select("place", "name", "id")
    assert new_rows(zones, turned).count() == 0
    assert append_rows(zones, turned).count() == 4
    doubled = zones.union(zones)
    assert new_rows(doubled, zones.limit(0)).count() == 2


def test_latest_version_wins(spark):
    history = spark.createDataFrame([(1, "old", 0), (1, None, 2), (2, "b", 1)], "id int, name string, v int")
    found = {row["id"]: row["name"] for row in latest_versions(history, "id", "v").collect()}
    assert found == {1: None, 2: "b"}
