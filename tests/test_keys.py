import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmart.operators.filters import valid_trips
from tripmart.operators.keys import assign_key, next_key, number_rows
from tripmart.plans.warehouse import PAIR, distinct_pairs
from tripmart.storage import new_folder


@pytest.fixture(scope="module")
def expected(raw, rows):
    numbers = F.row_number().over(Window.orderBy(*PAIR)) + 99
    return rows(distinct_pairs(valid_trips(raw)).withColumn("id", numbers.cast("long")))


@pytest.mark.parametrize("partitions", ["1", "7", "200"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_key_is_the_global_row_number(spark, raw, rows, conf, expected, partitions, adaptive):
    conf(spark__sql__shuffle__partitions=partitions, spark__sql__adaptive__enabled=adaptive)
    pairs = distinct_pairs(valid_trips(raw))
    keyed, following = assign_key(pairs, PAIR, "id", 100, new_folder(spark, "keys"))
    assert rows(keyed) == expected
    assert following == 100 + len(expected)


def test_equal_rows_get_different_keys(spark):
    same = spark.range(1000).select(F.lit(1).alias("a"))
    keyed, following = assign_key(same, ["a"], "id", 0, new_folder(spark, "keys"))
    assert sorted(row["id"] for row in keyed.collect()) == list(range(1000))
    assert following == 1000


def test_row_numbers_do_not_depend_on_how_files_are_split(spark, raw, rows, conf):
    def numbered():
        keyed, following = number_rows(raw, raw, "id", 5, new_folder(spark, "offsets"))
        return rows(keyed), following

    whole = numbered()
    conf(spark__sql__files__maxPartitionBytes="4096", spark__sql__files__openCostInBytes="0")
    assert numbered() == whole
    assert whole[1] == 5 + raw.count()


def test_next_key(spark, raw):
    assert next_key(spark.createDataFrame([], "id long"), "id") == 0
    assert next_key(spark.createDataFrame([], "id long"), "id", 1) == 1
    assert next_key(spark.range(12), "id") == 12


def test_no_rows(spark, raw):
    nothing = distinct_pairs(raw.limit(0))
    keyed, following = assign_key(nothing, PAIR, "id", 3, new_folder(spark, "keys"))
    assert keyed.count() == 0
    assert following == 3
