import math
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripmart.functions.calendar import code_label, in_years, weekday_name
from tripmart.functions.sums import exact_sum, exact_total
from tripmart.schemas import VENDOR_NAMES


def test_exact_sum_equals_a_decimal_sum(raw, rows):
    names = ["fare_amount", "tip_amount", "total_amount", "trip_distance"]
    found = raw.groupBy("payment_type").agg(*(exact_sum(n).alias(n) for n in names))
    decimals = raw.groupBy("payment_type").agg(
        *(F.sum(F.col(n).cast("decimal(18,4)")).cast("decimal(26,4)").alias(n) for n in names)
    )
    assert rows(found) == rows(decimals)


def test_exact_sum_does_not_depend_on_order(spark):
    amounts = spark.createDataFrame([(v,) for v in (1e11, 0.1, -1e11, 0.2, -0.3, 1.2345)], "x double")
    total = amounts.repartition(3).agg(exact_sum("x")).first()[0]
    assert total == Decimal("1.2345")
    assert amounts.limit(0).agg(exact_sum("x")).first()[0] is None


def test_exact_sum_keeps_digits_beyond_the_fourth(spark):
    small = spark.range(1000).select(F.lit(0.00004).alias("x")).repartition(4)
    assert small.agg(exact_sum("x")).first()[0] == Decimal("0.04")


def test_exact_total_passes_endless_amounts_through(spark):
    inf = float("inf")
    groups = {"a": [1.5, inf], "b": [inf, -inf, 1.0], "c": [float("nan"), 2.0], "d": [0.1, 0.2, None], "e": [None]}
    df = spark.createDataFrame([(k, v) for k, own in groups.items() for v in own], "k string, x double")
    found = {r.k: r.total for r in df.groupBy("k").agg(exact_total("x").alias("total")).collect()}
    assert found["a"] == inf and math.isnan(found["b"]) and math.isnan(found["c"])
    assert found["d"] == 0.3 and found["e"] is None


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("amounts", [[5e14, 5e14], [1e16, -1e16]])
def test_totals_out_of_range_raise_in_any_mode(spark, ansi, amounts):
    df = spark.createDataFrame([(v,) for v in amounts], "x double").repartition(2)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            df.agg(exact_total("x")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_weekday_names(spark):
    days = spark.range(1, 8).select(weekday_name(F.col("id").cast("int")).alias("day"))
    assert [row["day"] for row in days.collect()] == [
        "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
    ]


def test_unknown_code_has_no_label(spark):
    labels = spark.range(4).select(code_label(F.col("id"), VENDOR_NAMES).alias("name")).collect()
    assert [row["name"] for row in labels] == [None, *VENDOR_NAMES.values(), None]


@pytest.mark.parametrize("ts, inside", [
    ("1996-12-31 23:59:59.999999", False),
    ("1997-01-01 00:00:00", True),
    ("1998-12-31 23:59:59.999999", True),
    ("1999-01-01 00:00:00", False),
])
def test_year_range_edges(spark, ts, inside):
    one = spark.range(1).select(F.lit(ts).cast("timestamp_ntz").alias("ts"))
    assert one.select(in_years(F.col("ts"), 1997, 1998)).first()[0] is inside
