"""The physical plans that matter at scale."""

from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.checks import fixtures
from tripmart.checks.queries import QUERIES
from tripmart.operators.filters import paid, picked_up_in, valid_trips
from tripmart.operators.joins import hot_keys
from tripmart.operators.keys import number_rows
from tripmart.operators.sinks import write_bucketed, write_parquet
from tripmart.plans import marts
from tripmart.plans.models import trip_features
from tripmart.plans.warehouse import PAIR, build_dim_datetime, build_fact, counted_pairs
from tripmart.storage import new_folder

from conftest import SF_DIR


def test_filters_reach_the_scan(raw, plan):
    text = plan(valid_trips(raw, (1997, 1997)))
    for pushed in (
        "GreaterThan(trip_distance,0.0)",
        "GreaterThan(passenger_count,0)",
        "GreaterThanOrEqual(tpep_pickup_datetime,1997-01-01T00:00)",
        "LessThan(tpep_pickup_datetime,1998-01-01T00:00)",
    ):
        assert pushed in text
    assert "Not(In(payment_type, [4,6]))" in plan(paid(raw))


def test_year_range_equals_year(raw):
    by_year = raw.filter(F.year("tpep_pickup_datetime").between(1996, 1998)).count()
    assert picked_up_in(raw, 1996, 1998).count() == by_year > 0


def test_reports_read_few_columns_and_join_no_large_table(warehouse, plan):
    for report in (marts.trips_per_day, marts.trips_per_hour, marts.agg_total):
        text = plan(report(warehouse))
        assert "Join" not in text
        assert "trip_id" not in text
    assert "ReadSchema: struct<pick_hour:double>" in plan(marts.trips_per_hour(warehouse))
    for report in (marts.trips_per_pu_location, lambda w: marts.agg_per_year(marts.paid_totals(w))):
        assert "dim_datetime" not in plan(report(warehouse))


def test_one_year_reads_the_partitions_of_that_year(warehouse, plan):
    assert "(pick_year" in plan(trip_features(warehouse, 1997)).split("PartitionFilters")[1]
    dates = warehouse.dim_datetime().filter(F.col("pick_year") == 1997)
    assert "= 1997)" in plan(dates).split("PartitionFilters")[1]


def test_numbering_does_not_shuffle_the_rows(spark, raw, plan):
    keyed, _ = number_rows(raw, raw, "id", 0, new_folder(spark, "offsets"))
    text = plan(keyed)
    assert "Exchange hashpartitioning" not in text
    assert "BroadcastHashJoin" in text


def test_hot_pair_is_split_in_the_fact_join(spark, raw, conf, rows):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    trips = valid_trips(raw).select(*schemas.RAW_TRIP.names)
    count = trips.count()
    copy = F.explode(F.sequence(F.lit(1), F.lit(count)))
    copies = trips.limit(1).withColumn("copy", copy).drop("copy")
    keyed = trips.unionByName(copies).withColumn("trip_id", F.monotonically_increasing_id())
    path = new_folder(spark, "keyed")
    write_parquet(keyed, path)
    keyed = spark.read.schema(keyed.schema).parquet(path)
    pairs = counted_pairs(keyed)
    hot = hot_keys(pairs, PAIR, "trips", parts=40, min_rows=1)
    limit = 2 * count // 40
    assert [row["salts"] for row in hot.collect()] == [-(-(count + 1) // limit)]

    dates = build_dim_datetime(pairs.withColumn("datetime_id", F.xxhash64(*PAIR)))
    plain = build_fact(keyed, dates, hot.limit(0))
    salted = build_fact(keyed, dates, hot)
    assert rows(salted) == rows(plain)
    join = salted._jdf.queryExecution().executedPlan().toString()
    assert "salt" in join.split("SortMergeJoin")[1].split("]")[0]
    spread = keyed.join(hot, PAIR).groupBy(F.pmod(F.xxhash64("trip_id"), "salts")).count()
    assert spread.agg(F.max("count")).first()[0] < 2 * limit


def test_bucketed_tables_join_without_a_shuffle(spark, warehouse, conf, plan):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    names = []
    for _ in range(2):
        path = new_folder(spark, "bucketed")
        names.append("facts_" + path.rsplit("-", 1)[1])
        write_bucketed(warehouse.fact_trip(), names[-1], path, "trip_id", 4)
    left, right = (spark.table(name) for name in names)
    text = plan(left.join(right, "trip_id").select("trip_id"))
    for name in names:
        spark.sql(f"drop table {name}")
    assert "SortMergeJoin" in text
    assert "Exchange" not in text


def test_no_query_plans_a_cross_product_of_tables(spark, plan):
    for name in ("agg_per_year", "trips_per_pu_location", "join_star", "fact_known_zone"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_landed_items_move_once_by_order_and_once_by_time(spark, conf, plan):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    joined = fixtures.joined_rows(spark, SF_DIR)
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 4 and "SortMergeJoin [l_" not in text
    moved = joined.repartitionByRange(*map(F.expr, fixtures.JOINED_ORDER))
    assert len(moved.columns) == 12 and "m" not in moved.columns
    text = fixtures.measured(moved)._jdf.queryExecution().executedPlan().toString()
    assert "total_amount" not in text[text.index("rangepartitioning") :]


def test_landed_trips_are_those_of_the_sql(spark, rows, raw):
    tables = {n: spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("lineitem", "orders", "customer", "supplier")}
    text = fixtures.RAW_SQL.replace("{pickup}", fixtures.PICKUP.format(m="m"))
    text = text.replace("{dropoff}", fixtures.DROPOFF.format(m="m"))
    assert rows(raw.drop("src_file", "src_row")) == rows(spark.sql(text, **tables))
    ordered = raw.orderBy("src_file", "src_row").select(*fixtures.TRIP_ORDER).collect()
    assert [tuple((x is not None, x) for x in row) for row in ordered] == sorted(
        tuple((x is not None, x) for x in row) for row in ordered
    )


def test_a_code_stands_for_the_keys_of_an_item(spark):
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double"
    keys = [(8999940, 1199999, 59999, 7, 3.0), (-8, -9, -31, -6, None), (13, None, 14, 0, 1.0)]
    keys += [(0, 0, 0, None, 2.0), (None, 6, None, 1, 50.0), (None, None, None, None, None)]
    joined = spark.createDataFrame([(n, *key) for n, key in enumerate(keys)], f"n int, {schema}")
    joined = joined.withColumn("o_orderdate", F.lit("1995-03-04").cast("timestamp_ntz"))
    moved = fixtures.packed(joined).repartitionByRange(3, *map(F.expr, fixtures.PACKED_ORDER))
    assert moved.columns == ["n", "l_quantity", "o_orderdate", "code"]
    read = ["l_orderkey % 7", "l_partkey % 7", "l_suppkey % 3", "l_suppkey % 5", "l_linenumber % 7"]

    def seen(frame, *columns):
        return {row[0]: tuple(row[1:]) for row in frame.selectExpr("n", *columns).collect()}

    times = [text.format(m="m") for text in (fixtures.PICKUP, fixtures.DROPOFF)]
    assert seen(fixtures.unpacked(moved), *read, *times) == seen(joined, *read, *fixtures.JOINED_ORDER[:2])
    text = moved._jdf.queryExecution().executedPlan().toString()
    assert "_common_expr" not in text  # only the packed columns are moved
    assert seen(moved, *fixtures.PACKED_ORDER) == seen(joined, *fixtures.JOINED_ORDER)


def test_landing_moves_codes_instead_of_keys(spark, tmp_path, monkeypatch):
    ranges = []
    frame = type(spark.range(0))
    deal = frame.repartitionByRange
    monkeypatch.setattr(
        frame, "repartitionByRange", lambda self, *by: ranges.append(self.columns) or deal(self, *by)
    )
    for name in ("lineitem", "orders", "customer", "supplier", "nation", "region"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(9).write.parquet(f"{tmp_path}/{name}.parquet")
    fixtures.land(spark, str(tmp_path))
    moved = [columns for columns in ranges if "l_quantity" in columns]
    assert len(moved) == 1 and len(moved[0]) == 9
    assert not {"l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"} & set(moved[0])
