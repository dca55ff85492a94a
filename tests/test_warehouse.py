from functools import partial

import pytest
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.checks import joined
from tripmart.operators.filters import valid_trips
from tripmart.operators.joins import hot_keys
from tripmart.operators.sinks import read_published, write_parquet
from tripmart.plans import marts
from tripmart.plans.warehouse import PAIR, PICKUP, Warehouse, init_warehouse, load_batch
from tripmart.sources.trips import read_trips, with_source_row
from tripmart.storage import new_folder


def _all_tables(warehouse, rows):
    tables = (
        warehouse.fact_with_calendar,
        warehouse.dim_datetime,
        warehouse.dim_pickup_location,
        warehouse.dim_dropoff_location,
        warehouse.dim_rate_code,
        warehouse.dim_payment,
        warehouse.dim_vendor,
    )
    return [rows(table()) for table in tables]


def test_fact_keeps_every_valid_trip_once(warehouse, raw):
    fact = warehouse.fact_trip()
    trips = valid_trips(raw).count()
    assert fact.count() == trips
    assert fact.select("trip_id").distinct().count() == trips


def test_facts_lead_to_the_timestamps_of_their_trip(warehouse, raw, rows):
    dates = warehouse.dim_datetime().select("datetime_id", *PAIR)
    on = F.col("datetimestamp_id") == F.col("datetime_id")
    measures = ["fare_amount", "tip_amount", "total_amount", "trip_distance"]
    found = warehouse.fact_trip().join(dates, on).select(*PAIR, *measures)
    assert rows(found) == rows(valid_trips(raw).select(*PAIR, *measures))


def test_calendar_columns_on_facts_equal_the_dimension(warehouse, rows):
    names = ["pick_year", "pick_hour", "pick_weekday_id", "drop_hour", "drop_weekday_id"]
    dates = warehouse.dim_datetime().select("datetime_id", *names)
    on = F.col("datetimestamp_id") == F.col("datetime_id")
    joined_rows = warehouse.fact_trip().join(dates, on).select("trip_id", *names)
    assert rows(warehouse.fact_with_calendar().select("trip_id", *names)) == rows(joined_rows)


def test_dimension_keys_are_unique(warehouse):
    for table in (warehouse.dim_datetime(), warehouse.dim_pickup_location(), warehouse.dim_payment()):
        key = "datetime_id" if "datetime_id" in table.columns else table.columns[0]
        assert table.count() == table.select(key).distinct().count()
    pairs = warehouse.dim_datetime().select(*PAIR)
    assert pairs.count() == pairs.distinct().count()


def test_dropoff_weekday_is_that_of_the_dropoff(warehouse):
    dates = warehouse.dim_datetime()
    other_day = dates.filter("pick_weekday_id <> drop_weekday_id")
    assert other_day.count() > 0
    assert dates.filter(F.dayofweek(PAIR[1]) != F.col("drop_weekday_id")).count() == 0


def test_codes_read_back_as_long(warehouse):
    assert warehouse.dim_payment().schema["payment_type"].dataType.typeName() == "long"
    assert warehouse.dim_vendor().schema["VendorID"].dataType.typeName() == "long"


def test_reports_equal_those_with_all_joins(spark, warehouse, rows):
    area = new_folder(spark, "marts")
    marts.publish_all(warehouse, area)
    for name, report in joined.REPORTS.items():
        if name != "agg_per_year":
            assert rows(read_published(spark, area, name)) == rows(report(warehouse)), name
    mine = {r["year"]: r for r in read_published(spark, area, "agg_per_year").collect()}
    for row in joined.agg_per_year(warehouse).collect():
        found = mine[row["year"]]
        assert found["total_trips"] == row["total_trips"]
        assert found["total_passengers"] == row["sum_passenger_count"]
        assert found["total_amount"] == pytest.approx(row["sum_total_amount"], rel=1e-12)
        assert found["average_amount_per_trip"] == pytest.approx(row["avg_total_amount"], rel=1e-12)


def test_reports_add_up(warehouse):
    def total(df):
        return df.agg(F.sum("total_trips")).first()[0]

    everything = marts.agg_total(warehouse).first()["total_trips"]
    assert total(marts.trips_per_hour(warehouse)) == everything
    assert total(marts.trips_per_day(warehouse)) == everything
    totals = marts.paid_totals(warehouse)
    per_year = total(marts.agg_per_year(totals))
    assert total(marts.payment_per_year(totals)) == per_year
    assert total(marts.agg_per_payment(totals)) == per_year
    assert per_year < everything


def test_endless_amount_reaches_the_reports(spark, warehouse):
    """One infinite amount makes the totals it belongs to infinite and leaves the others as they are."""
    year = warehouse.fact_with_calendar().agg(F.min("pick_year")).first()[0]
    amount = F.when(F.col("pick_year") == year, F.lit(float("inf"))).otherwise(F.col("total_amount"))
    endless = Warehouse(spark, warehouse.root)
    endless.fact_with_calendar = lambda: warehouse.fact_with_calendar().withColumn("total_amount", amount)
    found = {r["year"]: r for r in marts.agg_per_year(marts.paid_totals(endless)).collect()}
    for row in marts.agg_per_year(marts.paid_totals(warehouse)).collect():
        if row["year"] != year:
            assert found[row["year"]] == row
        else:
            assert found[year]["total_amount"] == found[year]["average_amount_per_trip"] == float("inf")
            assert found[year]["total_distance"] == row["total_distance"]
    assert marts.agg_total(endless).first()["total_amount"] == float("inf")


def test_repeated_and_failed_loads_change_nothing(spark, raw_year, zones, rows, monkeypatch):
    root = new_folder(spark, "warehouse")
    init_warehouse(raw_year(1995), zones, root)
    once = _all_tables(load_batch(raw_year(1996), zones, root, 1), rows)
    twice = _all_tables(load_batch(raw_year(1996), zones, root, 1), rows)
    assert once == twice

    def broken(*args):
        raise RuntimeError("lost")

    init_warehouse(raw_year(1995), zones, root)  # forgets the loads before it
    with monkeypatch.context() as patch:
        patch.setattr("tripmart.plans.warehouse._occurring_codes", broken)
        with pytest.raises(RuntimeError, match="lost"):
            load_batch(raw_year(1996), zones, root, 1)
    seen = Warehouse(spark, root)
    assert seen.last_load == 0
    assert seen.fact_with_calendar().filter("pick_year = 1996").count() == 0
    assert _all_tables(load_batch(raw_year(1996), zones, root, 1), rows) == once


def test_pairs_seen_before_keep_their_key(spark, raw_year, zones, rows):
    root = new_folder(spark, "warehouse")
    first = init_warehouse(raw_year(1995), zones, root)
    dates = rows(first.dim_datetime())
    trips = first.fact_trip().count()
    again = load_batch(raw_year(1995), zones, root, 1)  # the same trips as another delivery
    assert rows(again.dim_datetime()) == dates
    fact = again.fact_trip()
    assert fact.count() == 2 * trips
    assert fact.select("trip_id").distinct().count() == 2 * trips
    assert fact.groupBy("datetimestamp_id").count().filter("count % 2 = 1").count() == 0


def test_batch_without_valid_trips(spark, raw_year, zones):
    root = new_folder(spark, "warehouse")
    first = init_warehouse(raw_year(1995), zones, root)
    trips, key = first.fact_trip().count(), first.next_datetime_id
    after = load_batch(raw_year(1996), zones, root, 1, (2010, 2010))
    assert after.fact_trip().count() == trips
    assert after.next_datetime_id == key
    assert after.last_load == 1


def test_unfinished_load_is_not_read(spark, raw_year, zones):
    root = new_folder(spark, "warehouse")
    first = init_warehouse(raw_year(1995), zones, root)
    trips = first.fact_trip().count()
    unfinished = first.fact_with_calendar().limit(3)
    write_parquet(unfinished, f"{root}/fact_trip/load_id=7", partition_by=["pick_year"])
    assert Warehouse(spark, root).fact_trip().count() == trips


def test_changed_zone_becomes_a_new_version(spark, raw_year, zones):
    root = new_folder(spark, "warehouse")
    first = init_warehouse(raw_year(1995), zones, root)
    known = first.dim_pickup_location().count()
    moved = F.when(F.col("LocationID") == 1, "SZ9").otherwise(F.col("service_zone"))
    after = load_batch(raw_year(1996), zones.withColumn("service_zone", moved), root, 1)
    current = after.dim_pickup_location()
    assert current.count() == current.select("PULocationID").distinct().count() >= known
    assert current.filter("PULocationID = 1").first()["service_zone"] == "SZ9"
    history = after.history(PICKUP).filter("PULocationID = 1")
    assert history.count() == 2
    per_zone = marts.trips_per_pu_location(after).agg(F.sum("total_trips")).first()[0]
    zones_known = after.fact_trip().filter("pu_location_id < 25").count()
    assert per_zone == zones_known


def test_code_first_seen_in_a_batch_is_reported(spark, raw, zones):
    files = {}
    for name, codes in (("first", (1, 2)), ("second", (1, 2, 3))):
        files[name] = new_folder(spark, name)
        kept = raw.filter(F.col("payment_type").isin(*codes))
        write_parquet(kept.select(*schemas.RAW_TRIP.names), files[name])
    root = new_folder(spark, "warehouse")
    first = init_warehouse(with_source_row(read_trips(spark, files["first"])), zones, root)
    assert marts.agg_per_payment(marts.paid_totals(first)).count() == 2
    second = load_batch(with_source_row(read_trips(spark, files["second"])), zones, root, 1)
    assert marts.agg_per_payment(marts.paid_totals(second)).count() == 3


def test_known_zones_only(spark, raw, zones):
    strict = init_warehouse(raw, zones, new_folder(spark, "warehouse"), require_known_zone=True)
    fact = strict.fact_trip()
    assert fact.filter("pu_location_id = 25 or do_location_id = 25").count() == 0
    known = valid_trips(raw).filter("PULocationID < 25 and DOLocationID < 25")
    assert fact.count() == known.count()
    pickups = valid_trips(raw).filter("PULocationID < 25").select("PULocationID").distinct()
    assert strict.dim_pickup_location().count() == pickups.count()


def test_repeated_zone_is_refused(spark, raw_year, zones):
    with pytest.raises(ValueError, match="LocationID is not unique"):
        init_warehouse(raw_year(1995), zones.union(zones), new_folder(spark, "warehouse"))


def test_wrong_input_is_refused(spark, raw_year, zones):
    narrow = raw_year(1995).withColumn("passenger_count", F.col("passenger_count").cast("int"))
    with pytest.raises(ValueError, match="passenger_count: expected bigint, found int"):
        load_batch(narrow, zones, new_folder(spark, "warehouse"), 0)


def test_hot_trip_and_hot_pair(spark, raw, zones, conf, rows, monkeypatch):
    """A third of all trips are copies of one, another third share its pair of timestamps."""
    trips = valid_trips(raw).select(*schemas.RAW_TRIP.names)
    count = trips.count()
    hot = trips.orderBy(*schemas.RAW_TRIP.names).limit(1)
    copy = F.explode(F.sequence(F.lit(1), F.lit(count)))
    copies = hot.withColumn("copy", copy).drop("copy")
    first = hot.first()
    same_pair = trips.withColumns({name: F.lit(str(first[name])).cast("timestamp_ntz") for name in PAIR})
    path = new_folder(spark, "skewed")
    write_parquet(trips.unionByName(copies).unionByName(same_pair), path)
    scan = with_source_row(read_trips(spark, path))
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    hot_from = partial(hot_keys, parts=100, min_rows=10)
    monkeypatch.setattr("tripmart.plans.warehouse.hot_keys", hot_from)
    built = init_warehouse(scan, zones, new_folder(spark, "warehouse"))
    fact = built.fact_trip()
    assert fact.count() == 3 * count == fact.select("trip_id").distinct().count()
    assert built.dim_datetime().count() == trips.select(*PAIR).distinct().count()
    busiest = fact.groupBy("datetimestamp_id").count().agg(F.max("count")).first()[0]
    assert busiest >= 2 * count
    assert built.hot_pairs().first()["salts"] > 60
    assert built.facts_with_dates().count() == 3 * count

    again = load_batch(scan, zones, built.root, 1)
    assert again.dim_datetime().count() == built.dim_datetime().count()
    assert again.fact_trip().count() == 6 * count
    assert again.hot_pairs().count() == built.hot_pairs().count() == 1
    named = again.facts_with_dates().select("trip_id", "pick_weekday_id")
    assert rows(named) == rows(again.fact_with_calendar().select("trip_id", "pick_weekday_id"))


def test_mistyped_root_is_refused(spark):
    with pytest.raises(ValueError, match="no load below"):
        Warehouse(spark, new_folder(spark, "nothing")).require_loaded()
