"""Loads that die, meet another writer, or bring zones that changed; and what a batch reads."""

import datetime
import time
from functools import partial

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from tripmart import schemas
from tripmart.checks import fixtures
from tripmart.checks.oracles import ORACLES
from tripmart.checks.queries import QUERIES
from tripmart.jobs import run
from tripmart.operators.changes import join_as_of, with_intervals
from tripmart.operators.filters import rejected_trips, valid_trips
from tripmart.operators.joins import hot_keys
from tripmart.operators.sinks import write_parquet
from tripmart.plans import commits, ledger, marts
from tripmart.plans import warehouse as wh
from tripmart.plans.pairs import PAIR, stored_pairs, with_stored_keys, write_pairs
from tripmart.plans.warehouse import PICKUP, Warehouse, init_warehouse, load_batch, vacuum
from tripmart.sources.trips import read_trips, with_source_row
from tripmart.storage import create_once, folders_below, new_folder


def _tables(warehouse, rows):
    return [rows(warehouse.history(table)) for table in wh.TABLES]


@pytest.fixture
def small(spark, raw):
    """A scan of few trips of some days, so that loads are quick."""

    def scan(first, last):
        path = new_folder(spark, "small")
        day = F.to_date(PAIR[0])
        kept = raw.filter(day.between(first, last)).select(*schemas.RAW_TRIP.names)
        write_parquet(kept, path, files=2)
        return with_source_row(read_trips(spark, path))

    return scan


class Lost(RuntimeError):
    pass


def _breaking(monkeypatch, at):
    """The write of that number fails after it has written, wherever a load writes."""
    calls = []

    def breaking(write):
        def step(*args, **kwargs):
            result = write(*args, **kwargs)
            calls.append(write.__name__)
            if len(calls) == at:
                raise Lost(write.__name__)
            return result

        return step

    for name in ("write_parquet", "write_pairs", "assign_key", "number_rows"):
        monkeypatch.setattr(wh, name, breaking(getattr(wh, name)))
    return calls


def test_a_rerun_lost_at_any_write_leaves_the_old_rows(spark, small, zones, rows, monkeypatch):
    root = new_folder(spark, "warehouse")
    init_warehouse(small("1996-01-01", "1996-01-20"), zones, root)
    batch = small("1996-01-15", "1996-02-05")
    before = _tables(load_batch(batch, zones, root, 1), rows)
    corrected = small("1996-01-15", "1996-01-25")
    at, lost = 1, 0
    while True:
        with monkeypatch.context() as patch:
            _breaking(patch, at)
            try:
                after = load_batch(corrected, zones, root, 1)
                break
            except Lost:
                lost += 1
        assert _tables(Warehouse(spark, root), rows) == before, f"write {at}"
        at += 1
    assert lost >= 10
    assert after.fact_trip().count() < len(before[0])
    assert after.last_load == 1
    attempts = commits.unreferenced_attempts(spark, root, ["fact_trip"], time.time() + 60)
    assert attempts and vacuum(spark, root, time.time() - 3600) == 0
    kept = _tables(after, rows)
    assert vacuum(spark, root, time.time() + 60) >= len(attempts)
    assert _tables(Warehouse(spark, root), rows) == kept
    assert not commits.unreferenced_attempts(spark, root, ["fact_trip"], time.time() + 60)


def test_a_lost_init_leaves_the_old_warehouse(spark, small, zones, rows, monkeypatch):
    root = new_folder(spark, "warehouse")
    init_warehouse(small("1996-01-01", "1996-01-10"), zones, root)
    before = _tables(load_batch(small("1996-02-01", "1996-02-03"), zones, root, 1), rows)
    with monkeypatch.context() as patch:
        _breaking(patch, 6)
        with pytest.raises(Lost):
            init_warehouse(small("1996-03-01", "1996-03-05"), zones, root)
    assert _tables(Warehouse(spark, root), rows) == before
    anew = init_warehouse(small("1996-03-01", "1996-03-05"), zones, root)
    assert anew.last_load == 0 and anew.next_trip_id > 0
    months = anew.dim_datetime().select("pick_month").distinct().collect()
    assert [row[0] for row in months] == [3]


def test_a_second_writer_is_refused(spark, small, zones, rows, monkeypatch):
    root = new_folder(spark, "warehouse")
    init_warehouse(small("1996-01-01", "1996-01-05"), zones, root)
    first, second = small("1996-01-04", "1996-01-12"), small("1996-02-01", "1996-02-03")
    codes = wh._occurring_codes
    inside = []

    def meanwhile(*args):
        if not inside:  # the other writer begins and ends while this one is at work
            inside.append(True)
            inside.append(_tables(load_batch(second, zones, root, 1), rows))
        return codes(*args)

    monkeypatch.setattr(wh, "_occurring_codes", meanwhile)
    with pytest.raises(commits.ConcurrentLoad):
        load_batch(first, zones, root, 1)
    stored = Warehouse(spark, root)
    assert _tables(stored, rows) == inside[1]
    assert not commits.unreferenced_attempts(spark, root, ["fact_trip"], time.time() + 60)
    after = load_batch(first, zones, root, 2)
    assert after.fact_trip().select("trip_id").distinct().count() == after.fact_trip().count()
    assert after.dim_datetime().select(*PAIR).distinct().count() == after.dim_datetime().count()


def test_a_file_is_created_once_and_whole(spark):
    path = new_folder(spark, "once") + "/1.json"
    create_once(spark, path, '{"a": 1}')
    with pytest.raises(FileExistsError):
        create_once(spark, path, '{"a": 2}')
    assert spark.read.text(path).first()[0] == '{"a": 1}'
    assert spark.read.text(path.rsplit("/", 1)[0]).count() == 1
    assert not folders_below(spark, path.rsplit("/", 1)[0], 1)


def _moved(zones, place):
    service = F.when(F.col("LocationID") % 2 == 1, place).otherwise(F.col("service_zone"))
    return zones.withColumn("service_zone", service)


def test_zone_versions_hold_from_their_day(spark, small, zones):
    root = new_folder(spark, "warehouse")
    spans = [("1995-01-01", "1995-12-31"), ("1996-01-01", "1996-06-30"), ("1996-07-01", "1996-12-31")]
    scans = [small(*span) for span in spans]
    init_warehouse(scans[1], zones, root)
    load_batch(scans[2], _moved(zones, "SZ8"), root, 1)
    same = load_batch(small("1997-01-01", "1997-06-30"), _moved(zones, "SZ8"), root, 2)
    # an older year arrives last, with the lookup of its time
    late = load_batch(scans[0], _moved(zones, "SZ7"), root, 3)
    assert same.history(PICKUP).filter("PULocationID = 1").count() == 2
    found = late.versions(PICKUP).filter("PULocationID = 1").orderBy("valid_from").collect()
    days = [valid_trips(scan).agg(F.min(F.to_date(PAIR[0]))).first()[0] for scan in scans]
    assert [r["valid_from"] for r in found] == days
    assert [r["valid_to"] for r in found] == [*days[1:], None]
    assert [r["is_current"] for r in found] == [False, False, True]
    assert late.dim_pickup_location().filter("PULocationID = 1").first()["service_zone"] == "SZ8"

    counted = marts.trips_per_pickup_version(late)
    want = {}
    places = {r["LocationID"]: r["service_zone"] for r in zones.collect()}
    versions = late.versions(PICKUP).collect()
    for zone, day in late.fact_with_calendar().select("pu_location_id", "pick_date").collect():
        if zone in places:
            own = sorted((v for v in versions if v["PULocationID"] == zone), key=lambda v: v["valid_from"])
            held = [v for v in own if v["valid_from"] <= day] or own[:1]
            key = (day.year, zone, held[-1]["service_zone"])
            want[key] = want.get(key, 0) + 1
    got = {(r["year"], r["LocationID"], r["service_zone"]): r["total_trips"] for r in counted.collect()}
    assert got == want
    now = marts.trips_per_pu_location(late).agg(F.sum("total_trips")).first()[0]
    assert now == sum(want.values())


def test_intervals_and_join_as_of(spark):
    day = datetime.date
    history = spark.createDataFrame(
        [(1, "a", day(2020, 1, 1), 0), (1, "b", day(2021, 1, 1), 1), (1, "c", day(2021, 1, 1), 2),
         (2, "x", day(2021, 6, 1), 1)],
        "id long, name string, since date, load_id long",
    )
    versions = with_intervals(history, "id", "since", "load_id")
    found = {(r["id"], r["name"]): (r["valid_from"], r["valid_to"], r["is_current"]) for r in versions.collect()}
    assert found == {
        (1, "a"): (day(2020, 1, 1), day(2021, 1, 1), False),
        (1, "c"): (day(2021, 1, 1), None, True),
        (2, "x"): (day(2021, 6, 1), None, True),
    }
    rows = spark.createDataFrame(
        [(1, day(2019, 1, 1)), (1, day(2020, 12, 31)), (1, day(2021, 1, 1)), (2, day(2000, 1, 1)), (3, day(2020, 1, 1))],
        "id long, day date",
    )
    joined = join_as_of(rows, versions, "id", "day").select("id", "day", "name").collect()
    assert sorted((r["id"], r["day"], r["name"]) for r in joined) == [
        (1, day(2019, 1, 1), "a"), (1, day(2020, 12, 31), "a"), (1, day(2021, 1, 1), "c"), (2, day(2000, 1, 1), "x"),
    ]
    assert "CartesianProduct" not in joined.__repr__()


def test_stored_pairs_are_scanned_once_and_not_moved(spark, raw, conf, plan):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    pairs = valid_trips(raw).select(*PAIR).distinct().withColumn("datetime_id", F.xxhash64(*PAIR))
    folders = []
    for year in (1995, 1996, 1997):
        folders.append(new_folder(spark, "pairs"))
        write_pairs(pairs.filter(F.year(PAIR[0]) == year), folders[-1], 4)
    path = new_folder(spark, "batch")
    write_parquet(valid_trips(raw).select(*PAIR).distinct(), path)
    batch = spark.read.parquet(path)
    with stored_pairs(spark, folders, 4) as stored:
        joined = with_stored_keys(batch, stored)
        text = plan(joined)
        assert joined.count() == batch.count()
        known = joined.filter("datetime_id is not null")
        assert known.count() == pairs.filter(F.year(PAIR[0]).between(1995, 1997)).count()
        assert known.filter(F.col("datetime_id") != F.xxhash64(*PAIR)).isEmpty()
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2
    assert final.count("Exchange hashpartitioning") == 1  # of the batch
    stored_side = final[final.index("SortMergeJoin") :].split("ShuffleQueryStage")[-1]
    assert "Bucketed: true" in stored_side and "SelectedBucketsCount: 4 out of 4" in final
    assert not spark.catalog.listTables() or all(
        not table.name.startswith("pairs_") for table in spark.catalog.listTables()
    )


def test_a_batch_reads_only_loads_of_its_months(spark, small, zones, monkeypatch):
    root = new_folder(spark, "warehouse")
    init_warehouse(small("1996-01-01", "1996-01-20"), zones, root)
    load_batch(small("1996-05-01", "1996-05-10"), zones, root, 1)
    asked = []

    def seen(spark, folders, buckets):
        asked.append(folders)
        return stored_pairs(spark, folders, buckets)

    monkeypatch.setattr(wh, "stored_pairs", seen)
    load_batch(small("1996-05-08", "1996-06-10"), zones, root, 2)
    load_batch(small("1996-09-01", "1996-09-02"), zones, root, 3)
    assert [[("load_id=1/" in folder) for folder in folders] for folders in asked] == [[True]]


@pytest.mark.parametrize("tasks", [3, 12])
def test_number_of_files_does_not_follow_tasks(spark, raw, zones, tasks, conf):
    conf(spark__sql__shuffle__partitions=str(tasks), spark__sql__adaptive__coalescePartitions__enabled="false")
    path = new_folder(spark, "many-files")
    raw.select(*schemas.RAW_TRIP.names).repartition(tasks).write.parquet(path)
    built = init_warehouse(with_source_row(read_trips(spark, path)), zones, new_folder(spark, "warehouse"))
    files = built.fact_trip().inputFiles()
    years = built.fact_with_calendar().select("pick_year").distinct().count()
    assert len(files) == years


def test_normalise_skips_what_the_ledger_has(spark, raw, capsys):
    area, out, book = (new_folder(spark, name) for name in ("area", "out", "ledger"))
    columns = schemas.RAW_TRIP.names

    def land(month, name):
        kept = raw.filter(F.date_format(PAIR[0], "yyyy-MM") == month).select(*columns)
        write_parquet(kept, f"{area}/yellow_tripdata_{name}.parquet", files=1)
        return kept.dropna().count()

    def run_job(*more):
        run(spark, ["normalise", "--files", area, "--out", out, "--ledger", book, *more])
        return capsys.readouterr().out

    rows = land("1996-01", "1996-01")
    assert "1996-01: new" in run_job()
    rows += land("1996-02", "1996-02")
    said = run_job()
    assert "1996-01: loaded" in said and "1996-02: new" in said
    assert read_trips(spark, out).count() == rows
    land("1996-03", "1996-02")  # the month comes again with other rows under its name
    assert "1996-02" in (said := run_job("--year", "1996")) and "new" in said
    before = read_trips(spark, out).count()
    said = run_job()
    assert "new" not in said and read_trips(spark, out).count() == before


def test_a_file_that_came_again_is_told_apart(spark):
    columns = "src_file string, bytes bigint, changed bigint, year int, month int, rows bigint"
    first = [("a", 10, 1, 2020, 1, 5), ("b", 10, 1, 2020, 2, 5), ("c", 7, 1, None, None, 5)]
    folder = new_folder(spark, "ledger")
    assert ledger.read_ledger(spark, folder).count() == 0
    ledger.enter(spark.createDataFrame(first, columns), folder)
    ledger.enter(spark.createDataFrame([("b", 11, 2, 2020, 2, 6)], columns), folder)
    landed = spark.createDataFrame(
        [("a", 10, 1, 2020, 1, 5), ("b", 10, 1, 2020, 2, 5), ("b2", 10, 1, 2020, 2, 5), ("c", 7, 9, None, None, 5)],
        columns,
    )
    found = ledger.judged(landed, ledger.read_ledger(spark, folder))
    states = {r["src_file"]: r["state"] for r in found.collect()}
    assert states == {"a": "loaded", "b": "redelivered", "b2": "new", "c": "redelivered"}
    per_month = {(r["month"], r["state"]): r["rows"] for r in ledger.period_states(found).collect()}
    assert per_month == {(1, "loaded"): 5, (2, "redelivered"): 5, (2, "new"): 5}


def test_rejected_and_valid_trips_are_all_trips(spark, raw):
    day = raw.limit(50).select(*schemas.RAW_TRIP.names)
    bad = day.withColumns(
        {"trip_distance": F.lit(float("nan")), "passenger_count": F.lit(None).cast("long")}
    ).unionByName(day.withColumn("trip_distance", F.lit(-1.0)))
    trips = raw.select(*schemas.RAW_TRIP.names).unionByName(bad)
    assert rejected_trips(trips).count() + valid_trips(trips).count() == trips.count()
    reasons = {r["reason"] for r in rejected_trips(trips).select("reason").distinct().collect()}
    assert reasons == {"incomplete", "no distance", "no passengers"}


def test_trips_of_any_year_are_loaded(spark, tmp_path):
    """Orders of years before and after those of the test tables; the five queries equal their SQL."""
    folder = str(tmp_path)
    for name in ("region", "nation", "customer", "supplier", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF_DIR}/{name}.parquet")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    moved = F.when(F.col("o_orderkey") % 97 == 0, F.col("o_orderdate") - F.expr("interval 9 years")).when(
        F.col("o_orderkey") % 89 == 0, F.col("o_orderdate") + F.expr("interval 11 years")
    )
    orders.withColumn("o_orderdate", F.coalesce(moved, "o_orderdate")).coalesce(1).write.parquet(
        f"{folder}/orders.parquet"
    )
    duck = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "lineitem"):
        duck.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    duck.execute(f"create view orders as select * from '{folder}/orders.parquet/*.parquet'")
    for name in ("surrogate_key", "surrogate_key_next", "dim_new_rows", "warehouse_batch", "warehouse_backfill"):
        found = QUERIES[name](spark, folder)
        want = duck.sql(ORACLES[name]).to_arrow_table().select(found.columns).to_pylist()
        got = found.toArrow().to_pylist()
        assert sorted(map(repr, got)) == sorted(map(repr, want)), name


def test_a_pair_that_is_hot_in_no_load_is_split_over_all(spark, raw, zones, conf, monkeypatch):
    """A pair stays just below the limit of every load; over all loads it is far above."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    trips = valid_trips(raw).select(*schemas.RAW_TRIP.names)
    first = trips.orderBy(*schemas.RAW_TRIP.names).first()
    same = {name: F.lit(str(first[name])).cast("timestamp_ntz") for name in PAIR}
    monkeypatch.setattr(wh, "hot_keys", partial(hot_keys, parts=10_000, min_rows=40))
    root = new_folder(spark, "warehouse")
    for load in range(4):
        path = new_folder(spark, "delivery")
        others = trips.filter(F.month(PAIR[0]) == load + 2)
        write_parquet(trips.limit(39).withColumns(same).unionByName(others), path, files=1)
        stored = load_batch(with_source_row(read_trips(spark, path)), zones, root, load)
        assert stored.hot_pairs().isEmpty() == (load == 0)
    hot = stored.hot_pairs().collect()
    assert [row["trips"] for row in hot] == [4 * 39] and hot[0]["salts"] == 4
    joined = stored.facts_with_dates()
    assert joined.count() == stored.fact_trip().count()
    assert "salt" in joined._jdf.queryExecution().executedPlan().toString()
    spread = stored.fact_trip().filter(F.col("datetimestamp_id") == hot[0]["datetime_id"])
    largest = spread.groupBy(F.pmod(F.xxhash64("trip_id"), F.lit(4))).count().agg(F.max("count")).first()[0]
    assert largest < 2 * 40


def _own_tables(spark, folder):
    day = "timestamp_ntz '1996-01-01' + make_dt_interval(cast(id % 700 as int))"
    made = {
        "lineitem": [
            "id as l_orderkey", "id % 9 as l_partkey", "id % 4 as l_suppkey", "cast(1 + id % 5 as int) as l_linenumber",
            "cast(2 + id % 40 as double) as l_quantity", "cast(100 + id as double) as l_extendedprice",
            "0.05D as l_discount", "0.02D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", f"{day} as l_shipdate",
        ],
        "orders": ["id as o_orderkey", "id % 10 as o_custkey", f"{day} as o_orderdate"],
        "customer": ["id as c_custkey", "cast(id % 3 as int) as c_nationkey"],
        "supplier": ["id as s_suppkey", "cast(id % 3 as int) as s_nationkey"],
        "nation": ["cast(id as int) as n_nationkey", "concat('N', id) as n_name", "cast(0 as int) as n_regionkey"],
        "region": ["cast(0 as int) as r_regionkey", "'R' as r_name"],
    }
    rows = {"customer": 10, "supplier": 4, "nation": 3, "region": 1}
    for name, columns in made.items():
        spark.range(rows.get(name, 3000)).selectExpr(*columns).write.parquet(f"{folder}/{name}.parquet")


def test_what_landing_and_facts_have_moved_is_deleted_when_written(spark, tmp_path, monkeypatch):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name.split("_")[1] for name in blocks.mkString(",").split(",") if name.startswith("shuffle_")}

    def left(before):
        """What stays; files are deleted in the background."""
        for _ in range(100):
            if not shuffles() - before:
                break
            time.sleep(0.1)
        return shuffles() - before

    _own_tables(spark, tmp_path)
    monkeypatch.setattr(fixtures, "_LANDED", {})
    before = shuffles()
    landed = fixtures.land(spark, str(tmp_path))
    assert not left(before)

    kept, store = {}, wh._Load.store

    def watched(self, df, table):
        before = shuffles()
        store(self, df, table)
        if table is wh.FACT:
            kept[table.name] = left(before)

    monkeypatch.setattr(wh._Load, "store", watched)
    scan = with_source_row(read_trips(spark, landed.area))
    loaded = init_warehouse(scan, fixtures.zone_rows(spark, str(tmp_path)), new_folder(spark, "warehouse"))
    assert not kept["fact_trip"]
    assert loaded.fact_trip().count() == 3000
