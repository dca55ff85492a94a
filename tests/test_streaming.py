import os
import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.operators.filters import valid_trips
from tripmart.operators.sinks import write_parquet
from tripmart.plans.warehouse import PAIR, init_warehouse, load_batch
from tripmart.sources.trips import read_trips
from tripmart.storage import new_folder
from tripmart.streaming.landing import ingest_landing, load_landed


def _month(raw, month):
    return raw.filter(F.date_format(PAIR[0], "yyyy-MM") == month).select(*schemas.RAW_TRIP.names)


def test_landed_files_are_ingested_once(spark, raw):
    area, target, checkpoint = (new_folder(spark, n) for n in ("area", "target", "checkpoint"))
    write_parquet(_month(raw, "1996-01"), f"{area}/yellow_tripdata_1996-01")
    ingest_landing(spark, area, target, checkpoint)
    first = read_trips(spark, target).count()
    assert first == _month(raw, "1996-01").count()
    ingest_landing(spark, area, target, checkpoint)
    assert spark.read.parquet(target).count() == first
    write_parquet(_month(raw, "1996-02"), f"{area}/yellow_tripdata_1996-02")
    ingest_landing(spark, area, target, checkpoint, files_per_batch=1)
    assert spark.read.parquet(target).count() == first + _month(raw, "1996-02").count()


def test_landed_months_extend_the_warehouse(spark, raw, zones):
    area, root, checkpoint = (new_folder(spark, n) for n in ("area", "warehouse", "checkpoint"))
    write_parquet(_month(raw, "1996-01"), f"{area}/yellow_tripdata_1996-01", files=1)
    first = load_landed(spark, area, zones, root, checkpoint, first_load=0)
    trips = valid_trips(_month(raw, "1996-01")).count()
    assert first.last_load == 0
    assert first.fact_trip().count() == trips
    write_parquet(_month(raw, "1996-02"), f"{area}/yellow_tripdata_1996-02", files=1)
    second = load_landed(spark, area, zones, root, checkpoint, first_load=0)
    trips += valid_trips(_month(raw, "1996-02")).count()
    assert second.last_load == 1
    fact = second.fact_trip()
    assert fact.count() == trips == fact.select("trip_id").distinct().count()
    third = load_landed(spark, area, zones, root, checkpoint, first_load=0)
    assert third.last_load == 1
    assert third.fact_trip().count() == trips


def test_stream_goes_on_after_a_failed_batch(spark, raw, zones, monkeypatch):
    area, root, checkpoint = (new_folder(spark, n) for n in ("area", "warehouse", "checkpoint"))
    write_parquet(_month(raw, "1996-03"), f"{area}/yellow_tripdata_1996-03", files=1)

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("tripmart.plans.warehouse._occurring_codes", broken)
        with pytest.raises(StreamingQueryException):
            load_landed(spark, area, zones, root, checkpoint, first_load=0)
    write_parquet(_month(raw, "1996-04"), f"{area}/yellow_tripdata_1996-04", files=1)
    stored = load_landed(spark, area, zones, root, checkpoint, first_load=0)
    months = _month(raw, "1996-03").unionByName(_month(raw, "1996-04"))
    assert stored.fact_trip().count() == valid_trips(months).count()
    assert stored.last_load == 1


def test_old_dated_file_is_ingested(spark, raw):
    area, target, checkpoint = (new_folder(spark, n) for n in ("area", "target", "checkpoint"))
    write_parquet(_month(raw, "1996-01"), f"{area}/yellow_tripdata_1996-01")
    ingest_landing(spark, area, target, checkpoint)
    write_parquet(_month(raw, "1996-02"), f"{area}/yellow_tripdata_1996-02")
    month_ago = time.time() - 30 * 86_400
    for file in Path(area, "yellow_tripdata_1996-02").iterdir():
        os.utime(file, (month_ago, month_ago))
    ingest_landing(spark, area, target, checkpoint)
    both = _month(raw, "1996-01").count() + _month(raw, "1996-02").count()
    assert spark.read.parquet(target).count() == both


def test_batch_between_stream_batches_keeps_its_trips(spark, raw, raw_year, zones):
    area, root, checkpoint = (new_folder(spark, n) for n in ("area", "warehouse", "checkpoint"))
    init_warehouse(raw_year(1995), zones, root)
    write_parquet(_month(raw, "1996-01"), f"{area}/yellow_tripdata_1996-01", files=1)
    assert load_landed(spark, area, zones, root, checkpoint).last_load == 1
    load_batch(raw_year(1997), zones, root, 2)
    write_parquet(_month(raw, "1998-01"), f"{area}/yellow_tripdata_1998-01", files=1)
    stored = load_landed(spark, area, zones, root, checkpoint, years=(1998, 1998))
    assert stored.last_load == 3
    years = {r[0] for r in stored.fact_with_calendar().select("pick_year").distinct().collect()}
    assert years == {1995, 1996, 1997, 1998}
    with pytest.raises(ValueError, match="followed by load 3"):
        load_batch(raw_year(1996), zones, root, 1)
    with pytest.raises(ValueError, match="was written from"):
        load_batch(raw_year(1996), zones, root, 3)
