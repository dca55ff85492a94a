from pyspark.sql import functions as F

from tripmart import schemas
from tripmart.checks.fixtures import YEAR_FOLDER
from tripmart.jobs import run
from tripmart.operators.sinks import write_parquet
from tripmart.plans.warehouse import Warehouse
from tripmart.storage import new_folder


def test_jobs_from_raw_files_to_scores(spark, landed, raw):
    root, marts = new_folder(spark, "warehouse"), new_folder(spark, "marts")
    load = ["--area", landed.area, "--zones", landed.zones, "--warehouse", root]
    years = [*load, "--folder", YEAR_FOLDER]
    run(spark, ["init", *years, "--year", "1995"])
    run(spark, ["batch", *years, "--year", "1996"])
    run(spark, ["batch", *years, "--year", "1996", "--load", "1"])
    run(spark, ["backfill", *years, "--first", "1997", "--last", "1998"])
    stored = Warehouse(spark, root)
    assert stored.last_load == 2
    per_year = stored.fact_with_calendar().groupBy("pick_year").count().collect()
    assert {row["pick_year"] for row in per_year} == {1995, 1996, 1997, 1998}

    arrived, checkpoint = new_folder(spark, "arrived"), new_folder(spark, "checkpoint")
    month = raw.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == "1999-01")
    files = new_folder(spark, "files")
    write_parquet(month.select(*schemas.RAW_TRIP.names).withColumn("extra_fee", F.lit(1)), files)
    run(spark, ["normalise", "--files", files, "--out", f"{arrived}/yellow_tripdata_1999-01"])
    landed_load = ["--area", arrived, "--zones", landed.zones, "--warehouse", root]
    run(spark, ["landed", *landed_load, "--checkpoint", checkpoint, "--first-load", "3"])
    assert Warehouse(spark, root).last_load == 3

    results = ["--warehouse", root, "--marts", marts]
    run(spark, ["reports", *results])
    run(spark, ["clusters", *results])
    run(spark, ["correlation", *results])
    run(spark, ["scores", *results, "--year", "1997"])
    facts = Warehouse(spark, root).fact_with_calendar()
    hours = facts.select("pick_year", F.floor("pick_hour")).distinct().count()
    sizes = {
        "agg_total": 1,
        "agg_per_year": 5,
        "agg_per_payment": 4,
        "trips_per_hour": hours,
        "kmean_pickup_location": 24,
        "feature_correlation": 17 * 17,
        "model_evaluation": 3,
    }
    for name, size in sizes.items():
        assert spark.read.parquet(f"{marts}/{name}").count() == size, name
