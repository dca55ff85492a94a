"""The reports with every join spelled out, to compare results and times with.

Each report joins the fact with the datetime dimension on its key and groups afterwards,
and the payment reports repeat the join, as the plain star-schema queries do.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.filters import paid
from tripmart.plans.warehouse import Warehouse


def _dated(warehouse: Warehouse) -> DataFrame:
    on = F.col("datetimestamp_id") == F.col("datetime_id")
    return warehouse.fact_trip().join(warehouse.dim_datetime(), on)


def _paid(warehouse: Warehouse) -> DataFrame:
    payments = F.broadcast(paid(warehouse.dim_payment()))
    return _dated(warehouse).join(payments, F.col("payment_id") == F.col("payment_type"))


def _trips(rows: DataFrame, **keys: str) -> DataFrame:
    names = [F.col(column).alias(name) for name, column in keys.items()]
    return rows.groupBy(*names).agg(F.count("trip_id").alias("total_trips"))


def agg_per_year(warehouse: Warehouse) -> DataFrame:
    return _paid(warehouse).groupBy(F.col("pick_year").alias("year")).agg(
        F.count("trip_id").alias("total_trips"),
        *(
            aggregate(column).alias(f"{prefix}_{column}")
            for column in ("passenger_count", "trip_distance", "total_amount")
            for prefix, aggregate in (("sum", F.sum), ("avg", F.avg))
        ),
    )


def payment_per_year(warehouse: Warehouse) -> DataFrame:
    return _trips(
        _paid(warehouse), year="pick_year", payment_id="payment_id", payment_name="payment_type_name"
    )


def agg_per_payment(warehouse: Warehouse) -> DataFrame:
    return _trips(_paid(warehouse), payment_id="payment_id", payment_name="payment_type_name")


def _per_location(warehouse: Warehouse, fact_key: str, zones: DataFrame, side: str) -> DataFrame:
    key = zones.columns[0]
    joined = _dated(warehouse).join(zones, F.col(fact_key) == F.col(key))
    keys = {"year": "pick_year", "LocationID": key, f"{side}_x": "X", f"{side}_y": "Y"}
    return _trips(joined, **keys, zone="zone", borough="borough", service_zone="service_zone")


def trips_per_pu_location(warehouse: Warehouse) -> DataFrame:
    return _per_location(warehouse, "pu_location_id", warehouse.dim_pickup_location(), "pickup")


def trips_per_do_location(warehouse: Warehouse) -> DataFrame:
    return _per_location(warehouse, "do_location_id", warehouse.dim_dropoff_location(), "dropoff")


def trips_per_day(warehouse: Warehouse) -> DataFrame:
    return _trips(_dated(warehouse), year="pick_year", day="pick_weekday", day_order="pick_weekday_id")


def trips_per_hour(warehouse: Warehouse) -> DataFrame:
    hours = _dated(warehouse).withColumn("whole_hour", F.col("pick_hour").cast("int"))
    return _trips(hours, year="pick_year", hour="whole_hour")


REPORTS = {
    report.__name__: report
    for report in (
        agg_per_year,
        payment_per_year,
        agg_per_payment,
        trips_per_pu_location,
        trips_per_do_location,
        trips_per_day,
        trips_per_hour,
    )
}
