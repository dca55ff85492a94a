"""The eight report queries over a stored warehouse.

A fact row carries the calendar columns of its pickup, so no report joins the datetime
dimension. Reports are grouped before they meet another table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.calendar import weekday_name
from tripmart.functions.sums import endless_sum, exact_sum, finite
from tripmart.operators.changes import join_as_of
from tripmart.operators.filters import paid
from tripmart.operators.sinks import publish, read_published
from tripmart.plans.warehouse import DROPOFF, PICKUP, Table, Warehouse


def trip_count() -> Column:
    """Every fact has a trip id, so rows can be counted without reading that wide column."""
    return F.count("*").alias("total_trips")


def _totals() -> list[Column]:
    return [
        trip_count(),
        F.sum("passenger_count").alias("total_passengers"),
        exact_sum(finite("trip_distance")).alias("total_distance"),
        exact_sum(finite("total_amount")).alias("total_amount"),
        endless_sum("trip_distance").alias("endless_distance"),
        endless_sum("total_amount").alias("endless_amount"),
    ]


def _double(noun: str) -> Column:
    """A total as a double; one that has an infinite amount or NaN is what those add up to."""
    return F.coalesce(f"endless_{noun}", F.col(f"total_{noun}").cast("double"))


def _as_double(noun: str) -> Column:
    return _double(noun).alias(f"total_{noun}")


def _per_trip(noun: str, total: Column) -> Column:
    return (total / F.col("total_trips")).alias(f"average_{noun}_per_trip")


def agg_total(warehouse: Warehouse) -> DataFrame:
    """Overall totals and averages of all facts."""
    return (
        warehouse.fact_with_calendar()
        .agg(*_totals())
        .select(
            "total_trips",
            "total_passengers",
            _as_double("distance"),
            _as_double("amount"),
            _per_trip("distance", _double("distance")),
            _per_trip("amount", _double("amount")),
        )
    )


def paid_totals(warehouse: Warehouse) -> DataFrame:
    """Totals per year and payment, over facts whose payment is known and was made.

    The three payment reports derive from these few rows, so the fact is read once. The
    payment dimension has at most one row per code of the fixed label table.
    """
    per_payment = warehouse.fact_with_calendar().groupBy("pick_year", "payment_id").agg(*_totals())
    payments = F.broadcast(paid(warehouse.dim_payment()))
    return per_payment.join(payments, F.col("payment_id") == F.col("payment_type")).select(
        F.col("pick_year").alias("year"),
        "payment_id",
        F.col("payment_type_name").alias("payment_name"),
        "total_trips",
        "total_passengers",
        "total_distance",
        "total_amount",
        "endless_distance",
        "endless_amount",
    )


def agg_per_year(totals: DataFrame) -> DataFrame:
    """Totals and averages per year, from ``paid_totals``."""
    names = [name for name in totals.columns if name.startswith(("total_", "endless_"))]
    return (
        totals.groupBy("year")
        .agg(*(F.sum(name).alias(name) for name in names))
        .select(
            "year",
            "total_trips",
            "total_passengers",
            _as_double("distance"),
            _as_double("amount"),
            _per_trip("passengers", F.col("total_passengers").cast("double")),
            _per_trip("distance", _double("distance")),
            _per_trip("amount", _double("amount")),
        )
    )


def payment_per_year(totals: DataFrame) -> DataFrame:
    """Trips per year and payment, from ``paid_totals``."""
    return totals.select("year", "payment_id", "payment_name", "total_trips")


def agg_per_payment(totals: DataFrame) -> DataFrame:
    """Trips per payment, from ``paid_totals``."""
    return totals.groupBy("payment_id", "payment_name").agg(
        F.sum("total_trips").alias("total_trips")
    )


def trips_per_year_and_zone(warehouse: Warehouse, fact_key: str, zones: DataFrame) -> DataFrame:
    """Trips per pickup year and zone, counted by year and id before zones are joined."""
    key = zones.columns[0]
    per_zone = (
        warehouse.fact_with_calendar()
        .groupBy("pick_year", F.col(fact_key).alias(key))
        .agg(trip_count())
    )
    return per_zone.join(zones, key).select("pick_year", *zones.columns, "total_trips")


def _trips_per_location(warehouse: Warehouse, fact_key: str, zones: DataFrame, side: str) -> DataFrame:
    counted = trips_per_year_and_zone(warehouse, fact_key, zones)
    names = {"pick_year": "year", zones.columns[0]: "LocationID", "X": f"{side}_x", "Y": f"{side}_y"}
    return counted.withColumnsRenamed(names)


def trips_per_pu_location(warehouse: Warehouse) -> DataFrame:
    return _trips_per_location(warehouse, "pu_location_id", warehouse.dim_pickup_location(), "pickup")


def trips_per_do_location(warehouse: Warehouse) -> DataFrame:
    return _trips_per_location(warehouse, "do_location_id", warehouse.dim_dropoff_location(), "dropoff")


def _trips_per_version(warehouse: Warehouse, fact_key: str, table: Table) -> DataFrame:
    """Trips per year and version of their zone, as it was on the day of the pickup.

    Trips are counted by zone and day first; the counts meet the versions, not the trips.
    """
    key = table.schema.names[0]
    counted = (
        warehouse.fact_with_calendar()
        .groupBy("pick_date", F.col(fact_key).alias(key))
        .agg(trip_count())
    )
    attributes = [F.col(name) for name in table.schema.names[1:]]
    return (
        join_as_of(counted, warehouse.versions(table), key, "pick_date")
        .groupBy(F.year("pick_date").alias("year"), F.col(key).alias("LocationID"), *attributes, "valid_from")
        .agg(F.sum("total_trips").alias("total_trips"))
    )


def trips_per_pickup_version(warehouse: Warehouse) -> DataFrame:
    return _trips_per_version(warehouse, "pu_location_id", PICKUP)


def trips_per_dropoff_version(warehouse: Warehouse) -> DataFrame:
    return _trips_per_version(warehouse, "do_location_id", DROPOFF)


def trips_per_day(warehouse: Warehouse) -> DataFrame:
    """Trips per year and pickup weekday; ``day_order`` 1 is Sunday."""
    per_day = warehouse.fact_with_calendar().groupBy("pick_year", "pick_weekday_id").agg(trip_count())
    return per_day.select(
        F.col("pick_year").alias("year"),
        weekday_name(F.col("pick_weekday_id")).alias("day"),
        F.col("pick_weekday_id").alias("day_order"),
        "total_trips",
    )


def trips_per_hour(warehouse: Warehouse) -> DataFrame:
    hour = F.col("pick_hour").cast("int").alias("hour")
    return (
        warehouse.fact_with_calendar()
        .groupBy(F.col("pick_year").alias("year"), hour)
        .agg(trip_count())
    )


def publish_all(warehouse: Warehouse, area: str) -> None:
    """Replace all eight result tables; the payment reports share one pass over the fact."""
    spark = warehouse.spark
    publish(paid_totals(warehouse), area, "paid_totals")
    totals = read_published(spark, area, "paid_totals")
    for report in (agg_per_year, payment_per_year, agg_per_payment):
        publish(report(totals), area, report.__name__)
    for report in (
        agg_total,
        trips_per_pu_location,
        trips_per_do_location,
        trips_per_day,
        trips_per_hour,
    ):
        publish(report(warehouse), area, report.__name__)
