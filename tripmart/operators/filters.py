"""Row filters of the load jobs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.functions.calendar import in_years
from tripmart.schemas import RAW_TRIP, UNPAID_CODES


def complete_trips(trips: DataFrame) -> DataFrame:
    """Trips without a null (or NaN) in any contract column."""
    return trips.dropna(subset=RAW_TRIP.names)


# Why a trip is not loaded, in the order in which it is asked.
INCOMPLETE, NO_DISTANCE, NO_PASSENGERS = "incomplete", "no distance", "no passengers"


def reject_reason() -> Column:
    """Why ``valid_trips`` leaves a trip out; null for a trip that it keeps."""
    missing = F.lit(False)
    for field in RAW_TRIP:
        missing |= F.col(field.name).isNull()
        if field.dataType.typeName() == "double":
            missing |= F.isnan(field.name)
    return (
        F.when(missing, INCOMPLETE)
        .when(~(F.col("trip_distance") > 0), NO_DISTANCE)
        .when(~(F.col("passenger_count") > 0), NO_PASSENGERS)
    )


def rejected_trips(trips: DataFrame) -> DataFrame:
    """The trips that are not loaded, with all their columns and the reason."""
    return trips.withColumn("reason", reject_reason()).filter(F.col("reason").isNotNull())


def picked_up_in(trips: DataFrame, first: int, last: int | None = None) -> DataFrame:
    return trips.filter(in_years(F.col("tpep_pickup_datetime"), first, last))


def valid_trips(trips: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
    """Complete trips with a distance and passengers, optionally of a closed range of years."""
    kept = complete_trips(trips).filter((F.col("trip_distance") > 0) & (F.col("passenger_count") > 0))
    return picked_up_in(kept, *years) if years else kept


def paid(df: DataFrame, code: str = "payment_type") -> DataFrame:
    """Leave out the payment codes that mean no payment was made."""
    return df.filter(~F.col(code).isin(*UNPAID_CODES))
