"""Calendar columns and code labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, Sunday first.
WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def fractional_hour(ts: Column) -> Column:
    return F.hour(ts) + F.minute(ts) / F.lit(60.0)


def weekday_name(weekday_id: Column) -> Column:
    """Name of a weekday number, as ``date_format(ts, 'EEEE')`` gives it without a time zone."""
    return F.element_at(F.array(*(F.lit(name) for name in WEEKDAY_NAMES)), weekday_id)


def calendar_parts(ts: Column, prefix: str) -> dict[str, Column]:
    """The six calendar columns of one timestamp; weekday 1 is Sunday."""
    return {
        f"{prefix}_hour": fractional_hour(ts),
        f"{prefix}_day": F.dayofmonth(ts),
        f"{prefix}_month": F.month(ts),
        f"{prefix}_year": F.year(ts),
        f"{prefix}_weekday": weekday_name(F.dayofweek(ts)),
        f"{prefix}_weekday_id": F.dayofweek(ts),
    }


def year_start(year: int) -> Column:
    return F.lit(f"{int(year):04d}-01-01 00:00:00").cast("timestamp_ntz")


def in_years(ts: Column, first: int, last: int | None = None) -> Column:
    """``year(ts)`` within a closed range, written as a plain range the parquet scan can use."""
    last = first if last is None else last
    return (ts >= year_start(first)) & (ts < year_start(int(last) + 1))


def code_label(code: Column, names: dict[int, str]) -> Column:
    """Label of a code, NULL when the code is unknown."""
    label = F.lit(None).cast("string")
    for value, name in names.items():
        label = F.when(code == value, name).otherwise(label)
    return label
