"""Sums whose result does not depend on the order in which tasks finish."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = 10_000


# Units that a long holds.
_MOST_UNITS = float(1 << 63)


def exact_sum(amount: Column | str) -> Column:
    """Sum a double column without losing digits; the result is a decimal of twelve places.

    Rows are added as whole ten-thousandths in a long, which is exact in any order and
    costs no more than a sum of doubles, while a decimal per row takes ten times as long.
    What a row holds beyond four places is added as a double; it is zero for amounts of
    four places or fewer. A group whose amounts without their signs total more than some
    900 trillion raises, in ANSI mode or not, as an infinite amount or NaN does.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    whole = F.rint(amount * _UNITS)
    units = F.sum(whole.cast("bigint")).cast("decimal(20,0)") * F.lit("0.0001").cast("decimal(5,4)")
    total = units + F.sum(amount - whole / _UNITS).cast("decimal(30,12)")
    too_much = F.raise_error(F.lit("exact_sum: the amounts of a group are beyond its range"))
    # NaN is larger than any number
    return F.when(F.sum(F.abs(whole)) >= _MOST_UNITS, too_much).otherwise(total)


def finite(amount: Column | str) -> Column:
    """The amount, or null where it is infinite or NaN."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.when(F.abs(amount) < float("inf"), amount)


def endless_sum(amount: Column | str) -> Column:
    """The sum of infinite amounts and NaN, null if there are none: then all amounts are finite."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(F.when(finite(amount).isNull(), amount))


def exact_total(amount: Column | str) -> Column:
    """exact_sum as a double; infinite amounts and NaN give what a sum of doubles gives."""
    return F.coalesce(endless_sum(amount), exact_sum(finite(amount)).cast("double"))
