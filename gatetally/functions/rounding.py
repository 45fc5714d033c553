"""Sums and rounding that do not depend on the order of the rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(number: Column) -> Column:
    """The sum, added as decimals of twelve places, so that its order does not matter.

    Where a value has no such decimal (NaN, infinities, 1e16 and more), the
    group is summed in floating point.
    """
    exact = number.try_cast("decimal(28,12)")
    others = F.count_if(number.isNotNull() & exact.isNull())
    return F.when(others == 0, F.sum(exact).cast("double")).otherwise(F.sum(number))


def steady_round(number: Column, digits: int) -> Column:
    """Round half up to ``digits`` places, ignoring noise below 1e-9.

    A distributed sum adds in no fixed order, so its last bits differ between
    runs and a tie such as 2.125 could go either way after a lost executor is
    replaced. Passing through a nine-place decimal removes that noise first.
    NaN, infinities and numbers too large for the decimal are left as they are.
    """
    settled = F.round(number.try_cast("decimal(38,9)"), digits).cast("double")
    return F.coalesce(settled, number)
