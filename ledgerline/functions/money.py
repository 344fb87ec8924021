"""Sums and means of amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount_sum(amount: Column, places: int | None = None) -> Column:
    """Sum of amounts, 0 if there are none.

    With ``places`` the amounts are summed as whole numbers of ``10 ** -places``. That is exact for amounts with no
    more decimals, and independent of the order of the rows.
    """
    if places is None:
        return F.coalesce(F.sum(amount.cast("double")), F.lit(0.0))
    unit = 10**places
    return F.coalesce(F.sum(F.round(amount * unit).cast("bigint")), F.lit(0)) / unit


def amount_mean(amount: Column, places: int | None = None) -> Column:
    if places is None:
        return F.avg(amount.cast("double"))
    unit = 10**places
    whole = F.round(amount * unit).cast("bigint")
    return F.try_divide(F.sum(whole), F.count(whole) * unit)
