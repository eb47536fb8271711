"""Weighted aggregates as Column expressions.

Weights are summed as decimals, so a total does not depend on how the rows were
partitioned; only the final ratio is a double.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

SUM_TYPE = "decimal(28,8)"


def weighted_total(weight: Column, where: Column | None = None) -> Column:
    """Sum of the weights, of all rows or of those matching ``where``."""
    exact = weight.cast(SUM_TYPE)
    return F.sum(exact if where is None else F.when(where, exact))


def ratio_pct(part: Column, whole: Column, places: int) -> Column:
    """``100 * part / whole`` rounded half up; null if the whole is zero or missing."""
    share = F.try_divide(100 * part.cast("double"), whole.cast("double"))
    return F.round(share, places)


def weighted_share(where: Column, weight: Column, base: Column | None = None, places: int = 1) -> Column:
    """Weighted percentage of rows matching ``where`` among rows matching ``base``.

    Like a filtered SQL sum, it is null when no row matches.
    """
    return ratio_pct(weighted_total(weight, where), weighted_total(weight, base), places)


def weighted_rate(flag: Column, weight: Column, places: int = 2) -> Column:
    """Weighted percentage of true flags among the known ones.

    No known flag gives null; known flags that are all false give zero.
    """
    hits = F.coalesce(weighted_total(weight, flag), F.lit(0).cast(SUM_TYPE))
    return ratio_pct(hits, weighted_total(weight, flag.isNotNull()), places)
