"""Aggregate building blocks (all with map-side partial aggregation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.scalars import ColumnOrName, col


def count_distinct(c: ColumnOrName) -> Column:
    return F.count_distinct(col(c))


def count_if(pred: Column) -> Column:
    """``sum(case when pred then 1 else 0 end)``."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("long")


def sum_of(c: ColumnOrName) -> Column:
    return F.sum(col(c))


def sum_if(pred: Column, value: ColumnOrName) -> Column:
    """``sum(case when pred then value else 0 end)``."""
    return F.sum(F.when(pred, col(value)).otherwise(F.lit(0)))


def min_of(c: ColumnOrName) -> Column:
    return F.min(col(c))


def max_if(pred: Column, value: ColumnOrName) -> Column:
    """``max(case when pred then value else 0 end)``."""
    return F.max(F.when(pred, col(value)).otherwise(F.lit(0)))


def any_flag(pred: Column) -> Column:
    """``max(case when pred then 1 else 0 end) = 1``: false, never NULL, when nothing matches."""
    return F.coalesce(F.bool_or(F.coalesce(pred, F.lit(False))), F.lit(False))


def max_text(c: ColumnOrName) -> Column:
    return F.max(col(c))


def avg_round(c: ColumnOrName, digits: int = 2) -> Column:
    return F.round(F.avg(col(c)), digits)
