"""Aggregate expressions used across the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_when(item: Column, cond: Column) -> Column:
    """``count(distinct case when cond then item end)``."""
    return F.count_distinct(F.when(cond, item))


def count_when(cond: Column) -> Column:
    return F.count_if(cond)


def sum_when(value: Column, cond: Column) -> Column:
    return F.sum(F.when(cond, value))
