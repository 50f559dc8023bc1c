"""Group-by shapes that stay flat under hot keys.

Each one reduces rows in the map tasks before anything is shuffled, and none collects the
members of a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_sum(df: DataFrame, keys: Sequence[str], by: Sequence[str], value: str, name: str) -> DataFrame:
    """Drop repeated (keys, by, value) rows, then sum ``value`` per ``keys``."""
    return df.select(*dict.fromkeys([*keys, *by, value])).distinct().groupBy(*keys).agg(F.sum(value).alias(name))


def distinct_counts(
    df: DataFrame,
    keys: Sequence[str],
    item: str,
    flags: Mapping[str, Column],
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Several conditional distinct counts of one item, plus sums, in two plain aggregations.

    First one row per (keys, item) with each condition folded to a maximum, then a sum of
    those. A ``count(distinct case ...)`` per condition would copy every row once per
    condition; here a hot group is first spread over its items.
    """
    sums = dict(sums or {})
    per_item = df.groupBy(*keys, item).agg(
        *(F.sum(c).alias(n) for n, c in sums.items()),
        *(F.max(F.when(c & F.col(item).isNotNull(), 1).otherwise(0)).alias(n) for n, c in flags.items()),
    )
    return per_item.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in (*sums, *flags)))


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The row-number filter is planned as a group limit: every map task keeps one row per key
    before the shuffle, so the size of a key does not matter.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where(F.col("_place") == 1).drop("_place")


def latest(df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key with the greatest ``order``, a NULL counting as greatest.

    Ties go to the smallest ``tiebreak`` values, NULLs first.
    """
    return first_wins(df, keys, [F.col(order).desc_nulls_first(), *(F.col(t).asc_nulls_first() for t in tiebreak)])


def resum(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum already aggregated measures onto coarser keys.

    Distinct counts are not additive: after this they count an item once per finer group.
    """
    return df.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))
