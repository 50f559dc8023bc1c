"""Join shapes: effective-dated lookups, match cascades, full outer merges, membership tests.

None of them carries a broadcast hint. Adaptive execution measures each side and broadcasts
it only under ``spark.sql.autoBroadcastJoinThreshold``; beyond it the join is a shuffle on
the equality keys, with hot partitions of the fact side split by the skew-join rule.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scan_filter(df: DataFrame, column: str, value) -> DataFrame:
    """Equality filter; reaches the Parquet scan as a pushed predicate."""
    return df.where(F.col(column) == value)


def banded_lookup(
    fact: DataFrame,
    bands: DataFrame,
    on: Mapping[str, str],
    at: str,
    low: str,
    high: str,
    values: Mapping[str, str],
    patch_high: tuple[int, int] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Left lookup of the band with equal keys whose [low, high] range contains ``at``.

    ``on`` maps fact columns to band columns, ``values`` maps band columns to output names.
    ``patch_high=(364, 371)`` widens bands ending at the first number to the second.
    Overlapping bands repeat the fact row; with ``unique=True`` the latest start wins.
    """
    keys = list(on.values())
    dim = bands.select(*dict.fromkeys([*keys, low, high, *values]))
    if patch_high:
        dim = dim.withColumn(high, F.when(F.col(high) == patch_high[0], patch_high[1]).otherwise(F.col(high)))
    names = [f"_k{i}" for i in range(len(keys))]
    picked = dim.select(
        *(F.col(k).alias(n) for k, n in zip(keys, names)),
        F.col(low).alias("_low"),
        F.col(high).alias("_high"),
        *(F.col(src).alias(name) for src, name in values.items()),
    )
    same_key = _all_equal(list(on), names)
    if not unique:
        inside = F.col(at).between(F.col("_low"), F.col("_high"))
        return fact.join(picked, same_key & inside, "left").drop("_low", "_high", *names)
    # Resolve each distinct (keys, moment) once; the fact then joins on equality alone.
    probes = fact.select(*(F.col(c).alias(f"_p{i}") for i, c in enumerate(on)), F.col(at).alias("_at")).distinct()
    probe_names = [f"_p{i}" for i in range(len(keys))]
    best = (
        probes.join(picked, _all_equal(probe_names, names) & F.col("_at").between(F.col("_low"), F.col("_high")))
        .groupBy(*probe_names, "_at")
        .agg(F.max(F.struct("_low", "_high", *values.values())).alias("_own"))
        .select(*probe_names, "_at", *(F.col(f"_own.{v}").alias(v) for v in values.values()))
    )
    cond = _all_equal([*on, at], [*probe_names, "_at"])
    return fact.join(best, cond, "left").drop("_at", *probe_names)


@dataclass(frozen=True)
class Bands:
    """Effective-dated rows of one table: key, range, further equalities (fact column: band column), values (band column: name)."""

    table: DataFrame
    key: str
    low: str
    high: str
    values: Mapping[str, str]
    also: Mapping[str, str] = field(default_factory=dict)


def _inside(bands: Bands, at: str) -> Callable[[Column], Column]:
    def test(band: Column) -> Column:
        found = F.col(at).between(band[bands.low], band[bands.high])
        for mine, theirs in bands.also.items():
            found = found & (F.col(mine) == band[theirs])
        return found

    return test


def folded(*tables: Bands) -> DataFrame:
    """One row a key (``_key``) with the bands of each table, a row per change, as a sorted array (``_bands0``, ``_bands1``, ...).

    The rows are dealt by key before they are gathered: a map task would only sort them to no use.
    """
    cards = None
    for i, bands in enumerate(tables):
        entry = F.struct(bands.low, bands.high, *bands.also.values(), *bands.values)
        own = bands.table.where(F.col(bands.key).isNotNull()).select(F.col(bands.key).alias("_key"), entry.alias("_entry"))
        card = own.repartition("_key").groupBy("_key").agg(F.sort_array(F.collect_list("_entry")).alias(f"_bands{i}"))
        cards = card if cards is None else cards.join(card, "_key", "full")
    return cards


def search_folded(found: DataFrame, kept: Sequence[str], at: str, *tables: Bands) -> DataFrame:
    """``kept`` and the values valid at ``at``, from the arrays of ``folded(*tables)`` that the rows carry.

    Overlapping bands repeat a row, as joins would.
    """
    kept = list(kept)
    for i, bands in enumerate(tables):
        hits = F.filter(f"_bands{i}", _inside(bands, at))
        values = F.transform(hits, lambda b: F.struct(*(b[v].alias(n) for v, n in bands.values.items())))
        rest = [f"_bands{j}" for j in range(i + 1, len(tables))]
        found = found.select(*kept, *rest, F.inline_outer(values))
        kept.extend(bands.values.values())
    return found


def folded_lookups(fact: DataFrame, key: str, at: str, *tables: Bands) -> DataFrame:
    """Several left lookups of bands that share one key, in a single join on that key.

    The bands of a key are folded into one row beforehand. The fact moves once and searches the arrays in place; overlapping
    bands repeat its rows, as joins would.
    """
    found = fact.join(folded(*tables), F.col(key) == F.col("_key"), "left")
    return search_folded(found, fact.columns, at, *tables)


def _all_equal(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.col(left[0]) == F.col(right[0])
    for a, b in zip(left[1:], right[1:]):
        cond = cond & (F.col(a) == F.col(b))
    return cond


def match_cascade(
    df: DataFrame,
    tiers: Sequence[tuple[DataFrame, Mapping[str, str]]],
    target: str,
    default_target: int,
    tier_name: str = "match_int",
) -> DataFrame:
    """First matching tier wins; each tier maps columns of ``df`` to columns of its table.

    Every tier is reduced to one row per key (the smallest ``target``) before joining, so the
    cascade keeps the row count. The tier number of a miss is one past the last tier.
    """
    for i, (table, on) in enumerate(tiers, start=1):
        best = table.groupBy(*on.values()).agg(F.min(target).alias(f"_t{i}"))
        names = [f"_k{j}" for j in range(len(on))]
        best = best.select(*(F.col(k).alias(n) for k, n in zip(on.values(), names)), f"_t{i}")
        df = df.join(best, _all_equal(list(on), names), "left").drop(*names)
    hits = [F.col(f"_t{i}") for i in range(1, len(tiers) + 1)]
    tier = F.coalesce(*(F.when(h.isNotNull(), i) for i, h in enumerate(hits, start=1)), F.lit(len(tiers) + 1))
    return (
        df.withColumn(target, F.coalesce(*hits, F.lit(default_target)))
        .withColumn(tier_name, tier)
        .drop(*(f"_t{i}" for i in range(1, len(tiers) + 1)))
    )


def full_outer_coalesce(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer merge on ``keys``; rows with a NULL key never pair but are kept."""
    return left.join(right, list(keys), "full")


def semi(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """``IN (subquery)``."""
    names = [f"_x{i}" for i in range(len(on))]
    listed = keys.select(*(F.col(k).alias(n) for k, n in zip(on.values(), names)))
    return df.join(listed, _all_equal(list(on), names), "left_semi")


def anti_not_in(df: DataFrame, keys: DataFrame, column: str, key: str, null_safe: bool = True) -> DataFrame:
    """``NOT IN (subquery)``.

    With a NULL in the list SQL returns nothing at all. ``null_safe`` drops NULLs from the
    list first, which is what such filters mean; turn it off for the literal rule. Either
    way a NULL ``column`` is excluded unless the list is empty.
    """
    listed = keys.select(F.col(key).alias("_x0"))
    kept = df.join(listed.where(F.col("_x0").isNotNull()), F.col(column) == F.col("_x0"), "left_anti")
    facts = listed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_x0").isNull()).alias("nulls"))
    empty = facts.select(F.col("n") - (F.col("nulls") if null_safe else F.lit(0)) == 0).scalar()
    kept = kept.where(F.col(column).isNotNull() | empty)
    if not null_safe:
        kept = kept.where(facts.select(F.col("nulls") == 0).scalar())
    return kept


def new_ids(staged: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Staged rows whose key is not known yet; a NULL staged key counts as new."""
    return staged.join(known.select(key), key, "left_anti")


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame as scalar subqueries."""
    return df.select("*", *(one_row.select(c).scalar().alias(c) for c in one_row.columns))


def union_branches(*branches: DataFrame) -> DataFrame:
    """UNION ALL of same-shape branches, matched by column name."""
    result = branches[0]
    for b in branches[1:]:
        result = result.unionByName(b)
    return result
