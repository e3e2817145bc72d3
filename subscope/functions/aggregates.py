"""Aggregate expressions and the two-level distinct roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import col


def n_distinct(*cols) -> Column:
    """Distinct tuples; a null part counts as a value of its own."""
    return F.count_distinct(F.struct(*[col(c) for c in cols]))


def count_distinct_if(cond: Column, *cols) -> Column:
    """Distinct tuples among the rows that satisfy ``cond``."""
    key = col(cols[0]) if len(cols) == 1 else F.struct(*[col(c) for c in cols])
    return F.count_distinct(F.when(cond, key))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sum_if(cond: Column, value) -> Column:
    """Sum of ``value`` where ``cond``; zero, not null, over nothing."""
    return F.coalesce(F.sum(F.when(cond, col(value))), F.lit(0))


def mean_if(cond: Column, value) -> Column:
    """Mean of ``value`` where ``cond``: the exact sum divided once (null over nothing)."""
    picked = F.when(cond, col(value))
    return F.try_divide(F.sum(picked).cast("double"), F.count(picked).cast("double"))


def sum0(value) -> Column:
    return F.coalesce(F.sum(col(value)), F.lit(0))


def distinct_rollup(
    df: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    flags: Mapping[str, Column] | None = None,
    sums: Mapping[str, Column] | None = None,
    total: str = "n",
) -> DataFrame:
    """Many conditional distinct counts of one key in one shuffle.

    A key counts for a flag when any of its rows satisfies it. The first
    aggregation is on ``by + key`` (spread over the cluster even when one
    group holds most rows, and combined map-side); the second only adds up
    flags. Each entry of ``sums`` also yields ``<name>_n``, the number of
    non-null values, so that a mean is ``name / name_n``.
    """
    flags, sums = dict(flags or {}), dict(sums or {})
    inner = [F.max(F.when(c, 1).otherwise(0)).alias(f) for f, c in flags.items()]
    for s, c in sums.items():
        inner += [F.sum(c).alias(s), F.count(c).alias(f"{s}_n")]
    if not inner:
        inner = [F.lit(1).alias("__one")]
    outer = [F.count(F.lit(1)).alias(total)]
    outer += [F.sum(f).alias(f) for f in flags]
    for s in sums:
        outer += [F.sum(s).alias(s), F.sum(f"{s}_n").alias(f"{s}_n")]
    return df.groupBy(*by, *key).agg(*inner).groupBy(*by).agg(*outer)
