"""Group extremes, group statistics and shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def key_of(cols: Sequence[str | Column]) -> Column:
    """One key column of several. Null parts compare as equal, and grouping and
    joining by the same column need one shuffle between them."""
    return F.struct(*[
        (F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(cols)
    ])


def group_stats(df: DataFrame, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Group aggregates under one key column, ready to be joined back."""
    return df.groupBy(key_of(by).alias("__key")).agg(*aggs)


def join_stats_back(df: DataFrame, by: Sequence[str], stats: DataFrame) -> DataFrame:
    return df.join(stats, key_of([df[c] for c in by]) == stats["__key"], "inner").drop("__key")


def _keep_extreme(df: DataFrame, by: Sequence[str], key: str, agg) -> DataFrame:
    best = group_stats(df, by, [agg(key).alias("__best")])
    same = key_of([df[c] for c in by]) == best["__key"]
    return df.join(best, same & (df[key] == best["__best"]), "left_semi")


def keep_group_max(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """Rows at their group's maximum of ``key``, all ties kept; null keys drop out.

    The semi-join key includes the extreme value, so a group that holds most
    rows is still spread by its values and the extremes are combined map-side.
    """
    return _keep_extreme(df, by, key, F.max)


def keep_group_min(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    return _keep_extreme(df, by, key, F.min)


def with_group_stat(df: DataFrame, by: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Add group aggregates to every row of the group (null keys form a group)."""
    return join_stats_back(df, by, group_stats(df, by, [c.alias(n) for n, c in stats.items()]))


def share_of(
    df: DataFrame, by: Sequence[str], value: str, name: str = "share", total: str = "total"
) -> DataFrame:
    """Percent of the group total (of the grand total when ``by`` is empty).

    ``df`` is an aggregated table. The grand total is a scalar subquery, so
    the table is never drawn into one task.
    """
    if by:
        df = df.withColumn(total, F.sum(value).over(W.partitionBy(*by)))
    else:
        df = df.withColumn(total, df.agg(F.sum(value)).scalar())
    return df.withColumn(
        name, F.try_divide(F.col(value).cast("double") * 100, F.col(total).cast("double"))
    )


def top_k_ties(df: DataFrame, k: int, weight: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose weight is among the ``k`` largest, with ties.

    Overall: the k-th weight is a scalar subquery over a distributed top-k.
    Per group: ``rank() <= k``, which Spark prunes in each task before the
    shuffle (window group limit), so a large group never travels whole.
    """
    if by:
        w = W.partitionBy(*by).orderBy(F.col(weight).desc())
        return df.withColumn("__r", F.rank().over(w)).where(f"__r <= {int(k)}").drop("__r")
    kth = df.select(weight).orderBy(F.col(weight).desc()).limit(k).agg(F.min(weight)).scalar()
    return df.where(F.col(weight) >= kth)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group in a total order (pruned before the shuffle)."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where(f"__r <= {int(n)}").drop("__r")


def sorted_output(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in a final order: ranges are dealt to tasks, so no task sorts all; files keep the order."""
    return df.orderBy(*order)


def first_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def duplicate_rows(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows whose key occurs more than once, with the count."""
    if set(df.columns) == set(keys):  # the rows are their keys: repeated, not joined back
        counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)
        each = F.explode(F.sequence(F.lit(1), F.col(name)))
        return counts.withColumn("__each", each).drop("__each")
    counts = group_stats(df, keys, [F.count(F.lit(1)).alias(name)]).where(F.col(name) > 1)
    return join_stats_back(df, keys, counts)
