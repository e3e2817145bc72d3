"""Wide and long tables, unions, schema alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_wide(
    df: DataFrame, by: Sequence[str], key: str, value: str, levels: Sequence[str]
) -> DataFrame:
    """Long to wide. The levels are declared, so no extra job looks for them."""
    return df.groupBy(*by).pivot(key, list(levels)).agg(F.sum(value))


def to_long(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], key: str, value: str
) -> DataFrame:
    return df.unpivot(list(ids), list(cols), key, value)


def distinct_channels(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str):
    """Number of columns above zero per row group, counted over the long form."""
    long = to_long(df, ids, cols, "__k", "__v")
    return long.groupBy(*ids).agg(
        F.count_distinct(F.when(F.col("__v") > 0, F.col("__k"))).alias(name)
    )


def bind_rows(*dfs: DataFrame) -> DataFrame:
    """Bag union by name; a column one side lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def align(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Cast to one declared schema before a union; missing columns become null."""
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
            for c, t in schema.items()
        ]
    )


def weekly_mean(
    df: DataFrame, by: Sequence[str], week: str, value: str, n_weeks: int, name: str
) -> DataFrame:
    """Mean per week over a grid of ``n_weeks``; weeks without a row count as zero.

    The grid itself is not built: the missing weeks add nothing to the sum.
    """
    return df.groupBy(*by).agg(F.sum(value).alias("total")).withColumn(
        name, F.coalesce(F.col("total"), F.lit(0)).cast("double") / F.lit(n_weeks)
    )


def as_report(
    df: DataFrame, names: Mapping[str, str], pct_cols: Sequence[str] = (), k: int = 0
) -> DataFrame:
    """Display table: chosen columns under display names, shares as percent text."""
    from ..functions.columns import pct_label

    return df.select(
        *[(pct_label(c, k) if c in pct_cols else F.col(c)).alias(n) for c, n in names.items()]
    )
