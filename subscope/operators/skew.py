"""Joins whose frequent keys are found beforehand.

A hash shuffle sends all rows of a key to one task. Here a frequent-items sketch names the keys
that may hold more than a task's even part. Of the other side, which has one row a key, the rows of
those few keys are broadcast and meet their rows where these are; only the rest is shuffled.
The plan holds all of it: no key reaches the driver's code, and nothing depends on
runtime splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .groups import group_stats, key_of

#: A key is frequent from this share of a task's even part on; the sketch's least support.
SHARE, LEAST = 0.5, 1e-4


def frequent_keys(df: DataFrame, by: Sequence[str], tasks: int, share: float = SHARE) -> DataFrame:
    """(__key): all keys that hold more than ``share / tasks`` of the rows, and perhaps some that hold less.

    A sketch of bounded size: at most ``tasks / share`` keys come out, 10,000 at most, however many there are.
    """
    support = min(1.0, max(share / tasks, LEAST))
    found = df.select(key_of(by).alias("__key")).freqItems(["__key"], support)
    return found.select(F.explode(found.columns[0]).alias("__key")).distinct()


def spread_join(df: DataFrame, by: Sequence[str], stats: DataFrame, tasks: int | None = None, share: float = SHARE) -> DataFrame:
    """``df`` joined with ``stats``, one row for each ``__key`` (:func:`groups.key_of`); frequent keys are not shuffled.

    Null key parts match each other. ``df`` is read three times (sketch, frequent rows, the rest) and
    ``stats`` twice: stage what is dear. ``tasks`` is the session's number of shuffle partitions if not given.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(frequent_keys(df, by, tasks, share).withColumnRenamed("__key", "__hot"))
    told = F.broadcast(stats.join(hot, stats["__key"] == hot["__hot"], "left_semi"))
    key = key_of([df[c] for c in by])
    often = df.join(told, key == told["__key"], "inner").drop("__key")
    # NOT IN would treat null parts as unknown; equal structs match.
    rest = df.join(hot, key == hot["__hot"], "left_anti")
    rest = rest.join(stats, key_of([rest[c] for c in by]) == stats["__key"], "inner").drop("__key")
    return often.unionByName(rest)


def with_spread_group_stat(df: DataFrame, by: Sequence[str], stats, tasks: int | None = None) -> DataFrame:
    """:func:`groups.with_group_stat` by :func:`spread_join`."""
    return spread_join(df, by, group_stats(df, by, [c.alias(n) for n, c in stats.items()]), tasks)
