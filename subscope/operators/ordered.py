"""Sequences inside a key: numbering, neighbours, running sums, streaks, quantiles.

A plain window sends every row of a key to one task. Here the key is cut into
buckets that follow the order (a month, a day, a value range); rows are
handled inside a bucket, and one small row per bucket carries the state from
bucket to bucket. Results equal the plain window's. Choose buckets so that one
key has at most a few thousand (days, hours, hash prefixes): a key's buckets
meet in one task, its rows never do. A bucket may be a struct, such as day
and hour.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.io import stage
from .groups import join_stats_back, key_of, with_group_stat

_K = "__slot"  # key and bucket in one column: grouped, windowed and joined by the same


def _slotted(df: DataFrame, by: Sequence[str], bucket: Column) -> DataFrame:
    return df.withColumn(_K, key_of([*by, bucket]))


def _along_key(by: Sequence[str]) -> W:
    """The slots of one key, in order."""
    return W.partitionBy(*[F.col(f"{_K}.k{i}") for i in range(len(by))]).orderBy(
        F.col(f"{_K}.k{len(by)}")
    )


def _carried(df: DataFrame, by: Sequence[str], per_slot: Column, carry) -> DataFrame:
    """One row per slot with what ``carry`` makes of the key's other slots."""
    slots = df.groupBy(_K).agg(per_slot.alias("__v"))
    return slots.select(F.col(_K).alias("__to"), carry("__v", _along_key(by)).alias("__carried"))


def _join_carried(inside: DataFrame, carried: DataFrame) -> DataFrame:
    return inside.join(carried, inside[_K] == carried["__to"], "inner").drop("__to", _K)


def _sum_before(value: str, along: W) -> Column:
    return F.sum(value).over(along.rowsBetween(W.unboundedPreceding, -1))


def running_sum(
    df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column, value: str, name: str
) -> DataFrame:
    """Sum of ``value`` from the key's first row to this one.

    ``order`` must be total inside a key; ``bucket`` must not decrease along it.
    """
    df = _slotted(df, by, bucket)
    w = W.partitionBy(_K).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    inside = df.withColumn(name, F.sum(value).over(w))
    out = _join_carried(inside, _carried(df, by, F.sum(value), _sum_before))
    here, before = F.col(name), F.col("__carried")
    return out.withColumn(name, F.coalesce(here + before, here, before)).drop("__carried")


def sequence_number(
    df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column, name: str
) -> DataFrame:
    """``row_number`` of a key's rows in a total order."""
    df = _slotted(df, by, bucket)
    inside = df.withColumn(name, F.row_number().over(W.partitionBy(_K).orderBy(*order)))
    out = _join_carried(inside, _carried(df, by, F.count(F.lit(1)), _sum_before))
    before = F.coalesce("__carried", F.lit(0))
    return out.withColumn(name, F.col(name) + before).drop("__carried")


def dense_number(
    df: DataFrame, by: Sequence[str], order: str, bucket: Column, name: str
) -> DataFrame:
    """``dense_rank`` by ``order``: the distinct values are numbered, then joined back."""
    keys = [*by, order]
    numbered = sequence_number(df.select(*keys).distinct(), by, [order], bucket, name)
    return join_stats_back(df, keys, numbered.select(key_of(keys).alias("__key"), name))


def neighbour(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    cols: Mapping[str, str],
    step: int,
) -> DataFrame:
    """Columns of the next (``step=1``) or previous (``step=-1``) row of the key."""
    assert step in (1, -1)
    edge_of = F.min_by if step == 1 else F.max_by
    move = F.lead if step == 1 else F.lag
    packed = F.struct(*[F.col(src).alias(dst) for dst, src in cols.items()])
    slotted = _slotted(df, by, bucket)
    inside = slotted.withColumn("__near", move(packed).over(W.partitionBy(_K).orderBy(*order)))
    edges = _carried(slotted, by, edge_of(packed, F.struct(*order)),
                     lambda v, along: move(v).over(along))
    out = _join_carried(inside, edges).withColumn("__near", F.coalesce("__near", "__carried"))
    return out.select(*df.columns, *[F.col(f"__near.{dst}").alias(dst) for dst in cols])


def sequence(
    df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column, *,
    number: str | None = None, rank: str | None = None, near: Mapping[str, str] | None = None, step: int = 1,
    running: Mapping[str, str] | None = None,
) -> DataFrame:
    """Number, neighbour and running sums of a key's rows together: the rows are shuffled once.

    ``number`` is the row's place, ``rank`` the place of its bucket among the key's buckets (a dense
    rank, where the bucket is the value ranked by), ``near`` columns of the next (``step=1``) or
    previous row, ``running`` sums up to the row. One table of slots carries the state of all of them.
    """
    assert step in (1, -1)
    near, running = dict(near or {}), dict(running or {})
    move, edge_of = (F.lead, F.min_by) if step == 1 else (F.lag, F.max_by)
    slotted, w = _slotted(df, by, bucket), W.partitionBy(_K).orderBy(*order)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    packed = F.struct(*[F.col(src).alias(dst) for dst, src in near.items()]) if near else None
    inside, state, carried = {}, [F.count(F.lit(1)).alias("n")], []
    along = _along_key(by)
    before = along.rowsBetween(W.unboundedPreceding, -1)
    if number:
        inside["__number"] = F.row_number().over(w)
        carried.append(F.coalesce(F.sum("__v.n").over(before), F.lit(0)).alias("number"))
    if rank:
        carried.append(F.row_number().over(along).alias("rank"))
    if near:
        inside["__near"] = move(packed).over(w)
        state.append(edge_of(packed, F.struct(*order)).alias("edge"))
        carried.append(move("__v.edge").over(along).alias("edge"))
    for i, value in enumerate(running.values()):
        inside[f"__sum{i}"] = F.sum(value).over(upto)
        state.append(F.sum(value).alias(f"sum{i}"))
        carried.append(F.sum(f"__v.sum{i}").over(before).alias(f"sum{i}"))
    slots = slotted.groupBy(_K).agg(F.struct(*state).alias("__v"))
    slots = slots.select(F.col(_K).alias("__to"), F.struct(*carried).alias("__c"))
    out, told = _join_carried(slotted.withColumns(inside), slots), []
    if number:
        told.append((F.col("__number") + F.col("__c.number")).alias(number))
    if rank:
        told.append(F.col("__c.rank").alias(rank))
    if near:
        both = F.coalesce("__near", "__c.edge")
        told += [both[dst].alias(dst) for dst in near]
    for i, name in enumerate(running):
        here, earlier = F.col(f"__sum{i}"), F.col(f"__c.sum{i}")
        told.append(F.coalesce(here + earlier, here, earlier).alias(name))
    return out.select(*[F.col(c) for c in df.columns], *told)


def carry_forward(
    df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column, value: str, name: str
) -> DataFrame:
    """Last non-null ``value`` at or before each row of the key."""
    slotted = _slotted(df, by, bucket)
    w = W.partitionBy(_K).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    inside = slotted.withColumn(name, F.last(value, ignorenulls=True).over(w))
    last_known = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order)))

    def last_before(v: str, along: W) -> Column:
        before = along.rowsBetween(W.unboundedPreceding, -1)
        return F.last(v, ignorenulls=True).over(before)

    out = _join_carried(inside, _carried(slotted, by, last_known, last_before))
    return out.withColumn(name, F.coalesce(F.col(name), F.col("__carried"))).drop("__carried")


def day_streaks(df: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """Runs of consecutive days per key: ``start``, ``end``, ``n_days``.

    The distinct days of a key are at most the days of the calendar, however
    many rows it has, so the numbering window is bounded by the calendar.
    """
    days = df.where(F.col(day).isNotNull()).select(*by, day).distinct()
    rn = F.row_number().over(W.partitionBy(*by).orderBy(day))
    islands = days.withColumn("__island", F.date_sub(F.col(day), rn))
    return islands.groupBy(*by, "__island").agg(
        F.min(day).alias("start"), F.max(day).alias("end"), F.count(F.lit(1)).alias("n_days")
    ).drop("__island")


def quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str],
    parts: int | None = None, per_part: int = 100_000,
) -> DataFrame:
    """Exact quantiles with linear interpolation.

    1. Count each distinct value per group (combined map-side); the counts are
       read four times below, so they are staged and ``df`` runs once.
    2. Cut a group's distinct values into about ``parts`` ranges at bounded
       approximate percentiles; sum the counts per range. ``parts`` follows the
       number of distinct values, about ``per_part`` to a range, 64 at least.
    3. Number values inside a range only, and add the earlier ranges' counts.
    4. Read the values at the two ranks around each quantile and interpolate.

    The percentiles only place the cuts; the ranks, and so the results, are
    exact. No task holds more than about 1/``parts`` of a group's values.
    """
    by = list(by)
    keys = by or ["__all"]
    base = df.where(F.col(value).isNotNull()).withColumn("__v", F.col(value).cast("double"))
    if not by:
        base = base.withColumn("__all", F.lit(1))
    freq = stage(base.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n")))
    if parts is None:
        parts = min(9_000, max(64, freq.count() // per_part))
    cuts = [i / parts for i in range(1, parts)]
    stats = {
        "__marks": F.percentile_approx("__v", cuts, max(1000, 8 * parts)),
        "__total": F.sum("__n"),
    }
    if by:
        cut = with_group_stat(freq, by, stats)
    else:
        cut = freq.withColumns({n: freq.agg(c).scalar() for n, c in stats.items()})
    part = F.size(F.filter("__marks", lambda m: m <= F.col("__v")))
    cut = cut.withColumn("__part", part).drop("__marks")
    ranked = running_sum(cut, keys, ["__v"], F.col("__part"), "__n", "__upto")
    at = []
    for i, p in enumerate(probs):
        pos = (F.col("__total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            hit = (F.col("__upto") > rank) & (F.col("__upto") - F.col("__n") <= rank)
            at.append(F.max(F.when(hit, F.col("__v"))).alias(f"__{side}{i}"))
    out = ranked.groupBy(*keys).agg(F.max("__total").alias("__total"), *at)
    picked = []
    for i, (p, name) in enumerate(zip(probs, names)):
        pos = (F.col("__total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        picked.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return out.select(*by, *picked)


def five_number(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Minimum, quartiles, maximum, mean and count per group."""
    q = quantiles(df, by, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    v = F.col(value).cast("double")
    basic = df.where(F.col(value).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.avg(v).alias("mean"),
    )
    return join_stats(basic, q, by)


def join_stats(a: DataFrame, b: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Put two per-group tables side by side (null-safe on the group key)."""
    if not by:  # two one-row tables
        row = b.select(F.struct(*b.columns)).scalar()
        return a.withColumn("__row", row).select(
            *a.columns, *[F.col(f"__row.{c}").alias(c) for c in b.columns]
        )
    right = b.select(key_of(by).alias("__key"), *[c for c in b.columns if c not in by])
    return a.join(right, key_of([a[c] for c in by]) == right["__key"], how).drop("__key")


def histogram(
    df: DataFrame, by: Sequence[str], value: str, width: float, lo=None, hi=None
) -> DataFrame:
    """Counts per bin of ``width``; ``bin`` is the lower edge; limits are inclusive."""
    v = F.col(value)
    if lo is not None:
        df = df.where(v >= lo)
    if hi is not None:
        df = df.where(v <= hi)
    edge = F.floor(v.cast("double") / width) * F.lit(width)
    return df.where(v.isNotNull()).groupBy(*by, edge.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def cdf_table(df: DataFrame, value: str, weight: str) -> DataFrame:
    """Share and cumulative share of ``weight`` by a whole-number ``value``."""
    total = df.agg(F.sum(weight)).scalar()
    bucket = F.floor(F.col(value) / 1000)
    out = running_sum(
        df.withColumn("__all", F.lit(1)), ["__all"], [value], bucket, weight, "cumulative"
    )
    return out.drop("__all").withColumn("total", total).select(
        "*",
        (F.col(weight) * 100.0 / F.col("total")).alias("share"),
        (F.col("cumulative") * 100.0 / F.col("total")).alias("cdf"),
    )
