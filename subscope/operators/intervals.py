"""Date grids, overlap, and counts or sums that are live over ranges of weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.columns import col, ladder


def week_grid(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(start_date, end_date) pairs, seven days apart; the last pair ends by ``last``."""
    starts = spark.range(1).select(
        F.explode(F.expr(f"sequence(date'{first}', date'{last}', interval 7 days)")).alias(
            "start_date"
        )
    )
    grid = starts.withColumn("end_date", F.date_add("start_date", 7))
    return grid.where(F.col("end_date") <= F.lit(last).cast("date"))


def active_between(df: DataFrame, lo, hi, start: str, end: str) -> DataFrame:
    """Rows live at some time in ``[lo, hi]``: plain range predicates, pushed to the scan."""
    return df.where(
        (F.col(start) <= F.lit(hi).cast("date")) & (F.col(end) >= F.lit(lo).cast("date"))
    )


def label_period(
    df: DataFrame, date: str, periods: Sequence[tuple[str, str, str]], name: str = "period"
) -> DataFrame:
    """Keep rows inside one of the (label, first day, last day) periods and label them."""
    steps = [
        (F.col(date).between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), label)
        for label, lo, hi in periods
    ]
    keep = steps[0][0]
    for cond, _ in steps[1:]:
        keep = keep | cond
    return df.where(keep).withColumn(name, ladder(steps))


def live_periods(
    df: DataFrame, start: str, end: str, periods: Sequence[tuple[str, str, str]], name: str
) -> DataFrame:
    """One row per (row, period it overlaps); ``periods`` is a short literal list."""
    hits = [
        F.when(
            (F.col(start) <= F.lit(hi).cast("date")) & (F.col(end) >= F.lit(lo).cast("date")),
            F.lit(label),
        )
        for label, lo, hi in periods
    ]
    return df.withColumn(name, F.explode(F.array_compact(F.array(*hits))))


def week_index(c, first: str) -> Column:
    """Number of the 7-day grid week (from 0) that holds a date."""
    return F.floor(F.datediff(col(c), F.lit(first).cast("date")) / 7).cast("bigint")


def overlap_weeks(
    df: DataFrame, start: str, end: str, first: str, n_weeks: int
) -> DataFrame:
    """One row per (row, grid week it overlaps), with the clipped day count.

    ``sequence`` and ``explode`` make only the weeks a row touches; there is
    no join. Use it where a result needs the rows themselves; for weekly totals
    use :func:`weekly_totals`, which does not multiply the rows.
    """
    lo = F.greatest(week_index(start, first), F.lit(0))
    hi = F.least(week_index(F.date_sub(F.col(end), 1), first), F.lit(n_weeks - 1))
    out = df.where(F.col(end) > F.col(start)).withColumn("__lo", lo).withColumn("__hi", hi)
    out = out.where("__lo <= __hi").withColumn("__w", F.explode(F.sequence("__lo", "__hi")))
    origin = F.lit(first).cast("date")
    week = F.date_add(origin, (F.col("__w") * 7).cast("int"))
    out = out.withColumn("week_start", week).withColumn("week_end", F.date_add("week_start", 7))
    days = F.datediff(F.least(end, "week_end"), F.greatest(start, "week_start"))
    return out.withColumn("days", days).drop("__lo", "__hi", "__w")


def weekly_totals(
    df: DataFrame, by: Sequence[str], start: str, end: str, first: str, n_weeks: int,
    per_day: str, per_week: str,
) -> DataFrame:
    """Weekly sums of ``per_day`` x days overlapped and of ``per_week`` once per week touched.

    Each row writes at most four change records (enter, first full week, last
    week, leave) instead of one record per week, so the shuffle does not grow
    with the length of the terms; the changes are combined map-side to one row
    per (group, week) and a running sum over the weeks gives the totals. Pass
    exact numbers (decimals), so that what is added and taken away cancels.
    """
    origin = F.lit(first).cast("date")
    s = F.greatest(F.datediff(start, origin), F.lit(0))
    e = F.least(F.datediff(end, origin), F.lit(7 * n_weeks))
    out = df.withColumn("__s", s).withColumn("__e", e).where("__e > __s")
    out = out.withColumn("__ws", F.floor(F.col("__s") / 7)).withColumn(
        "__we", F.floor((F.col("__e") - 1) / 7)
    )
    one = F.col("__ws") == F.col("__we")
    first_days = F.when(one, F.col("__e") - F.col("__s")).otherwise(
        7 - (F.col("__s") - 7 * F.col("__ws"))
    )
    last_days = F.col("__e") - 7 * F.col("__we")
    rate, flat = F.col(per_day), F.col(per_week)
    zero = F.lit(0)

    def change(week: Column, days, count) -> Column:
        # level change of the running totals at ``week``
        return F.struct(
            week.cast("bigint").alias("week"),
            (rate * days).alias("per_day_change"),
            (flat * count).alias("per_week_change"),
        )

    records = F.when(
        one,
        F.array(
            change(F.col("__ws"), first_days, F.lit(1)),
            change(F.col("__ws") + 1, -first_days, F.lit(-1)),
        ),
    ).otherwise(
        F.array(
            change(F.col("__ws"), first_days, F.lit(1)),
            change(F.col("__ws") + 1, 7 - first_days, zero),
            change(F.col("__we"), last_days - 7, zero),
            change(F.col("__we") + 1, -last_days, F.lit(-1)),
        )
    )
    changes = out.select(*by, F.inline(records))
    weekly = changes.groupBy(*by, "week").agg(
        F.sum("per_day_change").alias("per_day_change"),
        F.sum("per_week_change").alias("per_week_change"),
    )
    return _levels(weekly, by, {"per_day_total": "per_day_change",
                                "per_week_total": "per_week_change"}, first, n_weeks)


def _levels(weekly: DataFrame, by, sums: dict[str, str], first: str, n_weeks: int) -> DataFrame:
    """Running sums over every week of the grid; the window holds at most one grid per group."""
    origin = F.lit(first).cast("date")
    groups = weekly.select(*by).distinct() if by else weekly.select(F.lit(1).alias("__g")).limit(1)
    grid = groups.withColumn("week", F.explode(F.sequence(F.lit(0), F.lit(n_weeks - 1))))
    grid = grid.withColumn("week", F.col("week").cast("bigint"))
    full = grid.join(weekly, [*by, "week"], "left")
    w = W.partitionBy(*by).orderBy("week").rowsBetween(W.unboundedPreceding, 0)
    out = full.select(
        *by, F.date_add(origin, (F.col("week") * 7).cast("int")).alias("week_start"),
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(w).alias(n) for n, c in sums.items()],
    )
    return out


def live_keys_per_week(
    df: DataFrame, by: Sequence[str], key: Sequence[str], start: str, end: str,
    first: str, n_weeks: int, name: str,
) -> DataFrame:
    """Distinct keys live in each grid week, without one row per (key, week).

    A key's rows first shrink to distinct week ranges (bounded by the grid,
    whatever the number of rows), overlapping ranges are merged, and each
    merged range adds one at its first week and takes one off after its last.
    """
    lo = F.greatest(week_index(start, first), F.lit(0))
    hi = F.least(week_index(F.date_sub(F.col(end), 1), first), F.lit(n_weeks - 1))
    ranges = df.where(F.col(end) > F.col(start)).select(
        *by, *key, lo.alias("__lo"), hi.alias("__hi")
    ).where("__lo <= __hi")
    ranges = ranges.groupBy(*by, *key, "__lo").agg(F.max("__hi").alias("__hi"))
    w = W.partitionBy(*by, *key).orderBy("__lo")
    reach = F.max("__hi").over(w.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("__lo") > reach), 1).otherwise(0)
    marked = ranges.withColumn("__new", fresh)
    marked = marked.withColumn(
        "__island", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0))
    )
    merged = marked.groupBy(*by, *key, "__island").agg(
        F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi")
    )
    changes = merged.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("__lo").alias("week"), F.lit(1).alias("d")),
                F.struct((F.col("__hi") + 1).alias("week"), F.lit(-1).alias("d")),
            )
        ),
    )
    weekly = changes.groupBy(*by, "week").agg(F.sum("d").alias("d"))
    return _levels(weekly, by, {name: "d"}, first, n_weeks)
