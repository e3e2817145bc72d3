"""How often, how recently and how deeply subscribers read.

Everything after :func:`visit_rollup` reads the visit table, which has one row
per user, visit, day and device. ``grain`` names the columns that define a
reporting span (a period label, or year and month).
"""

from __future__ import annotations

import calendar
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.aggregates import distinct_rollup
from ..functions.columns import bucket, clean_id, is_weekend, ladder, paste, ratio, week_floor
from ..operators.groups import share_of
from ..operators.intervals import active_between, live_periods
from ..operators.joins import resolve_identity
from ..operators.ordered import cdf_table, day_streaks, five_number, histogram, neighbour
from ..operators.reshape import bind_rows, weekly_mean

Periods = Sequence[tuple[str, str, str]]
VISIT = ["visitor_id", "visit_number"]


def months(first: str, last: str) -> list[tuple[str, str, str]]:
    """(label, first day, last day) of each calendar month; true month ends in leap years too."""
    y, m = int(first[:4]), int(first[5:7])
    out = []
    while f"{y:04d}-{m:02d}" <= last[:7]:
        end = calendar.monthrange(y, m)[1]
        out.append((f"{y:04d}-{m:02d}", f"{y:04d}-{m:02d}-01", f"{y:04d}-{m:02d}-{end:02d}"))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


# --- users and visits -----------------------------------------------------------


def eligible_users(identity: DataFrame, drop_bad_quality: bool = False) -> DataFrame:
    """Customers with a subscription who are not a group account."""
    no_sub = F.col("old_customerid").isNull() & (F.col("new_customerid") == 0)
    keys = identity.groupBy("customermasterkey").agg(
        F.max(F.when(no_sub, 0).otherwise(1)).alias("subscriber"),
        F.max(F.col("isgroup").cast("int")).alias("grouped"),
        F.max(F.col("isbadquality").cast("int")).alias("bad"),
    ).where("subscriber = 1 and grouped = 0")
    if drop_bad_quality:
        keys = keys.where("bad = 0")
    return keys.select("customermasterkey")


def identity_map(identity: DataFrame, keys: DataFrame) -> DataFrame:
    """(uid, ref_id) of the eligible customers; a missing id maps nobody."""
    return identity.join(keys, "customermasterkey", "left_semi").select(
        clean_id("reader_id").alias("uid"), F.col("customermasterkey").alias("ref_id")
    ).where("uid is not null").distinct()


def visit_rollup(
    hits: DataFrame, ids: DataFrame, subscribe_text: str = "subs:subscribe:"
) -> DataFrame:
    """Page hits to visits of known users.

    Hits first shrink to one row per visit and page, so the distinct-page
    counts need no second copy of the log and a busy visitor is combined
    map-side. A visit belongs to the highest user id seen in it.
    """
    article = F.col("content_type").eqNullSafe("article")
    pages = hits.withColumn("article", article).groupBy(
        *VISIT, "hit_date", "device", "page_name", "article"
    ).agg(
        F.max(clean_id("uid_raw")).alias("uid"),
        F.min("clicks_to_page").alias("clicks"),
    )
    known = F.col("page_name").isNotNull()
    visits = pages.groupBy(*VISIT, "hit_date", "device").agg(
        F.max("uid").alias("uid"),
        F.count(F.when(F.col("article") & known, 1)).alias("n_articles"),
        F.min(F.when(F.col("article"), F.col("clicks"))).alias("clicks_to_article"),
        F.max(F.when(F.col("page_name").contains(subscribe_text), 1).otherwise(0))
        .alias("did_subscribe"),
        F.count(F.when(~F.col("article") & known, 1)).alias("n_other_pages"),
    )
    # a visit has at most one row per day and device here, so its window is small
    visits = visits.withColumn("visit_uid", F.max("uid").over(W.partitionBy(*VISIT))).drop("uid")
    m = ids.withColumnRenamed("uid", "__uid")
    return visits.join(m, visits["visit_uid"] == m["__uid"]).select(
        "ref_id", *VISIT, "hit_date", "device", "n_articles", "clicks_to_article",
        "did_subscribe", "n_other_pages",
    )


# --- the subscriber base ----------------------------------------------------------


def active_in_period(terms: DataFrame, periods: Periods, name: str = "period") -> DataFrame:
    """Distinct individual subscribers live in each period."""
    lo, hi = min(p[1] for p in periods), max(p[2] for p in periods)
    live = active_between(
        terms.where(F.col("donortype") == "I"), lo, hi, "startissuedate", "expirationissuedate"
    ).select("shiptocustomernumber", "startissuedate", "expirationissuedate")
    live = live_periods(live, "startissuedate", "expirationissuedate", periods, name)
    return distinct_rollup(live, [name], ["shiptocustomernumber"], total="n_active")


def active_by_month(terms: DataFrame, first: str, last: str) -> DataFrame:
    return active_in_period(terms, months(first, last), "month")


def visitor_share(visits: DataFrame, active: DataFrame) -> DataFrame:
    """Visitors as a percentage of live subscribers, per period."""
    n = distinct_rollup(visits, ["period"], ["ref_id"], total="n_visitors")
    return n.join(active, "period").withColumn(
        "share", ratio("n_visitors", "n_active") * 100
    )


# --- segments ------------------------------------------------------------------------


def _user_days(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Per user and span: active days and articles."""
    days = visits.groupBy("ref_id", *grain, "hit_date").agg(
        F.sum("n_articles").alias("n_articles")
    )
    return days.groupBy("ref_id", *grain).agg(
        F.count(F.lit(1)).alias("n_days"), F.sum("n_articles").alias("n_articles"),
        F.count(F.when(F.col("n_articles") > 0, 1)).alias("n_article_days"),
    )


def visit_segment(n_days, casual_below: int, loyal_upto: int) -> Column:
    return ladder(
        [(n_days < casual_below, "Casual Reader"), (n_days <= loyal_upto, "Loyal Reader")],
        "Brand Lover",
    )


def visit_segments(
    visits: DataFrame, active: DataFrame, grain: Sequence[str], casual_below: int = 2,
    loyal_upto: int = 14,
) -> DataFrame:
    """Users per span and segment of active days, with the subscriber base."""
    users = _user_days(visits, grain)
    seg = visit_segment(F.col("n_days"), casual_below, loyal_upto)
    n = users.groupBy(*grain, seg.alias("segment")).agg(F.count(F.lit(1)).alias("n_visitors"))
    return n.join(active, list(grain))


def segment_share(segments: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Segments plus a computed inactive row (base minus visitors), as shares of the base."""
    inactive = segments.groupBy(*grain).agg(
        F.max("n_active").alias("n_active"), F.sum("n_visitors").alias("seen")
    ).select(*grain, F.lit("Inactive").alias("segment"),
             (F.col("n_active") - F.col("seen")).alias("n_visitors"), "n_active")
    return bind_rows(segments, inactive).withColumn(
        "share", ratio("n_visitors", "n_active") * 100
    )


def articles_per_active_day(
    visits: DataFrame, grain: Sequence[str], casual_below: int = 2, loyal_upto: int = 14
) -> DataFrame:
    """Mean over users of articles per active day, by segment."""
    users = _user_days(visits, grain)
    seg = visit_segment(F.col("n_days"), casual_below, loyal_upto)
    per_day = F.round(ratio("n_articles", "n_days"), 2)
    return users.groupBy(*grain, seg.alias("segment")).agg(F.avg(per_day).alias("mean_articles"))


def _user_articles(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Articles per user and span, readers of at least one article."""
    return visits.groupBy("ref_id", *grain).agg(F.sum("n_articles").alias("n_articles")).where(
        "n_articles > 0"
    )


def article_buckets(
    visits: DataFrame, grain: Sequence[str], bounds: Sequence[int] = (2, 5, 12)
) -> DataFrame:
    """Users per bucket of articles read, as a share of the span's readers."""
    edges = [0, *bounds]
    labels = [f"{a + 1}-{b} Articles" for a, b in zip(edges, bounds)]
    labels.append(f"{edges[-1] + 1}+ Articles")
    seg = bucket("n_articles", bounds, labels)
    n = _user_articles(visits, grain).groupBy(*grain, seg.alias("article_segment")).agg(
        F.count(F.lit(1)).alias("n_users")
    )
    return share_of(n, grain, "n_users", "share", "total_users")


def articles_cdf(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Users per article count with the cumulative percentage."""
    users = _user_articles(visits, grain).select("ref_id", "n_articles").distinct()
    return cdf_table(users.groupBy("n_articles").agg(F.count(F.lit(1)).alias("n")),
                     "n_articles", "n")


def mean_articles(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    return _user_articles(visits, grain).groupBy(*grain).agg(
        F.avg("n_articles").alias("mean_articles")
    )


# --- days, gaps, streaks --------------------------------------------------------------


def active_days_per_user(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    return _user_days(visits, grain).select("ref_id", *grain, "n_days")


def active_days(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    return active_days_per_user(visits, grain).groupBy(*grain).agg(
        F.avg("n_days").alias("mean"), F.var_samp("n_days").alias("var")
    )


def active_days_histogram(visits: DataFrame, grain: Sequence[str], width: int = 1) -> DataFrame:
    return histogram(active_days_per_user(visits, grain), grain, "n_days", width)


def active_days_five_number(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    return five_number(active_days_per_user(visits, grain), grain, "n_days")


def article_day_rate(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Per user: articles divided by the days with an article (no-article days not counted)."""
    return _user_days(visits, grain).where("n_articles > 0").select(
        "ref_id", *grain, ratio("n_articles", "n_article_days").alias("articles_per_day")
    )


def articles_per_article_day(visits: DataFrame, grain: Sequence[str]) -> DataFrame:
    return article_day_rate(visits, grain).groupBy(*grain).agg(
        F.avg("articles_per_day").alias("mean"), F.var_samp("articles_per_day").alias("var")
    )


def articles_by_date(visits: DataFrame) -> DataFrame:
    return visits.groupBy("hit_date").agg(F.sum("n_articles").alias("total_articles")).withColumn(
        "is_weekend", is_weekend("hit_date")
    )


def visit_gaps(visits: DataFrame) -> DataFrame:
    """Each visit with the same user's previous visit day and device, and the gap in days."""
    out = neighbour(
        visits, ["ref_id", "period"], ["hit_date", "visit_number", "visitor_id", "device"],
        F.col("hit_date"), {"previous_date": "hit_date", "previous_device": "device"},
        -1,
    )
    return out.withColumn("gap", F.datediff("hit_date", "previous_date"))


def days_between_visits(visits: DataFrame) -> DataFrame:
    """Mean gap between visits per user and period (users with at least two visits)."""
    return visit_gaps(visits).where("gap is not null").groupBy("ref_id", "period").agg(
        F.avg("gap").alias("mean_gap"), F.count(F.lit(1)).alias("n_gaps")
    )


def with_visit_count(visits: DataFrame) -> DataFrame:
    """Visits with the user's number of distinct visits over the whole table."""
    per_user = visits.select("ref_id", *VISIT).distinct().groupBy(
        F.col("ref_id").alias("__ref")
    ).agg(F.count(F.lit(1)).alias("n_visits"))
    return visits.join(per_user, visits["ref_id"] == per_user["__ref"]).drop("__ref")


def single_visit_share(visits: DataFrame) -> DataFrame:
    rows = with_visit_count(visits)
    out = distinct_rollup(rows, ["period"], ["ref_id"], flags={
        "one_visit": F.col("n_visits") < 2}, total="n_visitors")
    return out.withColumn("prop", ratio("one_visit", "n_visitors"))


def device_mix(visits: DataFrame, repeat: bool) -> DataFrame:
    """Users by device among repeat (or single) visitors, as a share of the period."""
    rows = with_visit_count(visits).where(
        F.col("n_visits") >= 2 if repeat else F.col("n_visits") < 2
    )
    n = distinct_rollup(rows, ["period", "device"], ["ref_id"], total="n_visitors")
    return share_of(n, ["period"], "n_visitors")


def device_transition(visits: DataFrame) -> DataFrame:
    """Gap between visits by current -> previous device, users with at least two visits."""
    rows = visit_gaps(with_visit_count(visits).where("n_visits >= 2")).where("gap is not null")
    rows = rows.withColumn("device_pattern", paste(["device", "previous_device"], "->"))
    return five_number(rows, ["period", "device_pattern"], "gap")


def visits_and_articles(visits: DataFrame) -> DataFrame:
    """Per user and period: visits, articles, articles per visit."""
    per_visit = visits.groupBy("ref_id", "period", *VISIT, "hit_date").agg(
        F.sum("n_articles").alias("n_articles")
    )
    return per_visit.groupBy("ref_id", "period").agg(
        F.count(F.lit(1)).alias("total_visits"), F.sum("n_articles").alias("total_articles")
    ).withColumn("articles_per_visit", ratio("total_articles", "total_visits"))


def streaks(visits: DataFrame) -> DataFrame:
    """Runs of at least two consecutive active days per user and period."""
    return day_streaks(visits, ["ref_id", "period"], "hit_date").where("n_days >= 2")


def streak_share(visits: DataFrame) -> DataFrame:
    """Share of each period's users who ever had a run of two days or more."""
    had = streaks(visits).select(F.col("ref_id").alias("__ref")).distinct().withColumn(
        "__had", F.lit(True)
    )
    users = visits.select("ref_id", "period").distinct()
    rows = users.join(had, users["ref_id"] == had["__ref"], "left")
    return rows.groupBy("period").agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count("__had").alias("users_with_streak"),
    ).withColumn("prop", ratio("users_with_streak", "total_users"))


def weeks_touched(lo: str, hi: str) -> int:
    """Number of Sunday-to-Saturday weeks a span touches."""
    a, b = date.fromisoformat(lo), date.fromisoformat(hi)
    sunday = a.toordinal() - (a.weekday() + 1) % 7
    return (b.toordinal() - sunday) // 7 + 1


def articles_per_week(visits: DataFrame, periods: Periods) -> DataFrame:
    """Per user and period: mean weekly articles, empty weeks counted as zero."""
    weekly = visits.withColumn("week", week_floor("hit_date")).groupBy(
        "ref_id", "period", "week"
    ).agg(F.sum("n_articles").alias("n_articles"))
    n_weeks = ladder([(F.col("period") == p, weeks_touched(lo, hi)) for p, lo, hi in periods])
    out = weekly_mean(weekly, ["ref_id", "period"], "week", "n_articles", 1, "__sum")
    return out.withColumn("n_weeks", n_weeks).withColumn(
        "articles_per_week", ratio("__sum", "n_weeks")
    ).drop("__sum")


def zero_week_share(per_week: DataFrame) -> DataFrame:
    """Share of users without any article in the period, and the mean weekly rate."""
    return per_week.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_users"),
        F.avg(F.when(F.col("articles_per_week") == 0, 1.0).otherwise(0.0)).alias("zero_share"),
        F.avg("articles_per_week").alias("mean_per_week"),
    )


def visitors_per_day(visits: DataFrame) -> DataFrame:
    out = distinct_rollup(visits, ["period", "hit_date"], ["ref_id"], total="n_visitors")
    return out.withColumn("is_weekend", is_weekend("hit_date"))


def recency(visits: DataFrame, periods: Periods) -> DataFrame:
    """Days from a user's last article to the period's end; never reading counts the whole span."""
    last = visits.groupBy("ref_id", "period").agg(
        F.max(F.when(F.col("n_articles") > 0, F.col("hit_date"))).alias("last_article")
    )
    end = ladder([(F.col("period") == p, F.lit(hi).cast("date")) for p, _, hi in periods])
    span = ladder([
        (F.col("period") == p,
         date.fromisoformat(hi).toordinal() - date.fromisoformat(lo).toordinal())
        for p, lo, hi in periods
    ])
    return last.withColumn("recency", F.coalesce(F.datediff(end, "last_article"), span))


def no_article_share(recent: DataFrame) -> DataFrame:
    """Users without an article, their share, and the mean recency of the rest."""
    read = F.col("last_article").isNotNull()
    return recent.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count(F.when(~read, 1)).alias("without_article"),
        F.avg(F.when(read, F.col("recency"))).alias("mean_recency"),
    ).withColumn("pct_without", ratio("without_article", "n_users") * 100)


def identity_coverage(hits: DataFrame, first_map: DataFrame, second_map: DataFrame) -> DataFrame:
    """How many user ids each identity map resolves, tried in order."""
    uids = hits.select(clean_id("uid_raw").alias("uid")).where("uid is not null").distinct()
    one = first_map.select(F.col("uid").alias("u1"), F.lit("first map").alias("source"))
    two = second_map.select(F.col("uid").alias("u2"), F.lit("second map").alias("source"))
    found = resolve_identity(uids, "uid", [(one, "u1", "source"), (two, "u2", "source")], "via")
    lost = uids.join(found.select("uid"), "uid", "left_anti").withColumn("via", F.lit("none"))
    return found.unionByName(lost).groupBy("via").agg(F.count(F.lit(1)).alias("n_users"))
