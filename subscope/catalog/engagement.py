"""Engagement."""

from __future__ import annotations

from ..operators.intervals import label_period
from ..plans import engagement as e
from .registry import fragment, query

PERIODS = [("P1", "2024-01-01", "2024-01-15"), ("P2", "2024-01-16", "2024-01-30")]
# The subscriber base comes from the same two labels in the terms' own years.
BASE_PERIODS = [("P1", "1998-01-01", "1998-05-31"), ("P2", "1999-01-01", "1999-05-31")]
GRAIN, CASUAL, LOYAL = ["period"], 8, 10
SIGNUP = "signup:"

fragment("ids", ("identity",), """
  select distinct cast(reader_id as bigint) as uid, customermasterkey as ref_id
  from identity where customermasterkey in (
    select customermasterkey from identity group by 1
    having max(case when old_customerid is null and new_customerid = 0 then 0 else 1 end)
        = 1 and max(cast(isgroup as int)) = 0)""")
fragment("uid_hits", ("hits",), """
  select *, coalesce(content_type, '') = 'article' as article,
    max(try_cast(nullif(nullif(uid_raw, ''), 'NO_ID') as bigint))
      over (partition by visitor_id, visit_number) as uid_max from hits""")
fragment("visits", ("ids", "uid_hits"), """
  select ref_id, visitor_id, visit_number, hit_date, device,
    count(distinct case when article then page_name end) as n_articles,
    min(case when article then clicks_to_page end) as clicks_to_article,
    max(case when page_name like '%signup:%' then 1 else 0 end) as did_subscribe,
    count(distinct case when not article then page_name end) as n_other_pages,
    case when hit_date <= date '2024-01-15' then 'P1' else 'P2' end as period
  from uid_hits join ids on uid = uid_max group by 1, 2, 3, 4, 5""")
fragment("active", ("terms",), """
  select period, count(distinct shiptocustomernumber) as n_active
  from terms join (values ('P1', date '1998-01-01', date '1998-05-31'),
    ('P2', date '1999-01-01', date '1999-05-31')) p(period, lo, hi)
    on startissuedate <= hi and expirationissuedate >= lo
  where donortype = 'I' group by 1""")
fragment("user_days", ("visits",), """
  select ref_id, period, count(distinct hit_date) as n_days, sum(n_articles) as n_articles,
    count(distinct case when n_articles > 0 then hit_date end) as n_article_days
  from visits group by 1, 2""")
SEG = """case when n_days < 8 then 'Casual Reader' when n_days <= 10 then 'Loyal Reader'
      else 'Brand Lover' end"""
fragment("segments", ("user_days", "active"), f"""
  select s.period, segment, n_visitors, n_active from (
    select period, {SEG} as segment, count(*) as n_visitors from user_days group by 1, 2) s
  join active a on a.period = s.period""")


def visits(t):
    ids = e.identity_map(t.identity, e.eligible_users(t.identity))
    return label_period(e.visit_rollup(t.hits, ids, SIGNUP), "hit_date", PERIODS)


def active(t):
    return e.active_in_period(t.terms, BASE_PERIODS)


def segments(t):
    return e.visit_segments(visits(t), active(t), GRAIN, CASUAL, LOYAL)


@query("e0_eligible_users", "customermasterkey:s", ["identity"], """
    select customermasterkey from identity group by 1
    having max(case when old_customerid is null and new_customerid = 0 then 0 else 1 end)
      = 1 and max(cast(isgroup as int)) = 0 and max(cast(isbadquality as int)) = 0""")
def _(t):
    return e.eligible_users(t.identity, drop_bad_quality=True)


@query("e1_visit_rollup",
       "ref_id:s visitor_id:l visit_number:l hit_date:t device:s n_articles:l "
       "clicks_to_article:l did_subscribe:l n_other_pages:l period:s", ["visits"],
       "select * from visits")
def _(t):
    return visits(t)


@query("e2_active_by_month", "month:s n_active:l", ["terms"], """
    select strftime(lo, '%Y-%m') as month, count(distinct shiptocustomernumber) as n_active
    from terms join (select cast(unnest(generate_series(date '1996-01-01', date '1996-12-01',
      interval 1 month)) as date) as lo) m
      on startissuedate <= last_day(lo) and expirationissuedate >= lo
    where donortype = 'I' group by 1""")
def _(t):
    return e.active_by_month(t.terms, "1996-01", "1996-12")


@query("e3_active_in_period", "period:s n_active:l", ["active"], "select * from active")
def _(t):
    return active(t)


@query("e4_visitor_share", "period:s n_visitors:l n_active:l share:d", ["visits", "active"], """
    select v.period, count(distinct ref_id) as n_visitors, any_value(n_active) as n_active,
      count(distinct ref_id) * 100.0 / any_value(n_active) as share
    from visits v join active a on a.period = v.period group by 1""")
def _(t):
    return e.visitor_share(visits(t), active(t))


@query("e5_visit_segments", "period:s segment:s n_visitors:l n_active:l", ["segments"],
       "select * from segments")
def _(t):
    return segments(t)


@query("e6_articles_per_active_day", "period:s segment:s mean_articles:d", ["user_days"], f"""
    select period, {SEG} as segment, avg(round(cast(n_articles as double) / n_days, 2))
      as mean_articles from user_days group by 1, 2""")
def _(t):
    return e.articles_per_active_day(visits(t), GRAIN, CASUAL, LOYAL)


@query("e7_segment_share", "period:s segment:s n_visitors:l n_active:l share:d", ["segments"], """
    select *, n_visitors * 100.0 / n_active as share from (
      select * from segments union all
      select period, 'Inactive', max(n_active) - sum(n_visitors), max(n_active)
      from segments group by period) x""")
def _(t):
    return e.segment_share(segments(t), GRAIN)


@query("e8_article_buckets", "period:s article_segment:s n_users:l total_users:l share:d",
       ["user_days"], """
    with c as (select period, case when n_articles <= 2 then '1-2 Articles'
        when n_articles <= 5 then '3-5 Articles' when n_articles <= 12 then '6-12 Articles'
        else '13+ Articles' end as article_segment, count(*) as n_users
      from user_days where n_articles > 0 group by 1, 2)
    select *, sum(n_users) over (partition by period) as total_users,
      n_users * 100.0 / sum(n_users) over (partition by period) as share from c""")
def _(t):
    return e.article_buckets(visits(t), GRAIN)


@query("e9_articles_cdf", "n_articles:l n:l cumulative:l total:l share:d cdf:d", ["user_days"], """
    with c as (select n_articles, count(distinct ref_id) as n from user_days
      where n_articles > 0 group by 1)
    select *, n * 100.0 / total as share, cumulative * 100.0 / total as cdf from (
      select *, sum(n) over (order by n_articles) as cumulative, sum(n) over () as total from c)
      x""")
def _(t):
    return e.articles_cdf(visits(t), GRAIN)


@query("e10_mean_articles", "period:s mean_articles:d", ["user_days"], """
    select period, avg(n_articles) as mean_articles from user_days where n_articles > 0
    group by 1""")
def _(t):
    return e.mean_articles(visits(t), GRAIN)


@query("e11_active_days", "period:s mean:d var:d", ["user_days"], """
    select period, avg(n_days) as mean, var_samp(n_days) as var from user_days group by 1""")
def _(t):
    return e.active_days(visits(t), GRAIN)


@query("e11_active_days_histogram", "period:s bin:l n:l", ["user_days"], """
    select period, floor(n_days / 2.0) * 2 as bin, count(*) as n from user_days group by 1, 2""")
def _(t):
    return e.active_days_histogram(visits(t), GRAIN, 2)


@query("e11_active_days_five_number",
       "period:s n:l min:d q1:d median:d q3:d max:d mean:d", ["user_days"], """
    select period, count(*) as n, min(n_days) as min, quantile_cont(n_days, 0.25) as q1,
      median(n_days) as median, quantile_cont(n_days, 0.75) as q3, max(n_days) as max,
      avg(n_days) as mean from user_days group by 1""")
def _(t):
    return e.active_days_five_number(visits(t), GRAIN)


@query("e12_articles_per_article_day", "period:s mean:d var:d", ["user_days"], """
    select period, avg(cast(n_articles as double) / n_article_days) as mean,
      var_samp(cast(n_articles as double) / n_article_days) as var
    from user_days where n_articles > 0 group by 1""")
def _(t):
    return e.articles_per_article_day(visits(t), GRAIN)


@query("e13_articles_by_date", "hit_date:t total_articles:l is_weekend:b", ["visits"], """
    select hit_date, sum(n_articles) as total_articles, dayofweek(hit_date) in (0, 6)
      as is_weekend from visits group by 1""")
def _(t):
    return e.articles_by_date(visits(t))


fragment("gaps", ("visits",), """
  select *, hit_date - previous_date as gap from (
    select *, lag(hit_date) over w as previous_date, lag(device) over w as previous_device
    from visits
    window w as (partition by ref_id, period order by hit_date, visit_number, visitor_id, device))
    x""")
fragment("visit_counts", ("visits",), """
  select v.*, n_visits from visits v join (
    select ref_id as r, count(distinct (visitor_id, visit_number)) as n_visits
    from visits group by 1) c on c.r = v.ref_id""")


@query("e14_days_between_visits", "ref_id:s period:s mean_gap:d n_gaps:l", ["gaps"], """
    select ref_id, period, avg(gap) as mean_gap, count(*) as n_gaps from gaps
    where gap is not null group by 1, 2""")
def _(t):
    return e.days_between_visits(visits(t))


@query("e15_single_visit_share", "period:s n_visitors:l one_visit:l prop:d", ["visit_counts"], """
    select period, count(distinct ref_id) as n_visitors,
      count(distinct case when n_visits < 2 then ref_id end) as one_visit,
      cast(count(distinct case when n_visits < 2 then ref_id end) as double)
        / count(distinct ref_id) as prop from visit_counts group by 1""")
def _(t):
    return e.single_visit_share(visits(t))


DEVICES = """
    select *, n_visitors * 100.0 / total as share from (
      select *, sum(n_visitors) over (partition by period) as total from (
        select period, device, count(distinct ref_id) as n_visitors from visit_counts
        where n_visits {} group by 1, 2) a) b"""


@query("e15_single_visit_device", "period:s device:s n_visitors:l total:l share:d",
       ["visit_counts"], DEVICES.format("< 2"))
def _(t):
    return e.device_mix(visits(t), repeat=False)


@query("e16_device_transition",
       "period:s device_pattern:s n:l min:d q1:d median:d q3:d max:d mean:d",
       ["visit_counts"], """
    with g as (select period, device || '->' || previous_device as device_pattern,
        hit_date - previous_date as gap from (
      select *, lag(hit_date) over w as previous_date, lag(device) over w as previous_device
      from visit_counts where n_visits >= 2 window w as (partition by ref_id, period
        order by hit_date, visit_number, visitor_id, device)) x where previous_date is not null)
    select period, device_pattern, count(*) as n, min(gap) as min, quantile_cont(gap, 0.25) as q1,
      median(gap) as median, quantile_cont(gap, 0.75) as q3, max(gap) as max, avg(gap) as mean
    from g group by 1, 2""")
def _(t):
    return e.device_transition(visits(t))


@query("e17_repeat_device_mix", "period:s device:s n_visitors:l total:l share:d",
       ["visit_counts"], DEVICES.format(">= 2"))
def _(t):
    return e.device_mix(visits(t), repeat=True)


@query("e18_visits_and_articles",
       "ref_id:s period:s total_visits:l total_articles:l articles_per_visit:d", ["visits"], """
    select ref_id, period, count(distinct (visitor_id, visit_number, hit_date)) as total_visits,
      sum(n_articles) as total_articles, cast(sum(n_articles) as double)
        / count(distinct (visitor_id, visit_number, hit_date)) as articles_per_visit
    from visits group by 1, 2""")
def _(t):
    return e.visits_and_articles(visits(t))


fragment("streaks", ("visits",), """
  select ref_id, period, min(hit_date) as start, max(hit_date) as "end", count(*) as n_days
  from (select *, hit_date - cast(row_number() over (partition by ref_id, period
      order by hit_date) as int) as island
    from (select distinct ref_id, period, hit_date from visits) d) i
  group by ref_id, period, island having count(*) >= 2""")


@query("e19_day_streaks", "ref_id:s period:s start:t n_days:l", ["streaks"],
       "select * from streaks")
def _(t):
    return e.streaks(visits(t))


@query("e19_streak_share", "period:s total_users:l users_with_streak:l prop:d",
       ["visits", "streaks"], """
    select period, count(distinct ref_id) as total_users,
      count(distinct case when ref_id in (select ref_id from streaks) then ref_id end)
        as users_with_streak,
      cast(count(distinct case when ref_id in (select ref_id from streaks) then ref_id end)
        as double) / count(distinct ref_id) as prop from visits group by 1""")
def _(t):
    return e.streak_share(visits(t))


fragment("per_week", ("visits",), """
  select ref_id, period, 3 as n_weeks, sum(n_articles) as total,
    sum(n_articles) / 3.0 as articles_per_week from visits group by 1, 2""")


@query("e20_articles_per_week", "ref_id:s period:s n_weeks:l total:l articles_per_week:d",
       ["per_week"], "select * from per_week")
def _(t):
    return e.articles_per_week(visits(t), PERIODS)


@query("e20_zero_week_share", "period:s n_users:l zero_share:d mean_per_week:d", ["per_week"], """
    select period, count(*) as n_users,
      avg(case when total = 0 then 1.0 else 0.0 end) as zero_share,
      avg(articles_per_week) as mean_per_week from per_week group by 1""")
def _(t):
    return e.zero_week_share(e.articles_per_week(visits(t), PERIODS))


@query("e21_visitors_per_day", "period:s hit_date:t n_visitors:l is_weekend:b", ["visits"], """
    select period, hit_date, count(distinct ref_id) as n_visitors,
      dayofweek(hit_date) in (0, 6) as is_weekend from visits group by 1, 2""")
def _(t):
    return e.visitors_per_day(visits(t))


fragment("recent", ("visits",), """
  select *, coalesce((case period when 'P1' then date '2024-01-15' else date '2024-01-30' end)
      - last_article, 14) as recency from (
    select ref_id, period, max(case when n_articles > 0 then hit_date end) as last_article
    from visits group by 1, 2) x""")


@query("e22_recency", "ref_id:s period:s last_article:t recency:l", ["recent"],
       "select * from recent")
def _(t):
    return e.recency(visits(t), PERIODS)


@query("e23_no_article_share",
       "period:s n_users:l without_article:l mean_recency:d pct_without:d", ["recent"], """
    select period, count(*) as n_users, count(*) - count(last_article) as without_article,
      avg(case when last_article is not null then recency end) as mean_recency,
      (count(*) - count(last_article)) * 100.0 / count(*) as pct_without
    from recent group by 1""")
def _(t):
    return e.no_article_share(e.recency(visits(t), PERIODS))


@query("e24_identity_coverage", "via:s n_users:l", ["hits", "ids", "second_map"], """
    select case when uid in (select uid from ids) then 'first map'
        when uid in (select uid from second_map) then 'second map' else 'none' end as via,
      count(*) as n_users
    from (select distinct try_cast(nullif(nullif(uid_raw, ''), 'NO_ID') as bigint) as uid
      from hits) u where uid is not null group by 1""")
def _(t):
    ids = e.identity_map(t.identity, e.eligible_users(t.identity))
    return e.identity_coverage(t.hits, ids, t.second_map)
