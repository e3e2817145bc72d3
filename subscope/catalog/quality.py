"""Validation and revenue recognition (V1-V9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import history as h
from ..plans import quality as v
from .history import base, brand_history, captured, new_terms, stitched
from .registry import fragment, query

PAID = "donortype = 'I' and subscriptionclass = 'R' and termtype in ('P', 'C')"
FIRST, LAST = "1995-01-01", "2001-08-05"


@query("v1_duplicate_keys",
       "shiptocustomernumber:l ordernumber:l subscriptionreference:l termnumber:l n:l",
       ["terms"], """
    select shiptocustomernumber, ordernumber, subscriptionreference, termnumber, n
    from (select *, count(*) over (partition by shiptocustomernumber, ordernumber,
      subscriptionreference) as n from terms) x where n > 1""")
def _(t):
    return v.duplicate_keys(
        t.terms, ["shiptocustomernumber", "ordernumber", "subscriptionreference"]
    )


@query("v1_history_duplicate_terms", "new_subid:l termnumber:l ordernumber:s n:l", ["history"],
       """select new_subid, termnumber, ordernumber, n from (
            select *, count(*) over (partition by shiptocustomernumber, ordernumber,
              new_subid, old_subid, termnumber, pubcode) as n from history) x where n > 1""")
def _(t):
    keys = ["shiptocustomernumber", "ordernumber", "new_subid", "old_subid", "termnumber",
            "pubcode"]
    return v.duplicate_keys(stitched(t).select(*keys), keys)


@query("v2_missing_old_contracts", "shiptocustomernumber:l ordernumber:l subscriptionreference:l",
       ["terms", "history_cd"], """
    select shiptocustomernumber, ordernumber, subscriptionreference from terms t
    where expirationissuedate >= date '1999-01-01'
      and not exists (select 1 from history_cd l where l.old_subid = t.subscriptionreference)
      and not exists (select 1 from history_cd l
        where l.original_cust_value = t.shiptocustomernumber and l.ordernumber = cast(t.ordernumber as varchar))
    """)
def _(t):
    """Against the history of the brand that requires a header, by the old id or by customer and order."""
    t = t.shared(terms=True)
    terms = t.terms.withColumn("ordernumber", F.col("ordernumber").cast("string"))
    return v.missing_old_contracts(terms, h.stage(brand_history(t, "CD")), "1999-01-01")


@query("v3_missing_new_subscriptions",
       "subscriptionid:l oldproviderid:l quantity:l has_old_row:t",
       ["subscription", "history", "header"], """
    select s.subscriptionid, s.old as oldproviderid, s.quantity,
      h.firstissuesent as has_old_row
    from (select *, cast(nullif(regexp_replace(coalesce(oldproviderid, ''), '[^0-9]', '', 'g'),
            '') as bigint) as old from subscription) s
    left join header h on h.subscriptionreference = s.old
    where s.ispaid and s.subscriptionstatus in ('active', 'past_due')
      and not exists (select 1 from history x where x.new_subid = s.subscriptionid)""")
def _(t):
    t = t.shared()
    return v.missing_new_subscriptions(t.subscription, captured(t), t.header)


@query("v4_capture_rate", "brand:s total_subs:l captured_subs:l capture_pct:d missing_subs:l",
       ["subscription", "history"], """
    with live as (select * from subscription where subscriptionstatus in ('active', 'past_due')),
    total as (select businessunitcode as brand, sum(quantity) as total_subs from live
      where ispaid group by 1),
    found as (select businessunitcode as brand, sum(quantity) as captured_subs from live
      where subscriptionid in (select new_subid from history where new_subid is not null)
      group by 1)
    select t.brand, total_subs, captured_subs, captured_subs * 100.0 / total_subs as capture_pct,
      total_subs - captured_subs as missing_subs from total t join found f on f.brand = t.brand""")
def _(t):
    t = t.shared()
    return v.capture_rate(t.subscription, captured(t))


@query("v5_recognised_revenue_week",
       "individual_subs:l orders:l revenue:d mean_per_order:d", ["terms"], f"""
    with live as (select *, cast(rate as double)
        * (date '1998-03-08' - greatest(startissuedate, date '1998-03-01'))
        / (og_termlength * 7) as earned
      from terms where {PAID} and expirationissuedate >= date '1998-03-01'
        and startissuedate < date '1998-03-08'),
    best as (select *, max(earned) over (partition by shiptocustomernumber, ordernumber) as m
      from live)
    select count(distinct shiptocustomernumber) as individual_subs,
      count(distinct shiptocustomernumber || '-' || ordernumber) as orders, sum(m) as revenue,
      sum(m) / count(distinct shiptocustomernumber || '-' || ordernumber) as mean_per_order
    from best""")
def _(t):
    return v.recognised_revenue_week(t.terms, "1998-03-01", "1998-03-08")


fragment("revenue_series", ("terms",), f"""
  select brand, week_start, sum(cast(amount_days as double) / (og_termlength * 7)) as revenue,
    sum(copies) as copies, any_value(contracts) as contracts,
    any_value(subscriptions) as subscriptions
  from (
    select brand, week_start, og_termlength,
      sum(rate * copies * (least(expirationissuedate, week_start + 7)
        - greatest(startissuedate, week_start))) as amount_days,
      sum(copies) as copies
    from (select cast(unnest(generate_series(date '{FIRST}', date '{LAST}' - 7,
            interval 7 day)) as date) as week_start) w
    join terms t on t.startissuedate < w.week_start + 7 and t.expirationissuedate > w.week_start
    where {PAID} and rate > 0 group by 1, 2, 3) m
  join (
    select brand, week_start,
      count(distinct shiptocustomernumber || '-' || ordernumber || '-' || subscriptionreference)
        as contracts,
      count(distinct subscriptionreference) as subscriptions
    from (select cast(unnest(generate_series(date '{FIRST}', date '{LAST}' - 7,
            interval 7 day)) as date) as week_start) w
    join terms t on t.startissuedate < w.week_start + 7 and t.expirationissuedate > w.week_start
    where {PAID} and rate > 0 group by 1, 2) d using (brand, week_start)
  group by 1, 2""")


def series(t):
    return v.recognised_revenue_series(t.terms, FIRST, LAST)


@query("v6_recognised_revenue_series",
       "brand:s week_start:t revenue:d copies:l contracts:l subscriptions:l",
       ["revenue_series"], "select * from revenue_series")
def _(t):
    return series(t)


@query("v7_arpu_week", "brand:s week_start:t arpu_copies:d arpu_subs:d", ["revenue_series"], """
    select brand, week_start, revenue / copies as arpu_copies,
      revenue / subscriptions as arpu_subs from revenue_series""")
def _(t):
    return v.arpu_week(series(t))


@query("v8_arpu_year", "year:l total_rev:m n_contracts:l arpu:d", ["terms"], """
    select year(startissuedate) as year, sum(m) as total_rev,
      count(distinct shiptocustomernumber || '-' || ordernumber) as n_contracts,
      cast(sum(m) as double) / count(distinct shiptocustomernumber || '-' || ordernumber) as arpu
    from (select shiptocustomernumber, ordernumber, startissuedate, max(rate) as m from terms
      where startissuedate >= date '1996-01-01' group by 1, 2, 3) x group by 1""")
def _(t):
    return v.arpu_year(t.terms, "1996-01-01")


@query("v9_history_flags",
       "ordernumber:l subscriptionreference:l termnumber:l migrated:l order_migrated:l "
       "max_level:l order_total:m", ["terms_base", "new_terms"], """
    select ordernumber, subscriptionreference, termnumber, migrated,
      max(migrated) over w as order_migrated, max(pub_level) over w as max_level,
      sum(rate) over w as order_total
    from (select b.*, case when subscriptionreference in (select old_sub_id from new_terms)
      then 1 else 0 end as migrated from terms_base b) x
    window w as (partition by shiptocustomernumber, ordernumber)""")
def _(t):
    return v.history_flags(base(t), new_terms(t))
