"""Price-change analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import pricing as p
from .history import base
from .registry import fragment, query

AS_OF, CHANGE = "2001-08-01", "1998-07-01"
THRESHOLDS = {"Basic Digital": 30000, "Premium": 50000}
FIRST_SINCE = "1996-01-01"

fragment("contracts", ("terms_base",), """
  select shiptocustomernumber, ordernumber, orderdate, subscriptionreference as new_subid,
    isautorenew, product as pubcode, termnumber, termlength, rate, expirationissuedate,
    renewalrate, renewalordernumber, donortype from terms_base""")


def contracts(t):
    return base(t).withColumnsRenamed({"subscriptionreference": "new_subid"}).select(
        *p.CONTRACT_COLS[:4], "isautorenew", F.col("product").alias("pubcode"), "termnumber",
        "termlength", "rate", "expirationissuedate", "renewalrate", "renewalordernumber",
        "donortype",
    )


def outcomes(t):
    return p.renewal_outcomes(contracts(t), CHANGE, "1998-09-01", THRESHOLDS, AS_OF, 90000)


OUTCOMES = ("pubcode:s isautorenew:s contracts:l renewed_raise:l renewed_no_raise:l "
            "undetermined:l churned:l mean_rate_renewed:d mean_rate_churned:d "
            "mean_term_renewed:d mean_term_churned:d renewal_revenue:m churn_loss:m "
            "net_revenue:m")
ID = "shiptocustomernumber || '-' || ordernumber || '-' || new_subid"

fragment("outcomes", ("contracts",), f"""
  select *, renewal_revenue + churn_loss as net_revenue from (
  select pubcode, isautorenew, count(distinct id) as contracts,
    count(distinct case when n > 0 and (renewalrate >= price or renewalrate >= rate) then id end)
      as renewed_raise,
    count(distinct case when n > 0 and not (renewalrate >= price or renewalrate >= rate)
      then id end) as renewed_no_raise,
    count(distinct case when n = 0 and expirationissuedate >= date '{AS_OF}' then id end)
      as undetermined,
    count(distinct case when n = 0 and expirationissuedate < date '{AS_OF}' then id end)
      as churned,
    avg(case when n > 0 and renewalrate >= price then cast(rate as double) end)
      as mean_rate_renewed,
    avg(case when n = 0 and expirationissuedate <= date '{AS_OF}' then cast(rate as double) end)
      as mean_rate_churned,
    avg(case when n > 0 and renewalrate >= price then termnumber end) as mean_term_renewed,
    avg(case when n = 0 and expirationissuedate <= date '{AS_OF}' then termnumber end)
      as mean_term_churned,
    coalesce(sum(case when n > 0 and renewalrate >= price then renewalrate end), 0)
      as renewal_revenue,
    -coalesce(sum(case when n = 0 and expirationissuedate <= date '{AS_OF}' then price end), 0)
      as churn_loss
  from (select *, {ID} as id, case pubcode when 'Basic Digital' then 30000 else 50000 end as price
    from (select {', '.join(p.CONTRACT_COLS)}, max(renewalrate) as renewalrate,
            count(distinct renewalordernumber) as n
          from contracts
          where donortype = 'I' and expirationissuedate >= date '1998-09-01'
            and orderdate <= date '{CHANGE}' and pubcode in ('Basic Digital', 'Premium')
            and termlength = 'Annual' and rate <= 90000
          group by {', '.join(p.CONTRACT_COLS)}) g) x
  group by pubcode, isautorenew) y""")


@query("c1_renewal_outcomes", OUTCOMES, ["outcomes"], "select * from outcomes")
def _(t):
    return outcomes(t)


MONTHLY_COLS = [c for c in p.CONTRACT_COLS if c != "orderdate"]


@query("c2_renewal_outcomes_monthly",
       "pubcode:s termlength:s isautorenew:s contracts:l renewed_raise:l renewed_no_raise:l "
       "churned:l mean_rate_renewed:d mean_rate_churned:d mean_term_renewed:d "
       "mean_term_churned:d renewal_revenue:m churn_loss:m net_revenue:m "
       "median_rate_renewed:d median_rate_churned:d", ["contracts"], f"""
    with live as (
      select * from contracts where donortype = 'I' and termlength = 'Monthly'
        and (orderdate <= date '1998-07-15' and termnumber <> 1
             and expirationissuedate >= date '1998-07-15'
          or orderdate <= date '{CHANGE}' and expirationissuedate >= date '1998-07-15')
        and pubcode in ('Basic Digital', 'Premium')
        and (expirationissuedate <= date '{AS_OF}'
          or expirationissuedate >= date '{AS_OF}' and renewalordernumber is not null)),
    firsts as (select * from (select *, min(termnumber) over (partition by
      shiptocustomernumber, new_subid) as m from live) a where termnumber = m),
    g as (select {', '.join(MONTHLY_COLS)}, max(renewalrate) as renewalrate,
        count(distinct renewalordernumber) as n, any_value({ID}) as id
      from firsts where rate <= 100000 group by {', '.join(MONTHLY_COLS)}),
    f as (select *, n > 0 and (renewalrate >= 25000 or renewalrate > rate) as up,
        n = 0 and expirationissuedate < date '{AS_OF}' as lost from g)
    select *, renewal_revenue + churn_loss as net_revenue from (
    select pubcode, termlength, isautorenew, count(distinct id) as contracts,
      count(distinct case when up then id end) as renewed_raise,
      count(distinct case when n > 0 and renewalrate <= rate then id end) as renewed_no_raise,
      count(distinct case when lost then id end) as churned,
      avg(case when up then cast(rate as double) end) as mean_rate_renewed,
      avg(case when n = 0 then cast(rate as double) end) as mean_rate_churned,
      avg(case when up then termnumber end) as mean_term_renewed,
      avg(case when n = 0 then termnumber end) as mean_term_churned,
      coalesce(sum(case when up then renewalrate end), 0) as renewal_revenue,
      -coalesce(sum(case when lost then 25000 end), 0) as churn_loss,
      median(case when up then cast(rate as double) end) as median_rate_renewed,
      median(case when n = 0 then cast(rate as double) end) as median_rate_churned
    from f group by 1, 2, 3) y""")
def _(t):
    return p.renewal_outcomes_monthly(
        contracts(t), CHANGE, "1998-07-15", list(THRESHOLDS), 25000, AS_OF, 100000
    )


@query("c3_churn_report",
       "Product:s Auto_Renew:s Churn_Rate:s Mean_Termnumber_Renewed:d "
       "Mean_Termnumber_Churned:d Churned_Loss:m Initial_Renewal_Revenue:m", ["outcomes"], """
    select pubcode as "Product", isautorenew as "Auto_Renew",
      cast(round(cast(churned as double) / contracts * 100) as bigint) || '%' as "Churn_Rate",
      mean_term_renewed as "Mean_Termnumber_Renewed",
      mean_term_churned as "Mean_Termnumber_Churned", churn_loss as "Churned_Loss",
      net_revenue as "Initial_Renewal_Revenue" from outcomes""")
def _(t):
    return p.churn_report(outcomes(t))


@query("c4_new_orders",
       "pubcode:s termlength:s isautorenew:s contracts:l renewed:l undetermined:l churned:l "
       "mean_rate_renewed:d mean_rate_churned:d initial_revenue:m median_rate_renewed:d "
       "median_rate_churned:d", ["contracts"], f"""
    with g as (select {', '.join(p.CONTRACT_COLS)}, count(distinct renewalordernumber) as n,
        any_value({ID}) as id
      from contracts where donortype = 'I' and orderdate >= date '{FIRST_SINCE}'
        and termnumber = 1 and pubcode in ('Basic Digital', 'Premium')
      group by {', '.join(p.CONTRACT_COLS)})
    select pubcode, termlength, isautorenew, count(distinct id) as contracts,
      count(distinct case when n > 0 then id end) as renewed,
      count(distinct case when n = 0 and expirationissuedate >= date '{AS_OF}' then id end)
        as undetermined,
      count(distinct case when n = 0 and expirationissuedate < date '{AS_OF}' then id end)
        as churned,
      avg(case when n > 0 then cast(rate as double) end) as mean_rate_renewed,
      avg(case when n = 0 then cast(rate as double) end) as mean_rate_churned,
      sum(rate) as initial_revenue,
      median(case when n > 0 then cast(rate as double) end) as median_rate_renewed,
      median(case when n = 0 then cast(rate as double) end) as median_rate_churned
    from g group by 1, 2, 3""")
def _(t):
    return p.new_orders(contracts(t), FIRST_SINCE, AS_OF, list(THRESHOLDS))


@query("c5_product_mix_shift",
       "category:s pubcode:s termlength:s n_contracts:l total_contracts:l share:d",
       ["contracts"], f"""
    with c as (
      select case when orderdate < date '{FIRST_SINCE}' then 'pre' else 'post' end as category,
        pubcode, termlength, count(distinct {ID}) as n_contracts
      from contracts where donortype = 'I' and termnumber = 1 and rate < 60000
        and pubcode in ('Basic Digital', 'Premium')
        and orderdate between date '1995-05-01' and date '2001-08-01'
      group by 1, 2, 3)
    select *, sum(n_contracts) over (partition by category) as total_contracts,
      n_contracts * 100.0 / sum(n_contracts) over (partition by category) as share from c""")
def _(t):
    periods = [("pre", "1995-05-01", "1995-12-31"), ("post", "1996-01-01", "2001-08-01")]
    return p.product_mix_shift(contracts(t), periods, list(THRESHOLDS), F.col("rate") < 60000)


@query("c6_funnel_conversion",
       "category:s total_unique_visitors:l total_paid_orders:l conversion_rate:d", ["funnel"], """
    select case when funnel_date < date '2024-01-16' then 'pre' else 'post' end as category,
      sum(unique_visitors) as total_unique_visitors, sum(new_paid_orders) as total_paid_orders,
      cast(sum(new_paid_orders) as double) / sum(unique_visitors) as conversion_rate
    from funnel group by 1""")
def _(t):
    return p.funnel_conversion(t.funnel, "2024-01-16")


ORDER_TERMS = """
    rows as (select distinct {cols} from terms_base where {where}),
    leveled as (select *, max(pub_level) over (partition by shiptocustomernumber, ordernumber)
      as order_level from rows),
    o as (select shiptocustomernumber, ordernumber, termlength, isautorenew,
        expirationissuedate, sum(rate) as rate, max(termnumber) as termnumber,
        max(case when renewalrate is null then 0 else 1 end) as did_renew,
        sum(renewalrate) as renewalrate, max(order_level) as order_level,
        any_value(shiptocustomernumber || '-' || ordernumber) as id
      from leveled group by 1, 2, 3, 4, 5)"""


@query("c7_print_bundle_renewal",
       "order_level:l termlength:s active_orders:l renewed_raise:l renewed_no_raise:l "
       "avg_rate_before:d avg_rate_after:d avg_term_renewed:d avg_term_canceled:d "
       "renewal_revenue:m cancel_loss:m", ["terms_base"], "with " + ORDER_TERMS.format(
           cols=", ".join(p.TERM_COLS),
           where=f"""donortype = 'I' and expirationissuedate >= date '{CHANGE}'
             and orderdate < date '{CHANGE}' and og_termlength in (4, 52)""") + f"""
    select order_level, termlength, count(distinct id) as active_orders,
      count(distinct case when did_renew = 1 and renewalrate > rate
        and expirationissuedate < date '{AS_OF}' then id end) as renewed_raise,
      count(distinct case when did_renew = 1 and renewalrate <= rate
        and expirationissuedate < date '{AS_OF}' then id end) as renewed_no_raise,
      cast(sum(rate) as double) / count(*) as avg_rate_before,
      cast(sum(case when renewalrate > rate then renewalrate end) as double)
        / count(case when renewalrate > rate then 1 end) as avg_rate_after,
      avg(case when renewalrate > rate then termnumber end) as avg_term_renewed,
      avg(case when did_renew = 0 then termnumber end) as avg_term_canceled,
      coalesce(sum(case when renewalrate > rate then renewalrate end), 0) as renewal_revenue,
      -coalesce(sum(case when did_renew = 0 then rate end), 0) as cancel_loss
    from o group by 1, 2""")
def _(t):
    return p.print_bundle_renewal(base(t), CHANGE, AS_OF)


@query("c8_new_order_first_term",
       "order_level:l termlength:s new_orders:l renewed:l avg_rate:d new_revenue:m "
       "canceled_loss:m avg_rate_renewed:d avg_rate_canceled:d first_term_revenue:m "
       "median_rate:d", ["terms_base"], "with " + ORDER_TERMS.format(
           cols=", ".join(p.TERM_COLS),
           where=f"""donortype = 'I' and orderdate >= date '{FIRST_SINCE}' and termnumber = 1
             and expirationissuedate <= date '{AS_OF}'""") + """
    select order_level, termlength, count(distinct id) as new_orders,
      count(distinct case when did_renew = 1 then id end) as renewed,
      cast(sum(rate) as double) / count(*) as avg_rate, sum(rate) as new_revenue,
      -coalesce(sum(case when did_renew = 0 then rate end), 0) as canceled_loss,
      cast(sum(case when did_renew = 1 then rate end) as double) / sum(did_renew)
        as avg_rate_renewed,
      cast(sum(case when did_renew = 0 then rate end) as double) / sum(1 - did_renew)
        as avg_rate_canceled,
      sum(rate) - coalesce(sum(case when did_renew = 0 then rate end), 0)
        as first_term_revenue,
      median(cast(rate as double)) as median_rate
    from o group by 1, 2""")
def _(t):
    return p.new_order_first_term(base(t), FIRST_SINCE, AS_OF)


@query("c9_active_at_change", "active_users:l renewing_users:l", ["terms_base"], f"""
    select count(distinct shiptocustomernumber || '-' || billtocustomernumber) as active_users,
      count(distinct case when renewaltermnumber is not null
        then shiptocustomernumber || '-' || billtocustomernumber end) as renewing_users
    from terms_base where donortype = 'I' and expirationissuedate >= date '{CHANGE}'
      and startissuedate <= date '{CHANGE}'""")
def _(t):
    return p.active_at_change(base(t), CHANGE)
