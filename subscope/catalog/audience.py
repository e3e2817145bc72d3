"""Email funnel, audience profile and price feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordered import five_number
from ..plans import audience as a
from .registry import fragment, query

KINDS = {"J": "B", "B": "J"}  # this brand's code table has its kinds exchanged
OVERRIDES = [("J", "hot gear", "7")]
OTHER = "Other Organization"

fragment("deduped", ("sends",), """
  select * exclude (m) from (select *, max(did_open) over (partition by profile_id, message_id,
    blast_id, send_time, send_date) as m from sends) x where did_open = m""")
fragment("registered", ("registration", "profile_map"), """
  select userid, createdate, referrer,
    cast(coalesce(nullif(aa_subscriberid, ''), nullif(aad_subscriberid, ''),
      nullif(aaz_subscriberid, '')) as bigint) as sub_id, id as profile_id
  from registration left join profile_map on csid = userid""")
fragment("mailed", ("deduped", "registered"), """
  select * from deduped where profile_id in (select profile_id from registered
    where profile_id is not null)""")
fragment("email_stats", ("mailed",), """
  select profile_id, count(distinct (blast_id, message_id, profile_id, send_time)) as n_emails,
    count(distinct send_date) as n_dates, count(distinct blast_id) as n_blasts,
    count(distinct message_id) as n_messages, sum(did_open) as total_opens,
    sum(did_click) as total_clicks from mailed group by 1""")
fragment("reg_stats", ("registered", "email_stats"), """
  select r.*, n_emails, total_opens, total_clicks
  from registered r left join email_stats s on s.profile_id = r.profile_id""")


def registered(t):
    return a.registered_users(t.registration, t.profile_map)


def mailed(t):
    return a.relevant_sends(a.send_dedup(t.sends), registered(t))


def stats(t):
    return a.profile_email_stats(mailed(t))


SENDS = "profile_id:l message_id:l blast_id:l send_date:t did_open:l did_click:l"


@query("m1_send_dedup", SENDS, ["deduped"], "select * from deduped")
def _(t):
    return a.send_dedup(t.sends)


@query("m2_profile_email_stats",
       "profile_id:l n_emails:l n_dates:l n_blasts:l n_messages:l total_opens:l total_clicks:l",
       ["email_stats"], "select * from email_stats")
def _(t):
    return stats(t)


FUNNEL = """count(distinct userid) as registered,
      count(distinct case when n_emails is not null then userid end) as emailed,
      count(distinct case when total_opens > 0 then userid end) as opened,
      count(distinct case when total_opens > 0 and total_clicks > 0 then userid end) as clicked"""


@query("m3_email_funnel", "segment:s registered:l emailed:l opened:l clicked:l", ["reg_stats"],
       f"""select 'all' as segment, {FUNNEL} from reg_stats
       union all select 'converted', {FUNNEL} from reg_stats where sub_id is not null""")
def _(t):
    return a.email_funnel(registered(t), stats(t))


@query("m4_conversion_rate", "registered:l converted:l rate_pct:d", ["registered"], """
    select count(distinct userid) as registered,
      count(distinct case when sub_id is not null then userid end) as converted,
      round(cast(count(distinct case when sub_id is not null then userid end) as double)
        / count(distinct userid) * 100, 3) as rate_pct from registered""")
def _(t):
    return a.conversion_rate(registered(t))


fragment("email_load", ("mailed", "registered"), """
  select *, cast(total_emails as double) / total_weeks as emails_per_week,
    round(cast(total_opens as double) / total_emails * 100) as open_share_pct
  from (
    select userid, max(weeks) as total_weeks, sum(emails) as total_emails,
      sum(opens) as total_opens, sum(open_clicks) as total_open_clicks
    from registered r join (
      select profile_id, count(distinct week) as weeks, sum(emails) as emails,
        sum(opens) as opens, sum(open_clicks) as open_clicks
      from (select profile_id, floor((dayofyear(send_date) - 1) / 7.0) + 1 as week,
          count(distinct (blast_id, message_id, send_time)) as emails,
          count(distinct case when did_open = 1 then (blast_id, message_id, send_time) end)
            as opens,
          count(distinct case when did_open = 1 and did_click = 1
            then (blast_id, message_id, send_time) end) as open_clicks
        from mailed group by 1, 2) w group by 1) p on p.profile_id = r.profile_id
    group by 1) u""")


@query("m5_weekly_email_load",
       "userid:l total_weeks:l total_emails:l total_opens:l total_open_clicks:l "
       "emails_per_week:d open_share_pct:d", ["email_load"], "select * from email_load")
def _(t):
    return a.weekly_email_load(registered(t), mailed(t))


@query("m5_email_load_summary", "n:l min:d q1:d median:d q3:d max:d mean:p", ["email_load"], """
    select count(*) as n, min(emails_per_week) as min,
      quantile_cont(emails_per_week, 0.25) as q1, median(emails_per_week) as median,
      quantile_cont(emails_per_week, 0.75) as q3, max(emails_per_week) as max,
      avg(emails_per_week) as mean from email_load""")
def _(t):
    return five_number(a.weekly_email_load(registered(t), mailed(t)), [], "emails_per_week")


@query("m6_referrer_share", "source:s n_users:l total_users:l share:d", ["reg_stats"], """
    with c as (select coalesce(nullif(referrer, ''), 'Unknown') as source,
        count(distinct userid) as n_users from reg_stats where n_emails is null group by 1),
    s as (select *, sum(n_users) over () as total_users,
        round(cast(n_users as double) * 100 / sum(n_users) over (), 1) as share from c)
    select * from (select *, rank() over (order by share desc) as r from s) x where r <= 10""")
def _(t):
    return a.referrer_share(registered(t), stats(t), 10)


@query("m7_clicked_split",
       "did_click:b did_purchase:b n:l min:d q1:d median:d q3:d max:d mean:d", ["reg_stats"], """
    select total_clicks > 0 as did_click, sub_id is not null as did_purchase, count(*) as n,
      min(n_emails) as min, quantile_cont(n_emails, 0.25) as q1, median(n_emails) as median,
      quantile_cont(n_emails, 0.75) as q3, max(n_emails) as max, avg(n_emails) as mean
    from reg_stats where n_emails is not null group by 1, 2""")
def _(t):
    return a.clicked_split(registered(t), stats(t))


@query("m8_sends_after_signup",
       "userid:l createdate:t message_id:l blast_id:l send_date:t did_open:l did_click:l",
       ["registered", "deduped"], """
    select distinct userid, createdate, message_id, blast_id, send_date, send_time, did_open,
      did_click
    from registered r join deduped s on s.profile_id = r.profile_id
    where send_time >= createdate""")
def _(t):
    return a.sends_after_signup(registered(t), a.send_dedup(t.sends))


fragment("parsed_codes", ("code_index",), """
  select distinct kind, label,
    case when kind = 'J' and label = 'hot gear' then '7' else code end as code
  from (select case code_kind when 'J' then 'B' when 'B' then 'J' end as kind,
      trim(regexp_replace(value_text, '\\([^)]*\\)', '')) as label,
      nullif(regexp_extract(value_text, '\\(([^)]*)\\)', 1), '') as code from code_index) x""")
fragment("b_codes", ("parsed_codes",),
         "select code, min(label) as label from parsed_codes where kind = 'B' group by 1")
fragment("j_codes", ("parsed_codes",),
         "select code, min(label) as label from parsed_codes where kind = 'J' group by 1")
fragment("people", (), """
  select c_custkey as customer, r_name as brand from customer
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
fragment("industries", ("people", "demographic", "b_codes"), f"""
  select distinct customer, brand,
    case when known = 1 then label else '{OTHER}' end as value
  from (select *, max(known) over (partition by customer) as top from (
    select p.*, label, case when label is null or label like '%gear%' then 0 else 1 end as known
    from people p left join demographic d on d.reader_id = p.customer
    left join b_codes c on c.code = d.busind) x) y where known = top""")
fragment("jobs", ("people", "demographic", "j_codes"), """
  select distinct customer, brand, value
  from (select *, min(job) over (partition by customer) as low from (
    select p.*, coalesce(label, 'unknown') as value,
      coalesce(try_cast(d.jobfunction as int), 99) as job
    from people p left join demographic d on d.reader_id = p.customer
    left join j_codes c on c.code = d.jobfunction) x) y where job = low""")


def parsed(t):
    return a.code_parse(t.code_index, KINDS, OVERRIDES)


def people(t):
    c, n, r = t.table("customer"), t.table("nation"), t.table("region")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(
        r, n.n_regionkey == r.r_regionkey
    ).select(F.col("c_custkey").alias("customer"), F.col("r_name").alias("brand"))


def industries(t):
    codes = a.code_table(parsed(t), "B")
    return a.best_known_value(people(t), t.demographic, codes, "gear", OTHER)


def jobs(t):
    return a.senior_job(people(t), t.demographic, a.code_table(parsed(t), "J"))


@query("m9_code_parse", "kind:s label:s code:s", ["parsed_codes"], "select * from parsed_codes")
def _(t):
    return parsed(t).distinct()


@query("m10_best_known_value", "customer:l brand:s value:s", ["industries"],
       "select * from industries")
def _(t):
    return industries(t)


@query("m11_senior_job", "customer:l brand:s value:s", ["jobs"], "select * from jobs")
def _(t):
    return jobs(t)


@query("m12_audience_top_k", "value:s n:l total:l share:d", ["industries", "people"], f"""
    select * from (select *, rank() over (order by n desc) as r from (
      select value, count(distinct customer) as n, (select count(*) from people) as total,
        count(distinct customer) * 100.0 / (select count(*) from people) as share
      from industries where value <> '{OTHER}' group by 1) a) b where r <= 10""")
def _(t):
    return a.audience_top_k(industries(t), people(t), 10, [OTHER])


@query("m13_job_by_industry", "industry:s job:s n:l total_users:l share:d",
       ["industries", "jobs"], f"""
    with n as (select i.value as industry, j.value as job, count(distinct i.customer) as n
      from industries i join jobs j on j.customer = i.customer
      where j.value not like '%bolt%' group by 1, 2),
    s as (select *, sum(n) over (partition by industry) as total_users,
        round(cast(n as double) * 100 / sum(n) over (partition by industry), 1) as share,
        row_number() over (partition by industry order by n desc, job) as r from n)
    select * from s where r <= 5 and industry in (
      select value from (select value, rank() over (order by count(distinct customer) desc) as r
        from industries where value <> '{OTHER}' group by 1) x where r <= 5)""")
def _(t):
    return a.job_by_industry(industries(t), jobs(t), 5, "bolt", [OTHER])


@query("m14_cross_brand_share", "brand:s value:s n:l identified:l share:d", ["jobs"], """
    with n as (select brand, value, count(distinct customer) as n from jobs
        where value <> 'unknown' group by 1, 2),
    b as (select brand, count(distinct customer) as identified from jobs
        where value <> 'unknown' group by 1)
    select n.brand, value, n, identified,
      round(cast(n as double) / identified * 100, 1) as share
    from (select *, rank() over (partition by brand order by n desc) as r from n) n
    join b on b.brand = n.brand where r <= 5""")
def _(t):
    return a.cross_brand_share(jobs(t), 5, ["unknown"])


@query("m15_label_split", "c_custkey:l head:s", [], """
    select c_custkey, trim(split_part(c_name, '#', 1)) as head from customer""")
def _(t):
    return a.label_split(t.table("customer"), "c_name", "#", "head")


@query("m16_price_feed",
       "siteid:s customerid:l subscriptionid:l planid:l quantity:l source:s addressid:l brand:s "
       "productid:s billingmethod:s pricingsource:s", ["recommendation", "snapshot"], """
    select site_id as siteid, new_customer_id as customerid,
      subscription_id as subscriptionid, plan_id as planid, plan_interval_count as quantity,
      'Renewal' as source, shipping_address_id as addressid, businessunitcode as brand,
      s.product_id as productid, s.billing_method as billingmethod,
      pricing_source as pricingsource
    from recommendation r left join snapshot s on s.new_subscription_id = r.subscription_id
    """)
def _(t):
    return a.price_feed(t.recommendation, t.snapshot)
