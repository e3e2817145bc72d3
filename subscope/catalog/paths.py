"""Purchase paths (N1-N20) and product models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import inference as inf
from ..plans import models as m
from ..plans import paths as n
from ..plans.sampling import stratified_split
from ..sources.io import stage
from .registry import fragment, query

SINGLES = {"P1": "Digital Only", "P2": "Print Only"}
LEVELS = {"P1": ("Digital Only", 1), "P2": ("Print Only", 2), "P3": ("Health Pulse", 3),
          "P4": ("Digital and Print", 4)}
CH = n.CHANNELS
COUNT_COLS = " ".join(f"{c}:l" for c in n.COUNTS)

fragment("order_codes", (), """
  select l_orderkey as ordernumber, 'P' || cast(l_partkey % 4 + 1 as varchar)
    as publicationcode, case when l_returnflag = 'N' then 52 else 4 end as og_termlength
  from lineitem""")
fragment("new_orders", ("invoice",), """
  select customeraccountid - 500000 as customer,
    cast(date '2024-01-01' + cast((paidat - date '1990-01-01') % 30 as int) as date)
      as order_day,
    'P' || cast(planid + 1 as varchar) as pubcode from invoice""")
fragment("buyer_hits", ("hits",), """
  select * from (select *, max(orders) over (partition by uid) as has_order from (
    select *, coalesce(max(try_cast(nullif(nullif(uid_raw, ''), 'NO_ID') as bigint))
      over (partition by visitor_id, visit_number), visitor_id) as uid from hits) a) b
  where has_order = 1""")


def _path_sql(pick: str) -> str:
    return f"""
  select *, rn = cut as is_purchase from (
    select *, {pick}(case when purchase_id is not null then rn end) over (partition by uid) as cut
    from (select *, row_number() over (partition by uid
        order by hit_date, visit_number, clicks_to_page, event_id) as rn from buyer_hits) a) b
  where rn <= cut"""


fragment("path_first", ("buyer_hits",), _path_sql("min"))
fragment("path_last", ("buyer_hits",), _path_sql("max"))
ACCESS_SQL = "case when visitor_access is null then 0 when visitor_access = 'reg' then 1 else 3 end"
fragment("touch", ("path_last",), """
  select distinct uid, purchase_id, coalesce(referrer_type, 'missing') as last_touch,
    hit_date as purchase_date from path_last where is_purchase""")
PIVOT = ", ".join(
    f"sum(case when channel = '{c}' then n else 0 end) as {k}" for c, k in CH.items())
fragment("channel_days", ("path_last",), f"""
  select uid, hit_date, max(access) as access, {PIVOT}
  from (select uid, hit_date, coalesce(referrer_type, 'missing') as channel,
      max({ACCESS_SQL}) as access, count(distinct (visitor_id, visit_number)) as n
    from path_last group by 1, 2, 3) a group by 1, 2""")
fragment("channel_counts", ("channel_days",), f"""
  select uid, max(access) as access_level, count(distinct hit_date) as total_days,
    {', '.join(f'sum({k}) as {k}' for k in n.COUNTS)} from channel_days group by 1""")
fragment("prior_counts", ("channel_counts", "touch"), f"""
  select c.uid, access_level, total_days, purchase_id, last_touch,
    {', '.join(f"{k} - case when last_touch = '{c}' then 1 else 0 end as {k}"
               for c, k in CH.items())}
  from channel_counts c join touch t on t.uid = c.uid""")
fragment("order_products", ("order_codes",), """
  select ordernumber, case when n = 2 then 'Digital and Print'
      when n = 1 and code = 'P1' then 'Digital Only'
      when n = 1 and code = 'P2' then 'Print Only' else 'Health Pulse' end as product
  from (select ordernumber, count(distinct publicationcode) as n, max(publicationcode) as code
    from order_codes group by 1) a""")
fragment("new_products", ("touch", "new_orders"), """
  select distinct uid, purchase_id, case pubcode when 'P1' then 'Digital Only'
      when 'P2' then 'Print Only' when 'P3' then 'Health Pulse' else 'Digital and Print' end
      as product
  from (select t.*, o.pubcode, max(o.pubcode) over (partition by uid) as top
    from touch t join new_orders o on o.customer = t.uid and o.order_day = t.purchase_date) x
  where pubcode = top""")
fragment("model_rows", ("prior_counts", "order_products", "new_products"), f"""
  select uid, purchase_id, case access_level when 0 then 'anonymous' when 1 then 'reg'
      else 'subscribed' end as access, total_days, {', '.join(n.COUNTS)}, last_touch,
    case product when 'Health Pulse' then 'Print Only' else product end as product
  from (select c.*, product from prior_counts c join order_products o
      on o.ordernumber = c.purchase_id
    union all
    select c.*, product from prior_counts c join new_products p
      on p.uid = c.uid and p.purchase_id = c.purchase_id
    where not exists (select 1 from order_products o where o.ordernumber = c.purchase_id)) x""")
USED = " + ".join(
    f"(case when {k} + case when last_touch = '{c}' then 1 else 0 end > 0 then 1 else 0 end)"
    for c, k in CH.items())
NAME = " ".join(
    f"when {k} + case when last_touch = '{c}' then 1 else 0 end > 0 then '{k}'"
    for c, k in CH.items())
fragment("segment_rows", ("model_rows",), f"""
  select *, case when {USED} = 1 then case {NAME} end when {USED} = 0 then 'missing'
    else 'Multi-channel' end as channel_segment from model_rows""")


def order_codes(t):
    code = F.concat(F.lit("P"), (F.col("l_partkey") % 4 + 1).cast("string"))
    return t.table("lineitem").select(
        F.col("l_orderkey").alias("ordernumber"), code.alias("publicationcode"),
        F.when(F.col("l_returnflag") == "N", 52).otherwise(4).alias("og_termlength"),
    )


def new_orders(t):
    day = F.datediff("paidat", F.lit("1990-01-01").cast("date")) % 30
    return t.invoice.select(
        (F.col("customeraccountid") - 500000).alias("customer"),
        F.date_add(F.lit("2024-01-01").cast("date"), day).alias("order_day"),
        F.concat(F.lit("P"), (F.col("planid") + 1).cast("string")).alias("pubcode"),
    )


def path(t, mode="last"):
    return n.path_to_purchase(n.purchasers(t.hits), mode)


def products(t):
    return n.order_product(order_codes(t), SINGLES, "Digital and Print", "Health Pulse")


def rows(t):
    p = stage(path(t).select(
        "uid", "event_id", "hit_date", *n.VISIT, "clicks_to_page", "referrer_type", "device",
        "visitor_access", "purchase_id", "is_purchase"))
    found = n.order_product_new(n.last_touch(p), new_orders(t), LEVELS)
    return n.model_rows(p, products(t), found, merge={"Health Pulse": "Print Only"})


@query("n1_purchasers", "event_id:l uid:l orders:l", ["buyer_hits"],
       "select event_id, uid, orders from buyer_hits")
def _(t):
    return n.purchasers(t.hits)


@query("n2_path_to_first_purchase", "event_id:l uid:l is_purchase:b", ["path_first"],
       "select event_id, uid, is_purchase from path_first")
def _(t):
    return path(t, "first")


@query("n2_path_to_last_purchase", "event_id:l uid:l is_purchase:b", ["path_last"],
       "select event_id, uid, is_purchase from path_last")
def _(t):
    return path(t)


@query("n3_last_touch", "uid:l purchase_id:l last_touch:s purchase_date:t", ["touch"],
       "select * from touch")
def _(t):
    return n.last_touch(path(t))


@query("n4_access_level", "uid:l entry_level:l access_level:l", ["path_last"], f"""
    select uid, max(entry) as entry_level, max(top) as access_level from (
      select uid, max(access) over g as top, first_value(access) over (partition by uid, hit_date,
          device, referrer_type order by rn) as entry
      from (select *, {ACCESS_SQL} as access from path_last) a
      window g as (partition by uid)) b group by 1""")
def _(t):
    return n.access_level(path(t))


@query("n5_channel_counts", f"uid:l access_level:l total_days:l {COUNT_COLS}",
       ["channel_counts"], "select * from channel_counts")
def _(t):
    return n.channel_counts(path(t))


@query("n5_daily_channels_wide", f"uid:l hit_date:t {COUNT_COLS}", ["channel_days"],
       "select * from channel_days")
def _(t):
    return n.daily_channel_wide(path(t))


@query("n6_prior_channel_counts",
       f"uid:l access_level:l total_days:l purchase_id:l last_touch:s {COUNT_COLS}",
       ["prior_counts"], "select * from prior_counts")
def _(t):
    p = path(t)
    return n.prior_channel_counts(n.channel_counts(p), n.last_touch(p))


@query("n7_order_product", "ordernumber:l product:s", ["order_products"],
       "select * from order_products")
def _(t):
    return products(t)


@query("n7_order_product_terms", "ordernumber:l product:s", ["order_products", "order_codes"], """
    select o.ordernumber, product || case when weeks <= 4 then '_monthly' else '_annual' end
      as product
    from order_products o join (select ordernumber, min(og_termlength) as weeks from order_codes
      group by 1) w on w.ordernumber = o.ordernumber""")
def _(t):
    return n.order_product(order_codes(t), SINGLES, "Digital and Print", "Health Pulse", True)


@query("n8_order_product_new", "uid:l purchase_id:l product:s", ["new_products"],
       "select * from new_products")
def _(t):
    return n.order_product_new(n.last_touch(path(t)), new_orders(t), LEVELS)


MODEL_COLS = (f"uid:l purchase_id:l access:s total_days:l {COUNT_COLS} last_touch:s product:s")


@query("n9_model_rows", MODEL_COLS, ["model_rows"], "select * from model_rows")
def _(t):
    return rows(t)


def _share_sql(by: list[str], source: str, extra: str = "") -> str:
    over = f"(partition by {', '.join(by)})" if by else "()"
    keys = ", ".join([*by, "product"])
    return f"""
    with c as (select {keys}, count(distinct uid) as n from (select *{extra} from {source}) s
      group by {keys})
    select *, sum(n) over {over} as total, n * 100.0 / sum(n) over {over} as share from c"""


BUCKET = """, case when total_days = 1 then 'One Day' when total_days <= 5 then '2 - 5 Days'
      else '6 Days +' end as day_bucket"""


@query("n10_product_by_touch", "last_touch:s access:s product:s n:l total:l share:d",
       ["model_rows"], _share_sql(["last_touch", "access"], "model_rows"))
def _(t):
    return n.product_by_touch(rows(t))


@query("n11_channel_segment", "uid:l channel_segment:s", ["segment_rows"],
       "select uid, channel_segment from segment_rows")
def _(t):
    return n.with_channel_segment(rows(t))


@query("n12_product_by_segment", "channel_segment:s product:s n:l total:l share:d",
       ["segment_rows"], _share_sql(["channel_segment"], "segment_rows"))
def _(t):
    return n.product_by_segment(rows(t))


@query("n12_product_by_segment_access",
       "channel_segment:s access:s product:s n:l total:l share:d",
       ["segment_rows"], _share_sql(["channel_segment", "access"], "segment_rows"))
def _(t):
    return n.product_by_segment(rows(t), ["access"])


@query("n13_days_to_order",
       "channel_segment:s product:s n:l min:d q1:d median:d q3:d max:d mean:d",
       ["segment_rows"], """
    select channel_segment, product, count(*) as n, min(total_days) as min,
      quantile_cont(total_days, 0.25) as q1, median(total_days) as median,
      quantile_cont(total_days, 0.75) as q3, max(total_days) as max, avg(total_days) as mean
    from segment_rows group by 1, 2""")
def _(t):
    return n.days_to_order(rows(t))


@query("n14_day_bucket", "access:s day_bucket:s product:s n:l total:l share:d",
       ["model_rows"], _share_sql(["access", "day_bucket"], "model_rows", BUCKET))
def _(t):
    return n.product_by_day_bucket(rows(t))


@query("n15_product_share", "product:s n:l total:l share:d", ["model_rows"],
       _share_sql([], "model_rows"))
def _(t):
    return n.product_share(rows(t))


@query("n16_combo_share", "combo:s product:s n:l total:l share:d", ["segment_rows"], """
    with c as (select channel_segment || '-' || last_touch as combo, product, count(*) as n
      from segment_rows group by 1, 2)
    select *, sum(n) over (partition by combo) as total,
      n * 100.0 / sum(n) over (partition by combo) as share from c""")
def _(t):
    return n.combo_share(rows(t))


# --- models with many predictors: estimates, so no oracle; tests bound their log-loss ---------------------------

SIMPLE = "product ~ access + total_days + last_touch"
BASIC = SIMPLE + " + " + " + ".join(n.COUNTS)
DETAILED = BASIC + " + access:total_days"
# Every count may act differently by last touch.
FULL_MODEL = DETAILED + " + " + " + ".join(f"{c}:last_touch" for c in n.COUNTS)


def model_input(t):
    return stage(rows(t))


def scores(t):
    r = model_input(t)
    return m.score_long(m.fit_multinomial(r, BASIC), r)


@query("t9_fit_multinomial", "model:s n:l unscored:l loglik:d log_loss:d converged:b")
def _(t):
    r = model_input(t)
    return m.compare_models({"basic": m.fit_multinomial(r, BASIC)}, r)


@query("t10_compare_models",
       "step:l model:s parameters:l n:l unscored:l loglik:d log_loss:d lr_statistic:d lr_df:l "
       "converged:b")
def _(t):
    r = model_input(t)
    fits = {k: m.fit_multinomial(r, f, reg=0.0) for k, f in
            (("simple", SIMPLE), ("basic", BASIC), ("detailed", DETAILED), ("full", FULL_MODEL))}
    return m.compare_models(fits, r)


@query("t10_held_out_log_loss", "step:l model:s n:l unscored:l log_loss:d")
def _(t):
    split = stage(stratified_split(rows(t), "product", "purchase_id", 0.8, 1234))
    train, test = split.where("part = 'train'"), split.where("part = 'test'")
    fits = {k: m.fit_multinomial(train, f) for k, f in (("simple", SIMPLE), ("basic", BASIC))}
    return m.compare_models(fits, test)


@query("t11_vif", "predictor:s vif:d")
def _(t):
    return m.vif(model_input(t), ["total_days", *n.COUNTS])


@query("t12_odds_ratios", "category:s predictor:s coefficient:d odds_ratio:d")
def _(t):
    r = model_input(t)
    return m.odds_ratios(m.fit_multinomial(r, BASIC), r)


SCORE = "uid:l purchase_id:l category:s probability:d"


@query("t13_score_long", SCORE)
def _(t):
    return scores(t)


@query("t14_predicted_counts", "category:s observed:l predicted:l")
def _(t):
    r = model_input(t)
    return m.predicted_counts(m.fit_multinomial(r, BASIC), r, "product")


@query("t15_effect_grid", "access:s last_touch:s category:s probability:d")
def _(t):
    r = model_input(t)
    levels = {"access": list(n.ACCESS.values()), "last_touch": list(CH)}
    return m.effect_grid(m.fit_multinomial(r, BASIC), r, "product", levels,
                         ["total_days", *n.COUNTS])


@query("n17_fit_and_score", "access:s category:s mean_probability:d")
def _(t):
    return scores(t).groupBy("access", "category").agg(
        F.avg("probability").alias("mean_probability"))


@query("n18_score_by_distinct_channels",
       "category:s last_touch:s access:s n_channels:l mean_probability:d")
def _(t):
    return n.score_by_distinct_channels(scores(t))


@query("n19_score_by_segment",
       "channel_segment:s day_bucket:s access:s category:s mean_probability:d")
def _(t):
    return n.score_by_segment(scores(t))


@query("n20_score_by_visit_count",
       "last_touch:s category:s channel:s visit_count:l mean_probability:d")
def _(t):
    return n.score_by_visit_count(scores(t))


# --- errors, left-out rows and reports of a model whose maximum has a closed form -----------------
# With one text predictor the fitted probabilities are the shares by level, and the information
# is that of a table of counts.

fragment("cells", ("model_rows",), """
  select access, product, (select count(*) from model_rows r where r.access = a.access and r.product = c.product) as k,
    (select count(*) from model_rows r where r.access = a.access) as n
  from (select distinct access from model_rows) a, (select distinct product from model_rows) c""")
fragment("access_scores", ("model_rows", "cells"), """
  select r.* exclude (product), c.product as category, k * 1.0 / n as probability
  from model_rows r join cells c on c.access = r.access""")


def access_fit(t, by="access"):
    r = model_input(t)
    return r, inf.maximum(m.fit_multinomial(r, f"product ~ {by}", reg=0.0), r)


def access_scores(t):
    r, fit = access_fit(t)
    return inf.score_long(fit, r.drop("product"))


@query("t9_fit_access", "model:s n:l parameters:l loglik:d log_loss:d", ["cells"], """
    select 'access' as model, sum(k) as n, sum(k * ln(k * 1.0 / n)) as loglik, -sum(k * ln(k * 1.0 / n)) / sum(k) as log_loss,
      (select sum(seen - 1) from (select count(*) as seen from cells where k > 0 group by access) x) as parameters
    from cells where k > 0""")
def _(t):
    return inf.fit_report({"access": access_fit(t)[1]})


def _left_out(by: str) -> str:
    """ln of each row's probability by a fit without it (one Newton step), for product ~ ``by``."""
    return f"""select uid, purchase_id, product, row_number() over (order by uid, purchase_id, product, access, last_touch) as place,
      case when n = 1 then 0 else ln(p) - 1 / ((n - 1) * p) - ln(1 - p + p * exp(-1 / ((n - 1) * p))) end as l, ln(p) as f
    from (select *, count(*) over (partition by {by}) as n,
      count(*) over (partition by {by}, product) * 1.0 / count(*) over (partition by {by}) as p from model_rows) x"""


@query("t10_loo_compare", "model:s n:l elpd:d se:d parameters:d elpd_diff:d se_diff:d", ["model_rows"], f"""
    with a as ({_left_out("access")}), b as ({_left_out("last_touch")}),
    two as (select a.l as la, b.l as lb, a.f as fa, b.f as fb from a join b using (place)),
    s as (select count(*) as n, sum(la) as ea, sum(lb) as eb, stddev_samp(la) as sa, stddev_samp(lb) as sb,
      stddev_samp(la - lb) as sd, sum(fa) as fa, sum(fb) as fb from two)
    select 'access' as model, n, ea as elpd, sqrt(n) * sa as se, fa - ea as parameters, ea - greatest(ea, eb) as elpd_diff,
      case when ea >= eb then 0 else sqrt(n) * sd end as se_diff from s
    union all
    select 'last_touch', n, eb, sqrt(n) * sb, fb - eb, eb - greatest(ea, eb), case when eb > ea then 0 else sqrt(n) * sd end from s""")
def _(t):
    r, one = access_fit(t)
    return inf.loo_compare({"access": one, "last_touch": inf.maximum(m.fit_multinomial(r, "product ~ last_touch", reg=0.0), r)}, r)


_TAIL = ("1 - sqrt(2 / pi()) * abs(z) / 12000 * list_sum(list_transform(range(4001), lambda i: (case when i in (0, 4000) then 1 "
         "when i % 2 = 1 then 4 else 2 end) * exp(-pow(i * z / 4000, 2) / 2)))")


@query("t12_odds_ratio_intervals",
       "category:s predictor:s coefficient:d odds_ratio:d se:d z:d p_value:d lo:d hi:d", ["cells"], f"""
    with base as (select min(product) as c0, min(access) as a0 from cells),
    t as (select c.product as category, c.access, c.k as kj, x.k as k0, y.k as oj, z.k as o0
      from cells c, base join cells x on x.product = c.product and x.access = a0
      join cells y on y.product = c0 and y.access = c.access join cells z on z.product = c0 and z.access = a0
      where c.product <> c0),
    u as (select category, '(intercept)' as predictor, ln(k0 * 1.0 / o0) as coefficient, sqrt(1.0 / k0 + 1.0 / o0) as se
      from t, base where access = a0 and k0 > 0 and o0 > 0
      union all select category, 'access_' || access, ln(kj * o0 * 1.0 / (oj * k0)), sqrt(1.0 / kj + 1.0 / o0 + 1.0 / oj + 1.0 / k0)
      from t, base where access <> a0 and kj > 0 and o0 > 0 and oj > 0 and k0 > 0
      union all select category, case when access = a0 then '(intercept)' else 'access_' || access end, null, null
      from t, base where kj = 0 or o0 = 0 or oj = 0 or k0 = 0),
    v as (select *, coefficient / se as z from u)
    select category, predictor, coefficient, exp(coefficient) as odds_ratio, se, z, {_TAIL} as p_value,
      exp(coefficient - 1.959963984540054e0 * se) as lo, exp(coefficient + 1.959963984540054e0 * se) as hi from v""")
def _(t):
    r, fit = access_fit(t)
    return inf.odds_ratio_table(fit, r)


@query("t12_odds_ratio_intervals_basic",
       "category:s predictor:s coefficient:d odds_ratio:d se:d z:d p_value:d lo:d hi:d")
def _(t):
    r = model_input(t)
    return inf.odds_ratio_table(inf.maximum(m.fit_multinomial(r, BASIC, reg=0.0), r), r)


@query("t13_score_access", "uid:l purchase_id:l access:s category:s probability:d", ["access_scores"],
       "select uid, purchase_id, access, category, probability from access_scores")
def _(t):
    return access_scores(t)


@query("t14_predicted_access", "category:s observed:l predicted:l", ["cells"], """
    with top as (select access, n, max(k) as most from cells group by all),
    p as (select c.product, sum(t.n) as predicted from cells c join top t on t.access = c.access and c.k = t.most group by 1)
    select c.product as category, sum(k) as observed, coalesce(any_value(predicted), 0) as predicted
    from cells c left join p using (product) group by 1""")
def _(t):
    r, fit = access_fit(t)
    names = F.array(*map(F.lit, fit.classes))
    best = F.array_position("probabilities", F.array_max("probabilities")).cast("int") - 1
    told = inf.probabilities(fit, r).groupBy(F.get(names, best).alias("category")).agg(F.count(F.lit(1)).alias("predicted"))
    seen = r.groupBy(F.col("product").alias("category")).agg(F.count(F.lit(1)).alias("observed"))
    return seen.join(told, "category", "left").na.fill(0, ["predicted"])


@query("t15_effect_intervals", "access:s category:s probability:d se:d lo:d hi:d", ["cells"], """
    select access, product as category, p as probability, sqrt(p * (1 - p) / n) as se,
      case when p in (0, 1) then p else 1 / (1 + exp(-(ln(p / (1 - p)) - 1.959963984540054e0 / sqrt(n * p * (1 - p))))) end as lo,
      case when p in (0, 1) then p else 1 / (1 + exp(-(ln(p / (1 - p)) + 1.959963984540054e0 / sqrt(n * p * (1 - p))))) end as hi
    from (select *, k * 1.0 / n as p from cells) c""")
def _(t):
    r, fit = access_fit(t)
    return inf.effect_intervals(fit, r, {"access": list(n.ACCESS.values())})


@query("t15_effect_intervals_basic", "access:s last_touch:s category:s probability:d se:d lo:d hi:d")
def _(t):
    r = model_input(t)
    fit = inf.maximum(m.fit_multinomial(r, BASIC, reg=0.0), r)
    return inf.effect_intervals(fit, r, {"access": list(n.ACCESS.values()), "last_touch": list(CH)}, ["total_days", *n.COUNTS])


@query("n17_score_access", "access:s category:s mean_probability:d", ["access_scores"], """
    select access, category, avg(probability) as mean_probability from access_scores group by 1, 2""")
def _(t):
    return access_scores(t).groupBy("access", "category").agg(F.avg("probability").alias("mean_probability"))


FULL = {k: f"({k} + case when last_touch = '{c}' then 1 else 0 end)" for c, k in CH.items()}


@query("n18_distinct_channels_access", "category:s last_touch:s access:s n_channels:l mean_probability:d", ["access_scores"], f"""
    with used as (select uid, purchase_id, category, {' + '.join(f"max(case when {x} > 0 then 1 else 0 end)" for x in FULL.values())}
        as n_channels from access_scores group by 1, 2, 3)
    select category, last_touch, access, n_channels, avg(probability) as mean_probability
    from access_scores join used using (uid, purchase_id, category) group by 1, 2, 3, 4""")
def _(t):
    return n.score_by_distinct_channels(access_scores(t))


@query("n19_segment_access", "channel_segment:s day_bucket:s access:s category:s mean_probability:d",
       ["access_scores", "segment_rows"], f"""
    select channel_segment, day_bucket, access, product as category, avg(share) as mean_probability
    from (select s.channel_segment, s.access, c.product, c.k * 1.0 / c.n as share{BUCKET}
      from segment_rows s join cells c on c.access = s.access) x group by 1, 2, 3, 4""")
def _(t):
    return n.score_by_segment(access_scores(t))


@query("n20_visit_count_access", "last_touch:s category:s channel:s visit_count:l mean_probability:d", ["access_scores"], f"""
    select last_touch, category, channel, visit_count, avg(probability) as mean_probability
    from (unpivot (select last_touch, category, probability, {', '.join(f'cast({k} as bigint) as {k}' for k in n.COUNTS)} from access_scores)
      on {', '.join(n.COUNTS)} into name channel value visit_count) x group by 1, 2, 3, 4""")
def _(t):
    return n.score_by_visit_count(access_scores(t))
