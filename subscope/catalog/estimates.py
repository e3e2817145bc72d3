"""Closed-form estimates and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import likelihood as lik
from ..operators import statistics as s
from ..plans import engagement as e
from ..plans.sampling import sample_users, stratified_split
from .engagement import GRAIN, PERIODS, active, visits
from .registry import fragment, query

fragment("shares", ("visits", "active"), """
  select v.period, count(distinct ref_id) as k, any_value(n_active) as n
  from visits v join active a on a.period = v.period group by 1""")
fragment("posterior", ("shares",), """
  select *, a / (a + b) as post_mean, a * b / ((a + b) * (a + b) * (a + b + 1)) as post_var
  from (select *, cast(k as double) + 1 as a, cast(n as double) - k + 1 as b from shares) x""")


def posterior(t):
    return s.beta_posterior(e.visitor_share(visits(t), active(t)), "n_visitors", "n_active")


@query("t1_beta_posterior", "period:s n_visitors:l n_active:l post_mean:d post_var:d",
       ["posterior"], "select *, k as n_visitors, n as n_active from posterior")
def _(t):
    return posterior(t)


@query("t2_proportion_diff", "diff:d lo:d hi:d p_positive:d", ["posterior"], """
    with d as (select
        max(case when period = 'P2' then post_mean end)
          - max(case when period = 'P1' then post_mean end) as diff,
        sqrt(sum(post_var)) as sd,
        max(case when period = 'P1' then a end) as a1, max(case when period = 'P1' then b end) as b1,
        max(case when period = 'P2' then a end) as a2, max(case when period = 'P2' then b end) as b2
      from posterior)
    select diff, diff - 1.96 * sd as lo, diff + 1.96 * sd as hi, (
      select sum(exp(lgamma(a1 + i) + lgamma(b1 + b2) - lgamma(a1 + i + b1 + b2)
          - ln(b2 + i) - (lgamma(1 + i) + lgamma(b2) - lgamma(1 + i + b2))
          - (lgamma(a1) + lgamma(b1) - lgamma(a1 + b1))))
      from (select unnest(range(cast(a2 as bigint))) as i, a1, b1, a2, b2 from d) terms) as p_positive
    from d""")
def _(t):
    return s.proportion_diff(posterior(t), "period", "P1", "P2", "n_visitors", "n_active")


# Simpson's rule over 4,000 steps from zero to ``to``; ``height`` is a density of x.
def _area(to: str, height: str) -> str:
    weight = "case when i in (0, 4000) then 1 when i % 2 = 1 then 4 else 2 end"
    return (f"{to} / 12000 * (select sum({weight} * {height}) from "
            f"(select i, i * {to} / 4000 as x, * from (select unnest(range(4001)) as i) k, here) steps)")


_Z = "1.959963984540054e0"


@query("t3_prop_test", "prop_a:d prop_b:d chi_square:d p_two_sided:d p_less:d p_greater:d lo:d hi:d", ["shares"], f"""
    with w as (select cast(max(case when period = 'P1' then k end) as double) as ka,
        cast(max(case when period = 'P1' then n end) as double) as na,
        cast(max(case when period = 'P2' then k end) as double) as kb,
        cast(max(case when period = 'P2' then n end) as double) as nb from shares),
    x as (select *, (ka + kb) / (na + nb) as pool, ka / na - kb / nb as delta,
        1 / na + 1 / nb as inv from w),
    y as (select *, least(0.5, abs(delta) / inv) * inv as corr from x),
    here as (select *, greatest(abs(delta) - corr, 0) / sqrt(pool * (1 - pool) * inv) as z,
      {_Z} * sqrt(ka / na * (1 - ka / na) / na + kb / nb * (1 - kb / nb) / nb) + corr as width from y),
    area as (select *, {_area("(select z from here)", "exp(-x * x / 2) / sqrt(2 * pi())")} as half from here)
    select ka / na as prop_a, kb / nb as prop_b, z * z as chi_square, 1 - 2 * half as p_two_sided,
      0.5 + sign(delta) * half as p_less, 0.5 - sign(delta) * half as p_greater,
      greatest(delta - width, -1) as lo, least(delta + width, 1) as hi from area""")
def _(t):
    return s.prop_test(e.visitor_share(visits(t), active(t)), "period", "P1", "P2",
                       "n_visitors", "n_active")


# The interval's quantile by its expansion in 1 / dof (error below 1e-7 from thirty degrees on).
@query("t4_welch_t", "mean_a:d mean_b:d t:d dof:d p_two_sided:d p_less:d p_greater:d lo:d hi:d", ["user_days"], f"""
    with g as (select
        avg(n_days) filter (period = 'P1') as ma, avg(n_days) filter (period = 'P2') as mb,
        var_samp(n_days) filter (period = 'P1') / count(*) filter (period = 'P1') as sa,
        var_samp(n_days) filter (period = 'P2') / count(*) filter (period = 'P2') as sb,
        count(*) filter (period = 'P1') as na, count(*) filter (period = 'P2') as nb
      from user_days),
    here as (select ma, mb, ma - mb as delta, sqrt(sa + sb) as se, (ma - mb) / sqrt(sa + sb) as t,
      pow(sa + sb, 2) / (pow(sa, 2) / (na - 1) + pow(sb, 2) / (nb - 1)) as dof, {_Z} as z from g),
    area as (select *, {_area("(select abs(t) from here)",
        "exp(lgamma((dof + 1) / 2) - lgamma(dof / 2) - (dof + 1) / 2 * ln(1 + x * x / dof)) / sqrt(dof * pi())")} as half,
      se * (z + (pow(z, 3) + z) / (4 * dof) + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / (96 * pow(dof, 2))
        + (3 * pow(z, 7) + 19 * pow(z, 5) + 17 * pow(z, 3) - 15 * z) / (384 * pow(dof, 3))
        + (79 * pow(z, 9) + 776 * pow(z, 7) + 1482 * pow(z, 5) - 1920 * pow(z, 3) - 945 * z)
          / (92160 * pow(dof, 4))) as width from here)
    select ma as mean_a, mb as mean_b, t, dof, 1 - 2 * half as p_two_sided,
      0.5 + sign(t) * half as p_less, 0.5 - sign(t) * half as p_greater,
      delta - width as lo, delta + width as hi from area""")
def _(t):
    return s.welch_t(e.active_days_per_user(visits(t), GRAIN), "n_days", "period", "P1", "P2")


@query("t5_negbin_moments", "period:s n:l mean:d var:d dispersion:d", ["user_days"], """
    select *, case when var > mean then mean * mean / (var - mean) end as dispersion from (
      select period, count(*) as n, avg(n_articles) as mean, var_samp(n_articles) as var
      from user_days group by 1) x""")
def _(t):
    rows = visits(t).groupBy("ref_id", "period").sum("n_articles").withColumnRenamed(
        "sum(n_articles)", "n_articles")
    return s.negbin_moments(rows, "n_articles", ["period"])


def user_articles(t):
    return e.visits_and_articles(visits(t)).select("ref_id", "period", "total_articles")


# The shape by Newton's method on its logarithm. A difference of digamma functions at whole
# distances is a finite sum, so the score sums over the tail counts 1 / (theta + j).
def _shape_sql(rows: str, per: str, steps: int = 14) -> str:
    """CTEs ``shapes`` (k, theta, curve): one shape for each ``per`` of ``rows`` (k, period, y)."""
    text = f"""
    cells as (select {per} as k, period, y, count(*) as m from ({rows}) r group by all),
    means as (select k, period, sum(m) as n, sum(m * y) / sum(m) as mean from cells group by all),
    tails as (select k, j, sum(m) as tail from (select k, m, unnest(range(cast(y as bigint))) as j from cells) c group by all),
    f0 as (select k, ln(sum(m * mean * mean) / (sum(m * pow(y - mean, 2)) - sum(m * mean))) as phi
      from cells join means using (k, period) group by k having sum(m * pow(y - mean, 2)) > sum(m * mean))"""
    for i in range(steps):
        text += f""",
    g{i} as (select f.k, any_value(exp(phi)) as th, sum(tail / (exp(phi) + j)) as up, sum(tail / pow(exp(phi) + j, 2)) as down
      from f{i} f join tails t on t.k = f.k group by f.k),
    h{i} as (select g.k, any_value(th) as th, any_value(up) + sum(n * ln(th / (th + mean))) as score,
        -any_value(down) + sum(n * (1 / th - 1 / (th + mean))) as curve from g{i} g join means m on m.k = g.k group by g.k),
    f{i + 1} as (select k, ln(th) + greatest(-2, least(2, case when th * th * curve + th * score < 0
        then -th * score / (th * th * curve + th * score) else sign(score) end)) as phi from h{i})"""
    return text + f""",
    shapes as (select k, th as theta, curve from h{steps - 1}),
    fits as (select m.k, period, n, mean, theta, curve, sqrt((1 / mean + coalesce(1 / theta, 0)) / n) as se_log_mean
      from means m left join shapes s on s.k = m.k)"""


@query("t5_negbin_fit", "period:s n:l mean:d theta:d se_log_mean:d se_theta:d loglik:d", ["user_days"], f"""
    with {_shape_sql("select period, n_articles as y from user_days", "period")},
    lik as (select k, sum(m * (lgamma(y + theta) - lgamma(theta) - lgamma(y + 1) + theta * ln(theta / (theta + mean))
        + y * ln(mean / (theta + mean)))) as loglik from cells join fits using (k, period) group by k)
    select period, n, mean, theta, se_log_mean, sqrt(-1 / curve) as se_theta, loglik from fits left join lik using (k)""")
def _(t):
    return lik.negbin_fit(user_articles(t), "total_articles", ["period"])


@query("t5_negbin_difference", "mean_a:d mean_b:d diff:d se:d lo:d hi:d p_positive:d", ["user_days"], f"""
    with {_shape_sql("select period, n_articles as y from user_days", "1")},
    here as (select any_value(mean) filter (period = 'P1') as mean_a, any_value(mean) filter (period = 'P2') as mean_b,
      sqrt(sum(pow(mean * se_log_mean, 2))) as se from fits),
    area as (select *, mean_b - mean_a as diff,
      {_area("(select abs(mean_b - mean_a) / se from here)", "exp(-x * x / 2) / sqrt(2 * pi())")} as half from here)
    select mean_a, mean_b, diff, se, diff - {_Z} * se as lo, diff + {_Z} * se as hi, 0.5 + sign(diff) * half as p_positive
    from area""")
def _(t):
    return lik.mean_difference(lik.negbin_fit(user_articles(t), "total_articles", ["period"], []), "period", "P1", "P2")


@query("t5_negbin_random_intercept", "level:s n_rows:l n_groups:l log_mean:d se:d lo:d hi:d sd_group:d theta:d loglik:d converged:b")
def _(t):
    return lik.negbin_random_intercept(user_articles(t), "total_articles", "period", "ref_id", ["P1", "P2"])


# The ratio of the variances by halving an interval of its logarithm where the profile's slope
# changes sign, over the rows' own groups.
def _intercept_sql(rows: str, steps: int = 48) -> str:
    """CTE ``told`` (level, mean, se, sd_group, sd_residual) for ``rows`` (level, grp, v) of two levels P1 and P2."""
    text = f"""
    per as (select grp, count(*) as n, sum(v) as s, sum(v * v) as q, count(*) filter (level = 'P1') as n0,
      count(*) filter (level = 'P2') as n1, coalesce(sum(v) filter (level = 'P1'), 0) as s0,
      coalesce(sum(v) filter (level = 'P2'), 0) as s1 from ({rows}) r group by grp),
    b0 as (select -16.0::double as lo, 16.0::double as hi)"""
    sums = """sum(n) as rows, sum(q) - sum(r / (1 + n * r) * s * s) as c, sum(s0) - sum(r / (1 + n * r) * n0 * s) as y0,
      sum(s1) - sum(r / (1 + n * r) * n1 * s) as y1, sum(n0) - sum(r / (1 + n * r) * n0 * n0) as a00,
      sum(n1) - sum(r / (1 + n * r) * n1 * n1) as a11, -sum(r / (1 + n * r) * n0 * n1) as a01"""
    for i in range(steps + 1):
        text += f""",
    e{i} as (select any_value(lo) as lo, any_value(hi) as hi, any_value(r) as r, {sums} from per, (select *, exp((lo + hi) / 2) as r from b{i}) mid),
    w{i} as (select *, (y0 * a11 - y1 * a01) / (a00 * a11 - a01 * a01) as m0, (y1 * a00 - y0 * a01) / (a00 * a11 - a01 * a01) as m1 from e{i}),
    v{i} as (select *, (c - y0 * m0 - y1 * m1) / rows as var from w{i}),
    u{i} as (select any_value(lo) as lo, any_value(hi) as hi, sum(pow(s - n0 * m0 - n1 * m1, 2) / pow(1 + n * r, 2)) / any_value(var)
      - sum(n / (1 + n * r)) as slope from per, v{i}),
    b{i + 1} as (select case when slope > 0 then (lo + hi) / 2 else lo end as lo, case when slope > 0 then hi else (lo + hi) / 2 end as hi from u{i})"""
    return text + f""",
    told as (select unnest(['P1', 'P2']) as level, unnest([m0, m1]) as mean, unnest([sqrt(var * a11 / (a00 * a11 - a01 * a01)),
      sqrt(var * a00 / (a00 * a11 - a01 * a01))]) as se, sqrt(case when lo > -16 then r * var else 0 end) as sd_group, sqrt(var) as sd_residual from v{steps})"""


INTERCEPT = "mean:d se:d sd_group:d sd_residual:d icc:d"


@query("t6_hurdle_random_intercept", f"level:s n:l zero_share:d {INTERCEPT}", ["per_week"], f"""
    with {_intercept_sql("select period as level, ref_id as grp, ln(articles_per_week) as v from per_week where total > 0")},
    shares as (select period as level, count(*) as n, avg(case when total = 0 then 1.0 else 0.0 end) as zero_share
      from per_week group by 1)
    select *, pow(sd_group, 2) / (pow(sd_group, 2) + pow(sd_residual, 2)) as icc from shares join told using (level)""")
def _(t):
    weekly = e.articles_per_week(visits(t), PERIODS)
    zeros = s.hurdle_lognormal(weekly, "articles_per_week", ["period"]).select(
        F.col("period").alias("level"), "n", "zero_share")
    read = weekly.where("articles_per_week > 0").withColumn("v", F.ln("articles_per_week"))
    return zeros.join(lik.random_intercept(read, "v", "period", "ref_id", ["P1", "P2"]), "level")


@query("t7_price_random_intercept", f"level:s n_rows:l n_groups:l {INTERCEPT}", ["order_lines"], f"""
    with lines as (select case when l_linestatus = 'O' then 'P1' else 'P2' end as level, l_partkey as grp,
      ln(l_extendedprice) as v from order_lines),
    {_intercept_sql("select * from lines")}
    select *, pow(sd_group, 2) / (pow(sd_group, 2) + pow(sd_residual, 2)) as icc from told
    join (select level, count(*) as n_rows, (select count(*) from per) as n_groups from lines group by 1) c using (level)""")
def _(t):
    """Log price by line status, each part with its own level."""
    lines = t.order_lines.select(F.when(F.col("l_linestatus") == "O", "P1").otherwise("P2").alias("level"),
                                 "l_partkey", F.ln("l_extendedprice").alias("v"))
    return lik.random_intercept(lines, "v", "level", "l_partkey", ["P1", "P2"])


@query("t7_lognormal_weekend_intercept", f"level:s n_rows:l n_groups:l {INTERCEPT}", ["visits"], f"""
    with days as (select period, hit_date, sum(n_articles) as total, dayofweek(hit_date) in (0, 6) as is_weekend
      from visits group by 1, 2),
    {_intercept_sql("select period as level, is_weekend as grp, ln(total) as v from days where total > 0")}
    select *, pow(sd_group, 2) / (pow(sd_group, 2) + pow(sd_residual, 2)) as icc from told
    join (select period as level, count(*) as n_rows, (select count(*) from per) as n_groups from days where total > 0 group by 1) c
      using (level)""")
def _(t):
    days = visits(t).groupBy("period", "hit_date").agg(F.sum("n_articles").alias("total")).where("total > 0")
    days = days.withColumn("is_weekend", F.dayofweek("hit_date").isin(1, 7)).withColumn("v", F.ln("total"))
    return lik.random_intercept(days, "v", "period", "is_weekend", ["P1", "P2"])


@query("t6_hurdle_lognormal", "period:s n:l zero_share:d log_mean:d log_sd:d", ["per_week"], """
    select period, count(*) as n, avg(case when total = 0 then 1.0 else 0.0 end) as zero_share,
      avg(case when total > 0 then ln(articles_per_week) end) as log_mean,
      stddev_samp(case when total > 0 then ln(articles_per_week) end) as log_sd
    from per_week group by 1""")
def _(t):
    return s.hurdle_lognormal(e.articles_per_week(visits(t), PERIODS), "articles_per_week",
                              ["period"])


@query("t7_lognormal", "period:s n:l log_mean:d log_sd:d median:d", ["user_days"], """
    select period, count(*) as n, avg(ln(cast(n_articles as double) / n_article_days))
        as log_mean,
      stddev_samp(ln(cast(n_articles as double) / n_article_days)) as log_sd,
      exp(avg(ln(cast(n_articles as double) / n_article_days))) as median
    from user_days where n_articles > 0 group by 1""")
def _(t):
    return s.lognormal(e.article_day_rate(visits(t), GRAIN), "articles_per_day", ["period"])


@query("t8_gaussian", "is_weekend:b n:l mean:d pooled_sd:d", ["visits"], """
    with d as (select hit_date, dayofweek(hit_date) in (0, 6) as is_weekend,
        count(distinct ref_id) as n_visitors from visits group by 1),
    g as (select is_weekend, count(*) as n, avg(n_visitors) as mean, var_samp(n_visitors) as v
      from d group by 1)
    select is_weekend, n, mean, (select sqrt(sum((n - 1) * v) / sum(n - 1)) from g) as pooled_sd
    from g""")
def _(t):
    return s.gaussian(e.visitors_per_day(visits(t)), "n_visitors", "is_weekend")


@query("t16_stratified_split", "termtype:s part:s n:l smallest:s", ["terms"], """
    select termtype, part, count(*) as n, min(md5('7:' || k)) as smallest from (
      select termtype, k, case when row_number() over (partition by termtype
          order by md5('7:' || k), k) <= floor(count(*) over (partition by termtype) * 0.8)
        then 'train' else 'test' end as part
      from (select termtype, subscriptionreference || '-' || termnumber as k from terms) a) b
    group by 1, 2""")
def _(t):
    from pyspark.sql import functions as F

    from ..functions.columns import order_key
    from ..plans.sampling import key_hash

    rows = t.terms.select("termtype", order_key("subscriptionreference", "termnumber").alias("k"))
    split = stratified_split(rows, "termtype", "k", 0.8, 7)
    return split.groupBy("termtype", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min(key_hash("k", 7)).alias("smallest")
    )


@query("t17_sample_users", "event_id:l visitor_id:l", ["hits"], """
    select event_id, visitor_id from hits
    where substr(md5('11:' || visitor_id), 1, 8) < '40000000'""")
def _(t):
    return sample_users(t.hits, "visitor_id", 0.25, 11)
