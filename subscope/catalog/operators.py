"""The generic operators on their own: sources, predicates, joins, aggregates, sequences, shapes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import columns as x
from ..functions.aggregates import count_distinct_if, mean_if, n_distinct, sum0, sum_if
from ..operators import groups as g
from ..operators import intervals as iv
from ..operators import joins as j
from ..operators import ordered as o
from ..operators import reshape as r
from ..operators import skew
from ..sources import io, zipped
from .registry import query

# --- sources and sinks -----------------------------------------------------------------


def _scratch(t, name: str) -> str:
    app = t.spark.sparkContext.applicationId
    return f"{io.stage_root(t.spark).rstrip('/')}/subscope/{app}/{name}-{uuid.uuid4().hex}"


@query("s1_read_table", "o_orderkey:l o_custkey:l o_totalprice:m", [], """
    select o_orderkey, o_custkey, o_totalprice from orders where o_orderpriority = '5-LOW'""")
def _(t):
    return io.read_table(t.spark, f"{t.root}/orders.parquet", "o_orderpriority = '5-LOW'")


@query("s2_run_sql", "n_name:s customers:l", [], """
    select n_name, count(*) as customers from customer join nation on c_nationkey = n_nationkey
    group by 1""")
def _(t):
    text = """select n_name, count(*) as customers from {customer} c
        join {nation} n on c.c_nationkey = n.n_nationkey group by n_name"""
    return io.run_sql(t.spark, text, customer=t.table("customer"), nation=t.table("nation"))


@query("s3_csv_round_trip", "part_id:l part_name:s price:m", [], """
    select p_partkey as part_id, p_name || ', "' || p_brand || '"' as part_name,
      p_retailprice as price from part""")
def _(t):
    path = _scratch(t, "csv")
    p = t.table("part")
    io.write_csv(p.select("p_partkey", F.format_string('%s, "%s"', "p_name", "p_brand"),
                          "p_retailprice"), path)
    return io.read_csv(t.spark, path, "part_id bigint, part_name string, price double")


@query("s3_zipped_csv", "part_id:l part_name:s price:m", [], """
    select p_partkey as part_id, case when p_partkey % 7 > 0 then p_name || ', "' || p_brand || '"' end as part_name,
      p_retailprice as price from part""")
def _(t):
    p = t.table("part").select(
        "p_partkey", F.when(F.col("p_partkey") % 7 > 0, F.format_string('%s, "%s"', "p_name", "p_brand")).alias("name"),
        "p_retailprice")
    archives = zipped.write_zipped_csv(p, _scratch(t, "zipped"))
    return zipped.read_zipped_csv(t.spark, *archives, schema="part_id bigint, part_name string, price double")


@query("s5_create_table_as_select", "brand:s terms:l", ["order_lines"],
       "select r_name as brand, count(*) as terms from order_lines group by 1")
def _(t):
    path = _scratch(t, "table")
    io.write_table(t.order_lines.groupBy(F.col("r_name").alias("brand")).agg(
        F.count(F.lit(1)).alias("terms")), path)
    return io.read_table(t.spark, path)


@query("s6_stage", "o_orderstatus:s orders:l", [],
       "select o_orderstatus, count(*) as orders from orders group by 1")
def _(t):
    narrow = io.stage(t.table("orders").select("o_orderstatus", "o_orderkey"))
    return narrow.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query("s6_stage_as", "o_orderkey:l total:s day:t priority:l", [], """
    select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as varchar) as total, cast(o_orderdate as date) as day,
      try_cast(substr(o_orderpriority, 1, 1) as bigint) as priority from orders""")
def _(t):
    """Numbers come back as text, text as numbers and dates."""
    rows = t.table("orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.col("o_orderdate").cast("date").cast("string").alias("d"), F.substring("o_orderpriority", 1, 1).alias("p"))
    return io.stage_as(rows, "o_orderkey bigint, total string, day date, priority bigint")


@query("s7_read_snapshot", "event_id:l user_id:l snapshot_date:t", [], """
    select event_id, user_id, cast(ts as date) as snapshot_date from events
    where cast(ts as date) = date '2024-01-16'""")
def _(t):
    path = _scratch(t, "snapshots")
    daily = t.table("events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("snapshot_date"))
    io.write_table(daily, path, partition_by=("snapshot_date",))
    return io.read_snapshot(t.spark, path, "2024-01-16")


@query("s8_as_report", "Brand:s Share_of_Customers:s", ["order_lines"], """
    select c_mktsegment as "Brand",
      cast(round(count(*) * 100.0 / (select count(*) from customer)) as bigint) || '%'
        as "Share_of_Customers"
    from customer group by 1""")
def _(t):
    n = t.table("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    shares = g.share_of(n, [], "n").withColumn("share", F.col("share") / 100)
    return r.as_report(shares, {"c_mktsegment": "Brand", "share": "Share_of_Customers"}, ["share"])


# --- predicates and scalar functions --------------------------------------------------------


@query("f2_derived_chain", "l_orderkey:l l_linenumber:l l_partkey:l net:d gross:d band:s", [], """
    select *, case when gross < 20000 then 'low' when gross < 70000 then 'mid' else 'high' end
      as band
    from (select *, net * (1 + l_tax) as gross from (
      select *, l_extendedprice * (1 - l_discount) as net from lineitem) a) b""")
def _(t):
    net = t.table("lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    gross = net.withColumn("gross", F.col("net") * (1 + F.col("l_tax")))
    band = x.ladder([(F.col("gross") < 20000, "low"), (F.col("gross") < 70000, "mid")], "high")
    return gross.withColumn("band", band)


@query("f5_predicates", "o_orderkey:l o_custkey:l", [], """
    select o_orderkey, o_custkey from orders
    where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderdate >= date '1996-01-01'
      or o_orderpriority like '%LOW%' and o_orderstatus <> 'F'""")
def _(t):
    p = F.col("o_orderpriority")
    return t.table("orders").where(
        (p.isin("1-URGENT", "2-HIGH") & (F.col("o_orderdate") >= F.lit("1996-01-01").cast("date")))
        | (p.contains("LOW") & (F.col("o_orderstatus") != "F"))
    )


@query("f7_null_predicates", "event_id:l content_type:s known:b article:b", ["hits"], """
    select event_id, content_type, content_type is not null as known,
      regexp_matches(content_type, 'art|acc') as article
    from hits where (content_type = 'article') is not true""")
def _(t):
    c = F.col("content_type")
    return t.hits.where(~x.is_true(c == "article")).select(
        "event_id", "content_type", c.isNotNull().alias("known"),
        c.rlike("art|acc").alias("article"),
    )


@query("f10_active_between", "subscriptionreference:l termnumber:l", ["terms"], """
    select subscriptionreference, termnumber from terms
    where startissuedate <= date '1998-05-31' and expirationissuedate >= date '1998-01-01'""")
def _(t):
    return iv.active_between(t.terms, "1998-01-01", "1998-05-31", "startissuedate",
                             "expirationissuedate")


@query("f11_label_period", "event_id:l period:s", ["hits"], """
    select event_id, case when hit_date <= date '2024-01-10' then 'early' else 'late' end
      as period from hits
    where hit_date <= date '2024-01-10' or hit_date >= date '2024-01-20'""")
def _(t):
    return iv.label_period(t.hits, "hit_date", [
        ("early", "2024-01-01", "2024-01-10"), ("late", "2024-01-20", "2024-12-31")])


@query("f12_complete_cases", "event_id:l referrer_type:s content_type:s", ["hits"], """
    select event_id, referrer_type, content_type from hits
    where referrer_type is not null and content_type is not null""")
def _(t):
    return t.hits.na.drop(subset=["referrer_type", "content_type"])


@query("f13_keep_group_max", "subscriptionreference:l termnumber:l rate:m", ["terms"], """
    select subscriptionreference, termnumber, rate from (
      select *, max(rate) over (partition by subscriptionreference) as m from terms) a
    where rate = m""")
def _(t):
    return g.keep_group_max(t.terms, ["subscriptionreference"], "rate")


@query("f14_distinct", "brand:s publicationcode:s donortype:s", ["terms"],
       "select distinct brand, publicationcode, donortype from terms")
def _(t):
    return t.terms.select("brand", "publicationcode", "donortype").distinct()


@query("f16_clean_id", "event_id:l uid:l", ["hits"], """
    select event_id, try_cast(nullif(nullif(uid_raw, ''), 'NO_ID') as bigint) as uid from hits""")
def _(t):
    return t.hits.select("event_id", x.clean_id("uid_raw").alias("uid"))


@query("f17_coalesce_like", "userid:l sub:s source:s", ["registration"], """
    select userid, coalesce(nullif(aa_subscriberid, ''), nullif(aad_subscriberid, ''),
      nullif(aaz_subscriberid, '')) as sub, 'feed' as source from registration""")
def _(t):
    reg = t.registration
    return reg.select("userid", x.coalesce_like(reg.columns, "subscriberid").alias("sub"),
                      F.lit("feed").alias("source"))


@query("x1_text", "value_text:s code:s label:s digits:l pasted:s key:s", ["code_index"], """
    select value_text, regexp_extract(value_text, '\\(([^)]*)\\)', 1) as code,
      trim(regexp_replace(value_text, '\\([^)]*\\)', '')) as label,
      cast(regexp_replace(value_text, '[^0-9]', '', 'g') as bigint) as digits,
      coalesce(nullif(code_kind, 'J'), 'NA') || ' ' || value_text as pasted,
      code_kind || '-' || length(value_text) as key
    from code_index""")
def _(t):
    return t.code_index.select(
        "value_text", x.extract_code("value_text").alias("code"),
        F.trim(x.strip_code("value_text")).alias("label"),
        x.digits_id("value_text").alias("digits"),
        x.paste([F.nullif("code_kind", F.lit("J")), "value_text"]).alias("pasted"),
        x.order_key("code_kind", F.length("value_text")).alias("key"),
    )


@query("x3_json_field", "event_id:l k:l", [], """
    select event_id, cast(regexp_extract(props, '[0-9]+') as bigint) as k from events""")
def _(t):
    return t.table("events").select(
        "event_id", x.json_field("props", "k").try_cast("bigint").alias("k"))


@query("x6_pct_label", "l_orderkey:l l_partkey:l label:s", [], """
    select l_orderkey, l_partkey, cast(round(l_discount * 100) as bigint) || '%' as label
    from lineitem""")
def _(t):
    return t.table("lineitem").select(
        "l_orderkey", "l_partkey", x.pct_label("l_discount").alias("label"))


@query("x8_dates", "o_orderkey:l parsed:t short:t bad:t y:l m:l label:s ord:l week:l sunday:t "
       "weekend:b month_end:t days:l", [], """
    select o_orderkey, cast(o_orderdate as date) as parsed, cast(o_orderdate as date) as short,
      cast(null as date) as bad, year(o_orderdate) as y, month(o_orderdate) as m,
      strftime(o_orderdate, '%b') as label, month(o_orderdate) as ord,
      floor((dayofyear(o_orderdate) - 1) / 7.0) + 1 as week,
      cast(o_orderdate as date) - cast(dayofweek(o_orderdate) as int) as sunday,
      dayofweek(o_orderdate) in (0, 6) as weekend, last_day(o_orderdate) as month_end,
      date '2001-08-01' - cast(o_orderdate as date) as days
    from orders""")
def _(t):
    d = F.col("o_orderdate").cast("date")
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    long, short = F.date_format(d, "MMMM d, yyyy"), F.date_format(d, "M/d/yyyy")
    return t.table("orders").select(
        "o_orderkey", x.parse_date(long, "MMMM d, yyyy").alias("parsed"),
        x.parse_date(short, "M/d/yyyy").alias("short"),
        x.parse_date(short, "yyyy-MM-dd").alias("bad"), F.year(d).alias("y"),
        F.month(d).alias("m"), x.month_label(d).alias("label"),
        x.with_order(x.month_label(d), months).alias("ord"), x.week7(d).alias("week"),
        x.week_floor(d).alias("sunday"), x.is_weekend(d).alias("weekend"),
        F.last_day(d).alias("month_end"),
        x.days_between(d, F.lit("2001-08-01").cast("date")).alias("days"),
    )


@query("x18_numbers", "l_orderkey:l l_partkey:l rounded:d gap:d ratio:d band:s flag:s",
       [], """
    select l_orderkey, l_partkey, round(l_extendedprice / 1000, 1) as rounded,
      abs(l_quantity - 25) as gap,
      case when l_tax <> 0 then l_discount / l_tax end as ratio,
      case when l_quantity <= 10 then 'S' when l_quantity <= 30 then 'M' else 'L' end as band,
      case when l_tax = 0 then null when l_discount / l_tax > 1 then 'over' else 'under' end
        as flag
    from lineitem""")
def _(t):
    ratio = x.ratio("l_discount", "l_tax")
    return t.table("lineitem").select(
        "l_orderkey", "l_partkey", F.round(F.col("l_extendedprice") / 1000, 1).alias("rounded"),
        F.abs(F.col("l_quantity") - 25).alias("gap"), ratio.alias("ratio"),
        x.bucket("l_quantity", [10, 30], ["S", "M", "L"]).alias("band"),
        x.if_na(ratio > 1, F.lit("over"), F.lit("under")).alias("flag"),
    )


@query("x20_clip_dates", "subscriptionreference:l termnumber:l s:t e:t", ["terms"], """
    select subscriptionreference, termnumber, greatest(startissuedate, date '1998-01-01') as s,
      least(expirationissuedate, date '1998-12-31') as e from terms
    where startissuedate <= date '1998-12-31' and expirationissuedate >= date '1998-01-01'""")
def _(t):
    lo, hi = F.lit("1998-01-01").cast("date"), F.lit("1998-12-31").cast("date")
    s, e = x.clip_dates("startissuedate", "expirationissuedate", lo, hi)
    live = iv.active_between(t.terms, "1998-01-01", "1998-12-31", "startissuedate",
                             "expirationissuedate")
    return live.select("subscriptionreference", "termnumber", s.alias("s"), e.alias("e"))


# --- joins -------------------------------------------------------------------------------------


@query("j4_next_term", "subscriptionreference:l termnumber:l next_rate:m", ["terms"], """
    select subscriptionreference, termnumber,
      lead(rate) over (partition by subscriptionreference order by termnumber) as next_rate from terms""")
def _(t):
    return j.next_term(t.terms, "subscriptionreference", "termnumber", {"next_rate": "rate"})


@query("j6_scope", "subscriptionreference:l termnumber:l companyname:s", ["terms", "billto"], """
    select subscriptionreference, termnumber, companyname from terms
    left join billto on customernumber = billtocustomernumber
      and addresscode = billtoaddresscode
    where brand <> 'ASIA' and termtype in ('P', 'C') and subscriptionclass = 'R'""")
def _(t):
    scoped = t.terms.where(
        (F.col("brand") != "ASIA") & F.col("termtype").isin("P", "C")
        & (F.col("subscriptionclass") == "R"))
    b = t.billto
    return scoped.join(
        b, (scoped.billtocustomernumber == b.customernumber)
        & (scoped.billtoaddresscode == b.addresscode), "left")


@query("j8_anti_join", "c_custkey:l", [], """
    select c_custkey from customer where not exists (
      select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')""")
def _(t):
    urgent = t.table("orders").where("o_orderpriority = '1-URGENT'")
    return j.anti_on(t.table("customer"), ["c_custkey"], urgent, ["o_custkey"])


@query("j9_semi_join", "c_custkey:l", [], """
    select c_custkey from customer where c_custkey in (
      select o_custkey from orders where o_orderpriority = '1-URGENT')""")
def _(t):
    urgent = t.table("orders").where("o_orderpriority = '1-URGENT'")
    return j.semi_in(t.table("customer"), ["c_custkey"], urgent, ["o_custkey"])


@query("j10_not_in_with_nulls", "customermasterkey:s old_customerid:l", ["identity"], """
    select customermasterkey, old_customerid from identity i
    where not exists (select 1 from identity g where g.isgroup
      and g.old_customerid is not distinct from i.old_customerid)""")
def _(t):
    return j.anti_on(t.identity, ["old_customerid"], t.identity.where("isgroup"))


@query("j11_missing_on_either", "customermasterkey:s", ["identity", "subscription"], """
    select customermasterkey from identity i
    where not exists (select 1 from subscription s
        where s.customeraccountid = i.new_customerid)
      or not exists (select 1 from subscription s
        where s.customeraccountid - 500000 is not distinct from i.old_customerid)""")
def _(t):
    ref = t.subscription.select(
        "customeraccountid", (F.col("customeraccountid") - 500000).alias("old"))
    return j.missing_on_either(t.identity, ref, ("new_customerid", "customeraccountid"),
                               ("old_customerid", "old"))


@query("j13_overlap_weeks", "week_start:t terms:l days:l", ["terms"], """
    select week_start, count(*) as terms,
      sum(least(expirationissuedate, week_start + 7) - greatest(startissuedate, week_start)) as days
    from terms join (select cast(unnest(generate_series(date '1995-01-01', date '2001-12-23',
        interval 7 day)) as date) as week_start) w
      on startissuedate < week_start + 7 and expirationissuedate > week_start group by 1""")
def _(t):
    """The whole grid of seven years."""
    weeks = iv.overlap_weeks(t.terms, "startissuedate", "expirationissuedate", "1995-01-01", 365)
    return weeks.groupBy("week_start").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("days").alias("days"))


@query("j17_lookup", "busind:s readers:l value_text:s", ["demographic", "code_index"], """
    select d.busind, d.readers, c.value_text
    from (select busind, count(distinct reader_id) as readers from demographic group by 1) d
    left join (select distinct value_text, regexp_extract(value_text, '\\(([^)]*)\\)', 1) as code
      from code_index where code_kind = 'J') c on c.code = d.busind""")
def _(t):
    """All labels of every answer; both sides are reduced before they meet."""
    codes = t.code_index.where("code_kind = 'J'").select(
        "value_text", x.extract_code("value_text").alias("code")).distinct()
    answers = t.demographic.groupBy("busind").agg(F.count_distinct("reader_id").alias("readers"))
    return j.lookup(answers, codes, ("busind", "code"), ["value_text"])


@query("j18_resolve_identity", "uid:l ref_id:s", ["hits", "ids", "second_map"], """
    with u as (select distinct try_cast(nullif(nullif(uid_raw, ''), 'NO_ID') as bigint) as uid
      from hits)
    select u.uid, ref_id from u join ids on ids.uid = u.uid
    union all select u.uid, mapped_key from u join second_map s on s.uid = u.uid
      where u.uid not in (select uid from ids)""")
def _(t):
    from ..plans import engagement as e

    ids = e.identity_map(t.identity, e.eligible_users(t.identity))
    uids = t.hits.select(x.clean_id("uid_raw").alias("uid")).distinct()
    return j.resolve_identity(
        uids, "uid",
        [(ids.withColumnRenamed("uid", "id"), "id", "ref_id"),
         (t.second_map.withColumnRenamed("uid", "id"), "id", "mapped_key")], "ref_id")


@query("f18_prefer", "subscriptionid:l invoiceid:s start_date:t price:m",
       ["subscription", "invoice"], """
    select s.subscriptionid, i.invoiceid, coalesce(i.periodstart, s.currentperiodstart)
      as start_date, coalesce(i.planamount, s.price) as price
    from subscription s left join invoice i on i.subscriptionid = s.subscriptionid""")
def _(t):
    s, i = t.subscription.alias("s"), t.invoice.alias("i")
    both = s.join(i, F.col("i.subscriptionid") == F.col("s.subscriptionid"), "left")
    return both.select(
        "s.subscriptionid", "i.invoiceid",
        x.prefer("i.periodstart", "s.currentperiodstart").alias("start_date"),
        x.prefer("i.planamount", "s.price").alias("price"))


@query("j19_same_name_columns", "subscription_id:l offered:s held:s", [
       "recommendation", "snapshot"], """
    select r.subscription_id, r.product_id || '/' || r.billing_method as offered,
      s.product_id || '/' || s.billing_method as held
    from recommendation r join snapshot s on s.new_subscription_id = r.subscription_id""")
def _(t):
    a, b = t.recommendation.alias("r"), t.snapshot.alias("s")
    both = a.join(b, F.col("r.subscription_id") == F.col("s.new_subscription_id"))
    return both.select(
        "subscription_id", F.concat_ws("/", "r.product_id", "r.billing_method").alias("offered"),
        F.concat_ws("/", "s.product_id", "s.billing_method").alias("held"))


@query("j22_event_after_reference", "subscriptionreference:l termnumber:l orderdate:t",
       ["terms", "header"], """
    select t.subscriptionreference, termnumber, orderdate from terms t
    join header h on h.subscriptionreference = t.subscriptionreference
    where orderdate >= firstissuesent + 365""")
def _(t):
    both = t.terms.join(t.header.select("subscriptionreference", "firstissuesent"),
                        "subscriptionreference")
    return both.where(F.col("orderdate") >= F.date_add("firstissuesent", 365))


# --- aggregates ------------------------------------------------------------------------------------


@query("a1_aggregates", "brand:s n:l lo:m hi:m total:m mean:d codes:l sd:d", ["terms"], """
    select brand, count(*) as n, min(rate) as lo, max(rate) as hi, sum(rate) as total,
      cast(sum(rate) as double) / count(*) as mean, count(distinct publicationcode) as codes,
      stddev_samp(copies) as sd from terms group by 1""")
def _(t):
    return t.terms.groupBy("brand").agg(
        F.count(F.lit(1)).alias("n"), F.min("rate").alias("lo"), F.max("rate").alias("hi"),
        F.sum("rate").alias("total"),
        (F.sum("rate").cast("double") / F.count(F.lit(1))).alias("mean"),
        F.count_distinct("publicationcode").alias("codes"),
        F.stddev_samp("copies").alias("sd"),
    )


@query("a4_n_distinct_tuple", "device:s pairs:l articles:l", ["hits"], """
    select device, count(distinct (referrer_type, content_type)) as pairs,
      count(distinct case when content_type = 'article' then page_name end) as articles
    from hits group by 1""")
def _(t):
    return t.hits.groupBy("device").agg(
        n_distinct("referrer_type", "content_type").alias("pairs"),
        count_distinct_if(F.col("content_type") == "article", "page_name").alias("articles"),
    )


@query("a6_conditional", "brand:s annual_mean:p annual_sum:m none_sum:m", ["terms"], """
    select brand, cast(sum(rate) filter (og_termlength = 52) as double)
        / count(*) filter (og_termlength = 52) as annual_mean,
      sum(rate) filter (og_termlength = 52) as annual_sum, 0 as none_sum
    from terms group by 1""")
def _(t):
    annual = F.col("og_termlength") == 52
    return t.terms.groupBy("brand").agg(
        mean_if(annual, "rate").alias("annual_mean"),
        sum_if(annual, "rate").alias("annual_sum"),
        sum_if(F.col("og_termlength") == 0, "rate").alias("none_sum"),
    )


@query("a8_quantiles", "brand:s p05:d p50:d p95:d", ["terms"], """
    select brand, quantile_cont(cast(rate as double), 0.05) as p05,
      quantile_cont(cast(rate as double), 0.5) as p50,
      quantile_cont(cast(rate as double), 0.95) as p95 from terms group by 1""")
def _(t):
    return o.quantiles(t.terms, ["brand"], "rate", [0.05, 0.5, 0.95], ["p05", "p50", "p95"])


@query("a9_having", "subscriptionreference:l n:l first_date:t", ["terms"], """
    select subscriptionreference, count(*) as n, min(startissuedate) as first_date
    from terms group by 1 having count(*) > 12""")
def _(t):
    return t.terms.groupBy("subscriptionreference").agg(
        F.count(F.lit(1)).alias("n"), F.min("startissuedate").alias("first_date")
    ).where("n > 12")


@query("a10_scalar", "brand:s revenue:m share:d", ["terms"], """
    select brand, sum(rate) as revenue,
      cast(sum(rate) as double) / (select cast(sum(rate) as double) from terms) as share
    from terms group by 1""")
def _(t):
    by = t.terms.groupBy("brand").agg(F.sum("rate").alias("revenue"))
    total = t.terms.agg(sum0("rate")).scalar()
    return by.withColumn("share", x.ratio("revenue", total))


@query("a11_share_of", "brand:s publicationcode:s n:l total:l share:d", ["terms"], """
    select *, n * 100.0 / total as share from (select *, sum(n) over (partition by brand) as total
      from (select brand, publicationcode, count(*) as n from terms group by 1, 2) a) b""")
def _(t):
    n = t.terms.groupBy("brand", "publicationcode").agg(F.count(F.lit(1)).alias("n"))
    return g.share_of(n, ["brand"], "n")


@query("a14_group_stat", "event_id:l visit_uid:l", ["hits"], """
    select event_id, max(try_cast(nullif(nullif(uid_raw, ''), 'NO_ID') as bigint))
      over (partition by visitor_id, visit_number) as visit_uid from hits""")
def _(t):
    rows = t.hits.withColumn("uid", x.clean_id("uid_raw"))
    return g.with_group_stat(rows, ["visitor_id", "visit_number"], {"visit_uid": F.max("uid")})


@query("a17_histogram", "brand:s bin:d n:l", ["terms"], """
    select brand, floor(cast(rate as double) / 5000) * 5000 as bin, count(*) as n from terms
    where rate >= 10000 and rate <= 90000 group by 1, 2""")
def _(t):
    return o.histogram(t.terms, ["brand"], "rate", 5000, 10000, 90000)


@query("a18_five_number", "brand:s n:l min:d q1:d median:d q3:d max:d", ["terms"], """
    select brand, count(*) as n, min(rate) as min,
      quantile_cont(cast(rate as double), 0.25) as q1, median(cast(rate as double)) as median,
      quantile_cont(cast(rate as double), 0.75) as q3, max(rate) as max from terms group by 1""")
def _(t):
    return o.five_number(t.terms, ["brand"], "rate")


@query("a7_median_spread", "brand:s median:d sd:d var:d", ["terms"], """
    select brand, median(copies) as median, stddev_samp(copies) as sd, var_samp(copies) as var
    from terms group by 1""")
def _(t):
    spread = t.terms.groupBy("brand").agg(
        F.stddev_samp("copies").alias("sd"), F.var_samp("copies").alias("var"))
    return o.join_stats(spread, o.quantiles(t.terms, ["brand"], "copies", [0.5], ["median"]),
                        ["brand"])


@query("a12_share_of_grand_total", "publicationcode:s n:l total:l share:d", ["terms"], """
    select publicationcode, count(*) as n, sum(count(*)) over () as total,
      count(*) * 100.0 / sum(count(*)) over () as share from terms group by 1""")
def _(t):
    return g.share_of(t.terms.groupBy("publicationcode").agg(F.count(F.lit(1)).alias("n")),
                      [], "n")


@query("a13_two_level", "brand:s orders:l mean_lines:d", ["terms"], """
    select brand, count(*) as orders, avg(n) as mean_lines from (
      select brand, ordernumber, count(*) as n from terms group by 1, 2) a group by 1""")
def _(t):
    per_order = t.terms.groupBy("brand", "ordernumber").agg(F.count(F.lit(1)).alias("n"))
    return per_order.groupBy("brand").agg(F.count(F.lit(1)).alias("orders"),
                                          F.avg("n").alias("mean_lines"))


@query("a14_spread_group_stat", "ordernumber:l termnumber:l publicationcode:s top_rate:m n:l", ["terms"], """
    select ordernumber, termnumber, publicationcode, max(rate) over w as top_rate, count(*) over w as n
    from terms window w as (partition by publicationcode, donortype)""")
def _(t):
    """A group statistic on every row where a few groups hold all rows."""
    rows = io.stage(t.terms.select("ordernumber", "termnumber", "publicationcode", "donortype", "rate"))
    return skew.with_spread_group_stat(rows, ["publicationcode", "donortype"], {"top_rate": F.max("rate"), "n": F.count(F.lit(1))})


@query("a19_distinct_channels", "visitor_id:l n_channels:l", ["hits"], """
    select visitor_id, count(distinct referrer_type) as n_channels from hits group by 1""")
def _(t):
    kinds = ["other web sites", "search engines", "social networks", "typed/bookmarked"]
    wide = t.hits.groupBy("visitor_id").agg(*[
        F.count(F.when(F.col("referrer_type") == k, 1)).alias(k) for k in kinds])
    return r.distinct_channels(wide, ["visitor_id"], kinds, "n_channels")


# --- sequences ----------------------------------------------------------------------------------------


DAY_ORDER = ["startissuedate", "termnumber"]


def _hour():
    """Bucket of a hit: day and hour."""
    return F.struct("hit_date", F.floor(F.col("clicks_to_page") / 3600))


@query("w1_row_number", "event_id:l n:l", ["hits"], """
    select event_id, row_number() over (partition by visitor_id
      order by hit_date, clicks_to_page, event_id) as n from hits""")
def _(t):
    return o.sequence_number(t.hits, ["visitor_id"], ["hit_date", "clicks_to_page", "event_id"],
                             _hour(), "n")


@query("w2_dense_rank", "event_id:l n:l", ["hits"], """
    select event_id, dense_rank() over (partition by visitor_id order by hit_date) as n
    from hits""")
def _(t):
    return o.dense_number(t.hits, ["visitor_id"], "hit_date", F.col("hit_date"), "n")


@query("w3_lead", "subscriptionreference:l termnumber:l next_start:t next_rate:m", ["terms"], """
    select subscriptionreference, termnumber, lead(startissuedate) over w as next_start,
      lead(rate) over w as next_rate
    from terms window w as (partition by subscriptionreference
      order by startissuedate, termnumber)""")
def _(t):
    return o.neighbour(t.terms, ["subscriptionreference"], DAY_ORDER, F.col("startissuedate"),
                       {"next_start": "startissuedate", "next_rate": "rate"}, 1)


@query("w4_lag", "event_id:l previous_date:t previous_device:s", ["hits"], """
    select event_id, lag(hit_date) over w as previous_date, lag(device) over w as previous_device
    from hits window w as (partition by visitor_id order by hit_date, clicks_to_page, event_id)""")
def _(t):
    return o.neighbour(t.hits, ["visitor_id"], ["hit_date", "clicks_to_page", "event_id"],
                       _hour(),
                       {"previous_date": "hit_date", "previous_device": "device"}, -1)


@query("w7_running_sum", "subscriptionreference:l termnumber:l paid:m", ["terms"], """
    select subscriptionreference, termnumber, sum(rate) over (partition by subscriptionreference
      order by startissuedate, termnumber) as paid from terms""")
def _(t):
    return o.running_sum(t.terms, ["subscriptionreference"], DAY_ORDER, F.col("startissuedate"), "rate", "paid")


@query("w8_carry_forward", "event_id:l last_referrer:s", ["hits"], """
    select event_id, last_value(referrer_type ignore nulls) over (partition by visitor_id
      order by hit_date, clicks_to_page, event_id rows unbounded preceding) as last_referrer
    from hits""")
def _(t):
    return o.carry_forward(t.hits, ["visitor_id"], ["hit_date", "clicks_to_page", "event_id"],
                           _hour(), "referrer_type", "last_referrer")


@query("w12_continue_termnumber", "subscriptionid:l invoiceid:s termnumber:l",
       ["terms", "invoice"], """
    select subscriptionid, invoiceid, last_term + row_number() over (partition by subscriptionid
      order by paidat, invoiceid) as termnumber
    from invoice join (select subscriptionreference + 1000000 as sub, max(termnumber) as last_term
      from terms group by 1) t on sub = subscriptionid""")
def _(t):
    last = t.terms.groupBy((F.col("subscriptionreference") + 1000000).alias("sub")).agg(
        F.max("termnumber").alias("last_term"))
    rows = t.invoice.join(last, F.col("sub") == F.col("subscriptionid"))
    rows = o.sequence_number(rows, ["subscriptionid"], ["paidat", "invoiceid"],
                             F.col("paidat"), "n")
    return rows.withColumn("termnumber", F.col("last_term") + F.col("n"))


@query("w14_keep_group_min", "subscriptionid:l invoiceid:s paidat:t", ["invoice"], """
    select subscriptionid, invoiceid, paidat from (select *, min(paidat) over (partition by
      subscriptionid) as m from invoice) a where paidat = m""")
def _(t):
    return g.keep_group_min(t.invoice, ["subscriptionid"], "paidat")


# --- top-k, sets, shapes -------------------------------------------------------------------------------


@query("k4_top_k_ties", "brand:s og_termlength:l copies:l", ["terms"], """
    select brand, og_termlength, copies from (
      select *, rank() over (partition by brand order by copies desc) as r from (
        select brand, og_termlength, subscriptionreference, sum(copies) as copies
        from terms group by 1, 2, 3) a) b where r <= 3""")
def _(t):
    n = t.terms.groupBy("brand", "og_termlength", "subscriptionreference").agg(
        F.sum("copies").alias("copies"))
    return g.top_k_ties(n, 3, "copies", ["brand"])


@query("k2_sorted_output", "subscriptionreference:l termnumber:l rate:m", ["terms"],
       "select subscriptionreference, termnumber, rate from terms order by rate desc, 1, 2")
def _(t):
    return g.sorted_output(t.terms, [F.col("rate").desc(), F.col("subscriptionreference"),
                                     F.col("termnumber")])


@query("x9_parse_ts", "event_id:l day:t seconds:l bad:b", [], """
    select event_id, cast(ts as date) as day,
      epoch(date_trunc('second', ts))::bigint % 86400 as seconds, true as bad from events""")
def _(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    at = x.parse_ts(text)
    seconds = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return t.table("events").select(
        "event_id", at.cast("date").alias("day"), seconds.alias("seconds"),
        x.parse_ts(F.concat(F.lit("on "), text)).isNull().alias("bad"))


@query("k5_first_n", "subscriptionreference:l termnumber:l rate:m", ["terms"], """
    select subscriptionreference, termnumber, rate from terms
    order by rate desc, subscriptionreference, termnumber limit 10""")
def _(t):
    return g.first_n(t.terms, 10, [F.col("rate").desc(), F.col("subscriptionreference"),
                                   F.col("termnumber")])


@query("k6_top_per_group", "brand:s subscriptionreference:l termnumber:l rate:m", ["terms"], """
    select brand, subscriptionreference, termnumber, rate from (
      select *, row_number() over (partition by brand
        order by rate desc, subscriptionreference, termnumber) as r from terms) a where r <= 5""")
def _(t):
    order = [F.col("rate").desc(), F.col("subscriptionreference"), F.col("termnumber")]
    return g.top_per_group(t.terms, ["brand"], order, 5)


@query("u1_union_distinct", "customer:l", ["terms", "subscription"], """
    select shiptocustomernumber as customer from terms union
    select customeraccountid - 500000 from subscription""")
def _(t):
    return r.union_distinct(
        t.terms.select(F.col("shiptocustomernumber").alias("customer")),
        t.subscription.select((F.col("customeraccountid") - 500000).alias("customer")))


@query("u3_bind_rows", "id:l day:t source:s amount:m", ["terms", "invoice"], """
    select subscriptionreference as id, startissuedate as day, 'term' as source, rate as amount
    from terms union all select subscriptionid, paidat, 'invoice', null from invoice""")
def _(t):
    return r.bind_rows(
        t.terms.select(F.col("subscriptionreference").alias("id"),
                       F.col("startissuedate").alias("day"), F.lit("term").alias("source"),
                       F.col("rate").alias("amount")),
        t.invoice.select(F.col("subscriptionid").alias("id"), F.col("paidat").alias("day"),
                         F.lit("invoice").alias("source")))


@query("u6_align", "ordernumber:s rate:m note:s", ["terms", "invoice"], """
    select cast(ordernumber as varchar) as ordernumber, rate, cast(null as varchar) as note
    from terms union all select invoiceid, amountdue, chargereferences from invoice""")
def _(t):
    schema = {"ordernumber": "string", "rate": "decimal(18,2)", "note": "string"}
    inv = t.invoice.select(F.col("invoiceid").alias("ordernumber"),
                           F.col("amountdue").alias("rate"),
                           F.col("chargereferences").alias("note"))
    return r.union_all(r.align(t.terms, schema), r.align(inv, schema))


@query("r1_to_wide", "brand:s P1:m P2:m P3:m P4:m", ["terms"], """
    select brand, sum(rate) filter (publicationcode = 'P1') as P1,
      sum(rate) filter (publicationcode = 'P2') as P2,
      sum(rate) filter (publicationcode = 'P3') as P3,
      sum(rate) filter (publicationcode = 'P4') as P4 from terms group by 1""")
def _(t):
    return r.to_wide(t.terms, ["brand"], "publicationcode", "rate", ["P1", "P2", "P3", "P4"])


@query("r2_to_long", "funnel_date:t measure:s amount:l", ["funnel"], """
    select funnel_date, 'unique_visitors' as measure, unique_visitors as amount from funnel
    union all select funnel_date, 'new_paid_orders', new_paid_orders from funnel""")
def _(t):
    return r.to_long(t.funnel, ["funnel_date"], ["unique_visitors", "new_paid_orders"],
                     "measure", "amount")


@query("r5_week_grid", "start_date:t end_date:t started:l", ["terms"], """
    select start_date, cast(start_date + 7 as date) as end_date, count(subscriptionreference)
      as started
    from (select cast(unnest(generate_series(date '1995-01-01', date '2001-07-29',
      interval 7 day)) as date) as start_date) w
    left join terms on startissuedate >= start_date and startissuedate < start_date + 7
    group by 1, 2""")
def _(t):
    grid = iv.week_grid(t.spark, "1995-01-01", "2001-08-05")
    day = F.lit("1995-01-01").cast("date")
    week = F.date_add(day, (iv.week_index("startissuedate", "1995-01-01") * 7).cast("int"))
    n = t.terms.groupBy(week.alias("start_date")).agg(F.count(F.lit(1)).alias("started"))
    return grid.join(n, "start_date", "left").withColumn(
        "started", F.coalesce("started", F.lit(0)))


@query("r6_explode", "event_id:l part:s", [], """
    select event_id, unnest(string_split(event_type || ':' || user_id, ':')) as part
    from events""")
def _(t):
    return t.table("events").select(
        "event_id",
        F.explode(F.split(F.concat_ws(":", "event_type", "user_id"), ":")).alias("part"))
