"""Stand-in inputs: the product's tables derived from the test tables.

``Inputs`` builds each as a DataFrame; ``VIEW_SQL`` states the same table in
plain SQL for the oracle. See FIXTURES.md. Columns that the real extracts
carry ready-made (visit number, clicks to page, invoice id) are plain
expressions here, so that a stand-in never adds a sort of its own.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .io import stage_by

MONEY = "decimal(12,2)"
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# (l_orderkey, l_linenumber) repeats; this order is total.
LINE_ORDER = [*LINE_KEY, "l_shipdate", "l_extendedprice", "l_quantity"]


def _with_ref(lines: DataFrame) -> DataFrame:
    return lines.withColumn("ref", F.col("o_custkey") * 10 + F.col("l_partkey") % 4).withColumn(
        "orderdate", F.col("o_orderdate").cast("date"))


class Inputs:
    """Lazily built stand-ins over one test-data folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self._shared = spark, root, False

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        c, n, r = self.table("customer"), self.table("nation"), self.table("region")
        return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order lines with customer and region, the raw rows behind terms and invoices.

        Orders meet their customers before their lines, so the lines are shuffled once.
        """
        li, o, c = self.table("lineitem"), self.table("orders"), self.customers
        orders = o.join(c, o.o_custkey == c.c_custkey)
        return _with_ref(li.join(orders, li.l_orderkey == orders.o_orderkey))

    @cached_property
    def invoice_lines(self) -> DataFrame:
        """Order lines of any customer, known or not."""
        li, o = self.table("lineitem"), self.table("orders")
        return _with_ref(li.join(o, li.l_orderkey == o.o_orderkey))

    def shared(self, terms: bool = False) -> Inputs:
        """For queries that build several tables of the order lines, or one of them several times.

        The lines are joined once and staged by subscription, so that terms, header and subscriptions
        need no shuffle; the tables that are read more than once are staged by their keys (terms,
        if asked for). Of a line's customer the rows are kept as a list: lines without one, or with
        several, are the same for both uses. Call it before any of the tables is built.
        """
        if self._shared:
            return self
        self._shared, c = True, self.customers.where("c_custkey is not null")
        who = c.groupBy("c_custkey").agg(F.collect_list(F.struct(
            "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "n_name", "r_name")).alias("who"))
        o = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
        orders = stage_by(o.join(who, o.o_custkey == who.c_custkey, "left").drop("c_custkey"), ["o_orderkey"])
        li = stage_by(self.table("lineitem"), ["l_orderkey"])
        lines = stage_by(_with_ref(li.join(orders, li.l_orderkey == orders.o_orderkey)).drop("o_orderkey", "o_orderdate"), ["ref"])
        self.invoice_lines = lines.drop("who")
        self.order_lines = lines.withColumn("__who", F.explode("who")).select(
            *[x for x in lines.columns if x != "who"], "__who.*")
        self.subscription = stage_by(self.subscription, ["subscriptionid"])
        self.invoice = stage_by(self.invoice, ["subscriptionid"])
        self.header = stage_by(self.header, ["subscriptionreference"])
        if terms:
            self.terms = stage_by(self.terms, ["subscriptionreference"])
        return self

    @cached_property
    def terms(self) -> DataFrame:
        # A subscription's terms come numbered in the extract; the rows are shuffled once for it here.
        numbered = self.order_lines.withColumn("termnumber", F.row_number().over(
            W.partitionBy("ref").orderBy("orderdate", *LINE_ORDER)))
        annual = F.col("l_returnflag") == "N"
        status, seg = F.col("o_orderstatus"), F.col("c_mktsegment")
        return numbered.select(
            F.col("o_custkey").alias("shiptocustomernumber"),
            F.col("o_custkey").alias("billtocustomernumber"),
            F.when(F.col("l_linestatus") == "O", F.col("c_nationkey").cast("string"))
            .otherwise("none").alias("billtoaddresscode"),
            F.col("l_orderkey").alias("ordernumber"),
            F.col("ref").alias("subscriptionreference"),
            "termnumber",
            F.concat(F.lit("P"), (F.col("l_partkey") % 4 + 1).cast("string")).alias(
                "publicationcode"),
            "orderdate",
            F.col("orderdate").alias("startissuedate"),
            F.date_add("orderdate", F.when(annual, 364).otherwise(28)).alias(
                "expirationissuedate"),
            F.when(annual, 52).otherwise(4).alias("og_termlength"),
            F.col("l_extendedprice").cast(MONEY).alias("rate"),
            (F.col("l_linenumber") % 3 + 1).alias("copies"),
            F.when(seg == "BUILDING", "B").when(seg == "HOUSEHOLD", "G").otherwise("I")
            .alias("donortype"),
            F.when(status == "F", "A").when(status == "P", "C").otherwise("N")
            .alias("renewalpolicy"),
            F.when(F.col("l_linestatus") == "O", "C").otherwise("P").alias("termtype"),
            F.when(F.col("o_orderpriority") == "5-LOW", "X").otherwise("R")
            .alias("subscriptionclass"),
            F.when(F.col("n_name").endswith("1"), "CAD").otherwise("USD").alias("currency"),
            F.col("r_name").alias("brand"),
        )

    @cached_property
    def header(self) -> DataFrame:
        """Subscription header; customers of one segment have none."""
        t = self.order_lines.where(F.col("c_mktsegment") != "MACHINERY")
        return t.groupBy(F.col("ref").alias("subscriptionreference")).agg(
            F.min("orderdate").alias("firstissuesent"),
            F.max(F.when(F.col("o_orderstatus") == "F", "A")
                  .when(F.col("o_orderstatus") == "P", "C").otherwise("N")).alias("renewalpolicy"),
        )

    @cached_property
    def billto(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customernumber"),
            F.col("c_nationkey").cast("string").alias("addresscode"),
            F.col("c_name").alias("companyname"),
        )

    @cached_property
    def subscription(self) -> DataFrame:
        """New-system subscriptions: migrated, native or absent by customer."""
        src = self.order_lines.where(F.col("o_custkey") % 3 != 2)
        keys = src.groupBy(
            "ref", "o_custkey", F.col("r_name").alias("businessunitcode"), "c_acctbal",
            "c_mktsegment", (F.col("l_partkey") % 4).alias("planid"),
        ).agg(
            F.min("orderdate").alias("subscriptionstart"),
            F.max("orderdate").alias("currentperiodstart"),
            F.max("l_extendedprice").cast(MONEY).alias("planamount"),
            F.min("l_extendedprice").cast(MONEY).alias("price"),
            F.max("l_orderkey").alias("last_order"),
        )
        seg, cust = F.col("c_mktsegment"), F.col("o_custkey")
        old = F.concat(F.lit("old_"), F.col("ref").cast("string"))
        return keys.select(
            (F.lit(1000000) + F.col("ref")).alias("subscriptionid"),
            F.when(cust % 3 == 0, old).alias("oldproviderid"),
            (F.lit(500000) + cust).alias("customeraccountid"),
            "businessunitcode",
            (F.col("c_acctbal") >= 0).alias("ispaid"),
            (seg != "HOUSEHOLD").alias("issourced"),
            (seg == "BUILDING").alias("iscorporate"),
            F.lit(None).cast("boolean").alias("isagency"),
            (F.col("planid") == 3).alias("iscomp"),
            F.lit(None).cast("boolean").alias("isgiftdonor"),
            (~seg.isin("BUILDING", "HOUSEHOLD")).alias("isindividual"),
            F.concat(F.lit("P"), (F.col("planid") + 1).cast("string")).alias("productname"),
            "planid",
            "planamount",
            "price",
            (cust % 4 == 0).alias("isannualterm"),
            (cust % 4 == 1).alias("ismonthlyterm"),
            "subscriptionstart",
            "currentperiodstart",
            F.date_add("currentperiodstart", 364).alias("currentperiodend"),
            F.when(cust % 5 == 0, "past_due").when(cust % 5 == 1, "canceled")
            .otherwise("active").alias("subscriptionstatus"),
            (cust % 3 + 1).alias("quantity"),
            F.format_string('{"old_sub": "%d", "order_number": "%d"}', "ref", "last_order")
            .alias("metadata"),
        )

    @cached_property
    def invoice(self) -> DataFrame:
        j = self.invoice_lines.where(F.col("o_custkey") % 3 != 2)
        flag, ship = F.col("l_returnflag"), F.col("l_shipdate").cast("date")
        taxed = F.col("l_tax") > 0
        ref = F.col("o_custkey") * 10 + F.col("l_partkey") % 4
        return j.select(
            F.concat_ws("-", *[F.col(c).cast("string") for c in LINE_KEY],
                        F.col("l_quantity").cast("int").cast("string")).alias("invoiceid"),
            (F.lit(1000000) + ref).alias("subscriptionid"),
            (F.lit(500000) + F.col("o_custkey")).alias("customeraccountid"),
            F.when(flag == "R", "Liability adjustment").when(flag == "A", "null")
            .otherwise("charge").alias("chargereferences"),
            F.when(taxed, ship).alias("periodstart"),
            F.when(taxed, F.date_add(ship, F.when(flag == "N", 364).otherwise(28)))
            .alias("periodend"),
            F.col("l_extendedprice").cast(MONEY).alias("amountdue"),
            F.when(F.col("l_quantity") < 45, F.col("l_extendedprice").cast(MONEY))
            .alias("planamount"),
            F.when(F.col("l_quantity") > 2, F.col("l_extendedprice").cast(MONEY))
            .alias("invoicetotal"),
            F.when(F.col("l_quantity") < 40, F.concat(
                F.lit("P"), (F.col("l_partkey") % 4 + 1).cast("string"))
            ).alias("planproductname"),
            (F.round(F.col("l_extendedprice") * 100).cast("bigint")
             * F.round(100 - F.col("l_discount") * 100).cast("bigint"))
            .alias("amountpaid_e4"),
            ship.alias("paidat"),
            F.date_add(ship, F.col("l_linenumber").cast("int")).alias("createdat"),
            F.when(F.col("l_quantity") >= 10, F.get(F.array(*map(F.lit, REGIONS)), (F.col("o_custkey") % 5).cast("int")))
            .alias("businessunitcode"),
            F.when(F.col("l_linestatus") == "O", "charge_automatically")
            .when(F.col("l_quantity") < 25, "send_invoice").alias("billingtype"),
            (F.col("l_partkey") % 4).alias("planid"),
        )

    @cached_property
    def plan(self) -> DataFrame:
        k = F.col("r_regionkey")
        return self.table("region").where(k < 4).select(
            k.cast("bigint").alias("planid"),
            F.when(k == 0, "year").when(k == 1, "month").when(k == 2, "day")
            .alias("planinterval"),
            F.when(k % 2 == 0, True).alias("isautorenew"),
        )

    @cached_property
    def hits(self) -> DataFrame:
        k = F.regexp_extract("props", "([0-9]+)", 1)
        n, ts, typ = k.cast("int"), F.col("ts"), F.col("event_type")
        paid = (typ == "purchase") & (F.col("value") >= 100)
        eid, uid = F.col("event_id"), F.col("user_id")
        return self.table("events").select(
            "event_id",
            uid.alias("visitor_id"),
            ts.cast("date").alias("hit_date"),
            # Some visitors come once and stay: one visit number for all days.
            F.when(uid % 13 == 5, 1).otherwise(F.datediff(ts.cast("date"), F.lit("2023-12-31").cast("date")))
            .alias("visit_number"),
            (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts) + 1).alias("clicks_to_page"),
            F.concat_ws(":", typ, k).alias("page_name"),
            F.when(typ.isin("view", "click"), "article").when(typ != "error", "account")
            .alias("content_type"),
            F.when(uid % 10 == 0, "NO_ID").when(eid % 7 == 0, "")
            .otherwise(uid.cast("string")).alias("uid_raw"),
            F.when(paid, 1).otherwise(0).alias("orders"),
            F.when(paid, eid).alias("purchase_id"),
            F.when(n % 5 == 0, "search engines").when(n % 5 == 1, "social networks")
            .when(n % 5 == 2, "typed/bookmarked").when(n % 5 == 3, "other web sites")
            .alias("referrer_type"),
            F.when(eid % 3 == 0, "Mobile Phone").when(eid % 3 == 1, "Tablet")
            .otherwise("Other").alias("device"),
            F.when((F.col("value") < 20) | (uid % 4 == 0), None)
            .when((F.col("value") < 60) | (uid % 4 == 1), "reg")
            .otherwise("sub").alias("visitor_access"),
        )

    @cached_property
    def identity(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.table("customer").select(
            F.concat(F.lit("K"), c.cast("string")).alias("customermasterkey"),
            c.cast("string").alias("reader_id"),
            F.when(c % 3 == 0, 0).otherwise(500000 + c).alias("new_customerid"),
            F.when(c % 4 != 1, c).alias("old_customerid"),
            (F.col("c_mktsegment") == "HOUSEHOLD").alias("isgroup"),
            (F.col("c_acctbal") < 0).alias("isbadquality"),
        )

    @cached_property
    def second_map(self) -> DataFrame:
        """A hand-kept second identity map, by visitor number."""
        c = F.col("c_custkey")
        return self.table("customer").where(F.col("c_mktsegment") == "HOUSEHOLD").select(
            c.alias("uid"), F.concat(F.lit("H"), c.cast("string")).alias("mapped_key"),
        )

    @cached_property
    def sends(self) -> DataFrame:
        n, typ = F.regexp_extract("props", "([0-9]+)", 1).cast("int"), F.col("event_type")
        return self.table("events").select(
            F.col("user_id").alias("profile_id"), (n % 8).alias("message_id"),
            (n % 4).alias("blast_id"), F.col("ts").cast("date").alias("send_date"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("send_time"),
            F.when(typ.isin("view", "click", "purchase"), 1).otherwise(0).alias("did_open"),
            F.when(typ.isin("click", "purchase"), 1).otherwise(0).alias("did_click"),
        )

    @cached_property
    def registration(self) -> DataFrame:
        c, seg = F.col("c_custkey"), F.col("c_mktsegment")
        sub = c.cast("string")
        return self.table("customer").select(
            c.alias("userid"),
            F.date_add(F.lit("2024-01-01").cast("date"), (c % 30).cast("int")).alias("createdate"),
            F.when(seg == "MACHINERY", "").otherwise(F.concat_ws(" ", seg, F.col("c_nationkey")))
            .alias("referrer"),
            F.when(c % 4 == 0, sub).otherwise("").alias("aa_subscriberid"),
            F.when(c % 6 == 0, sub).alias("aad_subscriberid"),
            F.when(c % 9 == 0, sub).otherwise("").alias("aaz_subscriberid"),
        )

    @cached_property
    def profile_map(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.table("customer").where(c % 7 != 0).select(c.alias("id"), c.alias("csid"))

    @cached_property
    def funnel(self) -> DataFrame:
        paid = (F.col("event_type") == "purchase") & (F.col("value") >= 100)
        return self.table("events").groupBy(F.col("ts").cast("date").alias("funnel_date")).agg(
            F.count_distinct("user_id").alias("unique_visitors"),
            F.sum(F.when(paid, 1).otherwise(0)).alias("new_paid_orders"),
        )

    @cached_property
    def code_index(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.col("p_name"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(")"))
            .alias("value_text"),
            F.when(F.col("p_partkey") % 2 == 0, "J").otherwise("B").alias("code_kind"),
        )

    @cached_property
    def demographic(self) -> DataFrame:
        """Answers to a profile form: many rows per user, some empty."""
        o, li = self.table("orders"), self.table("lineitem")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        q = F.col("l_quantity").cast("int")
        return j.select(
            F.col("o_custkey").alias("reader_id"),
            F.when(F.col("l_returnflag") != "R", q.cast("string")).alias("busind"),
            F.when(F.col("l_linestatus") == "O", (q % 50 + 1).cast("string")).otherwise("")
            .alias("jobfunction"),
        )

    @cached_property
    def recommendation(self) -> DataFrame:
        p = self.subscription
        return p.select(
            F.lit("site").alias("site_id"), F.col("subscriptionid").alias("subscription_id"),
            (F.col("planid") + 1).alias("recommended_plan_id"), "businessunitcode",
            F.col("productname").alias("product_id"), F.lit("send").alias("billing_method"),
            F.when(F.col("ispaid"), "model").otherwise("control").alias("pricing_source"),
        )

    @cached_property
    def snapshot(self) -> DataFrame:
        """Subscriber snapshot: one row per current subscription."""
        p = self.subscription.where("subscriptionstatus <> 'canceled'")
        return p.select(
            F.col("subscriptionid").alias("new_subscription_id"),
            F.col("customeraccountid").alias("new_customer_id"),
            F.col("planid").alias("plan_id"), F.col("quantity").alias("plan_interval_count"),
            (F.col("customeraccountid") + 7).alias("shipping_address_id"),
            F.col("productname").alias("product_id"),
            F.when(F.col("issourced"), "auto").otherwise("send").alias("billing_method"),
            F.col("currentperiodstart").alias("snapshot_date"),
        )


# The same tables in plain SQL: name -> (views it reads, text).
VIEW_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "order_lines": ((), """
        select *, o_custkey * 10 + l_partkey % 4 as ref, cast(o_orderdate as date) as orderdate
        from lineitem join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey"""),
    "terms": (("order_lines",), """
        select o_custkey as shiptocustomernumber, o_custkey as billtocustomernumber,
          case when l_linestatus = 'O' then cast(c_nationkey as varchar) else 'none' end
            as billtoaddresscode,
          l_orderkey as ordernumber, ref as subscriptionreference,
          row_number() over (partition by ref
            order by orderdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
              l_extendedprice, l_quantity) as termnumber,
          'P' || cast(l_partkey % 4 + 1 as varchar) as publicationcode,
          orderdate, orderdate as startissuedate,
          cast(orderdate + (case when l_returnflag = 'N' then 364 else 28 end) as date)
            as expirationissuedate,
          case when l_returnflag = 'N' then 52 else 4 end as og_termlength,
          cast(l_extendedprice as decimal(12,2)) as rate,
          l_linenumber % 3 + 1 as copies,
          case c_mktsegment when 'BUILDING' then 'B' when 'HOUSEHOLD' then 'G' else 'I' end
            as donortype,
          case o_orderstatus when 'F' then 'A' when 'P' then 'C' else 'N' end as renewalpolicy,
          case l_linestatus when 'O' then 'C' else 'P' end as termtype,
          case o_orderpriority when '5-LOW' then 'X' else 'R' end as subscriptionclass,
          case when n_name like '%1' then 'CAD' else 'USD' end as currency,
          r_name as brand
        from order_lines"""),
    "header": (("order_lines",), """
        select ref as subscriptionreference, min(orderdate) as firstissuesent,
          max(case o_orderstatus when 'F' then 'A' when 'P' then 'C' else 'N' end)
            as renewalpolicy
        from order_lines where c_mktsegment <> 'MACHINERY' group by ref"""),
    "billto": ((), """
        select c_custkey as customernumber, cast(c_nationkey as varchar) as addresscode,
          c_name as companyname from customer"""),
    "subscription": (("order_lines",), """
        select 1000000 + ref as subscriptionid,
          case when o_custkey % 3 = 0 then 'old_' || cast(ref as varchar) end as oldproviderid,
          500000 + o_custkey as customeraccountid, r_name as businessunitcode,
          c_acctbal >= 0 as ispaid, c_mktsegment <> 'HOUSEHOLD' as issourced,
          c_mktsegment = 'BUILDING' as iscorporate, cast(null as boolean) as isagency,
          l_partkey % 4 = 3 as iscomp, cast(null as boolean) as isgiftdonor,
          c_mktsegment not in ('BUILDING', 'HOUSEHOLD') as isindividual,
          'P' || cast(l_partkey % 4 + 1 as varchar) as productname, l_partkey % 4 as planid,
          cast(max(l_extendedprice) as decimal(12,2)) as planamount,
          cast(min(l_extendedprice) as decimal(12,2)) as price,
          o_custkey % 4 = 0 as isannualterm, o_custkey % 4 = 1 as ismonthlyterm,
          min(orderdate) as subscriptionstart, max(orderdate) as currentperiodstart,
          cast(max(orderdate) + 364 as date) as currentperiodend,
          case when o_custkey % 5 = 0 then 'past_due' when o_custkey % 5 = 1 then 'canceled'
            else 'active' end as subscriptionstatus,
          o_custkey % 3 + 1 as quantity,
          '{"old_sub": "' || ref || '", "order_number": "' || max(l_orderkey) || '"}' as metadata
        from order_lines where o_custkey % 3 <> 2
        group by ref, o_custkey, r_name, c_acctbal, c_mktsegment, l_partkey % 4"""),
    "invoice": ((), """
        select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
            || '-' || cast(l_quantity as int) as invoiceid,
          1000000 + o_custkey * 10 + l_partkey % 4 as subscriptionid,
          500000 + o_custkey as customeraccountid,
          case l_returnflag when 'R' then 'Liability adjustment' when 'A' then 'null'
            else 'charge' end as chargereferences,
          case when l_tax > 0 then cast(l_shipdate as date) end as periodstart,
          case when l_tax > 0 then cast(cast(l_shipdate as date)
            + (case when l_returnflag = 'N' then 364 else 28 end) as date) end as periodend,
          cast(l_extendedprice as decimal(12,2)) as amountdue,
          case when l_quantity < 45 then cast(l_extendedprice as decimal(12,2)) end
            as planamount,
          case when l_quantity > 2 then cast(l_extendedprice as decimal(12,2)) end
            as invoicetotal,
          case when l_quantity < 40 then 'P' || cast(l_partkey % 4 + 1 as varchar) end
            as planproductname,
          cast(round(l_extendedprice * 100) as bigint)
            * cast(round(100 - l_discount * 100) as bigint) as amountpaid_e4,
          cast(l_shipdate as date) as paidat,
          cast(cast(l_shipdate as date) + cast(l_linenumber as int) as date) as createdat,
          case when l_quantity >= 10 then ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'][o_custkey % 5 + 1] end
            as businessunitcode,
          case when l_linestatus = 'O' then 'charge_automatically'
            when l_quantity < 25 then 'send_invoice' end as billingtype,
          l_partkey % 4 as planid
        from lineitem join orders on l_orderkey = o_orderkey where o_custkey % 3 <> 2"""),
    "plan": ((), """
        select cast(r_regionkey as bigint) as planid,
          case r_regionkey when 0 then 'year' when 1 then 'month' when 2 then 'day' end
            as planinterval,
          case when r_regionkey % 2 = 0 then true end as isautorenew
        from region where r_regionkey < 4"""),
    "hits": ((), """
        select event_id, user_id as visitor_id, cast(ts as date) as hit_date,
          case when user_id % 13 = 5 then 1 else cast(ts as date) - date '2023-12-31' end as visit_number,
          hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 1 as clicks_to_page,
          event_type || ':' || regexp_extract(props, '[0-9]+') as page_name,
          case when event_type in ('view', 'click') then 'article'
            when event_type <> 'error' then 'account' end as content_type,
          case when user_id % 10 = 0 then 'NO_ID' when event_id % 7 = 0 then ''
            else cast(user_id as varchar) end as uid_raw,
          case when event_type = 'purchase' and value >= 100 then 1 else 0 end as orders,
          case when event_type = 'purchase' and value >= 100 then event_id end as purchase_id,
          case cast(regexp_extract(props, '[0-9]+') as int) % 5
            when 0 then 'search engines' when 1 then 'social networks'
            when 2 then 'typed/bookmarked' when 3 then 'other web sites' end as referrer_type,
          case event_id % 3 when 0 then 'Mobile Phone' when 1 then 'Tablet' else 'Other' end
            as device,
          case when value < 20 or user_id % 4 = 0 then null
            when value < 60 or user_id % 4 = 1 then 'reg' else 'sub' end as visitor_access
        from events"""),
    "identity": ((), """
        select 'K' || c_custkey as customermasterkey,
          cast(c_custkey as varchar) as reader_id,
          case when c_custkey % 3 = 0 then 0 else 500000 + c_custkey end as new_customerid,
          case when c_custkey % 4 = 1 then null else c_custkey end as old_customerid,
          c_mktsegment = 'HOUSEHOLD' as isgroup, c_acctbal < 0 as isbadquality
        from customer"""),
    "second_map": ((), """
        select c_custkey as uid, 'H' || c_custkey as mapped_key
        from customer where c_mktsegment = 'HOUSEHOLD'"""),
    "sends": ((), """
        select user_id as profile_id,
          cast(regexp_extract(props, '[0-9]+') as int) % 8 as message_id,
          cast(regexp_extract(props, '[0-9]+') as int) % 4 as blast_id,
          cast(ts as date) as send_date, date_trunc('hour', ts) as send_time,
          case when event_type in ('view', 'click', 'purchase') then 1 else 0 end as did_open,
          case when event_type in ('click', 'purchase') then 1 else 0 end as did_click
        from events"""),
    "registration": ((), """
        select c_custkey as userid,
          cast(date '2024-01-01' + cast(c_custkey % 30 as int) as date) as createdate,
          case when c_mktsegment = 'MACHINERY' then ''
            else c_mktsegment || ' ' || c_nationkey end as referrer,
          case when c_custkey % 4 = 0 then cast(c_custkey as varchar) else '' end
            as aa_subscriberid,
          case when c_custkey % 6 = 0 then cast(c_custkey as varchar) end as aad_subscriberid,
          case when c_custkey % 9 = 0 then cast(c_custkey as varchar) else '' end
            as aaz_subscriberid
        from customer"""),
    "profile_map": ((), """
        select c_custkey as id, c_custkey as csid from customer where c_custkey % 7 <> 0"""),
    "funnel": ((), """
        select cast(ts as date) as funnel_date, count(distinct user_id) as unique_visitors,
          sum(case when event_type = 'purchase' and value >= 100 then 1 else 0 end)
            as new_paid_orders
        from events group by 1"""),
    "code_index": ((), """
        select p_name || ' (' || p_size || ')' as value_text,
          case when p_partkey % 2 = 0 then 'J' else 'B' end as code_kind
        from part"""),
    "demographic": ((), """
        select o_custkey as reader_id,
          case when l_returnflag <> 'R' then cast(cast(l_quantity as int) as varchar) end
            as busind,
          case when l_linestatus = 'O' then cast(cast(l_quantity as int) % 50 + 1 as varchar)
            else '' end as jobfunction
        from lineitem join orders on l_orderkey = o_orderkey"""),
    "recommendation": (("subscription",), """
        select 'site' as site_id, subscriptionid as subscription_id,
          planid + 1 as recommended_plan_id, businessunitcode, productname as product_id,
          'send' as billing_method,
          case when ispaid then 'model' else 'control' end as pricing_source
        from subscription"""),
    "snapshot": (("subscription",), """
        select subscriptionid as new_subscription_id, customeraccountid as new_customer_id,
          planid as plan_id, quantity as plan_interval_count,
          customeraccountid + 7 as shipping_address_id, productname as product_id,
          case when issourced then 'auto' else 'send' end as billing_method,
          currentperiodstart as snapshot_date
        from subscription where subscriptionstatus <> 'canceled'"""),
}
