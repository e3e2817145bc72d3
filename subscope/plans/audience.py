"""Email funnel, audience profile, and the price-list feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import distinct_rollup
from ..functions.columns import (
    blank_to_null, coalesce_like, digits_id, extract_code, ladder, ratio, split_part, strip_code,
    week7,
)
from ..operators.groups import (
    keep_group_max, keep_group_min, share_of, top_k_ties, top_per_group,
)
from ..operators.joins import semi_in
from ..operators.ordered import five_number

SEND_KEY = ["profile_id", "message_id", "blast_id", "send_time", "send_date"]


# --- email ------------------------------------------------------------------------------


def send_dedup(sends: DataFrame) -> DataFrame:
    """Per send keep the rows at the highest open flag, ties kept."""
    return keep_group_max(sends, SEND_KEY, "did_open")


def registered_users(registration: DataFrame, profile_map: DataFrame) -> DataFrame:
    """Registrations with their subscriber id (first non-blank of its family) and profile."""
    sub = coalesce_like(registration.columns, "subscriberid")
    reg = registration.select("userid", "createdate", "referrer", digits_id(sub).alias("sub_id"))
    p = profile_map.select(F.col("id").alias("profile_id"), F.col("csid").alias("__cs")).distinct()
    return reg.join(p, reg["userid"] == p["__cs"], "left").drop("__cs")


def relevant_sends(sends: DataFrame, registered: DataFrame) -> DataFrame:
    return semi_in(sends, ["profile_id"], registered.where("profile_id is not null"))


def profile_email_stats(sends: DataFrame) -> DataFrame:
    """Distinct emails, dates, blasts and messages, opens and clicks per profile.

    Rows shrink to one per send first, so the distinct counts see far less.
    """
    per_send = sends.groupBy(*SEND_KEY).agg(
        F.sum("did_open").alias("opens"), F.sum("did_click").alias("clicks")
    )
    return per_send.groupBy("profile_id").agg(
        F.count_distinct("blast_id", "message_id", "send_time").alias("n_emails"),
        F.count_distinct("send_date").alias("n_dates"),
        F.count_distinct("blast_id").alias("n_blasts"),
        F.count_distinct("message_id").alias("n_messages"),
        F.sum("opens").alias("total_opens"),
        F.sum("clicks").alias("total_clicks"),
    )


def _with_stats(registered: DataFrame, stats: DataFrame) -> DataFrame:
    return registered.join(stats, "profile_id", "left")


def email_funnel(registered: DataFrame, stats: DataFrame) -> DataFrame:
    """Registered -> emailed -> opened -> clicked, for all users and for converted ones."""
    rows = _with_stats(registered, stats)
    segment = F.array_compact(F.array(
        F.lit("all"), F.when(F.col("sub_id").isNotNull(), F.lit("converted"))
    ))
    mailed = F.col("n_emails").isNotNull()
    opened = mailed & (F.col("total_opens") > 0)
    return distinct_rollup(
        rows.withColumn("segment", F.explode(segment)), ["segment"], ["userid"],
        flags={"emailed": mailed, "opened": opened,
               "clicked": opened & (F.col("total_clicks") > 0)},
        total="registered",
    )


def conversion_rate(registered: DataFrame) -> DataFrame:
    """Converted registrations as a percentage of all."""
    return distinct_rollup(
        registered, [], ["userid"], flags={"converted": F.col("sub_id").isNotNull()},
        total="registered",
    ).withColumn("rate_pct", F.round(ratio("converted", "registered") * 100, 3))


def weekly_email_load(registered: DataFrame, sends: DataFrame) -> DataFrame:
    """Per user: weeks mailed, emails, opens; mean emails per week and share opened."""
    opened = F.col("did_open") == 1
    weekly = distinct_rollup(
        sends.withColumn("week", week7("send_date")), ["profile_id", "week"],
        ["blast_id", "message_id", "send_time"],
        flags={"opens": opened, "open_clicks": opened & (F.col("did_click") == 1)},
        total="emails",
    )
    profile = weekly.groupBy("profile_id").agg(
        F.count(F.lit(1)).alias("weeks"), F.sum("emails").alias("emails"),
        F.sum("opens").alias("opens"), F.sum("open_clicks").alias("open_clicks"),
    )
    return registered.join(profile, "profile_id").groupBy("userid").agg(
        F.max("weeks").alias("total_weeks"), F.sum("emails").alias("total_emails"),
        F.sum("opens").alias("total_opens"), F.sum("open_clicks").alias("total_open_clicks"),
    ).withColumn("emails_per_week", ratio("total_emails", "total_weeks")).withColumn(
        "open_share_pct", F.round(ratio("total_opens", "total_emails") * 100)
    )


def referrer_share(registered: DataFrame, stats: DataFrame, k: int) -> DataFrame:
    """Top referrers of users never mailed, by share rounded to one place, ties kept."""
    never = _with_stats(registered, stats).where("n_emails is null")
    source = F.coalesce(blank_to_null("referrer"), F.lit("Unknown"))
    n = distinct_rollup(never.withColumn("source", source), ["source"], ["userid"],
                        total="n_users")
    shares = share_of(n, [], "n_users", "share", "total_users").withColumn(
        "share", F.round("share", 1)
    )
    return top_k_ties(shares, k, "share")


def clicked_split(registered: DataFrame, stats: DataFrame) -> DataFrame:
    """Email volume of mailed users by whether they clicked and purchased."""
    rows = _with_stats(registered, stats).where("n_emails is not null").select(
        (F.col("total_clicks") > 0).alias("did_click"),
        F.col("sub_id").isNotNull().alias("did_purchase"), "n_emails",
    )
    return five_number(rows, ["did_click", "did_purchase"], "n_emails")


def sends_after_signup(registered: DataFrame, sends: DataFrame) -> DataFrame:
    """Sends to a user at or after registration."""
    return registered.join(sends, "profile_id").where(
        F.col("send_time") >= F.col("createdate").cast("timestamp_ntz")
    ).select("userid", "createdate", *SEND_KEY, "did_open", "did_click").distinct()


# --- codes and profiles ---------------------------------------------------------------------


def code_parse(
    codes: DataFrame, kinds: Mapping[str, str], overrides: Sequence[tuple[str, str, str]] = ()
) -> DataFrame:
    """Code out of a label's brackets and the label without it.

    ``kinds`` renames the kind column's values (one brand's table has its two
    kinds exchanged); ``overrides`` lists (kind, label, code) fixes.
    """
    kind = ladder([(F.col("code_kind") == a, b) for a, b in kinds.items()])
    parsed = codes.select(
        kind.alias("kind"), F.trim(strip_code("value_text")).alias("label"),
        extract_code("value_text").alias("code"),
    ).distinct()
    fixes = [((F.col("kind") == k) & (F.col("label") == lb), c) for k, lb, c in overrides]
    if fixes:
        parsed = parsed.withColumn("code", ladder(fixes, F.col("code")))
    return parsed


def code_table(parsed: DataFrame, kind: str) -> DataFrame:
    """One label per code of a kind (the first in text order)."""
    return parsed.where(F.col("kind") == kind).groupBy("code").agg(F.min("label").alias("label"))


def _answers(customers: DataFrame, answers: DataFrame, code: str) -> DataFrame:
    """Each customer's distinct answers; customers without any keep one null answer.

    Repeated answers are removed before the join, so a customer with very many
    form rows adds only as many rows as there are codes.
    """
    a = answers.select(F.col("reader_id").alias("__u"), F.col(code).alias("code")) \
        .distinct()
    return customers.join(a, customers["customer"] == a["__u"], "left").drop("__u")


def best_known_value(
    customers: DataFrame, answers: DataFrame, codes: DataFrame, other_pattern: str, other: str
) -> DataFrame:
    """Per customer the identified industries, or "other" when none is identified."""
    rows = _answers(customers, answers, "busind").join(codes, "code", "left")
    vague = F.col("label").isNull() | F.col("label").isin("unknown", "Undefined") \
        | F.col("label").rlike(other_pattern)
    rows = rows.withColumn("known", F.when(vague, 0).otherwise(1)).withColumn(
        "value", F.when(vague, F.lit(other)).otherwise(F.col("label"))
    )
    return keep_group_max(rows, ["customer"], "known").select(
        *customers.columns, "value"
    ).distinct()


def senior_job(
    customers: DataFrame, answers: DataFrame, codes: DataFrame, missing: int = 99
) -> DataFrame:
    """Per customer the lowest job code; a missing code ranks last."""
    rows = _answers(customers, answers, "jobfunction").join(codes, "code", "left")
    rank = F.coalesce(F.col("code").try_cast("int"), F.lit(missing))
    rows = rows.withColumn("job", rank).withColumn(
        "value", F.coalesce("label", F.lit("unknown"))
    )
    return keep_group_min(rows, ["customer"], "job").select(
        *customers.columns, "value"
    ).distinct()


def audience_top_k(
    values: DataFrame, base: DataFrame, k: int, exclude: Sequence[str] = ()
) -> DataFrame:
    """Customers per value and share of the base, the ``k`` largest with ties."""
    n = distinct_rollup(values, ["value"], ["customer"], total="n")
    total = base.agg(F.count_distinct("customer")).scalar()
    out = n.where(~F.col("value").isin(*exclude)) if exclude else n
    out = out.withColumn("total", total).withColumn("share", ratio("n", "total") * 100)
    return top_k_ties(out, k, "n")


def job_by_industry(
    industries: DataFrame, jobs: DataFrame, k: int, skip_jobs: str, exclude: Sequence[str] = ()
) -> DataFrame:
    """Top ``k`` jobs, with shares, in each of the ``k`` largest industries."""
    j = jobs.withColumnRenamed("value", "job").where(~F.col("job").rlike(skip_jobs))
    both = industries.withColumnRenamed("value", "industry").join(
        j.select("customer", "job"), "customer"
    )
    n = distinct_rollup(both, ["industry", "job"], ["customer"], total="n")
    n = share_of(n, ["industry"], "n", "share", "total_users").withColumn(
        "share", F.round(F.col("share"), 1)
    )
    top = top_per_group(n, ["industry"], [F.col("n").desc(), F.col("job")], k)
    large = audience_top_k(industries, industries, k, exclude)
    return semi_in(top, ["industry"], large, ["value"])


def label_split(df: DataFrame, c: str, sep: str, name: str) -> DataFrame:
    """The text before a separator."""
    return df.withColumn(name, F.trim(split_part(c, sep, 1)))


def cross_brand_share(values: DataFrame, k: int, unknown: Sequence[str]) -> DataFrame:
    """Per brand the top ``k`` values over the identified base, all brands in one pass."""
    n = distinct_rollup(values, ["brand", "value"], ["customer"], total="n")
    known = n.where(~F.col("value").isin(*unknown))
    base = distinct_rollup(
        values.withColumn("__known", ~F.col("value").isin(*unknown)), ["brand"], ["customer"],
        flags={"identified": F.col("__known")}, total="customers",
    )
    top = top_k_ties(known, k, "n", ["brand"])
    return top.join(base.select("brand", "identified"), "brand").withColumn(
        "share", F.round(ratio("n", "identified") * 100, 1)
    )


# --- feed --------------------------------------------------------------------------------------


def price_feed(recommendation: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Recommendations with the subscriber snapshot of the same date, in the load file's columns."""
    r, s = recommendation.alias("r"), snapshot.alias("s")
    j = r.join(s, F.col("r.subscription_id") == F.col("s.new_subscription_id"), "left")
    return j.select(
        F.col("r.site_id").alias("siteid"), F.col("s.new_customer_id").alias("customerid"),
        F.col("r.subscription_id").alias("subscriptionid"), F.col("s.plan_id").alias("planid"),
        F.col("s.plan_interval_count").alias("quantity"), F.lit("Renewal").alias("source"),
        F.col("s.shipping_address_id").alias("addressid"),
        F.col("r.businessunitcode").alias("brand"), F.col("s.product_id").alias("productid"),
        F.col("s.billing_method").alias("billingmethod"),
        F.col("r.pricing_source").alias("pricingsource"),
    )
