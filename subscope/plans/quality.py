"""Is the stitched history complete, and what revenue do contracts earn week by week."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import distinct_rollup
from ..functions.columns import digits_id, is_true, ratio
from ..operators.groups import duplicate_rows, with_group_stat
from ..operators.intervals import live_keys_per_week, weekly_totals
from ..operators.joins import anti_on, semi_in
from ..sources.io import stage


def _day(d: str) -> Column:
    return F.lit(d).cast("date")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key repeats; an empty result is the passing one."""
    return duplicate_rows(df, keys)


def missing_old_contracts(terms: DataFrame, history: DataFrame, since: str) -> DataFrame:
    """Old contracts in scope that the history has neither by id nor by (customer, order)."""
    scope = terms.where(F.col("expirationissuedate") >= _day(since)).select(
        "shiptocustomernumber", "ordernumber", "subscriptionreference"
    )
    rest = anti_on(scope, ["subscriptionreference"], history, ["old_subid"])
    return anti_on(rest, ["shiptocustomernumber", "ordernumber"], history,
                   ["original_cust_value", "ordernumber"])


def open_subscriptions(subscription: DataFrame) -> DataFrame:
    return subscription.where(F.col("subscriptionstatus").isin("active", "past_due"))


def missing_new_subscriptions(
    subscription: DataFrame, history: DataFrame, header: DataFrame
) -> DataFrame:
    """Open, paid new-system subscriptions the history lacks, with the old row's first issue."""
    open_paid = open_subscriptions(subscription).where(is_true("ispaid"))
    gone = anti_on(open_paid, ["subscriptionid"], history, ["new_subid"]).select(
        "subscriptionid", digits_id("oldproviderid").alias("oldproviderid"), "quantity"
    )
    old = header.select(F.col("subscriptionreference").alias("__ref"),
                        F.col("firstissuesent").alias("has_old_row"))
    return gone.join(old, gone["oldproviderid"] == old["__ref"], "left").drop("__ref")


def capture_rate(subscription: DataFrame, history: DataFrame) -> DataFrame:
    """Per brand: captured share of the open quantity, and how many copies are missing."""
    live = open_subscriptions(subscription)
    total = live.where(is_true("ispaid")).groupBy("businessunitcode").agg(
        F.sum("quantity").alias("total_subs")
    )
    found = semi_in(live, ["subscriptionid"], history, ["new_subid"]).groupBy(
        F.col("businessunitcode").alias("__brand")
    ).agg(F.sum("quantity").alias("captured_subs"))
    out = total.join(found, total["businessunitcode"] == found["__brand"], "left").drop("__brand")
    captured = F.coalesce("captured_subs", F.lit(0))
    return out.withColumn("captured_subs", captured).select(
        F.col("businessunitcode").alias("brand"), "total_subs", "captured_subs",
        (ratio("captured_subs", "total_subs") * 100).alias("capture_pct"),
        (F.col("total_subs") - F.col("captured_subs")).alias("missing_subs"),
    )


def _paid_terms(terms: DataFrame) -> DataFrame:
    """Individual, regular, past or current terms."""
    return terms.where(
        (F.col("donortype") == "I") & (F.col("subscriptionclass") == "R")
        & F.col("termtype").isin("P", "C")
    )


def recognised_revenue_week(terms: DataFrame, start: str, end: str) -> DataFrame:
    """Revenue earned in one week: price per day times days since the later of start and week.

    An order's rows all count at the order's highest value, as in the source.
    """
    live = _paid_terms(terms).where(
        (F.col("expirationissuedate") >= _day(start)) & (F.col("startissuedate") < _day(end))
    )
    days = F.datediff(_day(end), F.greatest(F.col("startissuedate"), _day(start)))
    earned = F.col("rate").cast("double") * days / (F.col("og_termlength") * 7)
    orders = live.groupBy("shiptocustomernumber", "ordernumber").agg(
        F.max(earned).alias("best"), F.count(F.lit(1)).alias("n")
    )
    people = orders.groupBy("shiptocustomernumber").agg(
        F.sum(F.col("best") * F.col("n")).alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    return people.agg(
        F.count(F.lit(1)).alias("individual_subs"), F.sum("orders").alias("orders"),
        F.sum("revenue").alias("revenue"),
    ).withColumn("mean_per_order", ratio("revenue", "orders"))


def recognised_revenue_series(terms: DataFrame, first: str, last: str) -> DataFrame:
    """All weeks and brands at once: revenue, contracts, subscriptions, copies.

    Money is summed exactly as price x copies x days per term length and
    divided at the end.
    """
    n_weeks = (date.fromisoformat(last) - date.fromisoformat(first)).days // 7
    live = stage(_paid_terms(terms).where(
        (F.col("rate") > 0) & (F.col("expirationissuedate") > _day(first))
        & (F.col("startissuedate") < _day(last))
    ).select(
        "brand", "shiptocustomernumber", "ordernumber", "subscriptionreference",
        "startissuedate", "expirationissuedate", "og_termlength", "copies",
        (F.col("rate") * F.col("copies")).cast("decimal(18,2)").alias("amount"),
    ))
    span = ("startissuedate", "expirationissuedate", first, n_weeks)
    money = weekly_totals(live, ["brand", "og_termlength"], *span, "amount", "copies")
    money = money.groupBy("brand", "week_start").agg(
        F.sum(F.col("per_day_total").cast("double") / (F.col("og_termlength") * 7))
        .alias("revenue"),
        F.sum("per_week_total").alias("copies"),
    )
    contract = ["shiptocustomernumber", "ordernumber", "subscriptionreference"]
    contracts = live_keys_per_week(live, ["brand"], contract, *span, "contracts")
    subs = live_keys_per_week(live, ["brand"], contract[2:], *span, "subscriptions")
    keys = ["brand", "week_start"]
    return money.join(contracts, keys).join(subs, keys).where(F.col("contracts") > 0)


def arpu_week(series: DataFrame) -> DataFrame:
    return series.select(
        "brand", "week_start", ratio("revenue", "copies").alias("arpu_copies"),
        ratio("revenue", "subscriptions").alias("arpu_subs"),
    )


def arpu_year(terms: DataFrame, since: str) -> DataFrame:
    """Per start year: highest price per order and start, summed; revenue per order."""
    starts = terms.where(F.col("startissuedate") >= _day(since)).groupBy(
        "shiptocustomernumber", "ordernumber", "startissuedate"
    ).agg(F.max("rate").alias("m")).withColumn("year", F.year("startissuedate"))
    out = distinct_rollup(
        starts, ["year"], ["shiptocustomernumber", "ordernumber"],
        sums={"total_rev": F.col("m")}, total="n_contracts",
    )
    return out.select("year", "total_rev", "n_contracts",
                      ratio("total_rev", "n_contracts").alias("arpu"))


def history_flags(terms: DataFrame, migrated: DataFrame) -> DataFrame:
    """Rows with whether their order migrated, the order's top level, and its total price."""
    order = ["shiptocustomernumber", "ordernumber"]
    known = migrated.select(F.col("old_sub_id").alias("__ref")).distinct().withColumn(
        "__in", F.lit(1)
    )
    rows = terms.join(known, terms["subscriptionreference"] == known["__ref"], "left")
    rows = rows.withColumn("migrated", F.coalesce("__in", F.lit(0))).drop("__ref", "__in")
    return with_group_stat(rows, order, {
        "order_migrated": F.max("migrated"), "max_level": F.max("pub_level"),
        "order_total": F.sum("rate"),
    })
