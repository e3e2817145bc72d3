"""What a price change did: renewals, churn, revenue, new orders, product mix."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import count_if, distinct_rollup
from ..functions.columns import ladder, pct_label, ratio
from ..operators.groups import keep_group_min, share_of, with_group_stat
from ..operators.intervals import label_period
from ..operators.ordered import join_stats, quantiles
from ..sources.io import stage

# One contract as the reports count it.
KEY = ["shiptocustomernumber", "ordernumber", "new_subid"]
CONTRACT_COLS = [
    "shiptocustomernumber", "ordernumber", "orderdate", "new_subid", "isautorenew", "pubcode",
    "termnumber", "termlength", "rate", "expirationissuedate",
]


def _day(d: str) -> Column:
    return F.lit(d).cast("date")


def _contracts(df: DataFrame, cols: Sequence[str] = CONTRACT_COLS) -> DataFrame:
    """One row per contract term: highest renewal price, whether it has a renewal order."""
    return df.groupBy(*cols).agg(
        F.max("renewalrate").alias("renewalrate"),
        F.count("renewalordernumber").alias("n_renewals"),
    )


def _mean(name: str, alias: str) -> Column:
    return ratio(name, f"{name}_n").alias(alias)


def _loss(name: str, alias: str) -> Column:
    return (-F.coalesce(F.col(name).cast("double"), F.lit(0.0))).alias(alias)


def _total(name: str, alias: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(alias)


def _with_medians(out: DataFrame, rows: DataFrame, by, value: str, **conds: Column) -> DataFrame:
    """Add the median of ``value`` under each condition, all in one pass."""
    which = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conds.items()]))
    labelled = rows.withColumn("__which", F.explode(which))
    q = quantiles(labelled, [*by, "__which"], value, [0.5], ["__median"])
    wide = q.groupBy(*by).agg(*[
        F.max(F.when(F.col("__which") == n, F.col("__median"))).alias(n) for n in conds
    ])
    return join_stats(out, wide, by, "left")


def renewal_outcomes(
    history: DataFrame, change_date: str, min_expiry: str, thresholds: Mapping[str, float],
    as_of: str, max_rate: float,
) -> DataFrame:
    """Annual contracts live at a price change, per product and auto-renew flag.

    Counts are distinct contracts; categories may overlap and need not add up.
    Churn counts use "expired before", means and losses "expired by" ``as_of``.
    """
    live = history.where(
        (F.col("donortype") == "I")
        & (F.col("expirationissuedate") >= _day(min_expiry))
        & (F.col("orderdate") <= _day(change_date))
        & F.col("pubcode").isin(*thresholds)
        & (F.col("termlength") == "Annual")
        & (F.col("rate") <= max_rate)
    )
    c = _contracts(live)
    price = ladder([(F.col("pubcode") == p, v) for p, v in thresholds.items()])
    renewed, gone = F.col("n_renewals") > 0, F.col("n_renewals") == 0
    at_raise = renewed & (F.col("renewalrate") >= price)
    expired = gone & (F.col("expirationissuedate") <= _day(as_of))
    raised = at_raise | (renewed & (F.col("renewalrate") >= F.col("rate")))
    out = distinct_rollup(
        c, ["pubcode", "isautorenew"], KEY,
        flags={
            "renewed_raise": raised,
            "renewed_no_raise": renewed & ~raised,
            "undetermined": gone & (F.col("expirationissuedate") >= _day(as_of)),
            "churned": gone & (F.col("expirationissuedate") < _day(as_of)),
        },
        sums={
            "r_rate": F.when(at_raise, F.col("rate")),
            "c_rate": F.when(expired, F.col("rate")),
            "r_term": F.when(at_raise, F.col("termnumber")),
            "c_term": F.when(expired, F.col("termnumber")),
            "r_rev": F.when(at_raise, F.col("renewalrate")),
            "c_loss": F.when(expired, price),
        },
        total="contracts",
    )
    return _outcome_columns(out, ["pubcode", "isautorenew"])


def _outcome_columns(out: DataFrame, by: Sequence[str]) -> DataFrame:
    return out.select(
        *by, "contracts", "renewed_raise", "renewed_no_raise",
        *[c for c in ("undetermined",) if c in out.columns], "churned",
        _mean("r_rate", "mean_rate_renewed"), _mean("c_rate", "mean_rate_churned"),
        _mean("r_term", "mean_term_renewed"), _mean("c_term", "mean_term_churned"),
        _total("r_rev", "renewal_revenue"), _loss("c_loss", "churn_loss"),
    ).withColumn("net_revenue", F.col("renewal_revenue") + F.col("churn_loss"))


def renewal_outcomes_monthly(
    history: DataFrame, order_by: str, change_date: str, products: Sequence[str],
    threshold: float, as_of: str, max_rate: float,
) -> DataFrame:
    """Monthly contracts around a price change, earliest applicable term only; adds medians."""
    exp, ordered = F.col("expirationissuedate"), F.col("orderdate")
    spans = ((ordered <= _day(change_date)) & (F.col("termnumber") != 1)
             & (exp >= _day(change_date))) | (
        (ordered <= _day(order_by)) & (exp >= _day(change_date)))
    known = (exp <= _day(as_of)) | ((exp >= _day(as_of)) & F.col("renewalordernumber").isNotNull())
    live = history.where(
        (F.col("donortype") == "I") & (F.col("termlength") == "Monthly") & spans
        & F.col("pubcode").isin(*products) & known
    )
    first = keep_group_min(live, ["shiptocustomernumber", "new_subid"], "termnumber")
    c = stage(_contracts(first.where(F.col("rate") <= max_rate),
                         [x for x in CONTRACT_COLS if x != "orderdate"]))
    by = ["pubcode", "termlength", "isautorenew"]
    renewed, gone = F.col("n_renewals") > 0, F.col("n_renewals") == 0
    raised = renewed & (
        (F.col("renewalrate") >= threshold) | (F.col("renewalrate") > F.col("rate"))
    )
    churned = gone & (exp < _day(as_of))
    out = distinct_rollup(
        c, by, KEY,
        flags={
            "renewed_raise": raised,
            "renewed_no_raise": renewed & (F.col("renewalrate") <= F.col("rate")),
            "churned": churned,
        },
        sums={
            "r_rate": F.when(raised, F.col("rate")),
            "c_rate": F.when(gone, F.col("rate")),
            "r_term": F.when(raised, F.col("termnumber")),
            "c_term": F.when(gone, F.col("termnumber")),
            "r_rev": F.when(raised, F.col("renewalrate")),
            "c_loss": F.when(churned, F.lit(threshold)),
        },
        total="contracts",
    )
    out = _outcome_columns(out, by)
    return _with_medians(out, c, by, "rate", median_rate_renewed=raised,
                         median_rate_churned=gone)


def churn_report(outcomes: DataFrame) -> DataFrame:
    """The display version: churn rate as text, tenure, loss."""
    return outcomes.select(
        F.col("pubcode").alias("Product"),
        F.col("isautorenew").alias("Auto_Renew"),
        pct_label(ratio("churned", "contracts")).alias("Churn_Rate"),
        F.col("mean_term_renewed").alias("Mean_Termnumber_Renewed"),
        F.col("mean_term_churned").alias("Mean_Termnumber_Churned"),
        F.col("churn_loss").alias("Churned_Loss"),
        F.col("net_revenue").alias("Initial_Renewal_Revenue"),
    )


def new_orders(
    history: DataFrame, since: str, as_of: str, products: Sequence[str]
) -> DataFrame:
    """First-term orders after the change: renewals, undetermined, churn, revenue."""
    first = history.where(
        (F.col("donortype") == "I") & (F.col("orderdate") >= _day(since))
        & (F.col("termnumber") == 1) & F.col("pubcode").isin(*products)
    )
    c = stage(_contracts(first))
    by = ["pubcode", "termlength", "isautorenew"]
    exp, renewed = F.col("expirationissuedate"), F.col("n_renewals") > 0
    out = distinct_rollup(
        c, by, KEY,
        flags={
            "renewed": renewed,
            "undetermined": ~renewed & (exp >= _day(as_of)),
            "churned": ~renewed & (exp < _day(as_of)),
        },
        sums={
            "r_rate": F.when(renewed, F.col("rate")),
            "c_rate": F.when(~renewed, F.col("rate")),
            "revenue": F.col("rate"),
        },
        total="contracts",
    ).select(
        *by, "contracts", "renewed", "undetermined", "churned",
        _mean("r_rate", "mean_rate_renewed"), _mean("c_rate", "mean_rate_churned"),
        _total("revenue", "initial_revenue"),
    )
    return _with_medians(out, c, by, "rate", median_rate_renewed=renewed,
                         median_rate_churned=~renewed)


def product_mix_shift(
    history: DataFrame, periods: Sequence[tuple[str, str, str]], products: Sequence[str],
    price_ok: Column,
) -> DataFrame:
    """Share of first orders by product and term, per period, in one pass."""
    first = history.where(
        (F.col("donortype") == "I") & (F.col("termnumber") == 1)
        & F.col("pubcode").isin(*products) & price_ok
    )
    first = label_period(first, "orderdate", periods, "category")
    n = distinct_rollup(first, ["category", "pubcode", "termlength"], KEY, total="n_contracts")
    return share_of(n, ["category"], "n_contracts", "share", "total_contracts")


def funnel_conversion(funnel: DataFrame, change_date: str) -> DataFrame:
    """Visitors, paid orders and conversion before and after a date."""
    side = F.when(F.col("funnel_date") < _day(change_date), "pre").otherwise("post")
    return funnel.groupBy(side.alias("category")).agg(
        F.sum("unique_visitors").alias("total_unique_visitors"),
        F.sum("new_paid_orders").alias("total_paid_orders"),
    ).withColumn("conversion_rate", ratio("total_paid_orders", "total_unique_visitors"))


ORDER = ["shiptocustomernumber", "ordernumber"]
TERM_COLS = [*ORDER, "subscriptionreference", "termnumber", "termlength", "isautorenew",
             "expirationissuedate", "rate", "renewalrate", "renewaltermlength", "pub_level"]


def _order_terms(terms: DataFrame) -> DataFrame:
    """Order-level rows: summed prices, whether renewed, the order's top product level."""
    rows = terms.select(*TERM_COLS).distinct()
    rows = with_group_stat(rows, ORDER, {"order_level": F.max("pub_level")})
    return rows.groupBy(*ORDER, "termlength", "isautorenew", "expirationissuedate").agg(
        F.sum("rate").alias("rate"),
        F.max("termnumber").alias("termnumber"),
        F.max(F.when(F.col("renewalrate").isNull(), 0).otherwise(1)).alias("did_renew"),
        F.sum("renewalrate").alias("renewalrate"),
        F.max("renewaltermlength").alias("renewaltermlength"),
        F.max("order_level").alias("order_level"),
    )


def print_bundle_renewal(terms: DataFrame, change_date: str, as_of: str) -> DataFrame:
    """Renewal, revenue per user and loss by top product and term, orders live at the change."""
    live = terms.where(
        (F.col("donortype") == "I") & (F.col("expirationissuedate") >= _day(change_date))
        & (F.col("orderdate") < _day(change_date)) & F.col("og_termlength").isin(4, 52)
    )
    rows = _order_terms(live)
    done = (F.col("did_renew") == 1) & (F.col("expirationissuedate") < _day(as_of))
    up = F.col("renewalrate") > F.col("rate")
    lost = F.col("did_renew") == 0
    by = ["order_level", "termlength"]
    return distinct_rollup(
        rows, by, ORDER,
        flags={"renewed_raise": done & up,
               "renewed_no_raise": done & (F.col("renewalrate") <= F.col("rate"))},
        sums={
            "before": F.col("rate"), "after": F.when(up, F.col("renewalrate")),
            "r_term": F.when(up, F.col("termnumber")),
            "c_term": F.when(lost, F.col("termnumber")), "loss": F.when(lost, F.col("rate")),
        },
        total="active_orders",
    ).select(
        *by, "active_orders", "renewed_raise", "renewed_no_raise",
        _mean("before", "avg_rate_before"), _mean("after", "avg_rate_after"),
        _mean("r_term", "avg_term_renewed"), _mean("c_term", "avg_term_canceled"),
        _total("after", "renewal_revenue"), _loss("loss", "cancel_loss"),
    )


def new_order_first_term(terms: DataFrame, since: str, as_of: str) -> DataFrame:
    """Outcome of the first term of orders placed after the change, finished by ``as_of``."""
    first = terms.where(
        (F.col("donortype") == "I") & (F.col("orderdate") >= _day(since))
        & (F.col("termnumber") == 1) & (F.col("expirationissuedate") <= _day(as_of))
    )
    rows = stage(_order_terms(first))
    kept, lost = F.col("did_renew") == 1, F.col("did_renew") == 0
    by = ["order_level", "termlength"]
    out = distinct_rollup(
        rows, by, ORDER,
        flags={"renewed": kept},
        sums={"rev": F.col("rate"), "kept": F.when(kept, F.col("rate")),
              "lost": F.when(lost, F.col("rate"))},
        total="new_orders",
    ).select(
        *by, "new_orders", "renewed", _mean("rev", "avg_rate"),
        _total("rev", "new_revenue"), _loss("lost", "canceled_loss"),
        _mean("kept", "avg_rate_renewed"), _mean("lost", "avg_rate_canceled"),
    ).withColumn("first_term_revenue", F.col("new_revenue") + F.col("canceled_loss"))
    return join_stats(out, quantiles(rows, by, "rate", [0.5], ["median_rate"]), by, "left")


def active_at_change(terms: DataFrame, date: str) -> DataFrame:
    """Distinct users live at a date, and those of them with a renewal."""
    live = terms.where(
        (F.col("donortype") == "I") & (F.col("expirationissuedate") >= _day(date))
        & (F.col("startissuedate") <= _day(date))
    )
    users = live.groupBy("shiptocustomernumber", "billtocustomernumber").agg(
        F.max(F.col("renewaltermnumber").isNotNull()).alias("renews")
    )
    return users.agg(
        F.count(F.lit(1)).alias("active_users"), count_if(F.col("renews")).alias("renewing_users")
    )
