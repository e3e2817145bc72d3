"""Closed-form estimates from grouped aggregates.

The source material samples Bayesian models on one machine; every model here
whose only predictor is a period or segment has a closed form, so one
``groupBy`` gives the estimate at any size. T5 to T8 report plug-in estimates
(no prior).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..functions.distributions import beta_greater, chi_square_sf, normal_cdf, t_cdf, t_quantile

#: Quantile of the standard normal distribution at 0.975.
Z95 = 1.959963984540054


def beta_posterior(counts: DataFrame, k: str, n: str) -> DataFrame:
    """Posterior mean and variance of a proportion under a uniform prior."""
    a = F.col(k).cast("double") + 1
    b = F.col(n).cast("double") - F.col(k) + 1
    return counts.withColumn("post_mean", a / (a + b)).withColumn(
        "post_var", a * b / ((a + b) * (a + b) * (a + b + 1))
    )


def pair_columns(df: DataFrame, by: str, a, b, cols: Sequence[str]) -> DataFrame:
    """The rows of two groups side by side: ``<col>_a`` and ``<col>_b``."""
    picks = []
    for side, level in (("a", a), ("b", b)):
        picks += [F.max(F.when(F.col(by) == level, F.col(c))).alias(f"{c}_{side}") for c in cols]
    return df.agg(*picks)


def proportion_diff(posterior: DataFrame, by: str, a, b, k: str = "k", n: str = "n") -> DataFrame:
    """b minus a: mean difference, 95 % normal interval and the exact P(difference > 0)."""
    p = pair_columns(posterior, by, a, b, ["post_mean", "post_var", k, n])
    diff = F.col("post_mean_b") - F.col("post_mean_a")
    sd = F.sqrt(F.col("post_var_a") + F.col("post_var_b"))
    shape = [x for s in ("a", "b") for x in (F.col(f"{k}_{s}") + 1, F.col(f"{n}_{s}") - F.col(f"{k}_{s}") + 1)]
    return p.select(
        diff.alias("diff"),
        (diff - F.lit(1.96) * sd).alias("lo"),
        (diff + F.lit(1.96) * sd).alias("hi"),
        beta_greater(*shape).alias("p_positive"),
    )


def _tails(below: Column) -> list[Column]:
    """p-values of a statistic by its distribution function: two-sided, for "less", for "greater"."""
    return [(2 * F.least(below, 1 - below)).alias("p_two_sided"), below.alias("p_less"), (1 - below).alias("p_greater")]


def prop_test(counts: DataFrame, by: str, a, b, k: str, n: str) -> DataFrame:
    """Two-sample proportion test with continuity correction.

    Chi-square on one degree, its p-value and those of both one-sided tests, and
    the 95 % interval of a minus b, kept within -1 and 1.
    """
    p = pair_columns(counts, by, a, b, [k, n])
    ka, kb = F.col(f"{k}_a").cast("double"), F.col(f"{k}_b").cast("double")
    na, nb = F.col(f"{n}_a").cast("double"), F.col(f"{n}_b").cast("double")
    pool = (ka + kb) / (na + nb)
    delta = ka / na - kb / nb
    inv = F.lit(1.0) / na + F.lit(1.0) / nb
    corr = F.least(F.lit(0.5), F.abs(delta) / inv)
    stat = F.pow(F.greatest(F.abs(delta) - corr * inv, F.lit(0.0)), 2) / (pool * (1 - pool) * inv)
    width = F.lit(Z95) * F.sqrt(ka / na * (1 - ka / na) / na + kb / nb * (1 - kb / nb) / nb) + corr * inv
    first = p.select((ka / na).alias("prop_a"), (kb / nb).alias("prop_b"), delta.alias("__d"),
                     stat.alias("chi_square"), width.alias("__w"))
    below = normal_cdf(F.signum("__d") * F.sqrt("chi_square"))
    return first.select(
        "prop_a", "prop_b", "chi_square", chi_square_sf("chi_square", F.lit(1.0)).alias("p_two_sided"),
        below.alias("p_less"), (1 - below).alias("p_greater"),
        F.greatest(F.col("__d") - F.col("__w"), F.lit(-1.0)).alias("lo"),
        F.least(F.col("__d") + F.col("__w"), F.lit(1.0)).alias("hi"))


def welch_t(df: DataFrame, value: str, by: str, a, b) -> DataFrame:
    """Welch's t, its degrees of freedom and p-values, and the 95 % interval of mean(a) - mean(b)."""
    v = F.col(value).cast("double")
    stats = df.groupBy(by).agg(
        F.avg(v).alias("m"), F.var_samp(v).alias("v"), F.count(v).cast("double").alias("n")
    )
    p = pair_columns(stats, by, a, b, ["m", "v", "n"])
    sa, sb = F.col("v_a") / F.col("n_a"), F.col("v_b") / F.col("n_b")
    dof = F.pow(sa + sb, 2) / (
        F.pow(sa, 2) / (F.col("n_a") - 1) + F.pow(sb, 2) / (F.col("n_b") - 1)
    )
    first = p.select(
        F.col("m_a").alias("mean_a"), F.col("m_b").alias("mean_b"),
        ((F.col("m_a") - F.col("m_b")) / F.sqrt(sa + sb)).alias("t"), dof.alias("dof"),
        F.sqrt(sa + sb).alias("__se"),
    )
    width = t_quantile(F.lit(0.975), "dof") * F.col("__se")
    told = first.select("*", t_cdf("t", "dof").alias("__below"), width.alias("__w"))
    diff = F.col("mean_a") - F.col("mean_b")
    return told.select("mean_a", "mean_b", "t", "dof", *_tails(F.col("__below")),
                       (diff - F.col("__w")).alias("lo"), (diff + F.col("__w")).alias("hi"))


def negbin_moments(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Mean, variance and moment estimate of the dispersion mean^2 / (var - mean).

    The dispersion is null where the data are not over-dispersed.
    """
    v = F.col(value).cast("double")
    out = df.groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var")
    )
    over = F.col("var") > F.col("mean")
    return out.withColumn(
        "dispersion", F.when(over, F.col("mean") * F.col("mean") / (F.col("var") - F.col("mean")))
    )


def hurdle_lognormal(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Share of zeros, and mean and sd of the log above zero."""
    v = F.col(value).cast("double")
    pos = F.when(v > 0, F.ln(v))
    return df.groupBy(*by).agg(
        F.count(v).alias("n"),
        F.avg(F.when(v == 0, 1.0).when(v.isNotNull(), 0.0)).alias("zero_share"),
        F.avg(pos).alias("log_mean"), F.stddev_samp(pos).alias("log_sd"),
    )


def lognormal(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    v = F.col(value).cast("double")
    pos = F.when(v > 0, F.ln(v))
    return df.groupBy(*by).agg(
        F.count(pos).alias("n"), F.avg(pos).alias("log_mean"),
        F.stddev_samp(pos).alias("log_sd"), F.exp(F.avg(pos)).alias("median"),
    )


def gaussian(df: DataFrame, value: str, by: str) -> DataFrame:
    """Group means with one pooled standard deviation.

    The pooled sd is a scalar subquery over the per-group rows.
    """
    v = F.col(value).cast("double")
    stats = df.groupBy(by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("__var")
    )
    within = F.sum((F.col("n") - 1) * F.coalesce(F.col("__var"), F.lit(0.0)))
    pooled = stats.agg(F.sqrt(ratio(within, F.sum(F.col("n") - 1)))).scalar()
    return stats.withColumn("pooled_sd", pooled).drop("__var")
