"""Quality rules with robust multivariate outliers.

Fixed rules reject first. Of what they keep, the statistics of a document form
a vector of logarithms, and a document far from the centre of its language and
source is rejected. Centre and spread are minimum-covariance-determinant
estimates: from coordinate-wise medians, concentration steps take the share
``KEEP`` of a group's rows nearest to the estimate and estimate again from them
until no group's determinant falls. A step is two aggregations over all groups at
once, with one row per group as the result; no group is gathered. The estimate of
a group is shrunk towards that of its language, and a language's towards that of
all rows, as if PRIOR more rows of the pool belonged to it (a regularised
determinant), so every group has an estimate, however few its rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_rows, frame, shipped, sized_join, stage, words_of

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
        "n_upper long, n_marks long, n_distinct long"
#: What is known of a group between steps.
_STATE = "grp string, rows long, center array<double>, cov array<double>, precision array<double>, logdet double, " \
         "falls boolean, pool_center array<double>, pool_cov array<double>, pool_scale double"
KEEP = 0.75
#: Rows that a group's pool counts for: ten for each coordinate.
PRIOR = 60
#: Fall of a logarithm of a determinant below which a group has settled.
SETTLED = 1e-3
#: Standard deviations added to each coordinate, so that what varies no more than this between sound texts
#: is no outlier: word length by an eighth, rates by a third (symbols, capitals, marks), repeats by 0.8
#: (a factor of 2.2), since most sound texts have none and some a refrain.
FLOORS = (0.12, 0.30, 0.35, 0.35, 0.80, 0.80)
#: Share of a normal sample beyond the cutoff of the squared distance: one sound text in a billion, as the
#: logarithms' tails are heavier than normal ones and sound texts are to stay.
BEYOND = 1e-9

_UPPER = re.compile("[A-ZÀ-ÖØ-Þ]")
_SYMBOLS = "#*$%&|<>"


def repeat_words(words: list[str]) -> int:
    """Words covered by three-word windows that occur twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    two = ids[:-2] * len(number) + ids[1:-1]
    if len(number) > 1 << 20:
        two = np.unique(two, return_inverse=True)[1]
    _, window, count = np.unique(two * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k:n + k] |= again
    return int(covered.sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The fields of STATS for one text."""
    if not text:
        return (0,) * 8
    words = words_of(text)
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += bool(line.strip(" \t\n\x0b\x0c\r"))
        seen.add(line)
    return (len(words), len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
            sum(map(text.count, _SYMBOLS)), again, repeat_words(words),
            len(_UPPER.findall(text)), sum(map(text.count, ".,;:!?")), len(set(words)))


def with_stats(docs: DataFrame, text_col: str = "text", name: str = "stats") -> DataFrame:
    """``docs`` with a struct of the statistics of its whole texts (null: none)."""
    names = [x.split()[0] for x in STATS.split(", ")]

    @F.pandas_udf(STATS)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_stats(t) for t in texts], columns=names)

    return shipped(docs).withColumn(name, of(F.col(text_col)))


def vector(s: str = "stats") -> list[Column]:
    """Transformed statistics: logarithms of smoothed rates, so that each spreads alike at any length."""
    c = lambda name: F.col(f"{s}.{name}").cast("double")
    words, chars = c("n_words") + 20, c("word_chars") + 100

    def rate(x: Column, per: Column, prior: float) -> Column:
        return F.log((x + prior * 20) / per)

    return [F.log(chars / words), rate(c("n_symbols"), words, 0.05), rate(c("n_upper"), words, 0.15),
            rate(c("n_marks"), words, 0.25), rate(c("n_repeat_words"), words, 0.1),
            rate(c("n_dup_lines") * 20, words, 0.1)]


def base_failed(s: str = "stats") -> Column:
    n = F.col(f"{s}.n_words")
    return (n < 50) | (F.col(f"{s}.n_repeat_words") * 100 > n * 50)


def chi2_quantile(p: float, k: int) -> float:
    """Wilson and Hilferty's approximation."""
    return k * (1 - 2 / (9 * k) + NormalDist().inv_cdf(p) * (2 / (9 * k)) ** 0.5) ** 3


def _stepped(state: DataFrame, floors: tuple[float, ...], prior: float) -> DataFrame:
    """The groups' state after a concentration step.

    ``state`` has the columns of _STATE and, of the rows nearest to a group's estimate, n, s (sums) and
    ss (sums of products, upper triangle); null for groups that had settled. ``pool_center`` and
    ``pool_cov`` are what an estimate is shrunk towards; null: nothing.
    """
    p = len(floors)
    upper = np.triu_indices(p)
    ridge = np.diag(np.square(floors))
    names = [x.split()[0] for x in _STATE.split(", ")]

    def estimate(n: float, s: np.ndarray, ss: np.ndarray, pool, spread) -> tuple[np.ndarray, np.ndarray]:
        center = np.asarray(s) / n
        second = np.zeros((p, p))
        second[upper] = np.asarray(ss) / n
        second = second + np.triu(second, 1).T
        cov = second - np.outer(center, center)
        low, axes = np.linalg.eigh((cov + cov.T) / 2)
        cov = (axes * np.maximum(low, 0)) @ axes.T + ridge
        if pool is not None:
            own = n / (n + prior)
            center = own * center + (1 - own) * np.asarray(pool)
            cov = own * cov + (1 - own) * np.asarray(spread).reshape(p, p)
        return center, cov

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                row["falls"] = False
                if row["s"] is not None:
                    center, cov = estimate(row["n"], row["s"], row["ss"], row["pool_center"], row["pool_cov"])
                    logdet = float(np.linalg.slogdet(cov)[1])
                    row["falls"] = bool(row["logdet"] - logdet > SETTLED)
                    if logdet < row["logdet"]:
                        row.update(center=center.tolist(), cov=cov.ravel().tolist(), logdet=logdet,
                                   precision=np.linalg.inv(cov).ravel().tolist())
                out.append(tuple(row[c] for c in names))
            yield frame(out, names)

    return state.mapInPandas(step, _STATE)


def _distance(p: int) -> Column:
    """Squared distance of x0.. from center; one parsed text, as hundreds of column calls cost seconds a step."""
    gap = [f"(x{i} - center[{i}])" for i in range(p)]
    row = [" + ".join(f"precision[{i * p + j}] * {gap[j]}" for j in range(p)) for i in range(p)]
    return F.expr(" + ".join(f"{g} * ({r})" for g, r in zip(gap, row)))


def _moments(rows: DataFrame, p: int) -> DataFrame:
    return rows.groupBy("grp").agg(
        F.expr("cast(count(1) as double) as n"),
        F.expr(f"array({', '.join(f'sum(x{i})' for i in range(p))}) as s"),
        F.expr(f"array({', '.join(f'sum(x{i} * x{j})' for i in range(p) for j in range(i, p))}) as ss"))


def mcd(rows: DataFrame, pool: DataFrame | None = None, floors: tuple[float, ...] = FLOORS, keep: float = KEEP,
        prior: float = PRIOR) -> DataFrame:
    """grp, center, cov, precision, scale: minimum-covariance-determinant estimates of x0.. within grp.

    ``pool``: the same columns for the values of the rows' column ``parent``, towards
    which a group is shrunk. ``scale`` makes the median squared distance that of a
    normal sample. A group keeps its lowest determinant; the steps end when none falls.
    """
    p = len(floors)
    xs = [f"x{i}" for i in range(p)]
    parent = F.lit(None).cast("string") if pool is None else F.col("parent")
    rows = rows.select("grp", parent.alias("parent"), *xs)
    middle = stage(rows.groupBy("grp").agg(
        F.first("parent").alias("parent"), F.count(F.lit(1)).alias("rows"),
        F.expr(f"array({', '.join(f'percentile_approx({x}, 0.5, 1000)' for x in xs)}) as m")))
    narrow = few_rows(middle)
    apart = rows.join(narrow(middle.select("grp", "m")), "grp").groupBy("grp").agg(F.expr(
        f"array({', '.join(f'percentile_approx(abs({x} - m[{i}]), 0.5, 1000)' for i, x in enumerate(xs))}) as d"))
    start = middle.join(narrow(apart), "grp")
    if pool is None:
        start = start.selectExpr("*", "cast(null as array<double>) as pool_center",
                                 "cast(null as array<double>) as pool_cov", "cast(null as double) as pool_scale")
    else:
        start = start.join(narrow(pool.selectExpr("grp as parent", "center as pool_center", "cov as pool_cov",
                                                  "scale as pool_scale")), "parent")
    inverse = [f"1 / (pow(d[{i}] * 1.4826D, 2) + {f * f!r}D)" for i, f in enumerate(floors)]
    now = stage(start.selectExpr(
        "grp", "rows", "m as center", "cast(null as array<double>) as cov",
        f"array({', '.join(inverse[i] if i == j else '0D' for i in range(p) for j in range(p))}) as precision",
        "double('Infinity') as logdet", "true as falls", "pool_center", "pool_cov", "pool_scale"))
    distance = _distance(p)
    while now.where("falls").limit(1).count():
        # Groups that have settled are read no more.
        far = rows.join(narrow(now.where("falls").select("grp", "center", "precision")), "grp").withColumn("d2", distance)
        cut = far.groupBy("grp").agg(F.percentile_approx("d2", keep, 1000).alias("cut"))
        moments = _moments(far.join(narrow(cut), "grp").where("d2 <= cut"), p)
        now = stage(_stepped(now.join(narrow(moments), "grp", "left"), floors, prior))
    far = rows.join(narrow(now.select("grp", "center", "precision")), "grp").withColumn("d2", distance)
    half = far.groupBy("grp").agg(F.percentile_approx("d2", 0.5, 1000).alias("half"))
    own = F.greatest(F.col("half") / chi2_quantile(0.5, p), F.lit(1.0))
    share = F.col("rows") / (F.col("rows") + F.lit(prior))
    return now.join(narrow(half), "grp").select(
        "grp", "center", "cov", "precision",
        F.when(F.col("pool_scale").isNull(), own).otherwise(share * own + (1 - share) * F.col("pool_scale")).alias("scale"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", beyond: float = BEYOND, prior: float = PRIOR) -> DataFrame:
    """doc_id, stats, base_failed, grp, distance, kept of every document.

    Null texts have no words and fail the base rules; null languages and sources
    are values like others. Every document that the base rules keep has a
    distance: from the estimate of its language and source, which counts ``prior``
    rows of the language's. Very long texts are measured whole; an empty table gives
    no rows. Rows with equal ids stay rows. Other columns of the input are not read.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    slim = with_stats(slim).drop("text")
    x = vector()
    slim = stage(slim.withColumn("base_failed", base_failed()).select(
        "*", *(c.alias(f"x{i}") for i, c in enumerate(x))))
    sound = slim.where("NOT base_failed")
    fit = None
    for group, parent in ((F.lit("*"), None), (F.to_json(F.struct("lang")), F.lit("*")),
                          (F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang")))):
        rows = sound.withColumn("grp", group)
        fit = stage(mcd(rows if parent is None else rows.withColumn("parent", parent), fit, prior=prior))
    cutoff = chi2_quantile(1 - beyond, len(x))
    judged = sized_join(rows, fit, "grp").withColumn("distance", _distance(len(x)) / F.col("scale"))
    judged = judged.select("doc_id", "stats", "base_failed", "grp", "distance",
                           (F.col("distance") <= cutoff).alias("kept"))
    return judged.unionByName(slim.where("base_failed").select(
        "doc_id", "stats", "base_failed", F.lit(None).cast("string").alias("grp"),
        F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept")))
