"""Errors, intervals and left-out fits of the multinomial product models.

Rows are coded by the model's own encoder and counted by equal coding, so each pass reads one row
for each distinct combination of predictors and class. A task adds up the blocks of the
information matrix (numpy), a second stage adds the tasks' blocks, and the driver sees some
FAN matrices of the model's own size, whatever the number of rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.distributions import bound, normal_cdf
from ..operators.statistics import Z95
from ..sources.io import stage
from .models import feature_names, labels_of, predictors, scorable

# Python workers get this module's code with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tasks of the second stage of a sum; Newton steps at most.
FAN, STEPS = 16, 25
#: A direction counts as unknown where its information is below this share of the largest, or worth fewer rows than this.
FLAT, LEAST = 1e-10, 1e-4


@dataclass
class Fit:
    """A multinomial model at its maximum: coefficients of each class against the first, and their covariance.

    ``unknown`` spans what the data do not determine: levels that have a column too many, and
    directions in which the likelihood only rises (a class never seen at a level).
    """

    model: PipelineModel
    classes: list[str]
    names: list[str]
    coefficients: np.ndarray
    covariance: np.ndarray
    #: Orthonormal directions that the data say nothing about, of the coefficients of one class after another.
    unknown: np.ndarray
    loglik: float
    n: int
    converged: bool

    @property
    def parameters(self) -> int:
        return self.coefficients.size - self.unknown.shape[1]


def coded(model: PipelineModel, rows: DataFrame, x: str = "x") -> DataFrame:
    """The rows with ``x``: one and the encoded predictors, null where the model cannot score them."""
    ok = scorable(rows, model.formula)
    text = {f.name for f in rows.schema if f.dataType.simpleString() == "string"}
    numbers = [c for c in predictors(model.formula) if c not in text]
    held = rows.withColumn("__ok", ok).withColumns({f"__was_{c}": F.col(c) for c in numbers}).na.fill(0, numbers)
    out = model.stages[1].transform(held).withColumn(
        x, F.when(F.col("__ok"), F.concat(F.array(F.lit(1.0)), vector_to_array("features"))))
    return out.drop("features", "__ok", *numbers).withColumnsRenamed({f"__was_{c}": c for c in numbers})


def _counted(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """x, y, m: distinct codings with their class's number, and how many rows have them."""
    label = model.formula.split("~", 1)[0].strip()
    at = F.array_position(F.array(*map(F.lit, labels_of(model))), F.col(label)).cast("int") - 1
    found = coded(model, rows).select("x", at.alias("y")).where("x IS NOT NULL AND y >= 0")
    return stage(found.groupBy("x", "y").agg(F.count(F.lit(1)).alias("m")))


def _probabilities(x: np.ndarray, b: np.ndarray) -> np.ndarray:
    eta = np.concatenate([np.zeros((len(x), 1)), x @ b.T], axis=1)
    eta -= eta.max(axis=1, keepdims=True)
    p = np.exp(eta)
    return p / p.sum(axis=1, keepdims=True)


def _sums(counted: DataFrame, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Information, score and log-likelihood at coefficients ``b``, block by block."""
    k, q = b.shape

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x, y, m = np.vstack(batch["x"]), batch["y"].to_numpy(), batch["m"].to_numpy(dtype=float)
            p = _probabilities(x, b)
            hit = (y[:, None] == np.arange(1, k + 1)) * 1.0
            score = ((hit - p[:, 1:]) * m[:, None]).T @ x
            log = float(m @ np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)))
            found = {(-1, 0): np.append(score.ravel(), log)}
            for i in range(k):
                for j in range(i + 1):
                    w = m * p[:, i + 1] * ((i == j) - p[:, j + 1])
                    found[i, j] = ((x * w[:, None]).T @ x).ravel()
            for key, v in found.items():
                held[key] = held[key] + v if key in held else v
        yield pd.DataFrame([(i, j, v.tobytes()) for (i, j), v in held.items()], columns=["i", "j", "v"])

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, j, v in zip(batch["i"], batch["j"], batch["v"]):
                v = np.frombuffer(v)
                held[i, j] = held[i, j] + v if (i, j) in held else v
        yield pd.DataFrame([(i, j, v.tobytes()) for (i, j), v in held.items()], columns=["i", "j", "v"])

    kind = "i int, j int, v binary"
    parts = counted.mapInPandas(blocks, kind).repartition(FAN).mapInPandas(added, kind)
    info, score = np.zeros((k, q, k, q)), np.zeros(k * q + 1)
    for r in parts.collect():
        v = np.frombuffer(bytes(r["v"]))
        if r["i"] < 0:
            score = score + v
        else:
            info[r["i"], :, r["j"], :] += v.reshape(q, q)
            if r["i"] != r["j"]:
                info[r["j"], :, r["i"], :] += v.reshape(q, q).T
    return info.reshape(k * q, k * q), score[:-1], float(score[-1])


def _inverse(info: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pseudo-inverse of an information matrix, and the directions it leaves out.

    ``size`` is each predictor's root mean square, so that information counts rows.
    """
    scale = np.tile(np.where(size > 0, size, 1.0), len(info) // len(size))
    worth, axes = np.linalg.eigh(info / np.outer(scale, scale))
    known = worth > max(FLAT * worth.max(), LEAST)
    half = axes[:, known] / np.sqrt(worth[known])
    lost = axes[:, ~known] / scale[:, None]
    inverse = half @ half.T / np.outer(scale, scale)
    return inverse, np.linalg.qr(lost)[0] if lost.size else np.zeros((len(info), 0))


def maximum(model: PipelineModel, rows: DataFrame) -> Fit:
    """The model's coefficients brought to the maximum of the likelihood (no penalty) by Newton steps, with their covariance.

    A predictor's levels all have columns; contrasts between levels are not affected by the one too many.
    ``converged`` is false if the steps run out. Rows are counted by equal coding before the first step.
    """
    counted = _counted(model, rows)
    lr = model.stages[-1]
    whole = np.column_stack([lr.interceptVector.toArray(), lr.coefficientMatrix.toArray()])
    b, converged = whole[1:] - whole[0], False
    squares = [F.sum(F.col("m") * F.pow(F.col("x")[j], F.lit(2))) for j in range(b.shape[1])]
    n, *squares = counted.agg(F.sum("m"), *squares).first()
    size = np.sqrt(np.array([s or 0.0 for s in squares]) / max(n or 0, 1))
    for _ in range(STEPS):
        info, score, loglik = _sums(counted, b)
        inverse, unknown = _inverse(info, size)
        step = inverse @ score
        if score @ step < 1e-16 * max(1.0, abs(loglik)):
            converged = True
            break
        b = b + (step * min(1.0, 5.0 / np.abs(step).max())).reshape(b.shape)
    return Fit(model, labels_of(model), ["(intercept)", *feature_names(model, rows)], b, inverse, unknown, loglik, n or 0, converged)


def _contrasts(fit: Fit, rows: DataFrame) -> list[tuple[str, np.ndarray]]:
    """(name, weights): numbers as they are, a text's levels against its first, by the encoder's names."""
    text = {f.name for f in rows.schema if f.dataType.simpleString() == "string"}
    out, first = [("(intercept)", np.eye(len(fit.names))[0])], {}
    for j, name in enumerate(fit.names):
        if not j:
            continue
        weights = np.eye(len(fit.names))[j]
        owner = next((c for c in predictors(fit.model.formula) if c in text and ":" not in name and name.startswith(f"{c}_")), None)
        if owner:
            if owner not in first:
                first[owner] = j
                out[0][1][j] += 1  # the intercept is that of the first levels
                continue
            weights[first[owner]] = -1
        out.append((name, weights))
    return out


def odds_ratio_table(fit: Fit, rows: DataFrame) -> DataFrame:
    """Each class against the first, each text level against its first: log odds ratio, odds ratio, error, z, p-value, 95 % interval.

    What the data cannot tell (a class or interaction never seen at a level) is null. The table
    has classes times predictors rows.
    """
    table, q = [], len(fit.names)
    for k in range(len(fit.classes) - 1):
        for name, weights in _contrasts(fit, rows):
            c = np.zeros(fit.coefficients.size)
            c[k * q:(k + 1) * q] = weights
            b, var = float(c @ fit.coefficients.ravel()), float(c @ fit.covariance @ c)
            told = np.abs(fit.unknown.T @ c).max(initial=0.0) < 1e-6 and var > 0
            table.append((fit.classes[k + 1], name, b if told else None, math.sqrt(var) if told else None))
    told = rows.sparkSession.createDataFrame(table, "category string, predictor string, coefficient double, se double")
    b, se = F.col("coefficient"), F.col("se")
    return told.select(
        "category", "predictor", "coefficient", F.exp(b).alias("odds_ratio"), "se", (b / se).alias("z"),
        (2 * normal_cdf(-F.abs(b / se))).alias("p_value"), F.exp(b - Z95 * se).alias("lo"), F.exp(b + Z95 * se).alias("hi"))


def effect_intervals(fit: Fit, rows: DataFrame, levels: Mapping[str, Sequence], held: Sequence[str] = ()) -> DataFrame:
    """Predictions over every combination of ``levels``, other predictors at their mean, with errors and 95 % intervals.

    Errors by the delta method; intervals on the scale of log odds, so they stay within 0 and 1.
    """
    label = fit.model.formula.split("~", 1)[0].strip()
    grid = rows.agg(*[F.avg(c).alias(c) for c in held], F.first(label, ignorenulls=True).alias(label))
    for c, values in levels.items():
        grid = grid.withColumn(c, F.explode(F.array(*[F.lit(v) for v in values])))
    b, cov, classes = fit.coefficients, fit.covariance, fit.classes

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.vstack(batch["x"])
            p, out = _probabilities(x, b), []
            for r in range(len(x)):
                for k in range(len(classes)):
                    # Derivative of the log odds of class k by the coefficients of the others.
                    pull = ((np.arange(1, len(classes)) == k) - p[r, 1:]) / max(1 - p[r, k], 1e-300)
                    g = np.outer(pull, x[r]).ravel()
                    out.append((*(batch[c].iloc[r] for c in levels), classes[k], p[r, k], math.sqrt(max(g @ cov @ g, 0.0))))
            yield pd.DataFrame(out, columns=[*levels, "category", "probability", "__se"])

    kinds = dict(grid.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in levels), "category string, probability double, __se double"])
    found = coded(fit.model, grid).select(*levels, "x").mapInPandas(predict, schema)
    p, least = F.col("probability"), F.lit(1e-300)
    odds = F.ln(F.greatest(p, least)) - F.ln(F.greatest(1 - p, least))

    def share(logit):
        return F.lit(1.0) / (1 + F.exp(-logit))

    return found.select(*levels, "category", "probability", (p * (1 - p) * F.col("__se")).alias("se"),
                        share(odds - Z95 * F.col("__se")).alias("lo"), share(odds + Z95 * F.col("__se")).alias("hi"))


def probabilities(fit: Fit, rows: DataFrame) -> DataFrame:
    """The rows with ``probabilities``, in the order of the fit's classes; null where a predictor is. No Python runs."""
    lines = F.expr("array(" + ", ".join("array(" + ", ".join(f"{v!r}D" for v in b) + ")" for b in fit.coefficients.tolist()) + ")")
    x = F.col("__x")
    eta = F.transform(lines, lambda b: F.aggregate(F.zip_with(x, b, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v))
    eta = F.concat(F.array(F.lit(0.0)), eta)
    # Each class's share of the sum, by differences that cannot overflow.
    share = bound(eta, lambda e: F.transform(e, lambda own: F.lit(1.0) / F.aggregate(
        e, F.lit(0.0), lambda s, v: s + F.exp(F.least(v - own, F.lit(700.0))))))
    return coded(fit.model, rows, "__x").withColumn("probabilities", F.when(x.isNotNull(), share)).drop("__x")


def score_long(fit: Fit, rows: DataFrame) -> DataFrame:
    """One row per input row and class; a row that cannot be scored gives one with null category and probability."""
    classes = F.array(*map(F.lit, fit.classes))
    return probabilities(fit, rows).select(*rows.columns, F.posexplode_outer("probabilities").alias("__i", "probability")).withColumn(
        "category", F.get(classes, F.col("__i"))).drop("__i")


def fit_report(fits: Mapping[str, Fit]) -> DataFrame:
    """One row per model: rows, free parameters, log-likelihood, log-loss, whether it converged."""
    rows = [(k, f.n, f.parameters, f.loglik, -f.loglik / f.n if f.n else None, f.converged) for k, f in fits.items()]
    return SparkSession.active().createDataFrame(rows, "model string, n long, parameters long, loglik double, log_loss double, converged boolean")


def loo_compare(fits: Mapping[str, Fit], rows: DataFrame) -> DataFrame:
    """Log-probability of every row by a fit without it, summed, and each model's distance to the best with its error.

    The fit without a row is one Newton step from the whole fit: with M the row's leverages and A its
    information, its linear predictors move by (I - M A)^-1 M (y - p). Rows that one model
    cannot score are left out for all. Columns: model, n, elpd, se, parameters (effective: the
    whole fit's log-likelihood minus elpd), elpd_diff, se_diff.
    """
    names = list(fits)
    label = next(iter(fits.values())).model.formula.split("~", 1)[0].strip()
    whole = rows
    for i, fit in enumerate(fits.values()):
        whole = coded(fit.model, whole, f"__x{i}")
    xs = [f"__x{i}" for i in range(len(names))]
    classes = next(iter(fits.values())).classes
    at = F.array_position(F.array(*map(F.lit, classes)), F.col(label)).cast("int") - 1
    cells = whole.select(*xs, at.alias("y")).where("y >= 0").na.drop(subset=xs).groupBy(*xs, "y").agg(F.count(F.lit(1)).alias("m"))
    held = [(f.coefficients, f.covariance.reshape(*f.coefficients.shape, *f.coefficients.shape)) for f in fits.values()]

    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            y = batch["y"].to_numpy()
            out = {"m": batch["m"].to_numpy()}
            for i, (b, cov) in enumerate(held):
                x = np.vstack(batch[f"__x{i}"])
                p = _probabilities(x, b)
                r = (y[:, None] == np.arange(1, len(b) + 1)) - p[:, 1:]
                lever = np.einsum("ni,kilj,nj->nkl", x, cov, x, optimize=True)
                own = p[:, 1:, None] * (np.eye(len(b)) - p[:, None, 1:])
                moved = np.linalg.solve(np.eye(len(b)) - lever @ own, (lever @ r[:, :, None]))[:, :, 0]
                eta = np.concatenate([np.zeros((len(x), 1)), x @ b.T - moved], axis=1)
                top = eta.max(axis=1)
                out[f"l{i}"] = eta[np.arange(len(y)), y] - top - np.log(np.exp(eta - top[:, None]).sum(axis=1))
                out[f"f{i}"] = np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))
            yield pd.DataFrame(out)

    span = range(len(names))
    kind = "m long, " + ", ".join(f"l{i} double, f{i} double" for i in span)
    m = F.col("m")
    sums = cells.mapInPandas(left_out, kind).agg(
        F.sum("m").alias("n"), *(F.sum(m * F.col(f"{c}{i}")).alias(f"{c}{i}") for i in span for c in "lf"),
        *(F.sum(m * F.col(f"l{i}") * F.col(f"l{j}")).alias(f"l{i}_{j}") for i in span for j in range(i + 1))).first()
    n = sums["n"] or 0
    if not n:
        return _compared(rows.sparkSession, [])
    best = max(span, key=lambda i: sums[f"l{i}"])

    def second(i: int, j: int) -> float:
        return sums[f"l{max(i, j)}_{min(i, j)}"]

    out = []
    for i in span:
        elpd, diff = sums[f"l{i}"], sums[f"l{i}"] - sums[f"l{best}"]
        spread = second(i, i) - 2 * second(i, best) + second(best, best) - diff * diff / n
        own = second(i, i) - elpd * elpd / n
        scale = n / max(n - 1, 1)
        out.append((names[i], n, elpd, math.sqrt(max(own * scale, 0.0)), sums[f"f{i}"] - elpd, diff,
                    math.sqrt(max(spread * scale, 0.0)) if i != best else 0.0))
    return _compared(rows.sparkSession, out)


def _compared(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, "model string, n long, elpd double, se double, parameters double, elpd_diff double, se_diff double")
