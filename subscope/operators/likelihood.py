"""Maximum likelihood from sufficient statistics: counts with a dispersion, and random intercepts.

The data are read once. What the likelihood needs of them is a small staged table (values with
their counts; group sizes with sums over the groups of that size), and every step of the
search is an aggregate over that table. The driver sees a few numbers a step.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distributions import bound, digamma, log_gamma, normal_cdf, trigamma
from ..sources.io import stage
from .statistics import Z95, pair_columns

#: Steps of Newton's method at most, and the largest step on the logarithmic scale.
STEPS, LARGEST = 60, 2.0
TOLERANCE = 1e-7


# --- counts -------------------------------------------------------------------------------


def negbin_fit(df: DataFrame, value: str, by: Sequence[str], shape_by: Sequence[str] | None = None) -> DataFrame:
    """Negative-binomial fit: a mean for each group of ``by``, a shape for each of ``shape_by`` (``by`` if not given).

    Columns: by, n, mean, theta (the shape: variance is mean + mean^2 / theta), se_log_mean,
    se_theta, loglik (of all groups that share the shape). The likelihood needs the values' counts
    alone. Groups without over-dispersion have no finite shape: theta and what follows
    from it are null, and se_log_mean is Poisson's. Null and negative values are left out.
    """
    wanted = list(by)
    if shape_by is not None and not shape_by:
        df, by, shape_by = df.withColumn("__all", F.lit(1)), [*by, "__all"], ["__all"]
    by, shape_by = list(by), list(by if shape_by is None else shape_by)
    y = F.col(value).cast("double")
    hist = stage(df.where(y >= 0).groupBy(*by, y.alias("__y")).agg(F.count(F.lit(1)).alias("__n")))
    means = stage(hist.groupBy(*by).agg(
        F.sum("__n").alias("n"), (F.sum(F.col("__y") * F.col("__n")) / F.sum("__n")).alias("mean")))
    rows = hist.join(means, by)
    # Start where the pooled moments agree.
    spread = F.sum(F.col("__n") * F.pow(F.col("__y") - F.col("mean"), 2))
    squares, firsts = F.sum(F.col("__n") * F.col("mean") * F.col("mean")), F.sum(F.col("__n") * F.col("mean"))
    fits = stage(rows.groupBy(*shape_by).agg(spread.alias("s"), squares.alias("m2"), firsts.alias("m1")).select(
        *shape_by, F.when(F.col("s") > F.col("m1") * (1 + 1e-9), F.ln(F.col("m2") / (F.col("s") - F.col("m1")))).alias("__phi")))
    theta = F.exp("__phi")
    score, curve = _shape_score(theta)
    for _ in range(STEPS):
        found = rows.join(fits.where("__phi IS NOT NULL"), shape_by).groupBy(*shape_by, "__phi").agg(
            F.sum(F.col("__n") * score).alias("s"), F.sum(F.col("__n") * curve).alias("c"))
        # On the scale of log theta; uphill where the curvature has the wrong sign.
        g, h = theta * F.col("s"), theta * theta * F.col("c") + theta * F.col("s")
        step = F.when(h < 0, -g / h).otherwise(F.signum(g))
        step = F.greatest(F.least(step, F.lit(LARGEST)), F.lit(-LARGEST))
        fits = stage(found.select(*shape_by, (F.col("__phi") + step).alias("__phi"), F.abs(step).alias("__step")))
        if fits.where(F.col("__step") > TOLERANCE).isEmpty():
            break
    fits = fits.select(*shape_by, "__phi")
    final = rows.join(fits, shape_by).groupBy(*shape_by, "__phi").agg(
        F.sum(F.col("__n") * curve).alias("__c"), F.sum(F.col("__n") * _negbin_log(F.col("__y"), F.col("mean"), theta)).alias("loglik"))
    shapes = final.select(*shape_by, theta.alias("theta"), F.sqrt(F.lit(-1.0) / F.col("__c")).alias("se_theta"), "loglik")
    out = means.join(shapes, shape_by, "left")
    excess = F.coalesce(F.lit(1.0) / F.col("theta"), F.lit(0.0))
    se = F.when(F.col("mean") > 0, F.sqrt((F.lit(1.0) / F.col("mean") + excess) / F.col("n")))
    return out.select(*wanted, "n", "mean", "theta", se.alias("se_log_mean"), "se_theta", "loglik")


def _shape_score(theta: Column) -> tuple[Column, Column]:
    """First and second derivative by theta of a value's log-likelihood, at the group's mean."""
    y, m = F.col("__y"), F.col("mean")
    first = digamma(y + theta) - digamma(theta) + F.ln(theta / (theta + m)) + 1 - (y + theta) / (theta + m)
    second = (trigamma(y + theta) - trigamma(theta) + F.lit(1.0) / theta - F.lit(2.0) / (theta + m)
              + (y + theta) / ((theta + m) * (theta + m)))
    return first, second


def _negbin_log(y: Column, mean: Column, theta: Column) -> Column:
    """Log-probability of a count."""
    seen = F.when(y > 0, y * F.ln(mean / (theta + mean))).otherwise(F.lit(0.0))
    return log_gamma(y + theta) - log_gamma(theta) - log_gamma(y + 1) + theta * F.ln(theta / (theta + mean)) + seen


def mean_difference(fits: DataFrame, by: str, a, b) -> DataFrame:
    """Mean of b minus mean of a of two fitted groups: estimate, standard error, 95 % interval, P(difference > 0)."""
    p = pair_columns(fits.withColumn("__v", F.pow(F.col("mean") * F.col("se_log_mean"), 2)), by, a, b, ["mean", "__v"])
    diff, se = F.col("mean_b") - F.col("mean_a"), F.sqrt(F.col("__v_a") + F.col("__v_b"))
    told = p.select("mean_a", "mean_b", diff.alias("diff"), se.alias("se"))
    return told.select("*", (F.col("diff") - Z95 * F.col("se")).alias("lo"), (F.col("diff") + Z95 * F.col("se")).alias("hi"),
                       normal_cdf(F.col("diff") / F.col("se")).alias("p_positive"))


# --- random intercepts --------------------------------------------------------------------

#: Ratios of the two variances that a round of the search tries, and how far it reaches on the natural logarithm's scale.
GRID, REACH, ROUNDS = 33, 16.0, 9


def _size_table(df: DataFrame, value: Column, level: str, group: str, levels: Sequence) -> DataFrame:
    """Sums over the groups of each size: what a random-intercept likelihood needs of the rows."""
    p = range(len(levels))
    per = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("size"), F.sum(value).alias("s"), F.sum(value * value).alias("q"),
        *(F.count(F.when(F.col(level) == x, 1)).cast("double").alias(f"n{i}") for i, x in enumerate(levels)),
        *(F.sum(F.when(F.col(level) == x, value).otherwise(0.0)).alias(f"s{i}") for i, x in enumerate(levels)))
    return stage(per.groupBy(F.col("size").cast("double").alias("size")).agg(
        F.count(F.lit(1)).cast("double").alias("groups"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s")).alias("ss"),
        *(F.sum(f"n{i}").alias(f"n{i}") for i in p), *(F.sum(f"s{i}").alias(f"s{i}") for i in p),
        *(F.sum(F.col(f"n{i}") * F.col("s")).alias(f"ns{i}") for i in p),
        *(F.sum(F.col(f"n{i}") * F.col(f"n{j}")).alias(f"nn{i}_{j}") for i in p for j in p if i <= j)))


class _Profile:
    """The likelihood of one ratio of variances, the other parameters at their best."""

    def __init__(self, ratio: float, sums, p: int, reml: bool):
        self.ratio = ratio
        rows = float(sum(sums[f"n{i}"] for i in range(p)))

        def square(w: str) -> np.ndarray:
            return np.array([[sums[f"{w}nn{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])

        def line(w: str) -> np.ndarray:
            return np.array([sums[f"{w}ns{i}"] for i in range(p)])

        xvx = np.diag([float(sums[f"n{i}"]) for i in range(p)]) - square("w")
        xvy = np.array([float(sums[f"s{i}"]) for i in range(p)]) - line("w")
        inverse = np.linalg.inv(xvx)
        self.beta = inverse @ xvy
        rss = max(float(sums["q"] - sums["wss"] - xvy @ self.beta), 0.0)
        # What a group's residuals sum to, squared and weighted by the weight's derivative.
        pull = float(sums["dss"] - 2 * self.beta @ line("d") + self.beta @ square("d") @ self.beta)
        self.free = rows - p if reml else rows
        self.residual = rss / self.free
        self.covariance = self.residual * inverse
        self.loglik = -0.5 * (self.free * (math.log(2 * math.pi * self.residual) + 1) + sums["det"]) if rss else math.inf
        self.slope = -0.5 * (sums["slope"] - pull / self.residual) if rss else 0.0
        if reml:
            self.loglik -= 0.5 * np.linalg.slogdet(xvx)[1]
            self.slope += 0.5 * np.trace(inverse @ square("d"))


def _profiles(table: DataFrame, ratios: Sequence[float], p: int, reml: bool) -> list[_Profile]:
    """Profiles of several ratios, by one pass over the table of sizes."""
    r, n = F.col("r"), F.col("size")
    w, d = r / (1 + n * r), F.lit(1.0) / ((1 + n * r) * (1 + n * r))
    weighted = ["ss", *(f"ns{i}" for i in range(p)), *(f"nn{i}_{j}" for i in range(p) for j in range(p) if i <= j)]
    points = F.expr("array(" + ", ".join(f"{x!r}D" for x in ratios) + ")")
    rows = table.withColumn("r", F.explode(points)).groupBy("r").agg(
        F.sum("q").alias("q"), *(F.sum(f"n{i}").alias(f"n{i}") for i in range(p)), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(p)),
        *(F.sum(w * F.col(c)).alias(f"w{c}") for c in weighted), *(F.sum(d * F.col(c)).alias(f"d{c}") for c in weighted),
        F.sum(F.col("groups") * F.log1p(n * r)).alias("det"), F.sum(F.col("groups") * n / (1 + n * r)).alias("slope"))
    return sorted((_Profile(x["r"], x, p, reml) for x in rows.collect()), key=lambda f: f.ratio)


def random_intercept(df: DataFrame, value: str, level: str, group: str, levels: Sequence, reml: bool = False) -> DataFrame:
    """``value ~ 0 + level + (1 | group)``: a mean for each level, and the variances between and within groups.

    One row a level: level, n_rows, n_groups, mean, se, lo, hi (95 %), sd_group, sd_residual,
    icc (the share of the variance that groups make), loglik; restricted likelihood with ``reml``.
    Rows are summed by group, then groups by size: the likelihood of a ratio of variances is a sum
    over the sizes, so the search reads a table as long as there are different group sizes. A group may
    hold any share of the rows. It ends where the likelihood's slope by the ratio changes sign, or
    at no variance between groups. Rows with a null value or group, or another level, are left out.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v) & F.col(group).isNotNull() & F.col(level).isin(list(levels)))
    seen = {r[0]: r[1] for r in rows.groupBy(level).agg(F.avg(v)).collect()}
    used = [x for x in levels if x in seen]
    if not used:
        return _told(df.sparkSession, [])
    # Sums of squares about the levels' own means lose no digits.
    centre = F.lit(0.0)
    for x in used:
        centre = F.when(F.col(level) == x, F.lit(seen[x])).otherwise(centre)
    table = _size_table(rows.withColumn("__v", v - centre), F.col("__v"), level, group, used)
    p = len(used)
    best = _search(table, p, reml)
    spread = best.ratio * best.residual
    n_groups = int(table.agg(F.sum("groups")).first()[0])
    counts = table.agg(*(F.sum(f"n{i}") for i in range(p))).first()
    out = []
    for i, x in enumerate(used):
        mean, se = seen[x] + float(best.beta[i]), math.sqrt(best.covariance[i, i])
        out.append((x, int(counts[i]), n_groups, mean, se, mean - Z95 * se, mean + Z95 * se, math.sqrt(spread),
                    math.sqrt(best.residual), best.ratio / (1 + best.ratio), float(best.loglik)))
    return _told(df.sparkSession, out)


def _search(table: DataFrame, p: int, reml: bool) -> _Profile:
    zero = _profiles(table, [0.0], p, reml)[0]
    if not zero.residual:
        return zero
    low, high = -REACH, REACH
    found = [zero, *_profiles(table, _ratios(low, high), p, reml)]
    top = max(range(len(found)), key=lambda i: found[i].loglik)
    if not top:
        return zero  # the likelihood falls from the start
    best, places = found[top], np.linspace(low, high, GRID)
    low, high = places[max(top - 2, 0)], places[min(top, GRID - 1)]
    for _ in range(ROUNDS):
        found, places = _profiles(table, _ratios(low, high), p, reml), np.linspace(low, high, GRID)
        # Where the slope turns from up to down.
        turn = next((i for i in range(GRID - 1) if found[i].slope > 0 >= found[i + 1].slope), None)
        if turn is None:
            return max([best, *found], key=lambda f: f.loglik)
        best = min(found[turn:turn + 2], key=lambda f: abs(f.slope))
        low, high = places[turn], places[turn + 1]
        if high - low < 1e-13:
            break
    return best


def _ratios(low: float, high: float) -> list[float]:
    return [float(r) for r in np.exp(np.linspace(low, high, GRID))]


def _told(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, "level string, n_rows long, n_groups long, mean double, se double, lo double, hi double, "
                                       "sd_group double, sd_residual double, icc double, loglik double")


# --- counts with random intercepts ----------------------------------------------------------

#: Nodes of the quadrature, steps to a group's mode, steps of the search, and the least logarithm of a deviation.
NODES, MODE_STEPS, SEARCH, FLAT = 15, 12, 40, -7.0
#: Half the width of the difference quotients.
WIDTH = 1e-3


def _marginal(point: Column) -> Column:
    """A group's log-likelihood, its intercept integrated out, but for what depends on single values.

    ``n`` and ``s`` are a group's rows and sums by level; ``point`` holds b (log means), sd and theta. Gauss-Hermite
    nodes lie about the mode, which Newton's method finds: the integrand is log-concave.
    """
    theta, sd = point["theta"], point["sd"]
    levels = F.zip_with(F.arrays_zip(F.col("n"), F.col("s")), point["b"], lambda c, b: F.struct(
        c["n"].alias("n"), c["s"].alias("s"), b.alias("b")))

    def height(z: Column, levels: Column) -> Column:
        return F.aggregate(levels, -z * z / 2.0, lambda t, x: t + x["s"] * (x["b"] + sd * z) - (
            x["s"] + x["n"] * theta) * F.ln(theta + F.exp(F.least(x["b"] + sd * z, F.lit(600.0)))))

    def slopes(z: Column, levels: Column) -> Column:
        start = F.struct((-z).alias("d"), F.lit(-1.0).alias("c"))

        def add(t: Column, x: Column) -> Column:
            share = F.lit(1.0) / (F.lit(1.0) + theta * F.exp(-x["b"] - sd * z))
            return bound(share, lambda q: F.struct(
                (t["d"] + sd * (x["s"] - (x["s"] + x["n"] * theta) * q)).alias("d"),
                (t["c"] - sd * sd * (x["s"] + x["n"] * theta) * q * (F.lit(1.0) - q)).alias("c")))

        return F.aggregate(levels, start, add)

    def step(z: Column, levels: Column) -> Column:
        return bound(slopes(z, levels), lambda t: z + F.greatest(F.least(-t["d"] / t["c"], F.lit(2.0)), F.lit(-2.0)))

    x, w = np.polynomial.hermite.hermgauss(NODES)
    nodes = F.expr("array(" + ", ".join(
        f"named_struct('x', {float(a)!r}D, 'w', {float(math.log(b) + a * a)!r}D)" for a, b in zip(x, w)) + ")")

    def whole(levels: Column) -> Column:
        mode = F.aggregate(F.expr(f"sequence(1, {MODE_STEPS})"), F.lit(0.0), lambda z, _: step(z, levels))

        def about(m: Column) -> Column:
            parts = F.struct(m.alias("z"), height(m, levels).alias("top"), F.sqrt(F.lit(-2.0) / slopes(m, levels)["c"]).alias("scale"))
            return bound(parts, lambda q: q["top"] + F.ln(q["scale"]) - math.log(2 * math.pi) / 2 + F.ln(F.aggregate(
                nodes, F.lit(0.0), lambda t, k: t + F.exp(k["w"] + height(q["z"] + q["scale"] * k["x"], levels) - q["top"]))))

        return bound(mode, about)

    return bound(levels, whole)


def negbin_random_intercept(df: DataFrame, value: str, level: str, group: str, levels: Sequence) -> DataFrame:
    """``value ~ 0 + level + (1 | group)`` for counts: negative-binomial with a normal intercept on the log scale.

    One row a level: level, n_rows, n_groups, log_mean, se, lo, hi (95 %, on the log scale), sd_group, theta,
    loglik, converged. The likelihood needs of a group only its rows and sums by level, and of single
    values their counts, so groups of equal sums are one row with a count and a group may hold any
    share of the rows. The parameters are found by Newton's method; difference
    quotients and trial steps are points that one pass over the table evaluates together. A deviation that
    shrinks to nothing is 0, a theta that grows beyond all bounds (no other dispersion) is null. Rows
    with a null or negative value, a null group or another level are left out.
    """
    spark, y = df.sparkSession, F.col(value).cast("double")
    rows = df.where((y >= 0) & F.col(group).isNotNull() & F.col(level).isin(list(levels))).select(
        F.col(group).alias("g"), F.col(level).alias("l"), y.alias("y"))
    hist = stage(rows.groupBy("l", "y").agg(F.count(F.lit(1)).alias("m")))
    seen = {r["l"]: r for r in hist.groupBy("l").agg(F.sum("m").alias("m"), (F.sum(F.col("y") * F.col("m")) / F.sum("m")).alias("mean")).collect()}
    used = [x for x in levels if x in seen and seen[x]["mean"] > 0]
    schema = ("level string, n_rows long, n_groups long, log_mean double, se double, lo double, hi double, sd_group double, "
              "theta double, loglik double, converged boolean")
    if not used:
        return spark.createDataFrame([], schema)
    each = [F.sum(F.when(F.col("l") == x, v).otherwise(0.0)) for v in (F.lit(1.0), F.col("y")) for x in used]
    p = len(used)
    groups = rows.where(F.col("l").isin(used)).groupBy("g").agg(F.array(*each[:p]).alias("n"), F.array(*each[p:]).alias("s"))
    table = stage(groups.groupBy("n", "s").agg(F.count(F.lit(1)).alias("m")))
    values = stage(hist.where(F.col("l").isin(used)).groupBy("y").agg(F.sum("m").alias("m")))
    n_groups = table.agg(F.sum("m")).first()[0]

    def logliks(points: list[np.ndarray]) -> np.ndarray:
        text = ", ".join(
            f"named_struct('i', {i}, 'b', array({', '.join(f'{float(b)!r}D' for b in x[:p])}), 'sd', {math.exp(x[p])!r}D, 'theta', {math.exp(x[p + 1])!r}D)"
            for i, x in enumerate(points))
        point = F.explode(F.expr(f"array({text})")).alias("at")
        at, theta = F.col("at"), F.col("at.theta")
        groups = table.select("n", "s", "m", point).select("at.i", (F.col("m") * _marginal(at)).alias("v"))
        single = log_gamma(F.col("y") + theta) - log_gamma(theta) - log_gamma(F.col("y") + 1) + theta * F.ln(theta)
        rest = values.select("y", "m", point).select("at.i", (F.col("m") * single).alias("v"))
        found = groups.union(rest).groupBy("i").agg(F.sum("v").alias("v")).collect()
        out = np.array([v for _, v in sorted((r["i"], r["v"]) for r in found)])
        return np.where(np.isfinite(out), out, -np.inf)

    here = np.array([*(math.log(seen[x]["mean"]) for x in used), math.log(0.5), 0.0])
    d, converged, low = len(here), False, [-30.0] * p + [FLAT, -10.0]
    high = [30.0] * p + [4.0, 14.0]
    pairs = [(i, j) for i in range(d) for j in range(i)]
    e = np.eye(d) * WIDTH

    def quotients(here: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        line = [k * e[i] for k in (1, -1, 2, -2) for i in range(d)]
        f = logliks([here, *(here + x for x in line), *(here + k * (e[i] + e[j]) for k in (1, -1) for i, j in pairs)])
        up, down, up2, down2 = f[1:1 + 4 * d].reshape(4, d)
        slope = (8 * (up - down) - (up2 - down2)) / (12 * WIDTH)
        curve = np.diag((16 * (up + down) - (up2 + down2) - 30 * f[0]) / (12 * WIDTH ** 2))
        both = f[1 + 4 * d:].reshape(2, -1)
        for k, (i, j) in enumerate(pairs):
            curve[i, j] = curve[j, i] = (both[0, k] + both[1, k] - up[i] - down[i] - up[j] - down[j] + 2 * f[0]) / (2 * WIDTH ** 2)
        return float(f[0]), slope, curve

    for _ in range(SEARCH):
        best, slope, curve = quotients(here)
        size, axes = np.linalg.eigh(-curve)
        step = axes @ ((axes.T @ slope) / np.maximum(np.abs(size), 1e-6 * np.abs(size).max()))
        gain = float(slope @ step)
        step *= min(1.0, 2.0 / np.abs(step).max())
        # Long steps too: a deviation that goes to nothing is far away on this scale.
        tries = [np.clip(here + a * step, low, high) for a in (10.0, 3.0, 1.0, 0.3, 0.05, 0.01)]
        found = logliks(tries)
        top = int(found.argmax())
        if not found[top] > best:
            converged = True
            break
        here = tries[top]
        if gain < 1e-9:
            converged = True
            break
    best, _, curve = quotients(here)
    edge = [k for k in (p, p + 1) if not low[k] + 1e-6 < here[k] < high[k] - 1e-6]
    inside = [k for k in range(d) if k not in edge]
    covariance = np.linalg.pinv(-curve[np.ix_(inside, inside)])
    sd, theta = (0.0 if here[p] <= FLAT + 1e-6 else math.exp(here[p])), (None if p + 1 in edge else math.exp(here[p + 1]))
    out = []
    for i, x in enumerate(used):
        b, se = float(here[i]), math.sqrt(max(covariance[i, i], 0.0))
        out.append((x, int(seen[x]["m"]), int(n_groups), b, se, b - Z95 * se, b + Z95 * se, sd, theta, best, converged))
    return spark.createDataFrame(out, schema)
