"""Likelihoods from sufficient statistics against closed forms and brute-force likelihoods."""

import math

import numpy as np
import pytest

from subscope.operators import likelihood as lik


def is_top(f, at, step=1e-3, slack=1e-7):
    """No neighbour of ``at`` along an axis is higher, and both sides fall alike."""
    for k in range(len(at)):
        low, high = (f([x + s if i == k else x for i, x in enumerate(at)]) - f(at) for s in (-step, step))
        assert low < 0 and high < 0 and abs(low - high) < 0.05 * abs(low + high) + slack


def test_balanced_intercepts_equal_the_analysis_of_variance(spark):
    rng, g, n = np.random.default_rng(5), 30, 5
    y = 2 + rng.normal(0, 1.3, g)[:, None] + rng.normal(0, 0.8, (g, n))
    df = spark.createDataFrame([(f"u{i}", "A", float(v)) for i in range(g) for v in y[i]], "g string, l string, y double")
    between = n * y.mean(1).var(ddof=1)
    within = y.var(1, ddof=1).mean()
    got = lik.random_intercept(df, "y", "l", "g", ["A"], reml=True).first()
    assert (got["n_rows"], got["n_groups"]) == (g * n, g)
    assert got["sd_residual"] == pytest.approx(math.sqrt(within), rel=1e-9)
    assert got["sd_group"] == pytest.approx(math.sqrt((between - within) / n), rel=1e-9)
    assert got["mean"] == pytest.approx(y.mean(), rel=1e-12)
    assert got["se"] == pytest.approx(math.sqrt(between / (g * n)), rel=1e-9)


@pytest.mark.parametrize("reml", [False, True])
def test_unbalanced_intercepts_top_the_likelihood(spark, reml):
    rng, rows = np.random.default_rng(6), []
    for i in range(40):
        u = rng.normal(0, 0.7)
        rows += [(f"u{i}", (x := "AB"[rng.integers(2)]), float((x == "B") * 0.7 + u + rng.normal(0, 1.1)))
                 for _ in range(rng.integers(1, 9))]
    odd = [(None, "A", 1.0), ("u1", "A", None), ("u1", "C", 5.0), ("u1", None, 5.0), ("u1", "A", math.nan)]
    df = spark.createDataFrame(rows + odd, "g string, l string, y double")
    got = lik.random_intercept(df, "y", "l", "g", ["A", "B", "Z"], reml).collect()
    groups = {}
    for k, x, v in rows:
        groups.setdefault(k, []).append((x == "B", v))

    def loglik(p):
        total, xvx = 0.0, np.zeros((2, 2))
        for held in groups.values():
            x = np.array([[1.0 - b, 1.0 * b] for b, _ in held])
            e = np.array([v for _, v in held]) - x @ np.array(p[2:])
            v = p[1] ** 2 * np.eye(len(held)) + p[0] ** 2
            total -= 0.5 * (len(held) * math.log(2 * math.pi) + np.linalg.slogdet(v)[1] + e @ np.linalg.solve(v, e))
            xvx += x.T @ np.linalg.solve(v, x)
        return total - reml * 0.5 * (np.linalg.slogdet(xvx)[1] - 2 * math.log(2 * math.pi))

    a, b = sorted(got, key=lambda r: r["level"])
    assert a["n_rows"] + b["n_rows"] == len(rows)
    at = [a["sd_group"], a["sd_residual"], a["mean"], b["mean"]]
    is_top(loglik, at)
    if not reml:
        assert a["loglik"] == pytest.approx(loglik(at), rel=1e-10)


def test_no_variance_between_groups(spark):
    rows = [(f"u{i}", "A", float(v)) for i in range(10) for v in (1.0, 2.0, 3.0)]
    got = lik.random_intercept(spark.createDataFrame(rows, "g string, l string, y double"), "y", "l", "g", ["A"]).first()
    assert got["sd_group"] == 0 and got["mean"] == pytest.approx(2.0) and got["sd_residual"] == pytest.approx(math.sqrt(2 / 3))
    same = spark.createDataFrame([("u", "A", 2.0), ("v", "A", 2.0)], "g string, l string, y double")
    assert lik.random_intercept(same, "y", "l", "g", ["A"]).first()["sd_residual"] == 0
    assert lik.random_intercept(same, "y", "l", "g", ["B"]).count() == 0


def negbin_log(y, mean, theta):
    return (math.lgamma(y + theta) - math.lgamma(theta) - math.lgamma(y + 1) + theta * math.log(theta / (theta + mean))
            + y * math.log(mean / (theta + mean)))


def test_negbin_fit_tops_the_likelihood(spark):
    rng = np.random.default_rng(7)
    rows = [("AB"[i % 2], int(rng.negative_binomial(1.7, 1.7 / (6.7 if i % 2 else 9.7)))) for i in range(1500)]
    rows += [("C", 3)] * 5 + [("C", 4)] * 5 + [("D", 0)] * 3
    df = spark.createDataFrame([*rows, ("A", None), ("B", -1)], "p string, y long")
    own = {r["p"]: r for r in lik.negbin_fit(df, "y", ["p"]).collect()}
    assert own["C"]["theta"] is None and own["D"]["theta"] is None and own["D"]["mean"] == 0
    for x in "AB":
        ys = [y for p, y in rows if p == x]
        assert own[x]["n"] == len(ys) and own[x]["mean"] == pytest.approx(np.mean(ys))
        is_top(lambda v: sum(negbin_log(y, v[0], v[1]) for y in ys), [own[x]["mean"], own[x]["theta"]])
        assert own[x]["loglik"] == pytest.approx(sum(negbin_log(y, own[x]["mean"], own[x]["theta"]) for y in ys))
    both = df.where("p in ('A', 'B')")
    one = {r["p"]: r for r in lik.negbin_fit(both, "y", ["p"], []).collect()}
    assert one["A"]["theta"] == one["B"]["theta"]
    is_top(lambda v: sum(negbin_log(y, one[p]["mean"], v[0]) for p, y in rows if p in "AB"), [one["A"]["theta"]])
    diff = lik.mean_difference(lik.negbin_fit(both, "y", ["p"], []), "p", "A", "B").first()
    assert diff["diff"] == pytest.approx(one["B"]["mean"] - one["A"]["mean"])
    assert diff["se"] == pytest.approx(math.hypot(*(one[x]["mean"] * one[x]["se_log_mean"] for x in "AB")))


def test_negbin_intercepts_top_the_likelihood(spark):
    rng, rows = np.random.default_rng(8), []
    for i in range(150):
        u = rng.normal(0, 0.8)
        rows += [(f"u{i}", x, int(rng.negative_binomial(2.0, 2.0 / (2.0 + math.exp(b + u)))))
                 for x, b in (("A", 1.2), ("B", 1.6)) for _ in range(rng.integers(0, 3))]
    odd = [(None, "A", 1), ("u1", "A", None), ("u1", "C", 5), ("u1", "A", -2)]
    df = spark.createDataFrame(rows + odd, "g string, l string, y long")
    a, b = sorted(lik.negbin_random_intercept(df, "y", "l", "g", ["A", "B"]).collect(), key=lambda r: r["level"])
    groups, z = {}, np.linspace(-9, 9, 2401)
    for k, x, v in rows:
        groups.setdefault(k, []).append((x == "B", v))

    def loglik(p):
        total, (sd, theta) = 0.0, p[:2]
        for held in groups.values():
            f = -z * z / 2 - math.log(2 * math.pi) / 2
            for second, y in held:
                eta = p[2 + second] + sd * z
                f = f + math.lgamma(y + theta) - math.lgamma(theta) + theta * np.log(theta / (theta + np.exp(eta))) + y * (
                    eta - np.log(theta + np.exp(eta))) - math.lgamma(y + 1)
            total += math.log(np.trapezoid(np.exp(f), z))
        return total

    at = [a["sd_group"], a["theta"], a["log_mean"], b["log_mean"]]
    assert a["converged"] and a["n_groups"] == len(groups)
    assert a["loglik"] == pytest.approx(loglik(at), rel=1e-7)
    is_top(loglik, at, slack=2e-6)
    none = spark.createDataFrame([], "g string, l string, y long")
    assert lik.negbin_random_intercept(none, "y", "l", "g", ["A"]).count() == 0
