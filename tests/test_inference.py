"""Information, errors and left-out fits of the product models against numerical derivatives and literal refits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from subscope.plans import inference as inf
from subscope.plans import models as m

FORMULA = "product ~ access + days + other"


@pytest.fixture(scope="module")
def table():
    rng, rows = np.random.default_rng(3), []
    for i in range(100):
        a, d, o = "ABC"[rng.integers(3)], int(rng.integers(1, 6)), float(rng.normal())
        eta = np.array([0.0, 0.3 * d - 0.5 + (a == "B"), 0.7 * o + 0.2 * (a == "C")])
        rows.append((i, a, d, o, "xyz"[rng.choice(3, p=np.exp(eta) / np.exp(eta).sum())]))
    return rows


@pytest.fixture(scope="module")
def df(spark, table):
    return spark.createDataFrame(table, "id long, access string, days long, other double, product string").cache()


@pytest.fixture(scope="module")
def fit(df):
    return inf.maximum(m.fit_multinomial(df, FORMULA, reg=0.0), df)


def design(table):
    x = np.array([[1, a == "A", a == "B", a == "C", d, o] for _, a, d, o, _ in table], dtype=float)
    return x, np.array(["xyz".index(p) for *_, p in table])


def loglik(b, x, y):
    eta = np.column_stack([np.zeros(len(x)), x @ b.reshape(2, -1).T])
    return float((eta[np.arange(len(y)), y] - np.log(np.exp(eta).sum(1))).sum())


def test_information_is_the_numerical_hessian(df, fit, table):
    x, y = design(table)
    assert fit.names == ["(intercept)", "access_A", "access_B", "access_C", "days", "other"] and fit.n == 100 and fit.converged
    b = fit.coefficients.ravel()
    assert fit.loglik == pytest.approx(loglik(b, x, y), abs=1e-9)
    info, score, _ = inf._sums(inf._counted(fit.model, df), fit.coefficients)
    assert np.abs(score).max() < 1e-7
    h, d = 1e-4, len(b)
    numeric = np.zeros((d, d))
    for i in range(d):
        for j in range(d):
            f = [loglik(b + u * h * np.eye(d)[i] + v * h * np.eye(d)[j], x, y) for u, v in ((1, 1), (1, -1), (-1, 1), (-1, -1))]
            numeric[i, j] = (f[0] - f[1] - f[2] + f[3]) / (4 * h * h)
    assert np.allclose(info, -numeric, atol=1e-4)
    # One column too many for each class.
    assert fit.unknown.shape == (12, 2) and fit.parameters == 10


def plain_fit(x, y, start, steps=50):
    """Newton's method with full-rank columns, by dense algebra; or so many of its steps."""
    b = start.copy()
    for _ in range(steps):
        eta = np.column_stack([np.zeros(len(x)), x @ b.reshape(2, -1).T])
        p = np.exp(eta) / np.exp(eta).sum(1, keepdims=True)
        r = (y[:, None] == [1, 2]) - p[:, 1:]
        info = np.zeros((b.size, b.size))
        for row, q in zip(x, p):
            info += np.kron(np.diag(q[1:]) - np.outer(q[1:], q[1:]), np.outer(row, row))
        step = np.linalg.solve(info, (r.T @ x).ravel())
        b = b + step
        if np.abs(step).max() < 1e-10:
            return b, np.linalg.inv(info)
    assert steps < 50
    return b, np.linalg.inv(info)


def test_table_equals_a_dense_fit(df, fit, table):
    x, y = design(table)
    x = np.delete(x, 1, axis=1)
    b, cov = plain_fit(x, y, np.zeros(10))
    got = {(r["category"], r["predictor"]): r for r in inf.odds_ratio_table(fit, df).collect()}
    names = ["(intercept)", "access_B", "access_C", "days", "other"]
    for k, c in enumerate("yz"):
        for j, name in enumerate(names):
            r, i = got[c, name], 5 * k + j
            assert r["coefficient"] == pytest.approx(b[i], abs=1e-7) and r["se"] == pytest.approx(math.sqrt(cov[i, i]), rel=1e-6)
            z = b[i] / math.sqrt(cov[i, i])
            assert r["p_value"] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-5)
            assert r["lo"] < r["odds_ratio"] < r["hi"]
    assert len(got) == 10


def test_left_out_rows_equal_literal_refits(df, fit, table):
    x, y = design(table)
    x = np.delete(x, 1, axis=1)
    b, _ = plain_fit(x, y, np.zeros(10))
    refits, steps = [], []
    for i in range(len(x)):
        keep = np.arange(len(x)) != i
        refits.append(loglik(plain_fit(x[keep], y[keep], b)[0], x[i:i + 1], y[i:i + 1]))
        steps.append(loglik(plain_fit(x[keep], y[keep], b, 1)[0], x[i:i + 1], y[i:i + 1]))
    small = inf.maximum(m.fit_multinomial(df, "product ~ days", reg=0.0), df)
    got = {r["model"]: r for r in inf.loo_compare({"whole": fit, "days": small}, df).collect()}
    assert got["whole"]["n"] == 100
    # Exactly one literal step without the row; a whole refit differs by little.
    assert got["whole"]["elpd"] == pytest.approx(sum(steps), abs=1e-6)
    assert got["whole"]["se"] == pytest.approx(math.sqrt(100) * np.std(steps, ddof=1), rel=1e-6)
    assert got["whole"]["parameters"] == pytest.approx(loglik(b, x, y) - sum(steps), abs=1e-6)
    assert got["whole"]["elpd"] == pytest.approx(sum(refits), rel=0.01)
    assert got["whole"]["se"] == pytest.approx(math.sqrt(100) * np.std(refits, ddof=1), rel=0.03)
    best = max(got.values(), key=lambda r: r["elpd"])
    assert best["elpd_diff"] == 0 and best["se_diff"] == 0
    assert all(r["elpd_diff"] == pytest.approx(r["elpd"] - best["elpd"]) for r in got.values())


def test_effects_and_scores(df, fit, table):
    grid = inf.effect_intervals(fit, df, {"access": ["A", "B", "C"]}, ["days", "other"]).collect()
    assert len(grid) == 9
    days, other = np.mean([r[2] for r in table]), np.mean([r[3] for r in table])
    b = fit.coefficients
    for r in grid:
        x = np.array([1, r["access"] == "A", r["access"] == "B", r["access"] == "C", days, other], dtype=float)
        k = "xyz".index(r["category"])

        def share(c):
            eta = np.append(0.0, c.reshape(2, -1) @ x)
            return np.exp(eta[k]) / np.exp(eta).sum()

        h, c = 1e-5, b.ravel()
        pull = np.array([(share(c + h * e) - share(c - h * e)) / (2 * h) for e in np.eye(12)])
        assert r["probability"] == pytest.approx(share(c), abs=1e-9)
        assert r["se"] == pytest.approx(math.sqrt(pull @ fit.covariance @ pull), rel=1e-5)
        assert 0 < r["lo"] < r["probability"] < r["hi"] < 1
    odd = df.select("access", F.when(F.col("id") > 3, F.col("days")).alias("days"), "other", "product").limit(30)
    long = inf.score_long(fit, odd)
    assert long.where("days is null").where("probability is not null").count() == 0
    sums = long.where("days is not null").groupBy("access", "days", "other").agg(F.sum("probability").alias("p")).collect()
    assert all(r["p"] == pytest.approx(1.0) for r in sums)
    report = inf.fit_report({"a": fit}).first()
    assert report["n"] == 100 and report["parameters"] == 10


def test_a_class_never_seen_at_a_level(spark):
    rows = [("A", "x")] * 5 + [("A", "y")] * 7 + [("B", "x")] * 4
    df = spark.createDataFrame(rows, "access string, product string")
    fit = inf.maximum(m.fit_multinomial(df, "product ~ access", reg=0.0), df)
    got = {r["predictor"]: r for r in inf.odds_ratio_table(fit, df).collect()}
    assert got["(intercept)"]["coefficient"] == pytest.approx(math.log(7 / 5)) and got["access_B"]["se"] is None
    assert got["(intercept)"]["se"] == pytest.approx(math.sqrt(1 / 5 + 1 / 7), rel=1e-6)
