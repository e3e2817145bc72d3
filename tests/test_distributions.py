"""Column distributions against closed forms in exact or standard arithmetic."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from subscope.functions import distributions as d


def values(spark, rows, fn, names):
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rows)], ["i", *names])
    return [r[0] for r in df.orderBy("i").select(fn(*map(F.col, names)).alias("v")).collect()]


def test_log_gamma_and_its_derivatives(spark):
    xs = [1e-6, 0.1, 0.5, 1, 1.5, 2, 3.3, 10, 57.25, 1e3, 1e6, 1e9]
    for x, got in zip(xs, values(spark, [(x,) for x in xs], d.log_gamma, ["x"])):
        assert got == pytest.approx(math.lgamma(x), rel=1e-13, abs=1e-13)
    # Differences of harmonic numbers, and Euler's constant.
    gamma = 0.57721566490153286
    for n, got in zip((1, 2, 7, 100), values(spark, [(1,), (2,), (7,), (100,)], d.digamma, ["x"])):
        assert got == pytest.approx(sum(1 / k for k in range(1, n)) - gamma, abs=1e-12)
    for n, got in zip((1, 2, 7, 100), values(spark, [(1,), (2,), (7,), (100,)], d.trigamma, ["x"])):
        assert got == pytest.approx(math.pi ** 2 / 6 - sum(1 / k ** 2 for k in range(1, n)), abs=1e-12)
    half = values(spark, [(0.5,)], d.digamma, ["x"])[0]
    assert half == pytest.approx(-gamma - 2 * math.log(2), abs=1e-12)


def test_log_beta(spark):
    rows = [(1, 1), (0.5, 0.5), (3, 40), (9.9, 10.1), (200, 3), (5e3, 4e3)]
    for (a, b), got in zip(rows, values(spark, rows, d.log_beta, ["a", "b"])):
        assert got == pytest.approx(math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b), abs=1e-10)
    # B(a, 1) = 1 / a at any size.
    assert values(spark, [(1e12, 1)], d.log_beta, ["a", "b"])[0] == pytest.approx(-math.log(1e12), abs=1e-10)


def binomial_tail(x, a, b):
    """P(X <= x) of a beta variable with whole parameters, exactly."""
    x, n = Fraction(x), a + b - 1
    return float(sum(math.comb(n, j) * x ** j * (1 - x) ** (n - j) for j in range(a, n + 1)))


def test_beta_cdf(spark):
    rows = [(0.3, 1, 1), (0.25, 2, 7), (0.5, 30, 30), (0.75, 100, 40), (0.7, 300, 100), (0.875, 1, 50), (0.001, 3, 4)]
    for (x, a, b), got in zip(rows, values(spark, rows, d.beta_cdf, ["x", "a", "b"])):
        assert got == pytest.approx(binomial_tail(x, a, b), rel=1e-9, abs=1e-13)
    assert values(spark, [(-1, 2, 3), (2, 2, 3), (0, 1, 1)], d.beta_cdf, ["x", "a", "b"]) == [0, 1, 0]


def test_gamma_and_chi_square(spark):
    def poisson(x, a):
        return sum(math.exp(-x + j * math.log(x) - math.lgamma(j + 1)) for j in range(a))

    rows = [(0.1, 1), (3, 2), (10, 10), (40, 12), (250, 200), (150, 200)]
    for (x, a), got in zip(rows, values(spark, rows, d.gamma_sf, ["x", "a"])):
        assert got == pytest.approx(poisson(x, a), rel=1e-9, abs=1e-13)
    for x in (0.01, 0.5, 3.84, 30.0):
        assert values(spark, [(x, 1)], d.chi_square_sf, ["x", "n"])[0] == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9)


def test_normal_cdf(spark):
    zs = [-8, -2.5, -1, -1e-3, 0, 1e-3, 0.7, 1.96, 6]
    for z, got in zip(zs, values(spark, [(z,) for z in zs], d.normal_cdf, ["z"])):
        assert got == pytest.approx(math.erfc(-z / math.sqrt(2)) / 2, rel=1e-9)


def test_student(spark):
    # Closed forms for one, two and four degrees of freedom; the normal limit.
    def two(t):
        return 0.5 + t / (2 * math.sqrt(2 + t * t))

    def four(t):
        return 0.5 + 3 / 8 * (t / math.sqrt(1 + t * t / 4)) * (1 - t * t / (12 * (1 + t * t / 4)))

    def normal(t):
        return math.erfc(-t / math.sqrt(2)) / 2

    ts = (-30, -3, -0.2, 0, 0.01, 1, 2.5, 12)
    laws = ((1, lambda t: 0.5 + math.atan(t) / math.pi), (2, two), (4, four), (1e13, normal))
    rows = [(t, n) for n, _ in laws for t in ts]
    want = [law(t) for _, law in laws for t in ts]
    assert values(spark, rows, d.t_cdf, ["t", "n"]) == pytest.approx(want, rel=1e-8, abs=1e-13)


def test_quantiles_invert(spark):
    for p, n in ((0.975, 1), (0.975, 2), (0.6, 7.3), (0.01, 30), (0.975, 1e6)):
        q = values(spark, [(p, n)], d.t_quantile, ["p", "n"])[0]
        assert values(spark, [(q, n)], d.t_cdf, ["t", "n"])[0] == pytest.approx(p, abs=1e-9)
    assert values(spark, [(0.975, 1)], d.t_quantile, ["p", "n"])[0] == pytest.approx(math.tan(0.475 * math.pi), rel=1e-7)
    for p, a, b in ((0.025, 3, 9), (0.975, 300, 120)):
        q = values(spark, [(p, a, b)], d.beta_quantile, ["p", "a", "b"])[0]
        assert values(spark, [(q, a, b)], d.beta_cdf, ["x", "a", "b"])[0] == pytest.approx(p, abs=1e-9)


def test_null_gives_null(spark):
    df = spark.createDataFrame([(None, 2.0)], "x double, y double")
    x, y = F.col("x"), F.col("y")
    row = df.select(d.log_gamma(x), d.log_beta(x, y), d.digamma(x), d.beta_cdf(x, y, y), d.beta_cdf(F.lit(0.5), x, y), d.gamma_sf(y, x),
                    d.normal_cdf(x), d.t_cdf(y, x), d.t_quantile(x, y), d.beta_quantile(F.lit(0.5), x, y)).first()
    assert all(v is None for v in row)


def test_beta_greater(spark):
    def exact(a1, b1, a2, b2):
        # Over the first variable's order statistics, in whole numbers.
        total = Fraction(0)
        for i in range(a2):
            top = Fraction(math.factorial(a1 + i - 1) * math.factorial(b1 + b2 - 1), math.factorial(a1 + i + b1 + b2 - 1))
            low = Fraction(math.factorial(i) * math.factorial(b2 - 1), math.factorial(i + b2))
            base = Fraction(math.factorial(a1 - 1) * math.factorial(b1 - 1), math.factorial(a1 + b1 - 1))
            total += top / ((b2 + i) * low * base)
        return float(total)

    rows = [(1, 1, 1, 1), (3, 9, 4, 7), (40, 5, 35, 6), (7, 300, 9, 250), (80, 20, 10, 90), (150, 150, 170, 140)]
    got = values(spark, rows, d.beta_greater, ["a1", "b1", "a2", "b2"])
    assert got == pytest.approx([exact(*r) for r in rows], rel=1e-9, abs=1e-12)
    big = values(spark, [(14598, 6042, 15453, 6097), (2e6, 1e6, 2.001e6, 1e6), (4e7, 2e7, 4e7, 2e7)], d.beta_greater, ["a1", "b1", "a2", "b2"])
    assert big[0] == pytest.approx(0.5 * math.erfc(-2.28 / math.sqrt(2)), abs=0.01) and 0.6 < big[1] < 0.99 and big[2] == pytest.approx(0.5, abs=1e-6)
