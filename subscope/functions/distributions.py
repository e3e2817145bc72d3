"""Gamma and beta functions and the distributions built on them, as column expressions.

Series and continued fractions run as ``aggregate`` over a fixed ``sequence``, so a value costs
some hundred steps inside the JVM; they are meant for summary rows. Accuracy is about 1e-10
unless a docstring says otherwise. Null arguments give null.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

# Lanczos coefficients for g = 7 and nine terms.
LANCZOS_G = 7
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
           -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
           1.5056327351493116e-7)
# Bernoulli numbers B2, B4, ... B12.
BERNOULLI = (1 / 6, -1 / 30, 1 / 42, -1 / 30, 5 / 66, -691 / 2730)
TINY = 1e-300
SHIFT = 10
#: Terms that a finite sum may have.
TERMS = 1_000_000


def _double(c) -> Column:
    return (F.lit(float(c)) if isinstance(c, (int, float)) else col(c)).cast("double")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _steps(n: int) -> Column:
    return F.expr(f"sequence(1, {n})")


def _literals(values) -> Column:
    """An array of numbers, as one expression."""
    return F.expr("array(" + ", ".join(f"{v!r}D" for v in values) + ")")


def _polynomial(x: Column, highest_first) -> Column:
    return F.aggregate(_literals(highest_first), F.lit(0.0), lambda s, c: s * x + c)


def _shifted(x: Column, power: int) -> Column:
    """The sum of ``(x + k) ** -power`` over the SHIFT first k."""
    return F.aggregate(_literals(map(float, range(SHIFT))), F.lit(0.0), lambda s, k: s + F.pow(x + k, F.lit(-power)))


def log_gamma(x) -> Column:
    """Logarithm of the gamma function of a positive number."""

    def at(x: Column) -> Column:
        terms = F.transform(_literals(LANCZOS[1:]), lambda c, i: c / (x + i + 1))
        series = F.aggregate(terms, F.lit(LANCZOS[0]), lambda s, v: s + v)
        t = x + (LANCZOS_G + 0.5)
        return (x + 0.5) * F.ln(t) - t + F.ln(series * math.sqrt(2 * math.pi)) - F.ln(x)

    return bound(_double(x), at)


def _log_gamma_tail(x: Column) -> Column:
    """What Stirling's formula lacks, for x of ten and more."""
    tail = [b / (2 * k * (2 * k - 1)) for k, b in enumerate(BERNOULLI, 1)]
    return _polynomial(F.lit(1.0) / (x * x), tail[::-1]) / x


def log_beta(a, b) -> Column:
    """Logarithm of the beta function; also where one argument is much larger than the other."""

    def at(p: Column) -> Column:
        big, small = p["big"], p["small"]
        far = (-(big - 0.5) * F.log1p(small / big) - small * F.ln(big + small) + small
               + _log_gamma_tail(big) - _log_gamma_tail(big + small))
        near = log_gamma(big) - log_gamma(big + small)
        return log_gamma(small) + F.when(big >= SHIFT, far).otherwise(near)

    a, b = _double(a), _double(b)
    both = a.isNotNull() & b.isNotNull()  # greatest and least would skip a null
    return F.when(both, bound(F.struct(F.greatest(a, b).alias("big"), F.least(a, b).alias("small")), at))


def digamma(x) -> Column:
    """Derivative of :func:`log_gamma`."""

    def at(x: Column) -> Column:
        y = x + float(SHIFT)
        inv = F.lit(1.0) / (y * y)
        tail = [b / (2 * k) for k, b in enumerate(BERNOULLI, 1)]
        return F.ln(y) - F.lit(0.5) / y - inv * _polynomial(inv, tail[::-1]) - _shifted(x, 1)

    return bound(_double(x), at)


def trigamma(x) -> Column:
    """Derivative of :func:`digamma`."""

    def at(x: Column) -> Column:
        y = x + float(SHIFT)
        inv = F.lit(1.0) / (y * y)
        return F.lit(1.0) / y + F.lit(0.5) * inv + inv / y * _polynomial(inv, BERNOULLI[::-1]) + _shifted(x, 2)

    return bound(_double(x), at)


def _nonzero(x: Column) -> Column:
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    first = F.lit(1.0) / _nonzero(F.lit(1.0) - (a + b) * x / (a + 1.0))

    def half(s: Column, term: Column) -> Column:
        return bound(term, lambda t: F.struct(
            _nonzero(F.lit(1.0) + t / s["c"]).alias("c"),
            (F.lit(1.0) / _nonzero(F.lit(1.0) + t * s["d"])).alias("d"), s["h"].alias("h")))

    def grown(s: Column) -> Column:
        return F.struct(s["c"].alias("c"), s["d"].alias("d"), (s["h"] * s["c"] * s["d"]).alias("h"))

    def step(s: Column, i: Column) -> Column:
        m = i.cast("double")
        even = m * (b - m) * x / ((a + 2.0 * m - 1.0) * (a + 2.0 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2.0 * m) * (a + 2.0 * m + 1.0))
        once = bound(half(s, even), grown)
        return bound(once, lambda o: bound(half(o, odd), grown))

    start = bound(first, lambda d: F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h")))
    return F.aggregate(_steps(steps), start, step)["h"]


def beta_cdf(x, a, b, rest=None, steps: int = 300) -> Column:
    """Regularised incomplete beta function: P(X <= x) of a beta variable.

    ``rest`` is 1 - x, where it is known better than by subtraction. The steps
    suffice for parameters up to about a million; Student's distribution needs forty at any size.
    """
    x, a, b = _double(x), _double(a), _double(b)
    rest = F.lit(1.0) - x if rest is None else _double(rest)

    def inside(p: Column) -> Column:
        a, b, x, y = p["a"], p["b"], p["x"], p["y"]
        log_x = F.when(y < 0.5, F.log1p(-y)).otherwise(F.ln(x))
        log_y = F.when(x < 0.5, F.log1p(-x)).otherwise(F.ln(y))
        front = F.exp(a * log_x + b * log_y - log_beta(a, b))
        low = x < (a + 1.0) / (a + b + 2.0)
        # One fraction, of the side where it converges.
        side = F.struct(F.when(low, a).otherwise(b).alias("a"), F.when(low, b).otherwise(a).alias("b"),
                        F.when(low, x).otherwise(y).alias("x"))
        part = front * bound(side, lambda s: _beta_fraction(s["a"], s["b"], s["x"], steps) / s["a"])
        return F.when(low, part).otherwise(F.lit(1.0) - part)

    args = F.struct(a.alias("a"), b.alias("b"), x.alias("x"), rest.alias("y"))
    return F.when(x <= 0, F.lit(0.0)).when(rest <= 0, F.lit(1.0)).when(
        x.isNotNull() & a.isNotNull() & b.isNotNull(), bound(args, inside))


def gamma_sf(x, a, steps: int = 400) -> Column:
    """Regularised upper incomplete gamma function: P(X > x) of a gamma variable of shape ``a`` (to about a thousand) and scale one."""
    x, a = _double(x), _double(a)

    def inside(p: Column) -> Column:
        a, x = p["a"], p["x"]
        front = F.exp(a * F.ln(x) - x - log_gamma(a))

        def add(s: Column, i: Column) -> Column:
            return bound(s["t"] * x / (a + i.cast("double")), lambda t: F.struct(t.alias("t"), (s["s"] + t).alias("s")))

        series = F.aggregate(_steps(steps), F.struct((F.lit(1.0) / a).alias("t"), (F.lit(1.0) / a).alias("s")), add)["s"]

        def step(s: Column, i: Column) -> Column:
            m = i.cast("double")
            parts = F.struct((m * (a - m)).alias("t"), (s["b"] + 2.0).alias("b"))
            return bound(parts, lambda q: bound(F.struct(
                q["b"].alias("b"), _nonzero(q["b"] + q["t"] / s["c"]).alias("c"),
                (F.lit(1.0) / _nonzero(q["b"] + q["t"] * s["d"])).alias("d"), s["h"].alias("h")),
                lambda o: F.struct(o["b"].alias("b"), o["c"].alias("c"), o["d"].alias("d"), (o["h"] * o["c"] * o["d"]).alias("h"))))

        at = x + 1.0 - a
        start = F.struct(at.alias("b"), F.lit(1 / TINY).alias("c"), (F.lit(1.0) / _nonzero(at)).alias("d"),
                         (F.lit(1.0) / _nonzero(at)).alias("h"))
        fraction = F.aggregate(_steps(steps), start, step)["h"]
        return F.when(x < a + 1.0, F.lit(1.0) - front * series).otherwise(front * fraction)

    args = F.struct(a.alias("a"), x.alias("x"))
    return F.when(x <= 0, F.lit(1.0)).when(x.isNotNull() & a.isNotNull(), bound(args, inside))


def chi_square_sf(x, dof) -> Column:
    """P(X > x) of a chi-square variable."""
    return gamma_sf(_double(x) / 2.0, _double(dof) / 2.0)


def normal_cdf(z) -> Column:
    """Standard normal distribution function."""

    def at(z: Column) -> Column:
        tail = gamma_sf(z * z / 2.0, F.lit(0.5), 200) / 2.0
        return F.when(z > 0, F.lit(1.0) - tail).otherwise(tail)

    z = _double(z)
    return F.when(z.isNotNull(), bound(z, at))


def t_cdf(t, dof) -> Column:
    """Student's distribution function, for any positive number of degrees of freedom.

    Beyond a million of them, the point with the same normal approximation at a million.
    """
    many = 1e6

    def normal(t: Column, n: Column) -> Column:
        return t * (F.lit(1.0) - F.lit(0.25) / n) / F.sqrt(F.lit(1.0) + t * t / (n * 2.0))

    def nearer(z: Column) -> Column:
        return z / F.sqrt(F.greatest(F.lit((1 - 0.25 / many) ** 2) - z * z / (2 * many), F.lit(1e-9)))

    def at(p: Column) -> Column:
        t, n = p["t"], p["n"]
        whole = n + t * t
        tail = beta_cdf(n / whole, n / 2.0, F.lit(0.5), t * t / whole, 60) / 2.0
        return F.when(t > 0, F.lit(1.0) - tail).otherwise(tail)

    t, n = _double(t), _double(dof)
    far = F.when(n > many, nearer(normal(t, n))).otherwise(t)
    args = F.struct(far.alias("t"), F.least(n, F.lit(many)).alias("n"))
    return F.when(t.isNotNull() & n.isNotNull(), bound(args, at))


def _by_bisection(cdf: Callable[[Column], Column], p: Column, low: float, high: float, halvings: int) -> Column:
    """Where a growing function of (low, high) reaches ``p``."""

    def step(s: Column, _: Column) -> Column:
        return bound((s["l"] + s["h"]) / 2.0, lambda m: bound(cdf(m) < p, lambda under: F.struct(
            F.when(under, m).otherwise(s["l"]).alias("l"), F.when(under, s["h"]).otherwise(m).alias("h"))))

    start = F.struct(F.lit(low).alias("l"), F.lit(high).alias("h"))
    return bound(F.aggregate(_steps(halvings), start, step), lambda s: (s["l"] + s["h"]) / 2.0)


def t_quantile(p, dof) -> Column:
    """Where Student's distribution function is ``p``, between 0 and 1.

    The quantile is found on a bounded scale, q / (1 + |q|), by halving; about 1e-9 of its size.
    """

    def unbounded(w: Column) -> Column:
        return w / (F.lit(1.0) - F.abs(w))

    def at(s: Column) -> Column:
        found = _by_bisection(lambda w: t_cdf(unbounded(w), s["n"]), s["p"], -1.0 + 1e-9, 1.0 - 1e-9, 50)
        return bound(found, unbounded)

    p, n = _double(p), _double(dof)
    return F.when((p > 0) & (p < 1) & n.isNotNull(), bound(F.struct(p.alias("p"), n.alias("n")), at))


def beta_quantile(p, a, b) -> Column:
    """Where the distribution function of a beta variable is ``p``, between 0 and 1."""

    def at(s: Column) -> Column:
        return _by_bisection(lambda x: beta_cdf(x, s["a"], s["b"]), s["p"], 0.0, 1.0, 50)

    p, a, b = _double(p), _double(a), _double(b)
    args = F.struct(p.alias("p"), a.alias("a"), b.alias("b"))
    return F.when((p > 0) & (p < 1) & a.isNotNull() & b.isNotNull(), bound(args, at))


def beta_greater(a1, b1, a2, b2) -> Column:
    """P(second > first) of two beta variables with whole parameters.

    A finite sum over the least of the four parameters, each term from the one before, on the
    logarithmic scale; where that takes over TERMS terms, the normal approximation.
    """
    a1, b1, a2, b2 = map(_double, (a1, b1, a2, b2))

    def total(p: Column) -> Column:
        """P(Y > X) over the first parameter of Y: terms B(ax + i, bx + by) / ((by + i) B(1 + i, by) B(ax, bx))."""
        ax, bx, by = p["ax"], p["bx"], p["by"]
        first = log_beta(ax, bx + by) - F.ln(by) - log_beta(F.lit(1.0), by) - log_beta(ax, bx)

        def step(s: Column, i: Column) -> Column:
            j = i.cast("double") - 1.0
            ratio = (ax + j) * (by + j) / ((ax + j + bx + by) * (j + 1.0))
            return bound(s["t"] + F.ln(ratio), lambda t: bound(F.greatest(t, s["s"]), lambda top: F.struct(
                t.alias("t"), (top + F.log1p(F.exp(F.least(t, s["s"]) - top))).alias("s"))))

        more = F.when(p["n"] > 1, F.sequence(F.lit(1), (p["n"] - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
        start = bound(first, lambda t: F.struct(t.alias("t"), t.alias("s")))
        summed = F.exp(F.aggregate(more, start, step)["s"])
        return F.when(p["flip"], F.lit(1.0) - summed).otherwise(summed)

    def form(ax: Column, bx: Column, n: Column, by: Column, flip: bool) -> Column:
        return F.struct(n.alias("n"), F.lit(flip).alias("flip"), ax.alias("ax"), bx.alias("bx"), by.alias("by"))

    # Y > X directly, its complement, and both for one minus the variables.
    forms = F.array(form(a1, b1, a2, b2, False), form(a2, b2, a1, b1, True),
                    form(b2, a2, b1, a1, False), form(b1, a1, b2, a2, True))
    mean1, mean2 = a1 / (a1 + b1), a2 / (a2 + b2)
    var = mean1 * (1 - mean1) / (a1 + b1 + 1) + mean2 * (1 - mean2) / (a2 + b2 + 1)
    return bound(F.array_min(forms), lambda p: F.when(p["n"] <= TERMS, total(p)).otherwise(
        normal_cdf((mean2 - mean1) / F.sqrt(var))))
