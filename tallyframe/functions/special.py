"""Incomplete gamma and beta functions and the laws that they give in closed form, as Column expressions.

Series and continued fractions run as folds whose length follows the parameters (a constant plus a multiple of their
square root), so no support is exploded. Powers over gamma functions come from saddle-point deviations, which keep their
precision for large parameters where differences of log-gammas do not. Inverses are bracketed: halving for the real
laws, whole-number halving for the integer ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe.functions.exprs import lgamma

#: Terms of a fold: so many, and so many times the root of the largest parameter.
TERMS, ROOTS = 80, 8.0
#: Halvings of a bracket: enough for any double, and for any whole number of a long.
HALVINGS, WHOLE_HALVINGS = 80, 63
#: What a probability may miss, relative to the smaller of p and 1 - p, to count as reaching it (rounding).
SLACK = 1e-12


def let(fn: Callable[..., Column], *values: Column) -> Column:
    """``fn`` of values that are worked out once, however often the expression names them."""
    names = [f"v{i}" for i in range(len(values))]
    bound = F.array(F.struct(*[v.cast("double").alias(n) for n, v in zip(names, values)]))
    return F.element_at(F.transform(bound, lambda s: fn(*[s[n] for n in names])), 1)


def _terms(size: Column) -> Column:
    return (F.lit(TERMS) + F.ceil(F.lit(ROOTS) * F.sqrt(size))).cast("int")


def _stirling(z: Column) -> Column:
    """ln Γ(z + 1) less Stirling's formula."""
    r = F.lit(1.0) / (z * z)
    series = (F.lit(1 / 12) - r * (F.lit(1 / 360) - r * (F.lit(1 / 1260) - r * (F.lit(1 / 1680) - r * F.lit(1 / 1188))))) / z
    exact = lgamma(z + 1.0) - (z + 0.5) * F.log(z) + z - F.lit(0.5 * math.log(2 * math.pi))
    return F.when(z < 16, exact).otherwise(series)


def _deviance(u: Column) -> Column:
    """u - 1 - ln u."""
    return (u - 1.0) - F.log1p(u - 1.0)


def poisson_mass(a: Column, x: Column) -> Column:
    """x^a e^-x / Γ(a + 1) for a, x > 0, to full precision also for large a."""
    return F.exp(-_stirling(a) - a * _deviance(x / a)) / F.sqrt(F.lit(2 * math.pi) * a)


def _gamma_series(a: Column, x: Column) -> Column:
    """P(a, x) by its power series, for x < a + 1."""
    fold = F.aggregate(F.sequence(F.lit(1), _terms(a)), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
                       lambda acc, n: F.struct((acc["t"] * x / (a + n)).alias("t"), (acc["s"] + acc["t"] * x / (a + n)).alias("s")))
    return poisson_mass(a, x) * fold["s"]


def _gamma_fraction(a: Column, x: Column) -> Column:
    """Q(a, x) by its continued fraction, from the innermost level outwards, for x >= a + 1."""
    n = _terms(a)
    fold = F.aggregate(F.sequence(n, F.lit(1), F.lit(-1)), x + n * 2 + 1 - a, lambda f, k: (x + k * 2 - 1 - a) + k * (a - k) / f)
    return poisson_mass(a, x) * a / fold


def gamma_p(a: Column, x: Column) -> Column:
    """The regularised lower incomplete gamma function P(a, x), a > 0."""
    return let(lambda a, x: F.when(x <= 0, 0.0).when(x < a + 1, _gamma_series(a, x)).otherwise(F.lit(1.0) - _gamma_fraction(a, x)), a, x)


def gamma_q(a: Column, x: Column) -> Column:
    """1 - P(a, x), with its own precision where it is small."""
    return let(lambda a, x: F.when(x <= 0, 1.0).when(x < a + 1, F.lit(1.0) - _gamma_series(a, x)).otherwise(_gamma_fraction(a, x)), a, x)


def _beta_fraction(a: Column, b: Column, x: Column, y: Column) -> Column:
    """I_x(a, b) by its continued fraction, for x up to the mean; y = 1 - x."""

    def level(f: Column, j: Column) -> Column:
        m = F.floor(j / 2)
        odd = -(a + m) * (a + b + m) * x / ((a + m * 2) * (a + m * 2 + 1))
        even = m * (b - m) * x / ((a + m * 2 - 1) * (a + m * 2))
        return F.lit(1.0) + F.when(j % 2 == 1, odd).otherwise(even) / f

    fold = F.aggregate(F.sequence(_terms(F.greatest(a, b)), F.lit(1), F.lit(-1)), F.lit(1.0), level)
    n = a + b
    front = F.exp(_stirling(n) - _stirling(a) - _stirling(b) - a * _deviance(n * x / a) - b * _deviance(n * y / b))
    return front * F.sqrt(a * b / (n * (2 * math.pi))) / (a * fold)


def _beta_i(a: Column, b: Column, x: Column, y: Column) -> Column:
    low = x < (a + 1.0) / (a + b + 2.0)
    return F.when(x <= 0, 0.0).when(y <= 0, 1.0).when(low, _beta_fraction(a, b, x, y)).otherwise(F.lit(1.0) - _beta_fraction(b, a, y, x))


def beta_i(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function I_x(a, b), a, b > 0: the beta law's CDF."""
    return let(lambda a, b, x: _beta_i(a, b, x, F.lit(1.0) - x), a, b, x)


# ---------------------------------------------------------------- cumulative probabilities


def beta_cdf(x: Column, a: Column, b: Column) -> Column:
    return beta_i(a, b, x)


def gamma_cdf(x: Column, shape: Column, rate: Column) -> Column:
    return gamma_p(shape, x * rate)


def poisson_cdf(k: Column, lam: Column) -> Column:
    """P(X <= k); λ = 0 has all mass at 0."""
    return let(lambda k, lam: F.when(k < 0, 0.0).when(lam <= 0, 1.0).otherwise(gamma_q(F.floor(k) + 1, lam)), k, lam)


def binomial_cdf(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) of n trials with chance p in [0, 1]."""
    return let(lambda k, n, p: F.when(k < 0, 0.0).when(k >= n, 1.0).otherwise(
        let(_beta_i, n - F.floor(k), F.floor(k) + 1.0, F.lit(1.0) - p, p)), k, n, p)


def poisson_tail(k: Column, lam: Column) -> Column:
    """P(X > k), with its own precision where it is small."""
    return let(lambda k, lam: F.when(k < 0, 1.0).when(lam <= 0, 0.0).otherwise(gamma_p(F.floor(k) + 1, lam)), k, lam)


def binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """P(X > k), with its own precision where it is small."""
    return let(lambda k, n, p: F.when(k < 0, 1.0).when(k >= n, 0.0).otherwise(
        let(_beta_i, F.floor(k) + 1.0, n - F.floor(k), p, F.lit(1.0) - p)), k, n, p)


# ---------------------------------------------------------------- inverses


def _halved(cdf: Callable[[Column], Column], p: Column, low: Column, high: Column) -> Column:
    """The middle of the bracket [low, high] after it has closed around cdf(x) = p."""

    def step(acc: Column, _: Column) -> Column:
        middle = (acc["lo"] + acc["hi"]) / 2
        enough = let(lambda x: cdf(x), middle) >= p
        return F.struct(F.when(enough, acc["lo"]).otherwise(middle).alias("lo"), F.when(enough, middle).otherwise(acc["hi"]).alias("hi"))

    end = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), F.struct(low.alias("lo"), high.alias("hi")), step)
    return (end["lo"] + end["hi"]) / 2


def _whole(cdf: Callable[[Column], Column], tail: Callable[[Column], Column], p: Column, high: Column, low: Column | None = None) -> Column:
    """The smallest whole number whose cumulative probability reaches p, at most ``high`` and above ``low`` (-1 if none is
    known). Above one half the probability beyond it is held against 1 - p, which keeps its precision there. A middle is
    worked out once, and there are as many halvings as the bracket needs."""

    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2)
        enough = F.when(p > 0.5, tail(middle) <= (F.lit(1.0) - p) * (1 + SLACK)).otherwise(cdf(middle) >= p * (1 - SLACK))
        next_ = F.element_at(F.transform(F.array(enough), lambda e: F.struct(
            F.when(e, acc["lo"]).otherwise(middle.cast("double")).alias("lo"), F.when(e, middle.cast("double")).otherwise(acc["hi"]).alias("hi"))), 1)
        return F.when(acc["hi"] - acc["lo"] <= 1, acc).otherwise(next_)

    high = high.cast("double")
    low = F.lit(-1.0) if low is None else F.greatest(F.least(low.cast("double"), high - 1), F.lit(-1.0))
    halvings = F.least(F.ceil(F.log2(high - low)) + 2, F.lit(WHOLE_HALVINGS)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), halvings), F.struct(low.alias("lo"), high.alias("hi")), step)["hi"].cast("bigint")


def beta_quantile(p: Column, a: Column, b: Column) -> Column:
    """Inverse CDF of the beta law, p in [0, 1]."""
    return let(lambda p, a, b: F.when(p <= 0, 0.0).when(p >= 1, 1.0).otherwise(
        _halved(lambda x: _beta_i(a, b, x, F.lit(1.0) - x), p, F.lit(0.0), F.lit(1.0))), p, a, b)


def gamma_quantile(p: Column, shape: Column, rate: Column) -> Column:
    """Inverse CDF of the gamma law, p in [0, 1); the bracket ends where Bernstein's inequality leaves 1 - p at most."""

    def found(p: Column, a: Column) -> Column:
        tail = -F.log1p(-p)
        high = a + F.sqrt(a * tail * 2) + tail + 1.0
        return F.when(p <= 0, 0.0).otherwise(_halved(lambda x: F.when(x < a + 1, _gamma_series(a, x)).otherwise(F.lit(1.0) - _gamma_fraction(a, x)), p, F.lit(0.0), high))

    return let(found, p, shape) / rate


def poisson_quantile(p: Column, lam: Column) -> Column:
    """The smallest k with P(X <= k) >= p, p in [0, 1); 0 for λ <= 0."""

    def found(p: Column, lam: Column) -> Column:
        tail = -F.log1p(-p)
        high = F.ceil(lam + tail / 3 + F.sqrt(tail * tail / 9 + lam * tail * 2)) + 1
        return F.when(lam <= 0, F.lit(0).cast("bigint")).otherwise(_whole(lambda k: poisson_cdf(k, lam), lambda k: poisson_tail(k, lam), p, high))

    return let(found, p, lam)


def binomial_quantile(q: Column, n: Column, p: Column) -> Column:
    """The smallest k with P(X <= k) >= q of n trials with chance p; Bernstein's inequality bounds it on both sides."""

    def found(q: Column, n: Column, p: Column) -> Column:
        def reach(rest: Column) -> Column:
            """How far from the mean less than exp(-rest) is left."""
            return rest / 3 + F.sqrt(rest * rest / 9 + n * p * (F.lit(1.0) - p) * rest * 2)

        inner = (q > 0) & (q < 1) & p.between(0.0, 1.0)
        low = F.when(inner, F.floor(n * p - reach(-F.log(q))) - 2).otherwise(-1)
        high = F.when(inner, F.least(F.ceil(n * p + reach(-F.log1p(-q))) + 2, n)).otherwise(n)
        return let(lambda q, n, p, low, high: _whole(lambda k: binomial_cdf(k, n, p), lambda k: binomial_tail(k, n, p), q, high, low), q, n, p, low, high)

    return let(found, q, n, p)
