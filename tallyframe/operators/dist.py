"""Parametric distributions as jobs over a parameter table.

Each row of ``params`` is one distribution (its group keys plus parameters, usually estimated with a
``groupBy``); the support is exploded per row and scored with Column expressions, so millions of PMFs are
built in parallel. Real-valued laws are tabulated on grids (raw densities, not normalised, as their PMF
views are defined); integer laws on their support.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.exprs import (
    exponential_pdf,
    ln_beta,
    ln_choose,
    ln_factorial,
    normal_cdf,
    normal_pdf,
    normalise_weight,
)
from tallyframe.functions.special import poisson_quantile
from tallyframe.operators.pmf import _by

DEFAULT_CUTOFF = 1e-4


def grid(params: DataFrame, lo: Column, hi: Column, steps: int) -> DataFrame:
    """``steps + 1`` points ``x_i = lo + i·(hi − lo)/steps`` per parameter row (column ``i``, ``x``)."""
    g = params.withColumn("_lo", lo.cast("double")).withColumn("_hi", hi.cast("double"))
    g = g.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(int(steps)))))
    return g.withColumn("x", F.col("_lo") + F.col("i") * ((F.col("_hi") - F.col("_lo")) / F.lit(float(steps)))).drop(
        "_lo", "_hi"
    )


def normal_pmf(params: DataFrame, mu: str, sigma: str, num_sigmas: float = 4.0, steps: int = 2000) -> DataFrame:
    """Normal densities on ``mu ± num_sigmas·sigma`` (2001 points by default)."""
    m, s = F.col(mu), F.col(sigma)
    g = grid(params, m - F.lit(num_sigmas) * s, m + F.lit(num_sigmas) * s, steps)
    return g.withColumn("density", normal_pdf(F.col("x"), m, s))


def exponential_pmf(params: DataFrame, lam: str, steps: int = 2000, cutoff: float = DEFAULT_CUTOFF,
                    abs_cutoff: float | None = None) -> DataFrame:
    """Exponential densities on ``[0, F⁻¹(1 − cutoff)] = [0, −ln(cutoff)/λ]``, or on ``[0, abs_cutoff]``."""
    lam_c = F.col(lam)
    end = F.lit(float(abs_cutoff)) if abs_cutoff is not None else F.lit(-math.log(cutoff)) / lam_c
    g = grid(params, F.lit(0.0), end, steps)
    return g.withColumn("density", exponential_pdf(F.col("x"), lam_c))


def exponential_cdf(x: Column, lam: Column) -> Column:
    return F.when(x < 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.exp(-lam * x))


def normal_cdf_col(x: Column, mu: Column, sigma: Column) -> Column:
    return normal_cdf(x, mu, sigma)


# Points of an integer support that one array holds; a support is exploded in ranges of so many.
SUPPORT_RANGE = 1 << 16


def _integer_support(params: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """One row per integer ``k`` (BIGINT) in ``lo..hi``; a row whose ``lo`` is above its ``hi`` has no support."""
    p = params.withColumn("_lo", lo.cast("bigint")).withColumn("_hi", hi.cast("bigint")).where("_lo <= _hi")
    p = p.withColumn("_r", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_hi") - F.col("_lo")) / SUPPORT_RANGE))))
    first = F.col("_lo") + F.col("_r") * SUPPORT_RANGE
    return p.withColumn("k", F.explode(F.sequence(first, F.least("_hi", first + (SUPPORT_RANGE - 1))))).drop("_lo", "_hi", "_r")


def poisson_pmf(params: DataFrame, by, lam: str, cutoff: float = DEFAULT_CUTOFF) -> DataFrame:
    """Poisson PMF on ``0 .. F⁻¹(1 − cutoff)``; empty when λ <= 0. The end of the support comes in closed form from
    the incomplete gamma function, so no cumulative sums are formed."""
    lam_c = F.col(lam)
    p = params.where(lam_c > 0)
    last = poisson_quantile(F.lit(1.0 - cutoff), lam_c)
    s = _integer_support(p, F.lit(0), last)
    return s.withColumn("prob", F.exp(F.col("k") * F.log(lam_c) - lam_c - ln_factorial(F.col("k"))))


def binomial_pmf(params: DataFrame, n: str, p: str) -> DataFrame:
    """Binomial PMF on the full support ``0..n``."""
    n_c, p_c = F.col(n), F.col(p)
    s = _integer_support(params, F.lit(0), n_c)
    k = F.col("k")
    logp = ln_choose(n_c, k) + k * F.log(p_c) + (n_c - k) * F.log(F.lit(1.0) - p_c)
    prob = (
        F.when(p_c <= 0, F.when(k == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .when(p_c >= 1, F.when(k == n_c, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.exp(logp))
    )
    return s.withColumn("prob", prob)


def hypergeom_pmf(params: DataFrame, pop: str, succ: str, sample: str) -> DataFrame:
    """Hypergeometric PMF: ``C(K,k)·C(N−K, n−k) / C(N, n)`` on ``max(0, n−(N−K)) .. min(n, K)``.

    A sample of 0 or no successes gives ``{0: 1}``; a population of successes only gives ``{n: 1}``. A sample
    larger than the population has no rows otherwise (its support is empty).
    """
    N, K, n = F.col(pop), F.col(succ), F.col(sample)
    degenerate0 = (n == 0) | (K == 0)
    degenerate_n = N == K
    lo = F.when(degenerate0, F.lit(0)).when(degenerate_n, n).otherwise(F.greatest(F.lit(0), n - (N - K)))
    hi = F.when(degenerate0, F.lit(0)).when(degenerate_n, n).otherwise(F.least(n, K))
    s = _integer_support(params, lo, hi)
    k = F.col("k")
    general = F.exp(ln_choose(K, k) + ln_choose(N - K, n - k) - ln_choose(N, n))
    return s.withColumn("prob", F.when(degenerate0 | degenerate_n, F.lit(1.0)).otherwise(general))


def beta_pdf(params: DataFrame, a: str, b: str, steps: int = 100) -> DataFrame:
    """Beta densities on ``[0, 1]`` (``steps + 1`` points). At the edges the usual limits apply: for
    α = 1 the density at 0 is β (0 for α > 1), for β = 1 the density at 1 is α (0 for β > 1)."""
    a_c, b_c = F.col(a), F.col(b)
    g = grid(params, F.lit(0.0), F.lit(1.0), steps)
    x = F.col("x")
    inside = F.exp((a_c - 1) * F.log(x) + (b_c - 1) * F.log(F.lit(1.0) - x) - ln_beta(a_c, b_c))

    def edge(own: Column, other: Column) -> Column:
        return F.when(own > 1, F.lit(0.0)).when(own == 1, other.cast("double")).otherwise(F.lit(float("inf")))

    return g.withColumn("density", F.when(x <= 0, edge(a_c, b_c)).when(x >= 1, edge(b_c, a_c)).otherwise(inside))


def betabinom_pmf(params: DataFrame, n: str, a: str, b: str) -> DataFrame:
    """Beta-binomial PMF: ``exp(ln C(n,k) + ln B(k+α, n−k+β) − ln B(α, β))`` on ``0..n``."""
    n_c, a_c, b_c = F.col(n), F.col(a), F.col(b)
    s = _integer_support(params, F.lit(0), n_c)
    k = F.col("k")
    return s.withColumn("prob", F.exp(ln_choose(n_c, k) + ln_beta(k + a_c, n_c - k + b_c) - ln_beta(a_c, b_c)))


def betabinom_moments(n: Column, a: Column, b: Column) -> dict[str, Column]:
    """Closed-form mean, variance and mode of a beta-binomial; of equal masses the smallest k is the mode.

    The mass ratio p(k)/p(k − 1) falls in k when α, β > 1 and passes 1 at ``(n + 1)(α − 1)/(α + β − 2)``. In all
    other cases an end of the support has the largest mass, and p(0) >= p(n) just when β >= α.
    """
    s = a + b
    turn = F.ceil((n + 1) * (a - 1) / F.nullif(s - 2, F.lit(0.0))) - 1
    mode = F.when((a > 1) & (b > 1), F.greatest(F.lit(0), F.least(n, turn))).when(b >= a, F.lit(0)).otherwise(n)
    return {
        "mean": n * a / s,
        "variance": n * a * b * (s + n) / (s * s * (s + 1)),
        "mode": mode.cast("int"),
    }


def poisson_moments(lam: Column) -> dict[str, Column]:
    return {"mean": lam, "variance": lam}


def binomial_moments(n: Column, p: Column) -> dict[str, Column]:
    return {"mean": n * p, "variance": n * p * (F.lit(1.0) - p)}


def hypergeom_moments(pop: Column, succ: Column, sample: Column) -> dict[str, Column]:
    """A population of one has variance 0."""
    share = succ / pop
    variance = F.when(pop > 1, sample * share * (F.lit(1.0) - share) * (pop - sample) / F.nullif(pop - 1, F.lit(0)))
    return {"mean": sample * share, "variance": F.coalesce(variance, F.lit(0.0))}


def exponential_quantile(p: Column, lam: Column) -> Column:
    """Inverse CDF ``−ln(1 − p)/λ`` for p in [0, 1)."""
    return -F.log1p(-p) / lam


# Rational approximation of the standard normal quantile (relative error below 1.2e-9), for the
# middle and for the tails, highest power first.
_MIDDLE_UP = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02,
              -3.066479806614716e01, 2.506628277459239e00)
_MIDDLE_DOWN = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01,
                -1.328068155288572e01, 1.0)
_TAIL_UP = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00,
            4.374664141464968e00, 2.938163982698783e00)
_TAIL_DOWN = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
_TAIL = 0.02425


def _horner(x: Column, coefficients) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column, mu: Column, sigma: Column) -> Column:
    """Inverse CDF of the normal law for p in (0, 1), to the relative error of the approximation above."""
    low = F.least(p, F.lit(1.0) - p)
    q = low - F.lit(0.5)
    r = q * q
    middle = q * _horner(r, _MIDDLE_UP) / _horner(r, _MIDDLE_DOWN)
    t = F.sqrt(F.lit(-2.0) * F.log(low))
    tail = _horner(t, _TAIL_UP) / _horner(t, _TAIL_DOWN)
    z = F.when(low < _TAIL, tail).otherwise(middle)
    return mu + sigma * F.when(p > 0.5, -z).otherwise(z)


def table_quantile(table: DataFrame, by, ps, k: str = "k", prob: str = "prob") -> DataFrame:
    """``(by..., p, value)`` of integer laws: the smallest k whose cumulative probability reaches p, or the last."""
    by = _by(by)
    w = Window.partitionBy(*by).orderBy(k).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = table.withColumn("_cum", F.sum(prob).over(w))
    wide = t.groupBy(*by).agg(*[
        F.coalesce(F.min(F.when(F.col("_cum") >= F.lit(float(p)), F.col(k))), F.max(k)).alias(f"_q{i}") for i, p in enumerate(ps)])
    rows = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col(f"_q{i}").alias("value")) for i, p in enumerate(ps)])
    return wide.select(*by, F.inline(rows))


def pdf_to_pmf(points: DataFrame, by, density: Callable[[Column], Column], x: str = "x") -> DataFrame:
    """Density at each **distinct** point, normalised per group (a PDF viewed as a PMF)."""
    by = _by(by)
    d = points.select(*by, x).distinct().withColumn("_d", density(F.col(x)))
    w = Window.partitionBy(*by)
    return d.withColumn("prob", normalise_weight(F.col("_d"), F.sum("_d").over(w))).drop("_d")
