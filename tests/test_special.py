"""Incomplete gamma and beta functions against exact sums; inverses against the laws themselves."""

import math
from fractions import Fraction
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import special
from tallyframe.operators import dist


def columns(spark, rows, names, **exprs):
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], ", ".join(f"{n} double" for n in names))
    return df.select(*names, *[e.alias(n) for n, e in exprs.items()]).collect()


def binomial_at_most(k, n, p):
    p = Fraction(p)
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_incomplete_beta_equals_binomial_sums(spark):
    rows = [(a, b, x) for a in (1, 2, 7, 60) for b in (1, 3, 40) for x in (0.0, 1 / 64, 0.25, 0.5, 0.875, 1.0)]
    for r in columns(spark, rows, "abx", v=special.beta_i(F.col("a"), F.col("b"), F.col("x"))):
        n = int(r["a"] + r["b"] - 1)
        want = 1 - binomial_at_most(int(r["a"]) - 1, n, r["x"])
        assert r["v"] == pytest.approx(float(want), rel=1e-11, abs=1e-15), r


def test_incomplete_beta_of_broken_parameters(spark):
    # I_x(1/2, 1/2) is an arc sine; I_x(a, 1) = x^a; I_x(a, b) + I_(1-x)(b, a) = 1.
    rows = [(a, b, x) for a, b in ((0.5, 0.5), (0.3, 1.0), (2.5, 0.7), (500.5, 300.25), (1e5, 2e5)) for x in (1e-6, 0.1, 1 / 3, 0.5, 0.9)]
    got = columns(spark, rows, "abx", v=special.beta_i(F.col("a"), F.col("b"), F.col("x")), w=special.beta_i(F.col("b"), F.col("a"), F.lit(1.0) - F.col("x")))
    for r in got:
        assert r["v"] + r["w"] == pytest.approx(1, abs=1e-11)
        if r["a"] == r["b"] == 0.5:
            assert r["v"] == pytest.approx(2 / math.pi * math.asin(math.sqrt(r["x"])), rel=1e-9)
        if r["b"] == 1:
            assert r["v"] == pytest.approx(r["x"] ** r["a"], rel=1e-10)


def test_incomplete_gamma_equals_poisson_sums(spark):
    rows = [(k, lam) for lam in (0.01, 1.0, 30.0, 1000.0, 20000.0) for k in (0, 1, int(lam), int(lam + 3 * lam**0.5), int(max(0, lam - 3 * lam**0.5)))]
    for r in columns(spark, rows, ["k", "lam"], v=special.poisson_cdf(F.col("k"), F.col("lam"))):
        lam, k = r["lam"], int(r["k"])
        want = math.fsum(math.exp(j * math.log(lam) - lam - math.lgamma(j + 1)) for j in range(k + 1))
        assert r["v"] == pytest.approx(want, rel=1e-9, abs=1e-14), r
    for r in columns(spark, [(0.5, x) for x in (1e-4, 0.5, 2.0, 9.0)], "ax", p=special.gamma_p(F.col("a"), F.col("x")), q=special.gamma_q(F.col("a"), F.col("x"))):
        assert r["p"] == pytest.approx(math.erf(math.sqrt(r["x"])), rel=1e-11) and r["q"] == pytest.approx(math.erfc(math.sqrt(r["x"])), rel=1e-11)


def test_large_parameters_stay_close_to_the_normal_law(spark):
    a = 1e8
    for z in (-2.0, 0.0, 1.5):
        r = columns(spark, [(a, a + z * math.sqrt(a))], "ax", v=special.gamma_p(F.col("a"), F.col("x")))[0]
        assert r["v"] == pytest.approx(NormalDist().cdf(z), abs=1e-4)


def test_quantiles_of_integer_laws(spark):
    ps = (0.0, 1e-6, 0.05, 0.5, 0.95, 0.9999)
    rows = [(p, n, c) for p in ps for n in (0, 1, 7, 60) for c in (0.0, 0.125, 0.5, 1.0)]
    for r in columns(spark, rows, "pnc", v=special.binomial_quantile(F.col("p"), F.col("n"), F.col("c"))):
        n = int(r["n"])
        want = next(k for k in range(n + 1) if binomial_at_most(k, n, r["c"]) >= Fraction(r["p"]) * (1 - Fraction(1, 10**11)))
        assert r["v"] == want, r
    for r in columns(spark, [(p, lam) for p in ps for lam in (0.0, 0.02, 1.0, 44.5, 3000.0)], ["p", "lam"], v=special.poisson_quantile(F.col("p"), F.col("lam"))):
        lam, total, k = r["lam"], 0.0, 0
        mass = lambda j: math.exp(j * math.log(lam) - lam - math.lgamma(j + 1)) if lam else float(j == 0)  # noqa: E731, B023
        total = mass(0)
        while total < r["p"] * (1 - 1e-11):
            k += 1
            total += mass(k)
        assert r["v"] == k, r


def test_quantiles_of_real_laws_invert_their_cdf(spark):
    ps = (0.0, 1e-5, 0.1, 0.5, 0.9, 0.99999)
    rows = [(p, a, b) for p in ps for a, b in ((1, 1), (0.5, 0.5), (2, 5), (300, 7))]
    got = columns(spark, rows, "pab", x=special.beta_quantile(F.col("p"), F.col("a"), F.col("b")), g=special.gamma_quantile(F.col("p"), F.col("a"), F.col("b")))
    back = columns(spark, [(r["a"], r["b"], r["x"], r["g"]) for r in got], "abxg", c=special.beta_cdf(F.col("x"), F.col("a"), F.col("b")), d=special.gamma_cdf(F.col("g"), F.col("a"), F.col("b")))
    for r, s in zip(got, back):
        assert s["c"] == pytest.approx(r["p"], abs=1e-9) and s["d"] == pytest.approx(r["p"], abs=1e-9)
        if r["a"] == r["b"] == 1:
            assert r["x"] == pytest.approx(r["p"]) and r["g"] == pytest.approx(-math.log1p(-r["p"]), rel=1e-9, abs=1e-12)


def test_poisson_table_ends_where_its_cumulative_sum_does(spark):
    params = spark.createDataFrame([(1, 0.3), (2, 12.0), (3, 700.0), (4, 0.0), (5, None)], "g int, lam double")
    for cutoff in (1e-4, 0.3):
        rows = {}
        for r in dist.poisson_pmf(params, ["g"], "lam", cutoff).collect():
            rows.setdefault(r["g"], []).append((r["k"], r["prob"]))
        assert set(rows) == {1, 2, 3}
        for own in rows.values():
            own.sort()
            total = math.fsum(p for _, p in own)
            assert [k for k, _ in own] == list(range(len(own))) and total >= 1 - cutoff - 1e-9 > total - own[-1][1] - 2e-9


def test_null_parameters_give_null(spark):
    df = spark.createDataFrame([(None, 2.0)], "a double, b double")
    assert df.select(special.beta_cdf(F.lit(0.5), F.col("a"), F.col("b")), special.gamma_p(F.col("a"), F.lit(1.0)), special.poisson_cdf(F.lit(3), F.col("a"))).first()[:] == (None, None, None)


def test_binomial_quantiles_in_their_bracket(spark):
    rows = [(q, n, p) for q in (1e-9, 0.05, 0.5, 0.95, 1 - 1e-9) for n in (3.0, 400.0, 1e6) for p in (1e-5, 0.03, 0.5, 0.99)]
    df = spark.createDataFrame(rows, "q double, n double, p double")
    q, n, p = F.col("q"), F.col("n"), F.col("p")
    found = df.select("q", "n", "p", special.binomial_quantile(q, n, p).alias("v"))
    # one fraction for each side of the mean, for the law and its tail, and the halving: no step works its middle out twice
    assert found._jdf.queryExecution().analyzed().toString().count("aggregate(") <= 5
    for r in found.select("*", special.binomial_cdf(F.col("v"), n, p).alias("c"), special.binomial_cdf(F.col("v") - 1, n, p).alias("b"),
                          special.binomial_tail(F.col("v"), n, p).alias("t"), special.binomial_tail(F.col("v") - 1, n, p).alias("u")).collect():
        if r["q"] > 0.5:
            assert r["t"] <= (1 - r["q"]) * (1 + 1e-9) and r["u"] > (1 - r["q"]) * (1 - 1e-9), r
        else:
            assert r["c"] >= r["q"] * (1 - 1e-9) and r["b"] < r["q"] * (1 + 1e-9), r
