"""Exact laws of sums and maxima against products of all outcomes, in blocks of any size, directly and by Fourier transform."""

import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.operators import cdf, exact, pmf


def laws(seed, groups=(1, 2, None), comps=5, low=-6, high=9):
    """{group: {comp: {outcome: weight}}}; a different number of components per group."""
    rng = random.Random(seed)
    return {g: {c: {rng.randint(low, high): rng.randint(1, 9) for _ in range(rng.randint(1, 6))} for c in range(comps - i)} for i, g in enumerate(groups)}


def frame(spark, given, step=1.0, times=None):
    rows = []
    for g, comps in given.items():
        for c, law in comps.items():
            total = sum(law.values())
            rows += [(g, f"c{c}", k * step, w / total, (times or {}).get(c, 1)) for k, w in law.items()]
    return spark.createDataFrame(rows, "g int, comp string, outcome double, prob double, times long").repartition(4)


def summed(comps, times=None):
    out = {0: Fraction(1)}
    for c, law in comps.items():
        total = sum(law.values())
        for _ in range((times or {}).get(c, 1)):
            new = defaultdict(Fraction)
            for a, p in out.items():
                for b, w in law.items():
                    new[a + b] += p * Fraction(w, total)
            out = new
    return out


def check(rows, given, step=1.0, times=None):
    got = defaultdict(dict)
    for r in rows:
        got[r["g"]][round(r["outcome"] / step)] = r["prob"]
    for g, comps in given.items():
        want = summed(comps, times)
        assert set(got[g]) == set(want)
        assert all(got[g][k] == pytest.approx(float(p), rel=1e-9, abs=1e-14) for k, p in want.items())


@pytest.mark.parametrize("block, direct", [(5, 64), (5, 0), (4096, 64), (64, 0)])
def test_sums_of_different_laws(spark, monkeypatch, block, direct):
    monkeypatch.setattr(exact, "DIRECT", direct)
    given = laws(block + direct)
    check(exact.sum_law(frame(spark, given), ["g"], "comp", block=block).collect(), given)


def test_repeated_draws_and_steps(spark):
    given, times = laws(3, groups=(1, 2)), {0: 5, 1: 0, 2: 3, 3: 1, 4: 2}
    check(exact.sum_law(frame(spark, given, 0.25, times), ["g"], "comp", times="times", step=0.25, block=8).collect(), given, 0.25, times)


def test_a_sum_of_many_draws_is_a_binomial_law(spark):
    coin = spark.createDataFrame([("c", 0.0, 0.75, 1000), ("c", 1.0, 0.25, 1000)], "comp string, outcome double, prob double, times long")
    got = {r["outcome"]: r["prob"] for r in exact.sum_law(coin, [], "comp", times="times", block=128).collect()}
    for k in (200, 250, 300):
        assert got[k] == pytest.approx(math.comb(1000, k) * 0.25**k * 0.75 ** (1000 - k), rel=1e-6)
    assert sum(got.values()) == pytest.approx(1)


def test_edges_of_sums(spark):
    given = laws(9, groups=(None,), comps=1)
    check(exact.sum_law(frame(spark, given), ["g"], "comp").collect(), given)  # one component is its own law
    empty = frame(spark, given).limit(0)
    assert exact.sum_law(empty, ["g"], "comp").count() == 0 and exact.sum_law(empty, [], "comp", times="times").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 10**6), st.booleans())
def test_block_products(n, seed, dense):
    rng = np.random.default_rng(seed)
    a, b = (rng.uniform(size=n) * (rng.uniform(size=n) < (0.9 if dense else 0.2)) for _ in range(2))
    old, exact.DIRECT = exact.DIRECT, 64 * (seed % 2)
    try:
        got = exact.convolved(a, b)
    finally:
        exact.DIRECT = old
    assert len(got) == 2 * n and got[:2 * n - 1] == pytest.approx(np.convolve(a, b), abs=1e-13)
    assert ((got > 0) == np.append(np.convolve(a > 0, b > 0), 0).astype(bool)).all()


def test_largest_of_different_laws(spark):
    given, times = laws(21, comps=4), {0: 2, 1: 1, 2: 7, 3: 1}
    table = cdf.to_cdf(pmf.from_weights(frame(spark, given), ["g", "comp"], "outcome", "prob"), ["g", "comp"], weight="weight")
    table = table.join(spark.createDataFrame([(f"c{c}", n) for c, n in times.items()], "comp string, times long"), "comp")
    for use in (None, "times"):
        got = defaultdict(dict)
        for r in exact.max_law(table, ["g"], "comp", times=use).collect():
            got[r["g"]][r["outcome"]] = r["cdf"]
        for g, comps in given.items():
            every = sorted({k for law in comps.values() for k in law})
            want = {k: math.prod((sum(w for x, w in law.items() if x <= k) / sum(law.values())) ** (times[c] if use else 1) for c, law in comps.items()) for k in every}
            assert got[g] == pytest.approx({k: p for k, p in want.items() if p > 0}, rel=1e-9)


def test_largest_over_outcome_blocks_and_edges(spark):
    given = laws(5, groups=(1,), comps=6, low=0, high=400)
    rows = [(1, c, float(k), sum(w for x, w in law.items() if x <= k) / sum(law.values())) for c, law in given[1].items() for k in law]
    df = spark.createDataFrame(rows, "g int, comp int, outcome double, cdf double").repartition(3)
    one = exact.max_law(df, ["g"], "comp")
    two = exact.max_law(df, ["g"], "comp", block=F.floor(F.col("outcome") / 40).cast("bigint"))
    a, b = ({r["outcome"]: r["cdf"] for r in x.collect()} for x in (one, two))
    assert a == pytest.approx(b) and max(a.values()) == pytest.approx(1)
    assert exact.max_law(df.limit(0), ["g"], "comp").count() == 0
