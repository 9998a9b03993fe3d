"""Quantile trees: bounds hold for any values and any order of merging, nodes stay bounded."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.operators import quantile_tree as qt

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def leaves(values):
    v = np.array(values, np.int64)
    return np.zeros(len(v), np.int64), v, np.ones(len(v), np.int64), v.astype(float)


def check_tree(tree, values, k):
    level, place, n, total = tree
    assert n.sum() == len(values) and total.sum() == pytest.approx(sum(values))
    assert len(set(zip(level.tolist(), place.tolist()))) == len(level) <= 64 * 2**k + 64
    ordered = sorted(values)
    for (at, p, c) in zip(level.tolist(), place.tolist(), n.tolist()):
        assert sum(p << at <= v < (p + 1) << at for v in ordered) >= c


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(-50, 50), st.integers(-2**62, 2**62 - 1)), min_size=1, max_size=120), st.integers(0, 4), st.integers(1, 5))
def test_compression_and_merging_keep_every_value(values, k, pieces):
    whole = qt.compressed(*leaves(values), k)
    check_tree(whole, values, k)
    parts = [qt.compressed(*leaves(values[i::pieces]), k) for i in range(pieces) if values[i::pieces]]
    check_tree(qt.compressed(*(np.concatenate(c) for c in zip(*parts)), k), values, k)


def test_small_trees_are_exact():
    level, place, n, _ = qt.compressed(*leaves([5, 5, -3, 9]), 10)
    assert (level == 0).all() and dict(zip(place.tolist(), n.tolist())) == {5: 2, -3: 1, 9: 1}


@pytest.mark.parametrize("k, spread", [(10, 2_000), (4, 2_000), (4, 2**61), (3, 2**40)])
def test_bounds_of_grouped_trees(spark, k, spread):
    rng = random.Random(k)
    data = [(rng.choice([1, 1, 1, 2, None]), int(rng.choice([rng.uniform(-spread, spread), rng.gauss(0, spread / 50), 7]))) for _ in range(4000)]
    df = spark.createDataFrame([*data, (1, None), (5, None)], "g int, v long").repartition(7)
    trees = qt.build(df, ["g"], "v", k, fan=2)
    rows = {}
    for r in trees.collect():
        rows.setdefault(r["g"], []).append(r)
    groups = {}
    for g, v in data:
        groups.setdefault(g, []).append(v)
    assert {g: sum(r["n"] for r in own) for g, own in rows.items()} == {g: len(v) for g, v in groups.items()}
    assert all(len(own) <= 64 * 2**k + 64 for own in rows.values())
    for r in qt.quantile_bounds(trees, ["g"], PS).collect():
        ordered = sorted(groups[r["g"]])
        rank = max(1, math.ceil(r["p"] * len(ordered)))
        assert r["lower"] <= ordered[rank - 1] <= r["upper"]
        between = sum(r["lower"] <= v <= r["upper"] for v in ordered) - ordered.count(r["lower"]) - ordered.count(r["upper"])
        assert between <= 64 * (len(ordered) >> k) + 1
    for low, high in ((-spread, spread), (0, spread // 3), (7, 8)):
        for r in qt.range_bounds(trees, ["g"], low, high).collect():
            inside = [v for v in groups[r["g"]] if low <= v < high]
            assert r["n_low"] <= len(inside) <= r["n_high"]
            if low >= 0:
                assert r["total_low"] <= sum(inside) * (1 + 1e-9) and sum(inside) <= r["total_high"] * (1 + 1e-9) + 1e-9


def test_ungrouped_trees_and_edges(spark):
    df = spark.range(1, 1001).selectExpr("id AS v").repartition(5)
    trees = qt.build(df, [], "v")
    assert {r["p"]: (r["lower"], r["upper"]) for r in qt.quantile_bounds(trees, [], [0.25, 0.5]).collect()} == {0.25: (250, 250), 0.5: (500, 500)}
    again = qt.merge(trees.unionByName(trees), [])
    assert again.agg({"n": "sum"}).first()[0] == 2000
    assert qt.build(df.where("v < 0"), [], "v").count() == 0
    assert qt.quantile_bounds(qt.build(df.where("v < 0"), [], "v"), [], [0.5]).count() == 0
