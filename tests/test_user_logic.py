"""State machines, user-defined aggregators and other logic that users bring: brute force, hot keys, edge rows."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.operators import aggregator, cdf, fold, fsm, ordered, pmf, sgd
from tallyframe.operators.aggregator import Aggregator

STATES = ["a", "b", "c"]


def logic(state):
    """x turns a to b to c to a, y resets to b, z depends on the value, others are not covered."""
    return (
        F.when((F.col("k") == "x") & (state == "a"), "b").when((F.col("k") == "x") & (state == "b"), "c").when(F.col("k") == "x", "a")
        .when(F.col("k") == "y", "b").when((F.col("k") == "z") & (F.col("v") > 5) & (state != "b"), "c"))


def by_hand(state, k, v):
    if k == "x":
        return {"a": "b", "b": "c", "c": "a"}[state]
    if k == "y":
        return "b"
    return "c" if k == "z" and v is not None and v > 5 and state != "b" else state


def event_rows(n=900):
    rng = random.Random(4)
    keys = [1] * 4 + [2, 3, None]  # more than a third of the rows have key 1
    return [(rng.choice(keys), i, rng.choice("xyzzqx"), rng.choice([None, 1, 9]), f"n{i}") for i in range(n)]


def states_by_hand(rows):
    state, out = defaultdict(lambda: "a"), []
    for g, i, k, v, name in sorted(rows, key=lambda r: r[1]):
        state[g] = by_hand(state[g], k, v)
        out.append((g, i, name, state[g]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows, group", [(7, 3), (50_000, 4096)])
def test_state_machine_equals_the_fold_in_order(spark, rows, group):
    data = event_rows()
    df = spark.createDataFrame(data, "g int, i long, k string, v int, name string").repartition(5)
    got = fsm.scan(df, ["g"], ["i"], STATES, logic, "a", block=ordered.value_block("i", 50), keep=["name"], rows=rows, group=group)
    assert got.columns == ["g", "i", "name", "state"]
    assert sorted(map(tuple, got.collect()), key=repr) == states_by_hand(data)
    whole = fsm.scan(df, [], ["i"], STATES, logic, "a", keep=["name"], rows=rows, group=group).collect()
    assert sorted((r["i"], r["state"]) for r in whole) == sorted(r[1::2] for r in states_by_hand([(0, *r[1:]) for r in data]))
    last = {r["g"]: (r["state"], r["inputs"]) for r in fsm.final(df, ["g"], ["i"], STATES, logic, "a", rows=rows, group=group).collect()}
    want = {}
    for g, i, _, s in sorted(states_by_hand(data), key=lambda r: r[1]):
        want[g] = (s, want.get(g, (0, 0))[1] + 1)
    assert last == want


def test_state_machine_chunks_a_hot_key(spark):
    df = spark.range(10_000).select(F.lit(1).alias("g"), F.col("id").alias("i"), F.lit("x").alias("k"), F.lit(1).alias("v"))
    chunks = ordered.row_chunks(df, ["g"], ["i"], 300, "c", ordered.value_block("i", 1000)).groupBy("c").count().collect()
    assert len(chunks) == 34 and max(r["count"] for r in chunks) == 300
    got = fsm.scan(df, ["g"], ["i"], STATES, logic, "a", rows=300, group=5).where("i = 9999").first()
    assert got["state"] == "b"  # 10,000 = 1 modulo 3 steps from a


def test_state_machine_edges(spark):
    empty = spark.createDataFrame([], "g int, i long, k string, v int")
    assert fsm.scan(empty, ["g"], ["i"], STATES, logic, "a").count() == 0
    numbers = spark.createDataFrame([(1, 1, "x", 3), (1, 2, "x", 3)], "g int, i long, k string, v int")
    got = fsm.scan(numbers, ["g"], ["i"], [0, 1, 2], lambda s: s + 1, 0).orderBy("i").collect()
    assert [r["state"] for r in got] == [1, 2] and got[0]["state"].__class__ is int
    with pytest.raises(Exception, match="not one of the states"):
        fsm.scan(numbers, ["g"], ["i"], [0, 1], lambda s: s + 1, 0).collect()
    with pytest.raises(ValueError, match="states"):
        fsm.scan(numbers, ["g"], ["i"], [0, 1], lambda s: s, 7)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 5), st.integers(0, 10**6))
def test_composition_is_the_fold(n, k, seed):
    maps = np.random.default_rng(seed).integers(0, k, (n, k))
    state, seen = list(range(k)), []
    for row in maps:
        state = [int(row[s]) for s in state]
        seen.append(state)
    assert fsm.composed(maps).tolist() == state
    for start in range(k):
        assert fsm.states_after(maps, start).tolist() == [s[start] for s in seen]


# --- user-defined aggregators ---

#: The longest common prefix, the joined values and their number: neither commutative nor built in.
WORDS = Aggregator("first string, joined string, n long", lambda s: (s, s, 1),
                   lambda a, b: (a[0], a[1] + b[1], a[2] + b[2]), "joined string, n long", lambda s: (s[1], s[2]))


@pytest.mark.parametrize("keys, fan", [(200_000, 256), (2, 2)])
def test_aggregator_in_order_with_a_hot_key(spark, keys, fan):
    data = [(r[0], r[4]) for r in event_rows(600)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(data, 9), "g int, s string")
    want = defaultdict(list)
    for g, s in data:  # the order of the table's partitions
        want[g].append(s)
    got = {r["g"]: (r["joined"], r["n"]) for r in aggregator.aggregate(df, ["g"], ["s"], WORDS, keys, fan).collect()}
    assert got == {g: ("".join(s), len(s)) for g, s in want.items()}
    whole = aggregator.aggregate(df, [], ["s"], WORDS, keys, fan).collect()
    assert [tuple(r) for r in whole] == [("".join(s for _, s in data), len(data))]


def test_aggregator_parts_hold_no_group(spark):
    df = spark.range(5000).select(F.lit("hot").alias("g"), F.col("id").cast("string").alias("s")).repartition(20)
    partial = aggregator.partial_states(df, ["g"], ["s"], WORDS)
    assert partial.count() == 20  # one state per task, whatever the key holds
    stored = aggregator.merged(partial, ["g"], WORDS, fan=4)
    assert stored.first()["n"] == 5000


def test_aggregators_together_and_edges(spark):
    mean = Aggregator("n long, total double", lambda v: (1, float(v)), lambda a, b: (a[0] + b[0], a[1] + b[1])).presented("mean double", lambda s: (s[1] / s[0],))
    high = Aggregator("top long", lambda v: (v,), lambda a, b: (max(a[0], b[0]),))
    both = aggregator.together(mean, high.prepared(lambda v: (v * v,)))
    df = spark.createDataFrame([(None, 3), (None, -4), (1, 2)], "g int, v long")
    assert {r["g"]: (r["mean"], r["top"]) for r in aggregator.aggregate(df, ["g"], ["v"], both).collect()} == {None: (-0.5, 16), 1: (2.0, 4)}
    assert aggregator.aggregate(df.limit(0), ["g"], ["v"], both).count() == 0
    assert aggregator.aggregate(df.limit(0), [], ["v"], both).columns == ["mean", "top"]


def test_log_mean_exp_does_not_overflow(spark):
    from tallyframe.plans.monoid_plans import LOG_SUM_EXP

    values = [1000.0, 1001.5, -2000.0, 999.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = aggregator.aggregate(df, [], ["v"], LOG_SUM_EXP).first()
    top = max(values)
    assert got["log_mean_exp"] == pytest.approx(top + math.log(sum(math.exp(v - top) for v in values) / len(values)))


# --- gradients that are not affine ---


def logistic_rows(n=4000, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 2))
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-(2.0 * x[:, 0] - 1.0 * x[:, 1] + 0.5)))).astype(float)
    return [(1, i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]


def sequential(rows, gradient, step, w, passes=1):
    for _ in range(passes):
        for _, _, a, b, y in rows:
            w = w - step * gradient(w, np.array([a, b, 1.0]), y)
    return w


def test_mixed_passes_come_close_to_the_sequential_one(spark):
    rows = logistic_rows()
    df = spark.createDataFrame(rows, "g int, i long, a double, b double, y double").repartition(6)
    want = sequential(rows, sgd.logistic_gradient, 0.05, np.zeros(3))
    one = sgd.sgd_mixed(df, ["g"], ["i"], "y", ["a", "b"], 0.05).first()
    assert one["w"] == pytest.approx(want.tolist(), abs=1e-12) and one["count"] == 4000  # a single chunk is the pass itself
    mixed = sgd.sgd_mixed(df, ["g"], ["i"], "y", ["a", "b"], 0.05, rounds=8, chunk_rows=500).first()
    again = sequential(rows, sgd.logistic_gradient, 0.05, np.zeros(3), passes=8)
    assert np.abs(np.array(mixed["w"]) - again).max() < 0.2  # the stated distance: eight mixed rounds, eight passes
    j = df.crossJoin(spark.createDataFrame([(mixed["w"], again.tolist())], "w array<double>, s array<double>"))
    losses = j.agg(sgd.log_loss("y", ["a", "b"], F.col("w")).alias("m"), sgd.log_loss("y", ["a", "b"], F.col("s")).alias("s")).first()
    assert losses["m"] < losses["s"] + 0.002


def test_own_gradient_null_points_and_edges(spark):
    def huber(w, x, y):  # the slope of the absolute error, softened
        miss = float(w @ x) - y
        return max(-1.0, min(1.0, miss)) * x

    rows = [(g, i, a, b, 3 * a - b + 1 + (50 if i % 40 == 0 else 0)) for g in (1, None) for _, i, a, b, _ in logistic_rows(300, g or 9)]
    holes = [(1, 9000, None, 1.0, 1.0), (1, 9001, 1.0, 1.0, None)]
    df = spark.createDataFrame([*rows, *holes], "g int, i long, a double, b double, y double").repartition(3)
    got = {r["g"]: r for r in sgd.sgd_mixed(df, ["g"], ["i"], "y", ["a", "b"], 0.1, huber, w0=[1, 1, 1]).collect()}
    for g in (1, None):
        want = sequential([r for r in rows if r[0] == g], huber, 0.1, np.ones(3))
        assert got[g]["w"] == pytest.approx(want.tolist(), abs=1e-12) and got[g]["count"] == 300
    assert sgd.sgd_mixed(df.limit(0), ["g"], ["i"], "y", ["a", "b"], 0.1, rounds=2).count() == 0
    whole = sgd.sgd_mixed(df, [], ["i", "a"], "y", ["a", "b"], 0.1, huber, rounds=2, chunk_rows=100).collect()
    assert len(whole) == 1 and whole[0]["count"] == 600


def test_passes_side_by_side_equal_single_ones():
    rng = np.random.default_rng(3)
    chunks = [np.column_stack([rng.integers(0, 2, n).astype(float), rng.normal(size=n)]) for n in (5, 0, 40, 1, 40, 17)]
    w = rng.normal(size=(len(chunks), 2))
    got = sgd._passes(chunks, w, 0.1, sgd.logistic_gradients)
    for c, start, end in zip(chunks, w, got):
        for y, x in c:
            start = start - 0.1 * sgd.logistic_gradient(start, np.array([x, 1.0]), y)
        assert end == pytest.approx(start, abs=1e-13)


@pytest.mark.parametrize("size", [1, 7, 100])
def test_mixed_passes_of_many_small_chunks(spark, size):
    """Chunks over the edges of Arrow batches, NULL keys and NULL places (last), against the rounds by hand."""
    rows = [(g, i, a, b, y) for g in (1, None, 3) for _, i, a, b, y in logistic_rows(290 if g == 1 else 33, g or 5)] + [(1, None, 0.5, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "g int, i long, a double, b double, y double").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        got = {r["g"]: r for r in sgd.sgd_mixed(df, ["g"], ["i"], "y", ["a", "b"], 0.1, rounds=2, chunk_rows=size).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for g in (1, None, 3):
        own, w = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, r[1] or 0)), np.zeros(3)
        for _ in range(2):
            cut = [own[k:k + size] for k in range(0, len(own), size)]
            w = sum(len(c) * sequential(c, sgd.logistic_gradient, 0.1, w) for c in cut) / len(own)
        assert got[g]["w"] == pytest.approx(w.tolist(), abs=1e-11) and got[g]["count"] == len(own)


# --- running sums in ranges ---


def test_ranged_cdf_of_a_hot_group(spark):
    rng = random.Random(6)
    rows = [(1, i) for i in rng.sample(range(100_000), 4000)] + [(g, rng.randint(0, 50)) for g in range(2, 900) for _ in range(3)] + [(None, 3), (None, 5), (None, 5)]
    df = spark.createDataFrame(rows, "g int, outcome int").repartition(5)
    p = pmf.from_keys(df, ["g"], "outcome").select("g", "outcome", "n")
    got = cdf.ranged_cdf(p, ["g"], parts=24)
    want = cdf.to_cdf(p, ["g"])
    names = ["g", "outcome", "n", "cum", "total"]
    assert sorted(map(tuple, got.select(names).collect()), key=repr) == sorted(map(tuple, want.select(names).collect()), key=repr)
    assert {r["cdf"] for r in got.groupBy("g").agg(F.max("cdf").alias("cdf")).collect()} == {1.0}
    cut = p.repartitionByRange(24, "g", "outcome").groupBy(F.spark_partition_id(), F.col("g").eqNullSafe(1)).count().collect()
    assert max(r["count"] for r in cut) < 3 * p.count() / 24  # the hot group lies in many ranges
    whole = cdf.ranged_cdf(p.where("g = 1").drop("g"), [], parts=7).orderBy("outcome").collect()
    assert [r["cum"] for r in whole] == list(range(1, 4001)) and {r["total"] for r in whole} == {4000}
    assert cdf.ranged_cdf(p.where("g < 0"), ["g"]).count() == 0


def test_short_keys_share_one_stream_of_batches(spark):
    """Many keys of one chunk each and a long one: no call per key, also with NULL places, which come last."""
    df = spark.range(6000).select((F.col("id") % 3000).alias("g"), F.col("id").alias("i"), F.lit("x").alias("k"), F.lit(1).alias("v"))
    df = df.unionByName(spark.range(1, 90).select(F.lit(-1).cast("long").alias("g"), F.col("id").alias("i"), F.lit("x").alias("k"), F.lit(1).alias("v")))
    df = df.unionByName(spark.createDataFrame([(-1, None, "y", 1)], "g long, i long, k string, v int"))
    out = fsm.scan(df, ["g"], ["i"], STATES, logic, "a", block=ordered.value_block("i", 50), rows=20, group=2)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1  # the rows of short keys pass no grouped call
    got = out.collect()
    assert {(r["i"] >= 3000, r["state"]) for r in got if r["g"] >= 0} == {(False, "b"), (True, "c")}
    hot = sorted((r for r in got if r["g"] == -1), key=lambda r: (r["i"] is None, r["i"] or 0))
    assert [r["state"] for r in hot] == [STATES[r["i"] % 3] for r in hot[:-1]] + ["b"]
    ones = fold.affine_scan(df, ["g"], ["i"], F.lit(0.5), F.lit(1.0), block=ordered.value_block("i", 50), rows=20)
    assert ones._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = ones.collect()
    assert {(r["i"] >= 3000, r["state"]) for r in got if r["g"] >= 0} == {(False, 1.0), (True, 1.5)}
    hot = sorted((r for r in got if r["g"] == -1), key=lambda r: (r["i"] is None, r["i"] or 0))
    want = 0.0
    for r in hot:
        want = 0.5 * want + 1.0
        assert r["state"] == want
