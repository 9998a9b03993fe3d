"""Frequent items and task-wise sketches: exact results, guarantees of the summaries, hot groups, edge rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import sketch


def skewed_rows(n=6000):
    rng = random.Random(9)
    items = [f"i{int(rng.paretovariate(0.6))}" for _ in range(n)]
    return [(rng.choice([1, 1, 1, 2, None]), x if rng.random() > 0.02 else None) for x in items]


@pytest.mark.parametrize("pct, counters", [(0.05, None), (0.01, None), (0.002, 600)])
def test_frequent_items_are_exact(spark, pct, counters):
    data = skewed_rows()
    df = spark.createDataFrame(data, "g int, x string").repartition(6)
    groups = Counter(g for g, _ in data)
    counts = Counter(data)
    want = sorted(((g, x, c) for (g, x), c in counts.items() if x is not None and c >= pct * groups[g]), key=repr)
    got = sketch.frequent_items(df, ["g"], "x", pct, counters).collect()
    assert sorted(map(tuple, got), key=repr) == want and want
    whole = Counter(x for _, x in data)
    assert {(r["x"], r["cnt"]) for r in sketch.frequent_items(df, [], "x", pct, counters).collect()} == {
        (x, c) for x, c in whole.items() if x is not None and c >= pct * len(data)}


@pytest.mark.parametrize("held", [1_000_000, 10])
def test_summaries_keep_their_bounds(spark, monkeypatch, held):
    monkeypatch.setattr(sketch, "COUNTERS", held)
    data = skewed_rows()
    df = spark.createDataFrame(data, "g int, x string").repartition(5)
    parts = sketch.misra_gries(df, ["g"], "x", 20).collect()
    true, rows = Counter(data), Counter(g for g, x in data if x is not None)
    low, missed, per_task, seen = Counter(), Counter(), Counter(), Counter()
    for r in parts:
        if r["item"] is None:
            seen[r["g"]] += r["count"]
        low[r["g"], r["item"]] += r["count"]
        missed[r["g"]] += r["missed"]
        per_task[r["g"]] += r["item"] is not None
    assert all(missed[g] <= rows[g] / 20 for g in rows) and seen == Counter(g for g, _ in data)
    for (g, x), c in true.items():
        if x is not None:
            assert low[g, x] <= c <= low[g, x] + missed[g]
    if held > 10:
        assert all(n <= 5 * 20 for n in per_task.values())


def test_task_sketches_equal_the_counted_sketch(spark):
    df = spark.createDataFrame([r for r in skewed_rows() if r[1] is not None], "g int, x string").repartition(4)
    for by in ([], ["g"]):
        one = sketch.cms_build(df, by, "x", 0.02, 0.01)
        two = sketch.cms_partials(df, by, "x", 0.02, 0.01)
        assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.select(one.columns).collect()), key=repr)


def test_heavy_hitters_without_grouping_all_items(spark, monkeypatch):
    df = spark.createDataFrame([(1, x) for _, x in skewed_rows() if x is not None], "g int, x string").repartition(4)
    one = sketch.heavy_hitters(df, [], "x", 0.01, 0.01, 0.01)
    two = sketch.heavy_hitters(df, ["g"], "x", 0.01, 0.01, 0.01)
    assert {(r["x"], r["est"], r["exact"]) for r in one.collect()} == {(r["x"], r["est"], r["exact"]) for r in two.collect()}
    monkeypatch.setattr(sketch, "CELLS", 1)  # a sketch too wide to send
    monkeypatch.setattr(sketch, "BROADCAST_CELLS", 1)
    three = sketch.heavy_hitters(df, [], "x", 0.01, 0.01, 0.01)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, three.select(one.columns).collect()))
    monkeypatch.undo()
    numbers = spark.range(50).select((F.col("id") % 4).alias("v"))
    assert {(r["v"], r["exact"]) for r in sketch.heavy_hitters(numbers, [], "v", 0.01, 0.01, 0.2).collect()} == {(0, 13), (1, 13), (2, 12), (3, 12)}


def test_edges(spark):
    empty = spark.createDataFrame([], "g int, x string")
    assert sketch.frequent_items(empty, ["g"], "x", 0.1).count() == 0
    assert sketch.frequent_items(empty, [], "x", 0.1).count() == 0
    nulls = spark.createDataFrame([(1, None), (1, None), (1, "a")], "g int, x string")
    assert [tuple(r) for r in sketch.frequent_items(nulls, ["g"], "x", 0.3).collect()] == [(1, "a", 1)]
    assert sketch.frequent_items(nulls, ["g"], "x", 0.4).count() == 0
    assert sketch.heavy_hitters(empty, [], "x", 0.1, 0.1, 0.1).count() == 0
    numbers = spark.range(90).select(F.lit(1).alias("g"), (F.col("id") % 3).alias("n"))
    assert sorted(map(tuple, sketch.frequent_items(numbers, ["g"], "n", 0.3).collect())) == [(1, 0, 30), (1, 1, 30), (1, 2, 30)]


def test_heavy_hitters_read_the_input_once(spark, monkeypatch):
    monkeypatch.setattr(sketch, "HASHES", 4)
    df = spark.createDataFrame([(w,) for w in ["a"] * 50 + ["b"] * 30 + [None] * 9 + [f"r{i % 15}" for i in range(20)]], "x string").repartition(3)
    counted = sketch.item_counts(df, "x")
    assert {(r["_item"], r["n"]) for r in counted.groupBy("_item").agg(F.sum("cnt").alias("n")).collect() if r["n"] > 2} == {("a", 50), ("b", 30)}
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    hits = sketch.heavy_hitters(df.mapInArrow(seen, df.schema), [], "x", 0.01, 0.01, 0.2).collect()
    assert {(r["x"], r["exact"]) for r in hits} == {("a", 50), ("b", 30)} and reads.value == df.count()
