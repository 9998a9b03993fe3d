"""Operators against brute force on small inputs, algebraic properties and edge rows."""

import itertools
import math
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import bayes, cdf, combine, decay, dist, fold, monoid, ordered, pmf, sample, sgd, sketch
from tallyframe.sources import parse_pairs, read_json_records, read_xy_csv


def test_normalise_and_zero_mass(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0), (2, "a", 0.0), (2, "b", 0.0)], "g int, outcome string, weight double")
    out = {(r["g"], r["outcome"]): r["weight"] for r in pmf.normalize(df, ["g"]).collect()}
    assert out == {(1, "a"): 0.25, (1, "b"): 0.75, (2, "a"): 0.0, (2, "b"): 0.0}
    glob = pmf.normalize(df.where("g = 1"), []).agg(F.sum("weight")).first()[0]
    assert glob == pytest.approx(1.0)


def test_empty_input(spark):
    df = spark.createDataFrame([], "g int, k int")
    assert pmf.from_keys(df, ["g"], "k").count() == 0
    assert cdf.to_cdf(pmf.from_keys(df, ["g"], "k"), ["g"]).count() == 0


def test_cdf_pmf_round_trip(spark):
    rows = [(g, random.Random(g * 100 + i).randint(0, 9)) for g in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, k int")
    p = pmf.from_keys(df, ["g"], "k")
    back = cdf.to_pmf(cdf.to_cdf(p, ["g"]), ["g"])
    diff = back.select(F.max(F.abs(F.col("prob") - F.col("n") / F.col("total")))).first()[0]
    assert diff < 1e-12
    sums = p.groupBy("g").agg(F.sum("prob").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-12 for r in sums)


def test_inverse_and_lookup_vs_brute_force(spark):
    vals = [1, 1, 2, 5, 5, 5, 9]
    df = spark.createDataFrame([(0, v) for v in vals], "g int, k int")
    c = cdf.to_cdf(pmf.from_keys(df, ["g"], "k"), ["g"])
    q = {r["p"]: r["value"] for r in cdf.inverse(c, ["g"], [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    srt = sorted(vals)
    for p, v in q.items():
        need = p * len(vals)
        assert v == next(x for i, x in enumerate(srt) if i + 1 >= need)
    probes = spark.createDataFrame([(0, x) for x in (-1.0, 0.99, 1.0, 3.5, 5.0, 8.9, 9.0, 100.0)], "g int, x double")
    got = {r["x"]: r["cdf"] for r in cdf.lookup(c, probes, ["g"], "x", buckets=4).collect()}
    for x, v in got.items():
        assert v == pytest.approx(sum(1 for y in vals if y <= x) / len(vals))


def test_sample_lookup_vs_brute_force(spark):
    df = spark.createDataFrame([(k,) for k in [1, 2, 2, 3, 3, 3]], "k int")
    c = cdf.to_cdf(pmf.from_keys(df, [], "k"), [])
    us = [0.0, 1 / 6, 0.2, 0.5, 0.5000001, 0.99]
    draws = spark.createDataFrame([(i, u) for i, u in enumerate(us)], "id int, u double")
    got = {r["id"]: r["outcome"] for r in cdf.sample_lookup(c, draws, [], "u", buckets=3).collect()}
    cum = [(1, 1 / 6), (2, 3 / 6), (3, 1.0)]
    for i, u in enumerate(us):
        assert got[i] == next(k for k, cv in cum if cv > u)


def test_sampling_is_reproducible(spark):
    df = spark.createDataFrame([(k,) for k in [1, 2, 2, 3]], "k int")
    c = cdf.to_cdf(pmf.from_keys(df, [], "k"), [])
    draws = spark.range(2000).withColumnRenamed("id", "d")
    a = sample.draw(c, draws, [], "d", "s").groupBy("outcome").count().orderBy("outcome").collect()
    b = sample.draw(c, draws.repartition(7), [], "d", "s").groupBy("outcome").count().orderBy("outcome").collect()
    assert a == b
    freq = {r["outcome"]: r["count"] / 2000 for r in a}
    assert freq[2] == pytest.approx(0.5, abs=0.05)


def test_convolution_vs_brute_force(spark):
    a = [(1, 0.5), (2, 0.5)]
    b = [(1, 0.25), (3, 0.75)]
    A = spark.createDataFrame(a, "outcome int, prob double")
    B = spark.createDataFrame(b, "outcome int, prob double")
    got = {r["outcome"]: r["prob"] for r in combine.add(A, B, []).collect()}
    exp = {}
    for ka, pa in a:
        for kb, pb in b:
            exp[ka + kb] = exp.get(ka + kb, 0) + pa * pb
    assert got == pytest.approx(exp)


def test_hot_key_running_sums_equal_window(spark):
    rows = [(1 if i % 3 == 0 else i % 17, i, float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    r = ordered.running_sums(df, ["k"], ["t"], {"s": F.col("v")}, block=ordered.value_block("t", 100))
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("s2", F.sum("v").over(w))
    bad = r.join(ref, ["k", "t"]).where(F.abs(F.col("s") - F.col("s2")) > 1e-9).count()
    assert bad == 0
    m = ordered.running(df, ["k"], ["t"], {"m": ("max", F.col("v"))}, block=ordered.value_block("t", 100))
    ref2 = df.withColumn("m2", F.max("v").over(w))
    assert m.join(ref2, ["k", "t"]).where(F.col("m") != F.col("m2")).count() == 0


def test_decayed_running_matches_step_recursion(spark):
    rnd = random.Random(7)
    vals = [rnd.uniform(0, 10) for _ in range(1000)]
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(vals)], "g int, t int, v double")
    got = decay.decayed_running(df, ["g"], ["t"], "v", F.col("t").cast("double"), 10.0, blocks_per_anchor=5.0)
    got = {r["t"]: r["decayed"] for r in got.collect()}
    d, step = 0.0, 2 ** (-1 / 10)
    for i, v in enumerate(vals):
        d = d * step + v
        assert got[i] == pytest.approx(d, rel=1e-9)
    tot = decay.decayed_value(df, ["g"], "v", F.col("t").cast("double"), 10.0, blocks_per_anchor=5.0).first()
    assert tot["decayed"] == pytest.approx(d, rel=1e-9)
    assert tot["decayed_avg"] == pytest.approx(d * math.log(2) / 10, rel=1e-9)


def test_sgd_blocks_equal_sequential(spark):
    rnd = random.Random(3)
    pts = [(i, rnd.random(), 0.0) for i in range(500)]
    pts = [(i, x, 2 * x + 4 + rnd.uniform(-1e-3, 1e-3)) for i, x, _ in pts]
    df = spark.createDataFrame(pts, "seq int, x double, y double")
    w = [0.0, 0.0]
    for _, x, y in pts:
        err = w[0] * x + w[1] - y
        w = [w[0] - 0.05 * err * x, w[1] - 0.05 * err]
    got = sgd.sgd_linear(df, [], ["seq"], "y", ["x"], 0.05, [0.0, 0.0], block=F.floor(F.col("seq") / 37)).first()
    assert got["count"] == 500
    assert got["w"] == pytest.approx(w, rel=1e-9, abs=1e-12)
    small = sgd.sgd_linear(df, [], ["seq"], "y", ["x"], 0.05, [0.0, 0.0], chunk_rows=7).first()
    assert (small["count"], small["w"]) == (500, pytest.approx(w, rel=1e-9, abs=1e-12))
    mse = df.select(sgd.mse(df, "y", ["x"], F.array(F.lit(0.0), F.lit(0.0)))).first()[0]
    assert mse == pytest.approx(sum(y * y for _, _, y in pts) / 500)


def test_bloom_no_false_negatives_and_cms_bounds(spark):
    words = spark.createDataFrame([(f"w{i % 300}",) for i in range(3000)], "w string")
    filt, params = sketch.bloom_build(words, [], "w", 0.01)
    mem = sketch.bloom_contains(filt, params, words, [], "w")
    assert mem.where(~F.col("in_filter")).count() == 0
    others = spark.createDataFrame([(f"x{i}",) for i in range(2000)], "w string")
    fp = sketch.bloom_contains(filt, params, others, [], "w").where("in_filter").count() / 2000
    assert fp < 0.05
    sk = sketch.cms_build(words, [], F.col("w"), 0.01, 1e-3)
    est = sketch.cms_estimate(sk, words, [], "w", 0.01, 1e-3)
    exact = monoid.count_by_key(words, "w", "exact")
    j = est.join(exact, "w")
    assert j.where((F.col("est") < F.col("exact")) | (F.col("est") > F.col("exact") + 0.01 * 3000)).count() == 0


def test_qtree_bounds_contain_exact(spark):
    rnd = random.Random(11)
    vals = [rnd.randint(1, 10_000_000) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    srt = sorted(vals)
    for r in sketch.qtree_bounds(df, [], "v", [0.25, 0.5, 0.75], level=10).collect():
        exact = srt[max(1, math.ceil(r["p"] * len(vals))) - 1]
        assert r["lower"] <= exact <= r["upper"]


def test_hll_merge_equals_whole(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("x"), (F.col("id") % 2).alias("half"))
    parts = sketch.hll_sketch(df, ["half"], "x", 12)
    merged = sketch.hll_merge(parts, []).select(sketch.hll_estimate("sketch")).first()[0]
    whole = sketch.hll_sketch(df, [], "x", 12).select(sketch.hll_estimate("sketch")).first()[0]
    assert merged == whole
    assert abs(whole - 5000) <= 4 * sketch.hll_rse(12) * 5000


def test_sources(spark, tmp_path):
    p = tmp_path / "dim.json"
    p.write_text('[{"id": 1, "title": "a"}, {"id": 2, "title": "b"}, {"id": 3, "title": "c"}]')
    assert read_json_records(spark, str(p)).count() == 3
    c = tmp_path / "xy.csv"
    c.write_text("0.5, 1.0\n 0.25,2.0\n1.0 , 3.5\n")
    rows = read_xy_csv(spark, str(c)).orderBy("seq").collect()
    assert [(r["x"], r["y"]) for r in rows] == [(0.5, 1.0), (0.25, 2.0), (1.0, 3.5)]
    msgs = spark.createDataFrame([("1, 90001",), ("2,90002",), ("x, 1",)], "m string")
    out = msgs.select(*parse_pairs(F.col("m"))).collect()
    assert [(r["userId"], r["itemId"]) for r in out] == [(1, 90001), (2, 90002), (None, 1)]


def test_words_drop_empty_tokens(spark):
    df = spark.createDataFrame([(" A b\tb\n c ",)], "text string")
    assert [r["word"] for r in monoid.word_rows(df, "text").collect()] == ["a", "b", "b", "c"]


def test_blocked_cdf_paths_equal_plain(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(rnd.randint(0, 5000),) for _ in range(4000)], "k int")
    p = pmf.from_keys(df, [], "k")
    plain = cdf.to_cdf(p, [], block=None)
    blocked = cdf.to_cdf(p, [], block=ordered.auto_block(p, "outcome", 16))
    j = plain.join(blocked.select("outcome", F.col("cum").alias("cum2")), "outcome")
    assert j.where(F.col("cum") != F.col("cum2")).count() == 0
    back = cdf.to_pmf(blocked, [], block=ordered.auto_block(blocked, "outcome", 16))
    assert back.where(F.col("mass") != F.col("n")).count() == 0
    nxt = ordered.neighbour(p, [], ["outcome"], "outcome", "nxt", "next", ordered.value_block("outcome", 300))
    ref = p.withColumn("nxt2", F.lead("outcome").over(Window.orderBy("outcome")))
    assert nxt.join(ref, "outcome").where(~F.col("nxt").eqNullSafe(F.col("nxt2"))).count() == 0


@pytest.mark.parametrize("rows", [1, 7, 1000])
def test_affine_scan_with_a_hot_key_resets_and_nulls(spark, rows):
    rnd = random.Random(rows)
    data = [(rnd.choice(["hot", "hot", "hot", "k1", None]), i, rnd.choice([0.0, 0.5, -1.5, 1.0, None]), rnd.choice([1.0, -2.0, 0.25, None]))
            for i in range(300)]
    df = spark.createDataFrame(data, "k string, t int, a double, b double")
    want, state = {}, {}
    for k, t, a, b in data:
        s = state.get(k, 3.0)
        state[k] = s if a is None or b is None else a * s + b
        want[t] = (k, state[k])
    for block in (None, F.floor(F.col("t") / 40)):
        got = fold.affine_scan(df, ["k"], ["t"], F.col("a"), F.col("b"), 3.0, block, rows=rows)
        assert got.columns == ["k", "t", "state"]
        assert {r["t"]: (r["k"], pytest.approx(r["state"], rel=1e-9)) for r in got.collect()} == want
    whole = fold.affine_scan(df, [], ["t"], F.lit(1.0), F.lit(1.0), rows=rows).collect()
    assert sorted((r["t"], r["state"]) for r in whole) == [(i, i + 1.0) for i in range(300)]
    assert fold.affine_scan(df.limit(0), ["k"], ["t"], F.col("a"), F.col("b")).count() == 0


def test_grouped_cdf_blocks_equal_one_scan_with_a_hot_group(spark):
    rnd = random.Random(8)
    keys = [(rnd.choice(["hot", "hot", "k1", None]), rnd.randint(0, 400)) for _ in range(3000)]
    table = pmf.from_keys(spark.createDataFrame(keys, "g string, v int"), ["g"], "v")
    fifty = ordered.value_block("outcome", 50)
    split, whole = cdf.to_cdf(table, ["g"], block=fifty), cdf.to_cdf(table, ["g"])
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    assert split.columns == whole.columns
    back = {(r["g"], r["outcome"]): r["mass"] for r in cdf.to_pmf(split, ["g"], block=fifty).collect()}
    assert back == {(r["g"], r["outcome"]): r["n"] for r in table.collect()}
    sums = {r["g"]: r["p"] for r in table.groupBy("g").agg(F.sum("prob").alias("p")).collect()}
    assert sums == {g: pytest.approx(1.0) for g in ("hot", "k1", None)}


def test_sgd_custom_gradient_scale(spark):
    pts = [(i, i / 10.0, 1.0 + i / 5.0) for i in range(20)]
    df = spark.createDataFrame(pts, "seq int, x double, y double")
    w = [0.0, 0.0]
    for _, x, y in pts:
        g = 2 * (w[0] * x + w[1] - y)
        w = [w[0] - 0.01 * g * x, w[1] - 0.01 * g]
    got = sgd.sgd_linear(df, [], ["seq"], "y", ["x"], 0.01, grad_scale=2.0, block=F.floor(F.col("seq") / 6)).first()
    assert got["w"] == pytest.approx(w, rel=1e-12)


def test_grouped_top_k_equals_window(spark):
    rnd = random.Random(9)
    rows = [(g, i, rnd.randint(0, 50)) for g in range(3) for i in range(2000 if g == 0 else 50)]
    df = spark.createDataFrame(rows, "g int, item int, cnt int")
    got = monoid.top_k(df, ["g"], 5, "cnt", "item", buckets=16).select("g", "item", "rank")
    w = Window.partitionBy("g").orderBy(F.col("cnt").desc(), F.col("item").asc())
    ref = df.withColumn("rank", F.row_number().over(w)).where("rank <= 5").select("g", "item", "rank")
    assert sorted(got.collect()) == sorted(ref.collect())


def test_set_union_forms(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["b", "c"]), (2, ["x"]), (2, None)], "g int, tags array<string>")
    arr = {r["g"]: r["items"] for r in monoid.set_union(df, ["g"], "tags", arrays=True).collect()}
    assert arr == {1: ["a", "b", "c"], 2: ["x"]}
    rows = sorted(tuple(r) for r in monoid.set_union(df, ["g"], "tags", arrays=True, as_rows=True).collect())
    assert rows == [(1, "a"), (1, "b"), (1, "c"), (2, "x")]


def test_results_do_not_depend_on_partitioning(spark):
    """Recomputed tasks (e.g. after a lost executor) must reproduce the same rows: blocks, folds and draws
    are functions of the data, not of partition ids or task order."""
    rnd = random.Random(21)
    rows = [(i % 7, i, rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int, v double")

    def run(d):
        r = ordered.running_sums(d, ["k"], ["t"], {"s": F.col("v")}, block=ordered.value_block("t", 250))
        w = sgd.sgd_linear(d, ["k"], ["t"], "v", [F.col("t") / 3000.0], 0.1, block=F.floor(F.col("t") / 500))
        return (sorted((x["k"], x["t"], x["s"]) for x in r.collect()),
                sorted((x["k"], tuple(x["w"])) for x in w.collect()))

    (r1, w1), (r2, w2) = run(df.repartition(3)), run(df.repartition(11, "t"))
    # same rows and positions; sums agree up to floating addition order of the block totals
    assert [x[:2] for x in r1] == [x[:2] for x in r2]
    assert all(abs(a[2] - b[2]) <= 1e-9 * max(1.0, abs(a[2])) for a, b in zip(r1, r2))
    # SGD composes identical block maps in block order: bit-identical
    assert w1 == w2


def test_grouped_bloom_and_cms(spark):
    rows = [(g, f"w{(i * (g + 1)) % (100 + 50 * g)}") for g in range(2) for i in range(1500)]
    df = spark.createDataFrame(rows, "g int, w string")
    filt, params = sketch.bloom_build(df, ["g"], "w", 0.01)
    assert {r["g"] for r in params.collect()} == {0, 1}
    mem = sketch.bloom_contains(filt, params, df, ["g"], "w")
    assert mem.where(~F.col("in_filter")).count() == 0
    sk = sketch.cms_build(df, ["g"], F.col("w"), 0.01, 1e-3)
    est = sketch.cms_estimate(sk, df, ["g"], "w", 0.01, 1e-3)
    exact = df.groupBy("g", "w").agg(F.count(F.lit(1)).alias("exact"))
    j = est.join(exact, ["g", "w"])
    assert j.count() == exact.count()
    assert j.where((F.col("est") < F.col("exact")) | (F.col("est") > F.col("exact") + 0.01 * 1500)).count() == 0
    hh = {(r["g"], r["w"]) for r in sketch.heavy_hitters(df, ["g"], "w", 0.01, 1e-3, 0.005).collect()}
    truth = {(r["g"], r["w"]) for r in exact.where(F.col("exact") >= 0.005 * 1500).collect()}
    assert truth <= hh


# ---------------------------------------------------------------- one code path, NULL keys, edges of laws

@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz", "double"])
def test_ungrouped_cdf_of_any_orderable_outcome(spark, kind):
    rows = spark.range(700).select((F.col("id") * 37 % 701).alias("i"))
    value = {
        "string": F.concat(F.lit("same prefix "), F.lpad(F.col("i").cast("string"), 4, "0")),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("i").cast("int")),
        "timestamp_ntz": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("i").cast("int")),
        "double": F.when(F.col("i") == 700, F.lit(1e12)).otherwise(F.col("i").cast("double")),
    }[kind]
    p = pmf.from_keys(rows.select(value.alias("v")), [], "v")
    one = cdf.to_cdf(p, [], block=None).orderBy("outcome").collect()
    got = cdf.to_cdf(p, [], block=ordered.auto_block(p, "outcome", 16)).orderBy("outcome").collect()
    auto = cdf.to_cdf(p, []).orderBy("outcome").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in got] == [tuple(r) for r in auto]
    back = cdf.to_pmf(cdf.to_cdf(p, []), []).collect()
    assert {r["mass"] for r in back} == {1}


def test_null_keys_are_keys(spark):
    from tallyframe.operators import decay, fold, kde

    rows = [(k, i, float(i), i == 3) for k in (None, "a") for i in range(8)]
    df = spark.createDataFrame(rows, "k string, i int, v double, reset boolean")
    got = {r["k"]: (r["state"], r["was_reset"]) for r in fold.reset_fold(
        df, "k", ["i"], F.col("reset"), F.lit(100.0), F.col("v")).collect()}
    assert got == {None: (122.0, True), "a": (122.0, True)}
    run = ordered.running_sums(df, "k", ["i"], {"s": F.col("v")}, F.floor(F.col("i") / 3)).collect()
    assert {(r["k"], r["i"]): r["s"] for r in run} == {(k, i): sum(range(i + 1)) for k in (None, "a") for i in range(8)}
    dens = kde.kde_grid(df, "k", "v", points=5).collect()
    assert sorted(r["density"] for r in dens if r["k"] is None) == pytest.approx(sorted(r["density"] for r in dens if r["k"] == "a"))
    old = {(r["k"], r["i"]): r["decayed"] for r in decay.decayed_running(
        df, "k", ["i"], "v", F.col("i").cast("double"), 1.0, blocks_per_anchor=2.0).collect()}
    for k in (None, "a"):
        for i in range(8):
            assert old[(k, i)] == pytest.approx(sum(j * 2.0 ** (j - i) for j in range(i + 1)))


def test_running_decay_over_many_blocks_is_exact(spark):
    from tallyframe.operators import decay

    df = spark.range(4000).select((F.col("id") * 40.0).alias("t"), F.lit(1.0).alias("v"), F.lit("k").alias("k"))
    got = [r["decayed"] for r in decay.decayed_running(df, "k", ["t"], "v", F.col("t"), 10.0, blocks_per_anchor=4.0).orderBy("t").collect()]
    assert got[0] == 1.0 and got[-1] == pytest.approx(1 / (1 - 2**-4), rel=1e-12)


def test_bayes_without_data_or_likelihood(spark):
    prior = spark.createDataFrame([("u", h, p) for h, p in (("a", 0.5), ("b", 0.5))] + [("w", "a", 0.25), ("w", "b", 0.75)],
                                  "g string, hypo string, prior double")
    data = spark.createDataFrame([("u", "x"), ("u", "unknown")], "g string, d string")
    lik = spark.createDataFrame([("a", "x", 0.9)], "hypo string, d string, lik double")
    got = {(r["g"], r["hypo"]): r["prob"] for r in bayes.posterior(prior, data, "g", "d", "hypo", lik).collect()}
    assert got == pytest.approx({("u", "a"): 0.9 / 1.9, ("u", "b"): 1 / 1.9, ("w", "a"): 0.25, ("w", "b"): 0.75})
    single = prior.where("g = 'w'").select("hypo", "prior")
    none = bayes.posterior(single, data.select("d").limit(0), [], "d", "hypo", lik).collect()
    assert {r["hypo"]: r["prob"] for r in none} == {"a": 0.25, "b": 0.75}


@pytest.mark.parametrize("count", [3, 400])
def test_bayes_any_number_of_hypotheses(spark, count):
    prior = spark.range(count).select(F.col("id").cast("string").alias("hypo"), F.lit(1.0 / count).alias("prior"))
    lik = spark.range(count).select(F.col("id").cast("string").alias("hypo"), F.lit("x").alias("d"), ((F.col("id") + 1) / F.lit(count + 1.0)).alias("lik"))
    data = spark.createDataFrame([("u", "x", 1), ("u", "x", 2)], "g string, d string, i int")
    got = {r["hypo"]: r["prob"] for r in bayes.posterior(prior, data, "g", "d", "hypo", lik).collect()}
    total = sum((i + 1) ** 2 for i in range(count))
    assert got == pytest.approx({str(i): (i + 1) ** 2 / total for i in range(count)})
    last = {r["hypo"]: r["prob"] for r in bayes.sequential(prior, data, "g", ["i"], "d", "hypo", lik).where("i = 2").collect()}
    assert last == pytest.approx(got)


def test_laws_at_their_edges(spark):
    from statistics import NormalDist

    p = spark.createDataFrame([("over", 3, 2, 5), ("ok", 5, 2, 3)], "g string, n int, k int, s int")
    got = dist.hypergeom_pmf(p.select("g", F.col("n").alias("pop"), F.col("k").alias("succ"), F.col("s").alias("sample")), "pop", "succ", "sample").collect()
    assert {r["g"] for r in got} == {"ok"} and sum(r["prob"] for r in got) == pytest.approx(1)
    assert [r["k"] for r in got] == [0, 1, 2]
    big = spark.createDataFrame([(50001.0, 50001.0), (0.5, 1.0), (1.0, 3.0)], "a double, b double")
    beta = {(r["a"], r["i"]): r["density"] for r in dist.beta_pdf(big, "a", "b", 10).collect()}
    lnb = 2 * math.lgamma(50001) - math.lgamma(100002)
    assert beta[(50001.0, 5)] == pytest.approx(math.exp(100000 * math.log(0.5) - lnb), rel=1e-6)
    assert beta[(50001.0, 0)] == 0.0 and beta[(0.5, 0)] == float("inf") and beta[(1.0, 0)] == 3.0 and beta[(1.0, 10)] == 0.0
    lam = spark.createDataFrame([("x", 2.0)], "g string, lam double")
    tail = dist.poisson_pmf(lam, "g", "lam", cutoff=1e-14).agg(F.max("k").alias("k")).first()["k"]
    assert sum(math.exp(k * math.log(2) - 2 - math.lgamma(k + 1)) for k in range(tail + 1)) >= 1 - 2e-14
    assert dist._integer_support(spark.range(1), F.lit(3_000_000_000), F.lit(3_000_200_000)).agg(F.max("k")).first()[0] == 3_000_200_000
    qs = [1e-9, 0.01, 0.3, 0.5, 0.975, 1 - 1e-6]
    z = spark.createDataFrame([(q,) for q in qs], "p double").select("p", dist.normal_quantile(F.col("p"), F.lit(3.0), F.lit(2.0)).alias("x")).collect()
    for r in z:
        assert r["x"] == pytest.approx(NormalDist(3, 2).inv_cdf(r["p"]), rel=1e-8, abs=1e-8)
    e = dist.exponential_pmf(spark.createDataFrame([(2.0,)], "l double"), "l", 10, abs_cutoff=4.0).agg(F.max("x")).first()[0]
    assert e == 4.0


def test_beta_binomial_mode_is_the_argmax(spark):
    rows = [(a, b, n) for a in (0.3, 1.0, 1.5, 4.0) for b in (0.3, 1.0, 2.0, 9.5) for n in (1, 7, 10)]
    df = spark.createDataFrame(rows, "a double, b double, n int")
    m = dist.betabinom_moments(F.col("n"), F.col("a"), F.col("b"))
    for r in df.select("a", "b", "n", m["mode"].alias("mode")).collect():
        lm = [math.lgamma(k + r["a"]) + math.lgamma(r["n"] - k + r["b"]) - math.lgamma(k + 1) - math.lgamma(r["n"] - k + 1) for k in range(r["n"] + 1)]
        assert r["mode"] == min(k for k, x in enumerate(lm) if x >= max(lm) - 1e-9), r


def test_as_of_lookup_survives_an_outlier_and_takes_any_type(spark):
    steps = spark.createDataFrame([(float(i), i / 100) for i in range(100)] + [(1e15, 1.0)], "outcome double, cdf double")
    probes = spark.createDataFrame([(x, ) for x in (-1.0, 0.0, 3.5, 99.5, 1e14, 1e15, 2e15)], "x double")
    got = {r["x"]: r["cdf"] for r in cdf.lookup(steps, probes, [], "x").collect()}
    assert got == {-1.0: 0.0, 0.0: 0.0, 3.5: 0.03, 99.5: 0.99, 1e14: 0.99, 1e15: 1.0, 2e15: 1.0}
    names = spark.createDataFrame([("g", "b", 0.4), ("g", "d", 1.0), (None, "c", 1.0)], "g string, outcome string, cdf double")
    asked = spark.createDataFrame([(g, x) for g in ("g", None, "none") for x in "abcde"], "g string, x string")
    found = {(r["g"], r["x"]): r["cdf"] for r in cdf.lookup(names, asked, "g", "x").collect()}
    assert [found[("g", x)] for x in "abcde"] == [0.0, 0.4, 0.4, 1.0, 1.0]
    assert [found[(None, x)] for x in "abcde"] == [0.0, 0.0, 1.0, 1.0, 1.0]
    assert {found[("none", x)] for x in "abcde"} == {0.0}


def test_normal_tails_by_erfc(spark):
    from tallyframe.functions.exprs import erfc, normal_cdf

    xs = [-30.0, -8.0, -4.5, -2.9, -0.1, 0.0, 0.7, 2.9, 3.1, 8.0, 25.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", erfc(F.col("x")).alias("e"), normal_cdf(F.col("x"), F.lit(0.0), F.lit(1.0)).alias("c")).collect():
        assert r["e"] == pytest.approx(math.erfc(r["x"]), rel=1e-9, abs=1e-300)
        assert r["c"] == pytest.approx(0.5 * math.erfc(-r["x"] / math.sqrt(2)), rel=2e-9, abs=1e-300)


def test_sorted_rows_carry_no_block_ends(spark):
    df = spark.createDataFrame([(g, i, i if i % 7 == 0 else None) for g in (1, 2) for i in range(1, 60)], "g int, i int, v int")
    marks = df.where("v is not null")
    for by, width in (([], 4), (["g"], 4)):
        rows = df if by else df.where("g = 1")
        out = ordered.carry_last(rows, marks if by else marks.where("g = 1"), by, ["i"], "v", "last", ordered.value_block("i", width))
        lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
        top = next(i for i, line in enumerate(lines) if "Window [" in line)
        depth = lines[top].index("Window [")
        below = "\n".join(itertools.takewhile(lambda line: re.search("[A-Z]", line).start() > depth, lines[top + 1:]))
        assert below and "scalar-subquery" not in below and "Join" not in below and "_ends" not in below  # what is sorted stays as narrow as the rows
        assert all(r["last"] == (r["i"] // 7 * 7 or None) for r in out.collect())
