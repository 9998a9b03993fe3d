"""Known answers of the reference's own examples and demos."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import bayes, fold, ordered, pmf, sketch


def test_hll_letters_is_three(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "id string").repartition(4)
    est = df.agg(sketch.hll_estimate(F.hll_sketch_agg("id", 12)).alias("n")).first()["n"]
    assert est == 3
    # create per row, merge, estimate: the same value through stored sketches
    per_row = df.groupBy("id").agg(F.hll_sketch_agg("id", 12).alias("sketch"))
    merged = per_row.agg(F.hll_union_agg("sketch").alias("s")).select(sketch.hll_estimate("s")).first()[0]
    assert merged == 3


def test_hll_lg_k_is_clamped():
    assert [sketch.checked_lg_k(k) for k in (4, 12, 21)] == [4, 12, 21]
    for bits in (3, 22):
        with pytest.raises(ValueError):
            sketch.checked_lg_k(bits)


def _dice(spark, rolls):
    prior = spark.createDataFrame([(h, 1.0) for h in (4, 6, 8, 12, 20)], "hypo int, prior double")
    data = spark.createDataFrame([(1, r) for r in rolls], "g int, roll int")
    lik = lambda x: F.when(F.col("roll") > F.col("hypo"), F.lit(0.0)).otherwise(F.lit(1.0) / F.col("hypo"))
    post = bayes.posterior(prior, data, ["g"], "roll", "hypo", lik)
    return {r["hypo"]: r["prob"] for r in post.collect()}


def test_dice_one_six(spark):
    p = _dice(spark, [6])
    assert p[4] == 0.0
    for h, v in {6: 0.39216, 8: 0.29412, 12: 0.19608, 20: 0.11765}.items():
        assert p[h] == pytest.approx(v, abs=1e-5)


def test_dice_many_rolls(spark):
    p = _dice(spark, [6, 6, 8, 7, 7, 5, 4])
    assert p[4] == 0.0 and p[6] == 0.0
    for h, v in {8: 0.943248, 12: 0.055206, 20: 0.001545}.items():
        assert p[h] == pytest.approx(v, abs=1e-6)


def test_monty_hall(spark):
    prior = spark.createDataFrame([(h, 1.0) for h in (1, 2, 3)], "hypo int, prior double")
    data = spark.createDataFrame([(1, 3)], "g int, opened int")
    # first choice is door 1: the host never opens the winner, opens 2 or 3 at random if 1 wins
    lik = lambda x: (F.when(F.col("opened") == F.col("hypo"), F.lit(0.0))
                     .when(F.col("hypo") == 1, F.lit(0.5)).otherwise(F.lit(1.0)))
    post = {r["hypo"]: r["prob"] for r in bayes.posterior(prior, data, ["g"], "opened", "hypo", lik).collect()}
    assert post[1] == pytest.approx(1 / 3) and post[2] == pytest.approx(2 / 3) and post[3] == 0.0


def test_all_impossible_posterior_stays_zero(spark):
    prior = spark.createDataFrame([(h, 1.0) for h in (4, 6)], "hypo int, prior double")
    data = spark.createDataFrame([(1, 9)], "g int, roll int")
    lik = lambda x: F.when(F.col("roll") > F.col("hypo"), F.lit(0.0)).otherwise(F.lit(1.0) / F.col("hypo"))
    post = bayes.posterior(prior, data, ["g"], "roll", "hypo", lik).collect()
    assert [r["prob"] for r in post] == [0.0, 0.0]


def test_fold_demo_eleven_twenty_two(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 5)], "k int, seq int, v int")
    last = fold.final(df, ["k"], F.col("v").cast("double"), 1.0, "sum", lambda s: 2 * s).first()
    assert (last["state"], last["output"]) == (11.0, 22.0)
    scan = fold.scan(df, ["k"], ["seq"], F.col("v").cast("double"), 1.0, "sum", lambda s: 2 * s).orderBy("pos")
    assert [(r["pos"], r["state"], r["output"]) for r in scan.collect()] == [
        (0, 1.0, 2.0), (1, 3.0, 6.0), (2, 6.0, 12.0), (3, 11.0, 22.0)]


def test_sort_demo(spark):
    df = spark.createDataFrame([(v,) for v in (1, 7, 3, 15, 2)], "v int")
    r = ordered.rank_within(df, [], ["v"], block=ordered.value_block("v", 4.0)).orderBy("pos")
    assert [x["v"] for x in r.collect()] == [1, 2, 3, 7, 15]


def test_pmf_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (1, "c"), (1, "a")], "g int, k string")
    m = pmf.mode(pmf.from_keys(df, ["g"], "k"), ["g"], weight="n").first()
    assert (m["outcome"], m["n"]) == ("a", 2)
