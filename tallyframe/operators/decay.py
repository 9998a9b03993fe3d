"""Exponentially decayed values: ``Σ v · 2^(-(t_ref - t) / half_life)``.

Large exponents overflow a double, so sums are anchored per time *block*: inside block ``b`` (start ``a_b``,
width ``B``) each term is ``v · 2^((t - a_b)/h)`` with an exponent in [0, B/h]. Block sums are mergeable
aggregates (a hot key spreads across its blocks) and are then combined per key with exponents that are never
positive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.exprs import col_of, join_by
from tallyframe.operators.pmf import _by

LN2 = math.log(2.0)


def _blocked(df: DataFrame, t: Column, half_life: float, blocks_per_anchor: float):
    width = half_life * blocks_per_anchor
    b = F.floor(t / F.lit(width)).cast("bigint")
    a = b.cast("double") * F.lit(width)
    return df.withColumn("_t", t).withColumn("_b", b).withColumn("_a", a), width


def decayed_value(
    df: DataFrame, by, value: str | Column, t: Column, half_life: float, blocks_per_anchor: float = 64.0
) -> DataFrame:
    """Decayed sum at each key's latest time, plus the decayed average ``value · ln2 / half_life``."""
    by = _by(by)
    h = float(half_life)
    d, _ = _blocked(df.withColumn("_v", col_of(value).cast("double")), t, h, blocks_per_anchor)
    blocks = d.groupBy(*by, "_b", "_a").agg(
        F.sum(F.col("_v") * F.pow(F.lit(2.0), (F.col("_t") - F.col("_a")) / F.lit(h))).alias("_s"),
        F.max("_t").alias("_tmax"),
    )
    w = Window.partitionBy(*by)
    scaled = blocks.withColumn("_T", F.max("_tmax").over(w)).withColumn(
        "_c", F.col("_s") * F.pow(F.lit(2.0), (F.col("_a") - F.col("_T")) / F.lit(h))
    )
    out = scaled.groupBy(*by).agg(F.sum("_c").alias("decayed"), F.max("_T").alias("t_last"))
    return out.withColumn("decayed_avg", F.col("decayed") * F.lit(LN2 / h))


def decayed_running(
    df: DataFrame, by, order: Sequence[str], value: str | Column, t: Column, half_life: float,
    blocks_per_anchor: float = 64.0,
) -> DataFrame:
    """Decayed sum as of every row: ``D_i = Σ_{j<=i} v_j 2^(-(t_i - t_j)/h)``, per key in ``order``.

    Within a block: a running window over ``(key, block)``. Across blocks: each block adds the carried sums of
    the key's earlier blocks, rescaled to its own anchor. A block is ``blocks_per_anchor`` half-lives wide, so
    the k-th earlier block is scaled by at most ``2^(-blocks_per_anchor·(k - 1))``; past the whole exponent range
    of a double (about 2100 powers of two) its share is exactly 0, and the carry reads no further back.
    """
    by = _by(by)
    h = float(half_life)
    d, _ = _blocked(df.withColumn("_v", col_of(value).cast("double")), t, h, blocks_per_anchor)
    d = d.withColumn("_x", F.col("_v") * F.pow(F.lit(2.0), (F.col("_t") - F.col("_a")) / F.lit(h)))
    blocks = d.groupBy(*by, "_b", "_a").agg(F.sum("_x").alias("_s"))
    prev = Window.partitionBy(*by).orderBy("_b").rowsBetween(-(math.ceil(2100 / blocks_per_anchor) + 2), -1)
    carry = blocks.withColumn("_prev", F.collect_list(F.struct("_a", "_s")).over(prev)).select(
        *by,
        "_b",
        F.aggregate(
            "_prev",
            F.lit(0.0),
            lambda acc, x: acc + x["_s"] * F.pow(F.lit(2.0), (x["_a"] - F.col("_a")) / F.lit(h)),
        ).alias("_carry"),
    )
    run = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = join_by(d, carry, [*by, "_b"], "left")
    out = j.withColumn(
        "decayed",
        (F.coalesce(F.col("_carry"), F.lit(0.0)) + F.sum("_x").over(run))
        * F.pow(F.lit(2.0), (F.col("_a") - F.col("_t")) / F.lit(h)),
    )
    return out.drop("_v", "_t", "_b", "_a", "_x", "_carry")
