"""Combining independent PMFs: join with an outcome combiner, sum (convolution), difference, mixture.

Both inputs are PMFs, i.e. already reduced to one row per ``(group, outcome)``; the join pairs distinct
outcomes of the same group (an equi-join on the group keys), never raw rows. Colliding combined outcomes
merge in a grouped sum, and the result is normalised, as the operator is defined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.exprs import join_by
from tallyframe.operators.pmf import _by, normalize


# Blocks of each side of an ungrouped product: every pair of blocks is one join key.
PRODUCT_BLOCKS = 8


def _product(left: DataFrame, right: DataFrame, blocks: int = PRODUCT_BLOCKS) -> DataFrame:
    """All pairs of two single PMFs' distinct outcomes (the operator itself), as an equi-join on block pairs:
    each row goes to ``blocks`` keys, and the pairs spread over ``blocks²`` of them, whatever the sizes."""
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    a = left.withColumn("_ba", F.pmod(F.xxhash64("_k1"), F.lit(blocks)).cast("int")).withColumn("_bb", every)
    b = right.withColumn("_bb", F.pmod(F.xxhash64("_k2"), F.lit(blocks)).cast("int")).withColumn("_ba", every)
    return a.join(b, ["_ba", "_bb"]).drop("_ba", "_bb")


def join(
    a: DataFrame, b: DataFrame, by, comb: Callable[[Column, Column], Column], outcome: str = "outcome",
    prob: str = "prob",
) -> DataFrame:
    """PMF of ``comb(X, Y)`` for independent X ~ a, Y ~ b (per group)."""
    by = _by(by)
    left = a.select(*by, F.col(outcome).alias("_k1"), F.col(prob).alias("_p1"))
    right = b.select(*by, F.col(outcome).alias("_k2"), F.col(prob).alias("_p2"))
    pairs = join_by(left, right, by) if by else _product(left, right)
    merged = pairs.groupBy(*by, comb(F.col("_k1"), F.col("_k2")).alias(outcome)).agg(
        F.sum(F.col("_p1") * F.col("_p2")).alias(prob)
    )
    return normalize(merged, by, weight=prob)


def add(a: DataFrame, b: DataFrame, by, **kw) -> DataFrame:
    """Distribution of the sum of two independent variables (convolution)."""
    return join(a, b, by, lambda x, y: x + y, **kw)


def sub(a: DataFrame, b: DataFrame, by, **kw) -> DataFrame:
    """Distribution of the difference X − Y of two independent variables."""
    return join(a, b, by, lambda x, y: x - y, **kw)


def mixture(
    weights: DataFrame, components: DataFrame, by, comp: str, weight: str = "weight", outcome: str = "outcome",
    prob: str = "prob",
) -> DataFrame:
    """Mixture ``Σ_c weight_c · P_c(k)``, normalised. ``weights``: (by..., comp, weight);
    ``components``: (comp, outcome, prob). An equi-join on the component id."""
    by = _by(by)
    j = weights.select(*by, comp, weight).join(components.select(comp, outcome, prob), comp)
    m = j.groupBy(*by, outcome).agg(F.sum(F.col(weight) * F.col(prob)).alias(prob))
    return normalize(m, by, weight=prob)
