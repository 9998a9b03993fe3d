"""Sampling from PMFs with reproducible md5 uniforms (independent of partitioning and task retries).

A draw maps a uniform u in [0, 1) to the first outcome whose cumulative probability exceeds u (inverse
transform), evaluated for all draws at once as a carry-forward over the merged (CDF steps, distinct draws)
order, then equi-joined back to the draws.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.exprs import md5_uniform
from tallyframe.operators import cdf as cdf_ops
from tallyframe.operators.pmf import _by


def draw(cdf: DataFrame, draws: DataFrame, by, draw_id: str, seed: str, outcome: str = "outcome") -> DataFrame:
    """One outcome per row of ``draws`` (columns by..., draw_id), from the group's CDF (by..., outcome, cdf)."""
    by = _by(by)
    d = draws.withColumn("_u", md5_uniform(F.col(draw_id), F.lit(seed)))
    return cdf_ops.sample_lookup(cdf, d, by, "_u", outcome).drop("_u")


def sample_join(
    cdfs: list[DataFrame], draws: DataFrame, draw_id: str, seeds: list[str],
    comb: Callable[[list[Column]], Column], outcome: str = "outcome",
) -> DataFrame:
    """Monte-Carlo join: one draw from each PMF per draw id, combined; returns the empirical PMF
    ``(outcome, n, prob)`` of the combined values."""
    cols = []
    joined = draws.select(draw_id)
    for i, (c, seed) in enumerate(zip(cdfs, seeds)):
        one = draw(c, draws.select(draw_id), [], draw_id, seed).select(draw_id, F.col("outcome").alias(f"_d{i}"))
        joined = joined.join(one, draw_id)
        cols.append(F.col(f"_d{i}"))
    vals = joined.select(comb(cols).alias(outcome))
    counts = vals.groupBy(outcome).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("prob", F.col("n") / total)
