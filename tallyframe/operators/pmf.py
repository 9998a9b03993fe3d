"""Probability mass functions as long tables ``(by..., outcome, weight)``.

Weights need not sum to one: building, adding mass and mapping values keep raw weights, exactly like an
unnormalised map of outcome to mass; :func:`normalize` divides by the group total. Every grouped operator first
reduces raw rows to one row per ``(group, outcome)`` (map-side partial aggregation), so a hot group costs as
many rows as it has distinct outcomes, not as many as it has raw rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.exprs import col_of, join_by, normalise_weight


def _by(by: Sequence[str] | str | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def from_keys(df: DataFrame, by, key: str | Column, outcome: str = "outcome") -> DataFrame:
    """Count each outcome per group (integer weights ``n``) and add its probability ``prob``."""
    by = _by(by)
    counts = df.groupBy(*by, col_of(key).alias(outcome)).agg(F.count(F.lit(1)).alias("n"))
    return normalize(counts, by, weight="n", out="prob")


def from_weights(df: DataFrame, by, key: str | Column, weight: str | Column, outcome: str = "outcome") -> DataFrame:
    """Accumulate the weights of repeated outcomes; the result is **not** normalised."""
    by = _by(by)
    return df.groupBy(*by, col_of(key).alias(outcome)).agg(F.sum(col_of(weight)).alias("weight"))


def normalize(pmf: DataFrame, by, weight: str = "weight", out: str | None = None) -> DataFrame:
    """Divide weights by their group total; a group whose total is zero keeps its weights.

    The totals are a partial aggregate joined by group, one row each, so a group with many outcomes does not gather
    in one task (AQE broadcasts the totals or splits the skewed side). With no group keys the total is a scalar
    subquery.
    """
    by = _by(by)
    out = out or weight
    if by:
        totals = pmf.groupBy(*by).agg(F.sum(weight).alias("_total"))
        held = join_by(pmf, totals, by, "left")
        return held.withColumn(out, normalise_weight(F.col(weight).cast("double"), F.col("_total"))).drop("_total")
    total = pmf.select(F.sum(weight)).scalar()
    return pmf.withColumn(out, normalise_weight(F.col(weight).cast("double"), total))


def moments(pmf: DataFrame, by, outcome: str = "outcome", prob: str = "prob") -> DataFrame:
    """Mean ``Σ k p`` and variance ``Σ k² p − mean²`` of each group's PMF, without renormalising."""
    by = _by(by)
    k = F.col(outcome).cast("double")
    p = F.col(prob)
    agg = pmf.groupBy(*by).agg(F.sum(k * p).alias("mean"), F.sum(k * k * p).alias("_m2"))
    return agg.select(*by, "mean", (F.col("_m2") - F.col("mean") * F.col("mean")).alias("variance"))


def mode(pmf: DataFrame, by, outcome: str = "outcome", weight: str = "weight", carry: Sequence[str] = ()) -> DataFrame:
    """Outcome with the greatest mass per group; ties go to the smallest outcome.

    A single mergeable ``min(struct(-weight, outcome, ...))`` aggregate: no window, partial aggregation
    applies, and a hot group reduces to one running minimum per task.
    """
    by = _by(by)
    fields = [(-F.col(weight)).alias("nw"), F.col(outcome).alias("k")] + [F.col(c).alias(c) for c in carry]
    best = F.min(F.struct(*fields)).alias("_best")
    return pmf.groupBy(*by).agg(best).select(
        *by,
        F.col("_best.k").alias(outcome),
        (-F.col("_best.nw")).alias(weight),
        *[F.col(f"_best.{c}").alias(c) for c in carry],
    )


def filter_keys(pmf: DataFrame, predicate: Column) -> DataFrame:
    """Keep outcomes satisfying ``predicate``; no renormalisation."""
    return pmf.where(predicate)


def map_keys(pmf: DataFrame, by, fn: Callable[[Column], Column], outcome: str = "outcome", weight: str = "weight") -> DataFrame:
    """Transform outcomes; outcomes that collide merge by summing their weights."""
    by = _by(by)
    return pmf.groupBy(*by, fn(F.col(outcome)).alias(outcome)).agg(F.sum(weight).alias(weight))


def map_values(pmf: DataFrame, fn: Callable[[Column], Column], weight: str = "weight") -> DataFrame:
    """Transform masses; no renormalisation."""
    return pmf.withColumn(weight, fn(F.col(weight)))


def add_mass(pmf: DataFrame, adds: DataFrame, by, outcome: str = "outcome", weight: str = "weight") -> DataFrame:
    """``pmf + (k, p)`` for every row of ``adds``: insert new outcomes, accumulate on existing ones."""
    by = _by(by)
    cols = [*by, outcome, weight]
    both = pmf.select(*cols).unionByName(adds.select(*cols))
    return both.groupBy(*by, outcome).agg(F.sum(weight).alias(weight))


def remove(pmf: DataFrame, keys: DataFrame, by, outcome: str = "outcome") -> DataFrame:
    """``pmf - k`` for every ``(group, k)`` row of ``keys`` (left anti join)."""
    by = _by(by)
    return pmf.join(keys.select(*by, outcome).distinct(), [*by, outcome], "left_anti")


def prob_of(pmf: DataFrame, probes: DataFrame, by, outcome: str = "outcome", prob: str = "prob") -> DataFrame:
    """Point lookup of each probe ``(group, k)``; 0.0 when the outcome is absent."""
    by = _by(by)
    hit = probes.join(pmf.select(*by, outcome, prob), [*by, outcome], "left")
    return hit.withColumn(prob, F.coalesce(F.col(prob), F.lit(0.0)))


def prob_where(pmf: DataFrame, by, predicate: Column, prob: str = "prob", out: str = "p") -> DataFrame:
    """Total mass of the outcomes matching ``predicate`` per group (0.0 when none match)."""
    by = _by(by)
    mass = F.sum(F.when(predicate, F.col(prob)).otherwise(F.lit(0.0)))
    return pmf.groupBy(*by).agg(F.coalesce(mass, F.lit(0.0)).alias(out))


def series(parts, key: str, value: str) -> DataFrame:
    """Plot series as one long ``(series, k, v)`` table. ``parts`` is a dict or a list of ``(name, df)``
    pairs; a name is a string, or a Column computing the name per row (one series per group). Re-plotting
    a name replaces it: the last part given for a string name wins."""
    out = None
    seen: dict[str, int] = {}
    items = list(parts.items()) if isinstance(parts, dict) else list(parts)
    for i, (name, _) in enumerate(items):
        if isinstance(name, str):
            seen[name] = i
    for i, (name, df) in enumerate(items):
        if isinstance(name, str) and seen[name] != i:
            continue
        label = F.lit(name) if isinstance(name, str) else name
        piece = df.select(label.alias("series"), F.col(key).alias("k"), F.col(value).alias("v"))
        out = piece if out is None else out.unionByName(piece)
    return out
