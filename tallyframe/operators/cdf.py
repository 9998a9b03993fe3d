"""Cumulative distributions as ``(by..., outcome, weight, cum, total)`` tables.

Cumulative sums run over one row per distinct outcome (the PMF), never over raw rows. Keep weights integral
(counts) wherever possible: comparisons such as ``cum >= p * total`` are then exact in any engine, and the
division happens last.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.exprs import join_by, normalise_weight
from tallyframe.operators import ordered
from tallyframe.operators.pmf import _by
from tallyframe.sources.tables import materialize


def _outcome_block(pmf: DataFrame, by: list[str], outcome: str, block):
    """Grouped CDFs scan per group (one row per distinct outcome) unless a ``block`` is given. An ungrouped CDF
    is always cut into outcome blocks, so that no single task holds every distinct outcome."""
    if isinstance(block, str) and block == "auto":
        return None if by else ordered.auto_block(pmf, outcome)
    return block


def ranged_cdf(pmf: DataFrame, by, outcome: str = "outcome", weight: str = "n", parts: int | None = None) -> DataFrame:
    """The same table as :func:`to_cdf` for groups of any size: no task holds more than its share of all outcomes.

    The PMF is cut into ``parts`` ranges of (group, outcome) and stored with each row's range, so every later read sees
    the same cut; a group that holds a third of all outcomes spreads over a third of the ranges, small groups share one.
    Sums run within (range, group). Only groups that cross an edge take earlier ranges' sums, at most two rows per range,
    from a table that is bounded by the number of ranges. ``pmf`` has one row per (by, outcome)."""
    by = _by(by)
    if not by:
        return ranged_cdf(pmf.withColumn("_g", F.lit(0)), ["_g"], outcome, weight, parts).drop("_g")
    parts = parts or int(pmf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = pmf.repartitionByRange(parts, *by, outcome).withColumn("_part", F.spark_partition_id())
    cut = materialize(cut, "cdf-ranges")
    sums = cut.groupBy(*by, "_part").agg(F.sum(weight).alias("_sum"))
    crossing = sums.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.sum("_sum").alias("_all")).where(F.col("_n") > 1).drop("_n")
    pieces = join_by(sums, F.broadcast(crossing), by)  # fewer groups than ranges cross an edge
    before = F.sum("_sum").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_sum")
    pieces = pieces.select(*by, "_part", before.alias("_before"), "_all")
    here = Window.partitionBy("_part", *by)
    run = cut.withColumn("_run", F.sum(weight).over(here.orderBy(outcome).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    run = run.withColumn("_own", F.sum(weight).over(here))
    j = join_by(run, F.broadcast(pieces), [*by, "_part"], "left")
    out = j.withColumn("cum", F.col("_run") + F.coalesce("_before", F.lit(0))).withColumn("total", F.coalesce("_all", "_own"))
    return out.withColumn("cdf", normalise_weight(F.col("cum").cast("double"), F.col("total"))).drop("_part", "_run", "_own", "_before", "_all")


def to_cdf(pmf: DataFrame, by, outcome: str = "outcome", weight: str = "n", block="auto") -> DataFrame:
    """Running sum of weight in outcome order, plus the group total; ``cdf = cum / total``."""
    by = _by(by)
    blk = _outcome_block(pmf, by, outcome, block)
    out = ordered.running(pmf, by, [outcome], {"cum": ("sum", F.col(weight))}, blk, {"cum": "total"})
    return out.withColumn("cdf", normalise_weight(F.col("cum").cast("double"), F.col("total")))


def to_pmf(cdf: DataFrame, by, outcome: str = "outcome", cum: str = "cum", total: str = "total",
           block="auto") -> DataFrame:
    """Successive differences of the cumulative column: the inverse of :func:`to_cdf`."""
    by = _by(by)
    prev = ordered.neighbour(cdf, by, [outcome], cum, "_prev", "prev", _outcome_block(cdf, by, outcome, block))
    step = F.col(cum) - F.coalesce(F.col("_prev"), F.lit(0))
    out = prev.withColumn("mass", step).drop("_prev")
    return out.withColumn("prob", normalise_weight(F.col("mass").cast("double"), F.col(total)))


def power(cdf: DataFrame, p: float, col: str = "cdf", out: str = "cdf_pow") -> DataFrame:
    """CDF of the maximum of ``p`` independent draws: ``F(x) ** p``."""
    return cdf.withColumn(out, F.pow(F.col(col), F.lit(float(p))))


def inverse(cdf: DataFrame, by, ps: Sequence[float], outcome: str = "outcome", cum: str = "cum", total: str = "total") -> DataFrame:
    """Smallest outcome whose cumulative weight reaches ``p * total``; the last outcome if none does.

    One grouped aggregate evaluates every requested ``p`` in the same pass; the result is long
    ``(by..., p, value)``.
    """
    by = _by(by)
    aggs = []
    for i, p in enumerate(ps):
        hit = F.min(F.when(F.col(cum) >= F.lit(float(p)) * F.col(total), F.col(outcome)))
        aggs.append(F.struct(F.lit(float(p)).alias("p"), F.coalesce(hit, F.max(outcome)).alias("value")).alias(f"_q{i}"))
    wide = cdf.groupBy(*by).agg(*aggs)
    return wide.select(*by, F.explode(F.array(*[F.col(f"_q{i}") for i in range(len(ps))])).alias("_q")).select(
        *by, "_q.p", "_q.value"
    )


def credible_interval(cdf: DataFrame, by, prob: float, outcome: str = "outcome") -> DataFrame:
    """Central interval holding ``prob`` of the mass: quantiles at (1−p)/2 and 1−(1−p)/2, in one pass."""
    by = _by(by)
    lo_p, hi_p = (1.0 - prob) / 2.0, 1.0 - (1.0 - prob) / 2.0
    q = inverse(cdf, by, [lo_p, hi_p], outcome=outcome)
    return q.groupBy(*by).agg(
        F.max(F.when(F.col("p") == lo_p, F.col("value"))).alias("lower"),
        F.max(F.when(F.col("p") == hi_p, F.col("value"))).alias("upper"),
    )


def _as_of(steps: DataFrame, rows: DataFrame, by: list[str], key: str, out: str,
           block: Callable[[DataFrame], Column]) -> DataFrame:
    """Each of ``rows`` with ``_v`` of the step (by..., _k, _v) at the greatest ``_k <= key``; NULL below the first.

    Steps and rows are put in one order and the last step's value is carried forward, ``block`` by block; nothing
    is paired.
    """
    every = F.struct(*[rows[f"`{c}`"] for c in rows.columns])
    kind = rows.select(every.alias("_row")).schema["_row"].dataType
    points = rows.select(*by, F.col(key).alias("_k"), F.lit(1).alias("_t"), every.alias("_row"))
    marked = steps.select(*by, "_k", F.lit(0).alias("_t"), F.struct("_v").alias("_v"))
    both = marked.withColumn("_row", F.lit(None).cast(kind)).unionByName(points, allowMissingColumns=True)
    carried = ordered.carry_last(both, marked, by, ["_k", "_t"], "_v", "_last", block(both))
    return carried.where(F.col("_t") == 1).select("_row.*", F.col("_last._v").alias(out))


def lookup(cdf: DataFrame, probes: DataFrame, by, key: str, outcome: str = "outcome", value: str = "cdf",
           buckets: int = 256) -> DataFrame:
    """As-of lookup: for each probe, ``value`` at the greatest outcome <= the probe key; 0.0 below the first and
    for a group without a CDF. Keys may be of any orderable type; each distinct key is looked up once. The blocks'
    edges are drawn from the values themselves, so neither an outlier nor an uneven spread fills one block."""
    by = _by(by)
    steps = cdf.select(*by, F.col(outcome).alias("_k"), F.col(value).alias("_v"))
    keys = probes.select(*by, key).distinct()
    answers = _as_of(steps, keys, by, key, value, lambda d: ordered.auto_block(d, "_k", buckets)).withColumn(value, F.coalesce(value, F.lit(0.0)))
    return join_by(probes, answers, [*by, key], "left")


def sample_lookup(cdf: DataFrame, draws: DataFrame, by, u: str, outcome: str = "outcome",
                  buckets: int = 256) -> DataFrame:
    """Map uniforms ``u`` in [0,1) to outcomes: the first outcome whose ``cdf`` exceeds ``u`` (inverse transform).

    Outcome j owns ``[cdf_{j-1}, cdf_j)``, and the last one all above. A draw of a group without a CDF gets NULL.
    """
    by = _by(by)
    fields = {f.name: f.dataType.typeName() for f in cdf.schema.fields}
    if {"cum", "total", "n"} <= set(fields) and fields["n"] in ("long", "integer") and fields["cum"] in ("long", "integer"):
        # Integral counts: the previous step is exactly (cum - n) / total, no window needed.
        iv = cdf.select(*by, F.col(outcome).alias("_v"), F.col("cdf").alias("_hi"),
                        normalise_weight((F.col("cum") - F.col("n")).cast("double"), F.col("total")).alias("_k"))
    else:
        iv = cdf.select(*by, F.col(outcome).alias("_v"), F.col("cdf").alias("_hi"))
        iv = ordered.neighbour(iv, by, ["_v"], "_hi", "_k", "prev", _outcome_block(iv, by, "_v", "auto"))
    iv = iv.withColumn("_k", F.coalesce("_k", F.lit(0.0))).where(F.col("_hi") > F.col("_k"))
    # Draws are uniform, so equal ranges of [0, 1) hold equal shares of them.
    return _as_of(iv, draws, by, u, outcome, lambda d: F.floor(F.col("_k") * F.lit(float(buckets))))
