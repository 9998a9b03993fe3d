"""Bayesian updates of a prior over hypotheses from observed data.

Data are first reduced to ``(group, datum, n)`` counts, so the hypothesis join sees distinct data only. The
likelihood is either a table ``(hypo, datum, lik)`` (an equi-join on both) or a Column expression
``lik(datum, hypo)``; one code path serves any number of hypotheses.

The update is done in log space: ``ll = Σ n · ln(lik)``; ``w = prior · exp(ll − max ll)``; then normalise once.
A zero likelihood makes its hypothesis impossible for good (``ln 0`` would be NULL in Spark and skipped by
``sum``, so it is tracked explicitly); if every hypothesis becomes impossible the posterior stays all zero.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.exprs import join_by, normalise_weight
from tallyframe.operators import ordered
from tallyframe.operators.pmf import _by

def data_counts(data: DataFrame, by, datum: str | Sequence[str]) -> DataFrame:
    by = _by(by)
    return data.groupBy(*by, *_by(datum)).agg(F.count(F.lit(1)).alias("n"))


def _with_hypotheses(rows: DataFrame, prior: DataFrame, by: list[str], hypo: str, how: str) -> DataFrame:
    """Each row with the hypotheses and priors of its group. A prior without group columns is one packed row
    (a scalar subquery), so rows and hypotheses never meet in a cross join."""
    prior_by = [c for c in by if c in prior.columns]
    if prior_by:
        return join_by(prior.select(*prior_by, hypo, "prior"), rows, prior_by, how)
    packed = prior.select(F.collect_list(F.struct(hypo, "prior"))).scalar()
    return rows.select("*", F.inline(packed))


def _pair(counts: DataFrame, prior: DataFrame, by: list[str], datum: list[str], hypo: str,
          likelihood: DataFrame | Callable[[DataFrame], Column]) -> DataFrame:
    """Attach ``lik`` to each (group, hypothesis, datum) with the group's prior; ``lik`` is NULL where none is given
    and for a group of the prior without data."""
    if not by:  # one group, which is there even without data
        none = [F.lit(None).cast(counts.schema[c].dataType).alias(c) for c in datum]
        counts = counts.unionByName(counts.sparkSession.range(1).select(*none, F.lit(0).cast("bigint").alias("n")))
    x = _with_hypotheses(counts, prior, by, hypo, "left")
    if isinstance(likelihood, DataFrame):
        x = x.join(likelihood.select(hypo, *datum, "lik"), [hypo, *datum], "left")
    else:
        x = x.withColumn("lik", likelihood(x))
    return x.withColumn("lik", F.when(F.col("n") > 0, F.col("lik")))


def _wide_likelihood(likelihood: DataFrame, datum: list[str], hypo: str, hyps: list) -> DataFrame:
    """One row per datum with ``_l0.._l{H-1}``: the likelihood of each hypothesis (NULL when not given)."""
    lk = likelihood.groupBy(*datum).pivot(hypo, hyps).agg(F.first("lik"))
    return lk.select(*datum, *[F.col(f"`{h}`").cast("double").alias(f"_l{i}") for i, h in enumerate(hyps)])


def posterior(
    prior: DataFrame, data: DataFrame, by, datum: str | Sequence[str], hypo: str = "hypo",
    likelihood: DataFrame | Callable[[DataFrame], Column] | None = None,
) -> DataFrame:
    """Posterior ``(by..., hypo, prob)`` after observing all ``data`` (set update, normalised once).

    ``prior``: (by?..., hypo, prior). Groups are those of ``prior`` if it has the group columns, else those of
    ``data``; a group without data keeps its prior. A datum for which a hypothesis has no likelihood row leaves
    that hypothesis as it is (a factor of one).
    """
    by = _by(by)
    datum = _by(datum)
    x = _pair(data_counts(data, by, datum), prior, by, datum, hypo, likelihood)
    ll = x.groupBy(*by, hypo, "prior").agg(
        F.min("lik").alias("_minlik"),
        F.sum(F.col("n") * F.log(F.when(F.col("lik") > 0, F.col("lik")))).alias("_ll"),
    )
    possible = F.col("_minlik").isNull() | (F.col("_minlik") > 0)
    return _normalise_log(ll.withColumn("_ll", F.when(possible, F.coalesce("_ll", F.lit(0.0)))), by, hypo)


def _normalise_log(ll: DataFrame, by: list[str], hypo: str, extra: Sequence[str] = ()) -> DataFrame:
    """``_ll`` NULL means impossible. Shift by the group max, exponentiate, multiply the prior, normalise."""
    part = [*by, *extra]
    w = Window.partitionBy(*part)
    x = ll.withColumn("_m", F.max("_ll").over(w))
    x = x.withColumn("_w", F.coalesce(F.col("prior") * F.exp(F.col("_ll") - F.col("_m")), F.lit(0.0)))
    x = x.withColumn("prob", normalise_weight(F.col("_w"), F.sum("_w").over(w)))
    return x.select(*part, hypo, "prob")


def sequential(
    prior: DataFrame, data: DataFrame, by, order: Sequence[str], datum: str | Sequence[str], hypo: str = "hypo",
    likelihood: DataFrame | None = None, block: Column | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """The posterior after each datum, in ``order`` per group: ``(by..., order..., keep..., hypo, prob)``.

    Running log-likelihood sums per (group, hypothesis) use the skew-safe block scan; a running count of
    impossible data enforces the zero rule; each step normalises over the hypotheses of that step. A datum for
    which a hypothesis has no likelihood row leaves that hypothesis as it is.
    """
    by = _by(by)
    datum = _by(datum)
    order = list(order)
    rows = data.select(*by, *order, *datum, *keep)
    x = _with_hypotheses(rows, prior, by, hypo, "inner")
    x = x.join(likelihood.select(hypo, *datum, "lik"), [hypo, *datum], "left")
    sums = {
        "_lls": F.log(F.when(F.col("lik") > 0, F.col("lik"))),
        "_zeros": F.when(F.col("lik") <= 0, F.lit(1)).otherwise(F.lit(0)),
    }
    run = ordered.running_sums(x, [*by, hypo], order, sums, block)
    run = run.withColumn("_ll", F.when(F.col("_zeros") == 0, F.col("_lls")))
    out = _normalise_log(run, by, hypo, extra=[*order, *keep])
    return out
