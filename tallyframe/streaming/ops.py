"""Streaming operators: per-window and running distinct counts, sketches, heavy hitters, keyed sketch
state joined to a dimension, per-key Bayes state as a changelog, and an ordered per-key fold with custom
state."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tallyframe.operators.sketch import _hash_halves, checked_lg_k, cms_cells, cms_shape


def distinct_per_window(stream: DataFrame, ts: str, key: str, window: str, lateness: str) -> DataFrame:
    """Exact distinct keys per tumbling event-time window. Duplicates are dropped within the watermark,
    so state for a (window, key) pair is released once the watermark passes it."""
    w = stream.withWatermark(ts, lateness).withColumn("window_start", F.window(ts, window).start)
    return w.dropDuplicatesWithinWatermark(["window_start", key]).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("distinct_keys")
    )


def running_distinct(stream: DataFrame, key: str) -> DataFrame:
    """Exact running distinct count (streaming ``countDistinct`` is not supported: dedup, then count)."""
    return stream.dropDuplicates([key]).groupBy().agg(F.count(F.lit(1)).alias("distinct_keys"))


def sketch_state(stream: DataFrame, by: Sequence[str], item: str, lg_k: int = 12) -> DataFrame:
    """Keyed HLL sketch as streaming state (merged across micro-batches)."""
    return stream.groupBy(*by).agg(F.hll_sketch_agg(F.col(item), checked_lg_k(lg_k)).alias("sketch"))


def distinct_error(stream: DataFrame, by: Sequence[str], key: str, lg_k: int = 12) -> DataFrame:
    """Running ``(by..., exact, est, error_pct)``: exact distinct keys, their HLL estimate and its error in percent, all
    from state: a key enters count and sketch once, when it is new to its group."""
    new = stream.dropDuplicates([*by, key])
    out = new.groupBy(*by).agg(F.count(F.col(key)).alias("exact"), F.hll_sketch_estimate(F.hll_sketch_agg(F.col(key), checked_lg_k(lg_k))).alias("est"))
    return out.withColumn("error_pct", (F.col("est") / F.nullif(F.col("exact"), F.lit(0)) - 1) * 100)


def window_sketch(stream: DataFrame, ts: str, by: Sequence[str], item: str, window: str, lateness: str,
                  lg_k: int = 12) -> DataFrame:
    """Tumbling event-time window sketches with a watermark (state dropped once a window is final)."""
    w = stream.withWatermark(ts, lateness)
    return w.groupBy(F.window(ts, window).start.alias("window_start"), *by).agg(
        F.hll_sketch_agg(F.col(item), checked_lg_k(lg_k)).alias("sketch")
    )


def top_counts(stream: DataFrame, key: str, k: int) -> DataFrame:
    """Running exact counts per key, top ``k`` (ties: smallest key). Complete mode."""
    c = stream.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    return c.orderBy(F.desc("cnt"), F.asc(key)).limit(k)


def enrich_top(stream: DataFrame, key: str, item: str, dim: DataFrame, dim_key: str, k: int, lg_k: int = 14):
    """Per-key distinct estimate (sketch state) joined to a static dimension, top ``k`` by estimate."""
    s = stream.groupBy(key).agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(item), checked_lg_k(lg_k))).alias("est"))
    j = s.join(dim, s[key] == dim[dim_key])
    return j.orderBy(F.desc("est"), F.asc(key)).limit(k)


def ordered_fold(stream: DataFrame, key: str, order: Sequence[str], value: str, keep: Sequence[str],
                 init: float = 0.0) -> DataFrame:
    """Per-key running sum emitted for every event, with the state kept in the streaming state store.

    Each micro-batch's rows of a key are sorted by ``order`` before folding; a restart resumes from the
    checkpointed state.
    """
    out_fields = [stream.schema[key], *[stream.schema[c] for c in keep], T.StructField("state", T.DoubleType())]
    out_schema = T.StructType(out_fields)
    state_schema = T.StructType([T.StructField("acc", T.DoubleType())])

    def step(k, batches, state):
        acc = state.get[0] if state.exists else init
        pdf = pd.concat(list(batches), ignore_index=True).sort_values(list(order), kind="mergesort")
        run = acc + pdf[value].fillna(0.0).cumsum()
        state.update((float(run.iloc[-1]) if len(run) else acc,))
        res = pdf[[*keep]].copy()
        res.insert(0, key, k[0])
        res["state"] = run.to_numpy()
        yield res

    return stream.groupBy(key).applyInPandasWithState(
        step, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout
    )


def cms_state(stream: DataFrame, item: str, eps: float, delta: float) -> DataFrame:
    """Count-min sketch as streaming state: ``(depth, bucket, cnt)``, at most depth × width rows whatever the
    traffic, plus nothing else; each micro-batch adds its cell counts (combined map-side)."""
    width, depth = cms_shape(eps, delta)
    cells = stream.select(*_hash_halves(F.col(item))).select(
        F.explode(cms_cells(F.col("_h1"), F.col("_h2"), width, depth)).alias("_cell"))
    return cells.groupBy(F.col("_cell.depth").alias("depth"), F.col("_cell.bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("cnt"))


def bayes_changelog(stream: DataFrame, key: str, datum: str, likelihood: DataFrame, hyps: list,
                    hypo: str = "hypo") -> DataFrame:
    """Per-key Bayes sufficient statistics kept in the state store and emitted as an append-only changelog.

    For each key and micro-batch the state holds, per hypothesis, the minimum likelihood seen and the sum of
    log-likelihoods; the updated state is appended with a version number, so a file sink (not the driver)
    receives it and readers take the latest version per key. ``hyps`` is the bounded hypothesis list.
    """
    from tallyframe.operators.bayes import _wide_likelihood

    n = len(hyps)
    lk = _wide_likelihood(likelihood, [datum], hypo, hyps)
    x = stream.join(lk, datum).select(key, *[f"_l{i}" for i in range(n)])
    out_schema = T.StructType([
        stream.schema[key],
        T.StructField("version", T.LongType()),
        T.StructField("minlik", T.ArrayType(T.DoubleType())),
        T.StructField("ll", T.ArrayType(T.DoubleType())),
    ])
    state_schema = T.StructType([
        T.StructField("version", T.LongType()),
        T.StructField("minlik", T.ArrayType(T.DoubleType())),
        T.StructField("ll", T.ArrayType(T.DoubleType())),
    ])

    def step(k, batches, state):
        import numpy as np

        if state.exists:
            version, minlik, ll = state.get
            minlik, ll = np.asarray(minlik, float), np.asarray(ll, float)
        else:
            version, minlik, ll = 0, np.full(n, np.inf), np.zeros(n)
        for pdf in batches:
            lik = pdf[[f"_l{i}" for i in range(n)]].to_numpy(float)
            minlik = np.minimum(minlik, np.nanmin(np.where(np.isnan(lik), np.inf, lik), axis=0))
            with np.errstate(divide="ignore"):
                ll = ll + np.where(lik > 0, np.log(np.where(lik > 0, lik, 1.0)), 0.0).sum(axis=0)
        version += 1
        state.update((version, minlik.tolist(), ll.tolist()))
        yield pd.DataFrame({key: [k[0]], "version": [version], "minlik": [minlik.tolist()], "ll": [ll.tolist()]})

    return x.groupBy(key).applyInPandasWithState(step, out_schema, state_schema, "append",
                                                 GroupStateTimeout.NoTimeout)


def latest_version(changelog: DataFrame, key: str) -> DataFrame:
    """The newest row per key of an append-only state changelog (a mergeable ``max_by`` aggregate)."""
    cols = [c for c in changelog.columns if c not in (key, "version")]
    latest = changelog.groupBy(key).agg(F.max_by(F.struct(*cols), "version").alias("_s"))
    return latest.select(key, *[F.col(f"_s.{c}").alias(c) for c in cols])
