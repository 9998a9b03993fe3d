"""Ordered state folds: ``state + ordered inputs -> states/outputs``.

* :func:`scan` emits the initial state and then one state per input (running aggregate, skew-safe blocks);
* :func:`final` returns only the last state (a grouped aggregate: no ordering needed for sum/max/min);
* :func:`reset_fold` applies "reset" events: a reset replaces the state and discards every earlier input;
* :func:`affine_scan` emits every state of ``s <- a*s + b``, with factors and steps (so also resets) per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.exprs import join_by
from tallyframe.operators import ordered
from tallyframe.operators.pmf import _by


def scan(
    df: DataFrame, by, order: Sequence[str], prepare: Column, init: float, op: str = "sum",
    present: Callable[[Column], Column] | None = None, block: Column | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """``(by..., pos, keep..., state, output)``: pos 0 is the initial state, then one row per input in order.

    ``prepare`` maps an input row to the monoid value, ``op`` is the monoid (sum/max/min), ``present`` maps a
    state to the emitted output (identity by default).
    """
    by = _by(by)
    present = present or (lambda s: s)
    x = df.select(*by, *order, *keep, prepare.alias("_in"))
    r = ordered.running(x, by, order, {"_acc": (op, F.col("_in")), "pos": ("sum", F.lit(1))}, block)
    comb = {"sum": lambda a: a + F.lit(init), "max": lambda a: F.greatest(a, F.lit(init)),
            "min": lambda a: F.least(a, F.lit(init))}[op]
    steps = r.select(*by, F.col("pos").cast("bigint").alias("pos"), *keep,
                     comb(F.col("_acc")).cast("double").alias("state"))
    first = df.select(*by).distinct().select(*by, F.lit(0).cast("bigint").alias("pos"),
                                             *[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keep],
                                             F.lit(float(init)).alias("state"))
    out = steps.unionByName(first)
    return out.withColumn("output", present(F.col("state")))


def final(df: DataFrame, by, prepare: Column, init: float, op: str = "sum",
          present: Callable[[Column], Column] | None = None) -> DataFrame:
    """Last state and last output of the fold, plus the number of inputs."""
    by = _by(by)
    present = present or (lambda s: s)
    agg = {"sum": F.sum, "max": F.max, "min": F.min}[op]
    comb = {"sum": lambda a: F.coalesce(a, F.lit(0.0)) + F.lit(init),
            "max": lambda a: F.greatest(F.coalesce(a, F.lit(init)), F.lit(init)),
            "min": lambda a: F.least(F.coalesce(a, F.lit(init)), F.lit(init))}[op]
    g = df.groupBy(*by).agg(agg(prepare).alias("_acc"), F.count(F.lit(1)).alias("inputs"))
    out = g.select(*by, comb(F.col("_acc")).cast("double").alias("state"), "inputs")
    return out.withColumn("output", present(F.col("state")))


def reset_fold(
    df: DataFrame, by, order: Sequence[str], is_reset: Column, reset_state: Column, prepare: Column,
    zero: float = 0.0,
) -> DataFrame:
    """State monoid with resets: the last reset (in ``order``) sets the state; later inputs are summed onto it.

    A reset discards everything to its left, so only the rows after each key's last reset matter. The last
    reset is a mergeable ``max_by`` aggregate; no ordering of the whole key is needed.
    """
    by = _by(by)
    ordkey = F.struct(*[F.col(c) for c in order])
    x = df.select(*by, ordkey.alias("_ord"), is_reset.alias("_reset"), reset_state.alias("_rs"), prepare.alias("_in"))
    last = x.where(F.col("_reset")).groupBy(*by).agg(
        F.max("_ord").alias("_last"), F.max_by("_rs", "_ord").alias("_state0")
    )
    j = join_by(x.where(~F.col("_reset")), last, by, "left")
    after = j.where(F.col("_last").isNull() | (F.col("_ord") > F.col("_last")))
    sums = after.groupBy(*by).agg(F.sum("_in").alias("_s"), F.count(F.lit(1)).alias("inputs"))
    keys = x.select(*by).distinct()
    out = join_by(join_by(keys, last, by, "left"), sums, by, "left")
    return out.select(
        *by,
        (F.coalesce(F.col("_state0"), F.lit(zero)) + F.coalesce(F.col("_s"), F.lit(0.0))).alias("state"),
        F.coalesce(F.col("inputs"), F.lit(0)).cast("bigint").alias("inputs"),
        F.col("_last").isNotNull().alias("was_reset"),
    )


#: Rows folded in one call of the affine scan.
CHUNK_ROWS = 50_000


def _states(a, b, start: float) -> list[float]:
    return list(accumulate(zip(a, b), lambda s, r: r[1] if r[0] == 0 else r[0] * s + r[1], initial=start))


def affine_scan(
    df: DataFrame, by, order: Sequence[str], a: Column, b: Column, init: float = 0.0, block: Column | None = None,
    keep: Sequence[str] = (), rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``(by..., order..., keep..., state)``: the state after each row of ``s <- a*s + b`` from ``init``, in ``order``.

    A factor of 0 is a reset to ``b``; a row with a NULL factor or step leaves the state as it is. Each chunk of at
    most ``rows`` rows of a longer key reduces to one map (its own a and b); the maps of a key, one small row per chunk,
    give each chunk its first state. The chunks then emit their states, all chunks of a task in one stream, so that a
    short key costs no call of its own.
    """
    by = _by(by)
    g = by or ["_g"]
    shown = list(dict.fromkeys([*order, *keep]))
    known = a.isNotNull() & b.isNotNull()
    places, spread = ordered.nulls_last(order, block)
    x = df.select(*([F.col(c) for c in by] or [F.lit(0).alias("_g")]), *shown,
                  F.when(known, a.cast("double")).otherwise(F.lit(1.0)).alias("_a"),
                  F.when(known, b.cast("double")).otherwise(F.lit(0.0)).alias("_b"),
                  spread.alias("_blk"))

    def chunked(part: DataFrame) -> DataFrame:
        return ordered.row_chunks(part, g, places, rows, "_chunk", F.col("_blk"), "_rank").drop("_blk")

    fields = {f.name: f for f in x.schema.fields}
    keys = [fields[c] for c in g]

    def chunk_map(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rank")
        factor = 0.0 if (pdf["_a"] == 0).any() else pdf["_a"].prod()
        out = {c: [pdf[c].iloc[0]] for c in [*g, "_chunk"]}
        return pd.DataFrame({**out, "_a": [factor], "_b": [_states(pdf["_a"], pdf["_b"], 0.0)[-1]]})

    def chunk_starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        return pdf[[*g, "_chunk"]].assign(_chunk=pdf["_chunk"] + 1, _b=_states(pdf["_a"], pdf["_b"], float(init))[1:])

    carried = [*g, *shown]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = float(init)
        for batch in batches:
            ranks = batch.column("_rank").to_numpy(zero_copy_only=False)
            states = []
            for begins, factor, step in zip((ranks == 1).tolist(), batch.column("_a").to_pylist(), batch.column("_b").to_pylist()):
                if begins:
                    state = float(init)
                state = step if factor == 0 else factor * state + step
                states.append(state)
            done = pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(states, pa.float64())], names=[*carried, "state"])
            yield done.filter(pa.array(ranks > 0))

    number = [T.StructField("_chunk", T.LongType())]
    double = {c: T.StructField(c, T.DoubleType()) for c in ("_a", "_b", "state")}
    full = chunked(ordered.long_keys(x, g, rows))
    maps = full.groupBy(*g, "_chunk").applyInPandas(chunk_map, T.StructType([*keys, *number, double["_a"], double["_b"]]))
    starts = maps.groupBy(*g).applyInPandas(chunk_starts, T.StructType([*keys, *number, double["_b"]]))
    # a reset to the chunk's first state before its first row
    out = ordered.fold_chunks(chunked(x), starts.withColumn("_a", F.lit(0.0)), g, emit,
                              T.StructType([*keys, *[fields[c] for c in shown], double["state"]]))
    return out if by else out.drop("_g")
