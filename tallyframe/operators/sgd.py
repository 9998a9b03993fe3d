"""Stochastic gradient descent in row order, at any scale: one exact pass of a linear model, mixed passes of any other.

The step ``w <- w − s·(w·x̃ − y)·x̃`` (``x̃ = xs ++ [1.0]``, bias last) is affine in ``w``:
``w <- (I − s x̃ x̃ᵀ) w + s y x̃``. A run of rows therefore composes to a single affine map. The rows of a key are cut
into chunks of a fixed number of consecutive rows; each chunk's map is the product of its rows' maps (a vectorised
tree product in numpy, within one task). The maps compose in order, first within groups of neighbouring chunks and
then per key. No key is ever gathered into one list, a hot key spreads over its chunks, and a call's memory depends
on the chunk's rows alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.exprs import col_of, join_by
from tallyframe.operators import ordered
from tallyframe.operators.pmf import _by
from tallyframe.sources.tables import materialize

#: Rows of a chunk, and chunks whose maps compose in one call before the maps of a key do.
CHUNK_ROWS, CHUNK_GROUP = 50_000, 4096


def _row_maps(x: np.ndarray, y: np.ndarray, step: float) -> np.ndarray:
    """Homogeneous (d+1)x(d+1) matrices of each row's affine step, x already holding the bias column."""
    n, d = x.shape
    m = np.zeros((n, d + 1, d + 1))
    m[:, :d, :d] = np.eye(d)[None, :, :] - step * x[:, :, None] * x[:, None, :]
    m[:, :d, d] = step * y[:, None] * x
    m[:, d, d] = 1.0
    return m


def _ordered_product(m: np.ndarray) -> np.ndarray:
    """``M_n ⋯ M_2 M_1`` (M_1 applied first) by pairwise reduction: log2(n) vectorised rounds."""
    dim = m.shape[1]
    while len(m) > 1:
        if len(m) % 2:
            m = np.concatenate([m, np.eye(dim)[None, :, :]])
        m = np.matmul(m[1::2], m[0::2])
    return m[0] if len(m) else np.eye(dim)


def sgd_linear(
    df: DataFrame, by, order: Sequence[str], y: str | Column, xs: Sequence[str | Column], step: float,
    w0: Sequence[float] | None = None, block: Column | None = None, grad_scale: float = 1.0,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Weights after one ordered pass per key: ``(by..., w ARRAY<DOUBLE> (bias last), count)``.

    ``grad_scale`` multiplies the gradient (a custom gradient ``c·(w·x̃ − y)·x̃``; c = 2 is the squared-error
    derivative without the usual 1/2); the step stays affine in ``w``. ``block`` (see :mod:`ordered`) spreads the
    numbering of a hot key's rows.
    """
    step = step * float(grad_scale)
    by = _by(by)
    order = list(order)
    d = len(xs) + 1
    w0 = list(w0) if w0 is not None else [0.0] * d
    if len(w0) != d:
        raise ValueError(f"w0 needs {d} values (features then bias)")
    g = by or ["_g"]
    rows = df.select(
        *([F.col(b) for b in by] or [F.lit(0).alias("_g")]),
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
        col_of(y).cast("double").alias("_y"),
        *[col_of(x).cast("double").alias(f"_x{i}") for i, x in enumerate(xs)],
        (block if block is not None else F.lit(0)).cast("bigint").alias("_blk"),
    )
    # a point without a label or a feature is not a sample: it is skipped, not folded in as NaN
    rows = rows.dropna(subset=["_y", *[f"_x{i}" for i in range(len(xs))]])
    okeys = [f"_o{i}" for i in range(len(order))]
    rows = ordered.row_chunks(rows, g, okeys, chunk_rows, "_chunk", F.col("_blk"))
    key_fields = [f for f in rows.schema.fields if f.name in g]
    map_schema = T.StructType(key_fields + [
        T.StructField("_chunk", T.LongType()),
        T.StructField("_m", T.ArrayType(T.DoubleType())),
        T.StructField("_n", T.LongType()),
    ])

    def chunk_map(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(okeys, kind="mergesort")
        x = np.column_stack([pdf[f"_x{i}"].to_numpy(float) for i in range(d - 1)] + [np.ones(len(pdf))])
        m = _ordered_product(_row_maps(x, pdf["_y"].to_numpy(float), step))
        return one_row(pdf, m, len(pdf))

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        m = np.stack([np.asarray(flat, dtype=float).reshape(d + 1, d + 1) for flat in pdf["_m"]])
        return one_row(pdf, _ordered_product(m), int(pdf["_n"].sum()))

    def one_row(pdf: pd.DataFrame, m: np.ndarray, n: int) -> pd.DataFrame:
        out = {k: [pdf[k].iloc[0]] for k in [*g, "_chunk"]}
        return pd.DataFrame({**out, "_m": [m.ravel().tolist()], "_n": [n]})

    maps = rows.groupBy(*g, "_chunk").applyInPandas(chunk_map, map_schema)
    near = F.floor(F.col("_chunk") / F.lit(CHUNK_GROUP))
    maps = maps.groupBy(*g, near).applyInPandas(compose, map_schema)
    whole = maps.groupBy(*g).applyInPandas(compose, map_schema)
    state = [*w0, 1.0]
    weights = [sum((F.col("_m")[i * (d + 1) + j] * F.lit(float(v)) for j, v in enumerate(state)), F.lit(0.0)) for i in range(d)]
    return whole.select(*by, F.array(*weights).alias("w"), F.col("_n").alias("count"))


Gradient = Callable[[np.ndarray, np.ndarray, float], np.ndarray]


def logistic_gradient(w: np.ndarray, x: np.ndarray, y: float) -> np.ndarray:
    """Of the log-loss of a label 0 or 1; x ends in the bias's 1."""
    z = max(-700.0, min(700.0, float(w @ x)))
    return (1.0 / (1.0 + math.exp(-z)) - y) * x


def logistic_gradients(w: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """:func:`logistic_gradient` of many weights at a point each: rows of ``w`` and ``x``, values of ``y``."""
    z = np.clip((w * x).sum(axis=1), -700.0, 700.0)
    return (1.0 / (1.0 + np.exp(-z)) - y)[:, None] * x


#: Points that the passes of a task hold at a time, of as many chunks as that makes.
POINTS = 1 << 20


def _passes(chunks: list[np.ndarray], w: np.ndarray, step: float, gradients: Gradient) -> np.ndarray:
    """The weights (rows of ``w``) after a pass over each chunk, rows (y, xs...): the next point of every chunk at once,
    each chunk's points in their order."""
    sizes = np.array([len(c) for c in chunks])
    longest_first = np.argsort(-sizes, kind="stable")
    w, points = w[longest_first].copy(), np.ones((sizes.max(), len(chunks), w.shape[1] + 1))
    for i, c in enumerate(longest_first):
        points[:sizes[c], i, :-1] = chunks[c]
    active = len(chunks) - np.searchsorted(np.sort(sizes), np.arange(len(points)), side="right")
    for at, n in zip(points, active.tolist()):
        w[:n] -= step * gradients(w[:n], at[:n, 1:], at[:n, 0])
    out = np.empty_like(w)
    out[longest_first] = w
    return out


def sgd_mixed(
    df: DataFrame, by, order: Sequence[str], y: str | Column, xs: Sequence[str | Column], step: float,
    gradient: Gradient = logistic_gradient, w0: Sequence[float] | None = None, rounds: int = 1,
    block: Column | None = None, chunk_rows: int = CHUNK_ROWS, gradients: Gradient | None = None,
) -> DataFrame:
    """Weights after ``rounds`` passes with any gradient: ``(by..., w ARRAY<DOUBLE> (bias last), count)``.

    A step that is not affine in the weights has no composed form, so a round passes over each chunk of consecutive
    rows in order, all chunks from the key's present weights, and mixes the chunks' weights by their numbers of rows.
    With one chunk per key this is the sequential pass; with c chunks of a key each weight moves in ``rounds`` rounds
    like the mean of ``c`` shorter passes. Chunks are packed once into a stored table (one row of doubles per chunk) and
    each round reads that; only weights are shuffled. A point without a label or a feature is skipped.

    ``gradients`` is ``gradient`` of many chunks' weights at a point each (see :func:`logistic_gradients`); with it, a
    task's chunks are passed over side by side. Without it, points are taken one by one.
    """
    by, order, d = _by(by), list(order), len(xs) + 1
    start = [float(v) for v in w0] if w0 is not None else [0.0] * d
    if len(start) != d or rounds < 1:
        raise ValueError(f"w0 needs {d} values (features then bias), rounds at least 1")
    if gradients is None and gradient is logistic_gradient:
        gradients = logistic_gradients
    g = by or ["_g"]
    names = ["_y", *(f"_x{i}" for i in range(d - 1))]
    okeys = [f"_o{i}" for i in range(len(order))]
    rows = df.select(
        *([F.col(b) for b in by] or [F.lit(0).alias("_g")]), *[F.col(o).alias(n) for o, n in zip(order, okeys)],
        *[col_of(c).cast("double").alias(n) for c, n in zip([y, *xs], names)],
        (block if block is not None else F.lit(0)).cast("bigint").alias("_blk"),
    ).dropna(subset=names)
    places, spread = ordered.nulls_last(okeys, F.col("_blk"))
    rows = ordered.row_chunks(rows, g, places, chunk_rows, "_chunk", spread, "_rank").select(*g, "_chunk", "_rank", *names)
    keys = [f for f in rows.schema.fields if f.name in g]
    chunked = T.StructType([*keys, T.StructField("_n", T.LongType()), T.StructField("_points", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []  # of the chunk at the end of the batch

        def packed_rows(done: list[tuple]) -> pa.RecordBatch:
            points = [np.concatenate(parts) for _, parts in done]
            columns = [pa.concat_arrays([k[i] for k, _ in done]) for i in range(len(g))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(map(len, points), pa.int64()), pa.array([p.tobytes() for p in points], pa.binary())],
                                              names=[*g, "_n", "_points"])

        for batch in batches:
            points = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            first = np.flatnonzero(batch.column("_rank").to_numpy(zero_copy_only=False) % chunk_rows == 1 % chunk_rows)
            edges, done = [*first.tolist(), len(points)], []
            held.append(points[:edges[0]])
            for low, high in zip(edges, edges[1:]):
                if key is not None:
                    done.append((key, held))
                key, held = [batch.column(c).slice(low, 1) for c in g], [points[low:high]]
            if done:
                yield packed_rows(done)
        if key is not None:
            yield packed_rows([(key, held)])

    packed = rows.repartition(*g, "_chunk").sortWithinPartitions(*g, "_chunk", "_rank").mapInArrow(pack, chunked)
    packed = materialize(packed, "sgd-chunks")

    def one_by_one(points: np.ndarray, w: np.ndarray) -> np.ndarray:
        x = np.column_stack([points[:, 1:], np.ones(len(points))])
        for i, label in enumerate(points[:, 0].tolist()):
            w = w - step * gradient(w, x[i], label)
        return w

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            many = max(1, POINTS // int(pdf["_n"].max())) if len(pdf) else 1
            for low in range(0, len(pdf), many):
                part = pdf.iloc[low:low + many]
                chunks = [np.frombuffer(points).reshape(-1, d) for points in part["_points"]]
                w = np.array(part["_w"].tolist(), float)
                ends = _passes(chunks, w, step, gradients) if gradients else [one_by_one(c, w[i]) for i, c in enumerate(chunks)]
                yield part[[*g, "_n"]].assign(_w=[end.tolist() for end in ends])

    passed = T.StructType([*keys, T.StructField("_n", T.LongType()), T.StructField("_w", T.ArrayType(T.DoubleType()))])
    weights = None
    for _ in range(rounds):
        begun = packed.withColumn("_w", F.array(*map(F.lit, start))) if weights is None else join_by(packed, weights, g)
        done = begun.mapInPandas(run, passed)
        mixed = [(F.sum(F.col("_n") * F.col("_w")[i]) / F.sum("_n")).alias(f"_w{i}") for i in range(d)]
        weights = done.groupBy(*g).agg(*mixed, F.sum("_n").alias("_n")).select(*g, F.array(*[f"_w{i}" for i in range(d)]).alias("_w"), "_n")
        weights = materialize(weights, "sgd-weights")
        rows_of = weights.select(*by, F.col("_w").alias("w"), F.col("_n").alias("count"))
        weights = weights.drop("_n")
    return rows_of


def log_loss(y: str | Column, xs: Sequence[str | Column], w: Column) -> Column:
    """Mean log-loss of labels 0 or 1 at ``w`` as an aggregate expression (``w`` an array column)."""
    z = F.element_at(w, len(xs) + 1)
    for i, x in enumerate(xs):
        z = z + F.element_at(w, i + 1) * col_of(x)
    return F.avg(F.greatest(z, F.lit(0.0)) - z * col_of(y) + F.log1p(F.exp(-F.abs(z))))


def mse(df: DataFrame, y: str | Column, xs: Sequence[str | Column], w: Column) -> Column:
    """Mean squared error of ``w·x̃`` against ``y`` as an aggregate expression (``w`` an array column)."""
    pred = F.lit(0.0)
    for i, x in enumerate(xs):
        pred = pred + F.element_at(w, i + 1) * col_of(x)
    pred = pred + F.element_at(w, len(xs) + 1)
    return F.avg(F.pow(pred - col_of(y), 2))
