"""Ordered folds with any user logic over a finite set of states, as a parallel prefix of transition functions.

The logic names the next state of each state as a Column of the input row, so a row is a function from states to
states. Such functions compose associatively whatever the logic does, and a reset is just a constant function. A key's
rows are cut into chunks of a fixed number of consecutive rows; each chunk reduces to one function, neighbouring
chunks' functions compose in groups and then per key, first states come back down the same way, and the chunks emit
the state after each of their rows side by side. A hot key thus spreads over its chunks, and a call's memory depends
on ``rows`` (or ``group``) alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.exprs import join_by
from tallyframe.operators import ordered
from tallyframe.operators.pmf import _by

#: Rows of a chunk, and chunks whose functions compose in one call before those of a key do.
CHUNK_ROWS, CHUNK_GROUP = 50_000, 4096

Logic = Callable[[Column], Column]


def transitions(states: Sequence, logic: Logic) -> list[Column]:
    """The number of the next state of each state. A NULL next state (logic that does not cover the row) leaves the
    state as it is; a value that is no state leads to one more, which nothing leaves."""

    known = F.array(*[F.lit(s) for s in states])

    def number(state) -> Column:
        place = F.array_position(known, F.coalesce(logic(F.lit(state)), F.lit(state)))  # names the logic once; 0: no state
        return F.pmod(place - 1, F.lit(len(states) + 1))

    return [*(number(s) for s in states), F.lit(len(states))]


def composed(maps: np.ndarray) -> np.ndarray:
    """One function from rows of functions, the first row applied first: pairwise, in log2(n) vectorised rounds."""
    while len(maps) > 1:
        rest = maps[len(maps) // 2 * 2:]
        maps = np.concatenate([np.take_along_axis(maps[1::2], maps[0:len(maps) // 2 * 2:2], axis=1), rest])
    return maps[0]


def states_after(maps: np.ndarray, start: int) -> np.ndarray:
    """The state after each row from ``start``: inclusive prefix functions by doubling steps."""
    prefix, step = maps, 1
    while step < len(prefix):
        prefix = np.concatenate([prefix[:step], np.take_along_axis(prefix[step:], prefix[:-step], axis=1)])
        step *= 2
    return prefix[:, start]


def scan(
    df: DataFrame, by, order: Sequence[str], states: Sequence, logic: Logic, init, block: Column | None = None,
    keep: Sequence[str] = (), out: str = "state", rows: int = CHUNK_ROWS, group: int = CHUNK_GROUP,
) -> DataFrame:
    """``(by..., order..., keep..., out)``: the state after each row, from ``init``, in ``order`` (a total order within
    a key). Logic that leads a key out of ``states`` raises an error. ``block`` (see :mod:`ordered`) spreads the numbering of a hot key's rows. A NULL key is a key like any
    other; an empty table gives an empty one."""
    by, states = _by(by), list(states)
    if len(set(states)) < len(states) or init not in states:
        raise ValueError("states must differ, and the first one must be among them")
    g = by or ["_g"]
    shown = list(dict.fromkeys([*order, *keep]))
    steps = [f"_t{i}" for i in range(len(states) + 1)]
    places, spread = ordered.nulls_last(order, block)
    x = df.select(*([F.col(c) for c in by] or [F.lit(0).alias("_g")]), *[c for c in shown if c not in by],
                  *[c.cast("int").alias(n) for c, n in zip(transitions(states, logic), steps)], spread.alias("_blk"))

    def chunked(part: DataFrame) -> DataFrame:
        return ordered.row_chunks(part, g, places, rows, "_chunk", F.col("_blk"), "_rank").drop("_blk")

    fields = {f.name: f for f in x.schema.fields}
    keys = [fields[c] for c in g]
    number = {c: T.StructField(c, T.LongType()) for c in ("_chunk", "_near", "_start")}
    moves = [T.StructField(c, T.IntegerType()) for c in steps]

    def functions(pdf: pd.DataFrame) -> np.ndarray:
        return pdf[steps].to_numpy(np.int64)

    def reduce(sort: list[str], ident: list[str]):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(sort, kind="mergesort")
            whole = composed(functions(pdf))
            return pd.DataFrame({c: [pdf[c].iloc[0]] for c in [*g, *ident]} | {c: [v] for c, v in zip(steps, whole)})

        return run

    def starts(ident: str, following: int = 0):
        """First states of the chunks (or groups), or of the ones that follow them."""

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(ident)
            first = int(pdf["_start"].iloc[0])
            after = [first, *states_after(functions(pdf), first)]
            return pdf[[*g, ident]].assign(**{ident: pdf[ident] + following}, _start=after[following:][:len(pdf)])

        return run

    carried = [*g, *[c for c in shown if c not in g]]
    first_state, width = states.index(init), len(steps)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = first_state
        for batch in batches:
            ranks = batch.column("_rank").to_numpy(zero_copy_only=False)
            moved = memoryview(np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int32) for c in steps]).ravel())
            after = []
            for i, begins in enumerate((ranks == 1).tolist()):
                state = moved[i * width + (first_state if begins else state)]
                after.append(state)
            done = pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], pa.array(after, pa.int64())], names=[*carried, "_start"])
            yield done.filter(pa.array(ranks > 0))

    full = chunked(ordered.long_keys(x, g, rows))
    chunks = full.groupBy(*g, "_chunk").applyInPandas(reduce(["_rank"], ["_chunk"]), T.StructType([*keys, number["_chunk"], *moves]))
    chunks = chunks.withColumn("_near", F.floor(F.col("_chunk") / F.lit(group)).cast("bigint"))
    groups = chunks.groupBy(*g, "_near").applyInPandas(reduce(["_chunk"], ["_near"]), T.StructType([*keys, number["_near"], *moves]))
    first = groups.withColumn("_start", F.lit(first_state).cast("bigint")).groupBy(*g).applyInPandas(
        starts("_near"), T.StructType([*keys, number["_near"], number["_start"]]))
    first = join_by(chunks, first, [*g, "_near"]).groupBy(*g, "_near").applyInPandas(
        starts("_chunk", 1), T.StructType([*keys, number["_chunk"], number["_start"]]))
    # a constant function before a chunk's first row
    first = first.select(*g, "_chunk", *[F.col("_start").cast("int").alias(c) for c in steps])
    done = ordered.fold_chunks(chunked(x), first, g, emit, T.StructType([*[fields[c] for c in carried], number["_start"]]))
    names = F.array(*[F.lit(s) for s in states])
    state = F.when(F.col("_start") == len(states), F.raise_error(F.lit("the logic leads to a value that is not one of the states"))).otherwise(
        F.element_at(names, (F.col("_start") + 1).cast("int")))
    return done.select(*by, *[c for c in shown if c not in by], state.alias(out))


def final(df: DataFrame, by, order: Sequence[str], states: Sequence, logic: Logic, init, block: Column | None = None,
          out: str = "state", **sizes) -> DataFrame:
    """``(by..., out, inputs)``: the last state of each key and how many rows led to it."""
    by = _by(by)
    place = F.struct(*[F.col(c) for c in order])
    done = scan(df, by, order, states, logic, init, block, out=out, **sizes)
    return done.groupBy(*by).agg(F.max_by(out, place).alias(out), F.count(F.lit(1)).alias("inputs"))
