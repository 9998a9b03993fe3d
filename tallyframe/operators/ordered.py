"""Ordered scans that survive a hot key.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task; if one key holds a third
of the data, so does that task. Here each row also gets a *block*: a deterministic function of its order value
(a time bucket, an ordinal range). The scan runs as a window over ``(key, block)``, and each block adds the
totals of the key's earlier blocks, read from a small per-``(key, block)`` aggregate (partial aggregation,
then a window over a few rows per key). A hot key is thereby spread over as many tasks as it has blocks.

Because blocks are a pure function of the row, every recomputation (a lost executor, a second branch of the
plan) assigns the same rows to the same block; nothing depends on sampling or partition ids.

A NULL key is a key like any other; ``order`` must be a total order within a key (add a unique tie-breaker otherwise), and
``block`` must be non-decreasing in ``order``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.exprs import join_by, ntz_micros, with_scalars
from tallyframe.operators.pmf import _by

BLOCK = "_block"


def time_block(ts: str | Column, seconds: int) -> Column:
    """Block id of a timestamp: whole ``seconds``-wide buckets since the epoch."""
    c = F.col(ts) if isinstance(ts, str) else ts
    us = ntz_micros(c)
    w = F.lit(seconds * 1_000_000)
    return ((us - F.pmod(us, w)) / w).cast("bigint")


def value_block(v: str | Column, width: float) -> Column:
    c = F.col(v) if isinstance(v, str) else v
    return F.floor(c / F.lit(width)).cast("bigint")


_OPS = {"sum": F.sum, "max": F.max, "min": F.min}
_COMBINE = {"sum": lambda a, b: a + b, "max": F.greatest, "min": F.least}


def running(
    df: DataFrame, by, order: Sequence[str], aggs: dict[str, tuple[str, Column]], block: Column | None = None,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running aggregates per key in ``order``: ``aggs`` maps name -> (op, expression), op in
    sum/max/min (any associative, commutative op works the same way).

    With ``block`` the scan is skew-safe (see module doc); without it, one window per key. ``totals`` maps names in
    ``aggs`` to columns for the aggregate over the whole key.
    """
    by = _by(by)
    totals = totals or {}
    order = list(order)
    names = list(aggs)
    ops = {c: op for c, (op, _) in aggs.items()}
    vals = {f"_v_{c}": (F.coalesce(e, F.lit(0)) if ops[c] == "sum" else e) for c, (_, e) in aggs.items()}
    base = df.withColumns(vals)
    if block is None:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = {t: _OPS[ops[c]](f"_v_{c}").over(Window.partitionBy(*by)) for c, t in totals.items()}
        out = base.withColumns({c: _OPS[ops[c]](f"_v_{c}").over(w) for c in names} | whole)
        return out.drop(*vals)

    base = base.withColumn(BLOCK, block)
    tot = base.groupBy(*by, BLOCK).agg(*[_OPS[ops[c]](f"_v_{c}").alias(f"_v_{c}") for c in names])
    before = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*by, BLOCK, *[_OPS[ops[c]](f"_v_{c}").over(before).alias(f"_o_v_{c}") for c in names],
                      *[_OPS[ops[c]](f"_v_{c}").over(Window.partitionBy(*by)).alias(f"_t_v_{c}") for c in totals])
    joined = join_by(base, offs, [*by, BLOCK], "left")
    w = Window.partitionBy(*by, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = {}
    for c in names:
        local = _OPS[ops[c]](f"_v_{c}").over(w)
        off = F.col(f"_o_v_{c}")
        if ops[c] == "sum":
            cols[c] = local + F.coalesce(off, F.lit(0))
        else:
            cols[c] = F.when(off.isNull(), local).when(local.isNull(), off).otherwise(_COMBINE[ops[c]](local, off))
    out = joined.withColumns(cols | {t: F.col(f"_t_v_{c}") for c, t in totals.items()})
    return out.drop(BLOCK, *vals, *[f"_o_v_{c}" for c in names], *[f"_t_v_{c}" for c in totals])


def running_sums(
    df: DataFrame, by, order: Sequence[str], sums: dict[str, Column], block: Column | None = None
) -> DataFrame:
    """Add inclusive running sums ``sums`` (name -> expression) per key in ``order``."""
    return running(df, by, order, {c: ("sum", e) for c, e in sums.items()}, block)


def rank_within(df: DataFrame, by, order: Sequence[str], out: str = "pos", block: Column | None = None) -> DataFrame:
    """1-based position of each row within its key in ``order`` (a skew-safe row_number)."""
    r = running_sums(df, by, order, {out: F.lit(1)}, block)
    return r.withColumn(out, F.col(out).cast("bigint"))


def row_chunks(df: DataFrame, by, order: Sequence[str], rows: int, out: str, block: Column | None = None,
               rank: str | None = None) -> DataFrame:
    """Add ``out``: the number of the chunk of at most ``rows`` consecutive rows of a key, from 0, and ``rank``, the
    row's place in its key from 1. A chunk's size does not depend on the data, whatever its key or block holds."""
    ranked = rank_within(df, by, order, rank or "_rank", block)
    chunks = ranked.withColumn(out, F.floor((F.col(rank or "_rank") - 1) / F.lit(rows)).cast("bigint"))
    return chunks if rank else chunks.drop("_rank")


def long_keys(df: DataFrame, by, rows: int) -> DataFrame:
    """The rows of keys that have more than ``rows`` rows. There are fewer such keys than rows / ``rows``."""
    by = _by(by)
    keys = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).drop("_n")
    return join_by(df, F.broadcast(keys), by, "left_semi")


def fold_chunks(chunks: DataFrame, starts: DataFrame, by, fold: Callable, schema: T.StructType) -> DataFrame:
    """Chunks of :func:`row_chunks` (columns by..., _chunk, _rank), many of them in one sorted stream of Arrow batches.

    ``starts`` has a row for each chunk of a key but its first: it comes before the chunk's rows, with a ``_rank`` of 0
    and columns that say where the chunk starts. A key's first chunk starts where ``_rank`` is 1. ``fold`` maps the
    batches of a task, in which no chunk is split over tasks, to batches of ``schema``; it holds one batch at a time, so
    neither the number of keys nor their sizes cost calls or memory."""
    by = _by(by)
    rows = chunks.unionByName(starts.withColumn("_rank", F.lit(0).cast("bigint")), allowMissingColumns=True)
    return rows.repartition(*by, "_chunk").sortWithinPartitions(*by, "_chunk", "_rank").mapInArrow(fold, schema)


def nulls_last(order: Sequence[str], block: Column | None) -> tuple[list[Column], Column]:
    """``order`` and ``block`` with NULLs after all others, in which :func:`row_chunks` then numbers the rows."""
    last = F.lit(2**63 - 1).cast("bigint")
    return [F.col(c).asc_nulls_last() for c in order], F.coalesce(block.cast("bigint"), last) if block is not None else F.lit(0).cast("bigint")


def neighbour(df: DataFrame, by, order: Sequence[str], col: str, out: str, direction: str = "prev",
              block: Column | None = None) -> DataFrame:
    """``lag`` (``direction="prev"``) or ``lead`` (``"next"``) of ``col`` per key in ``order``, skew-safe.

    Inside a block it is the plain window function; the first (last) row of a block takes the last (first)
    value of the nearest earlier (later) non-empty block of its key, read from one summary row per block.
    """
    by = _by(by)
    order = list(order)
    if block is None:
        w = Window.partitionBy(*by).orderBy(*order)
        fn = F.lag if direction == "prev" else F.lead
        return df.withColumn(out, fn(col, 1).over(w))
    base = df.withColumn(BLOCK, block)
    key = F.struct(*[F.col(o) for o in order])
    edge = (F.max_by(col, key) if direction == "prev" else F.min_by(col, key)).alias("_edge")
    blocks = base.groupBy(*by, BLOCK).agg(edge)
    bw = Window.partitionBy(*by).orderBy(BLOCK)
    across = (F.lag if direction == "prev" else F.lead)("_edge", 1).over(bw)
    blocks = blocks.select(*by, BLOCK, across.alias("_across"))
    w = Window.partitionBy(*by, BLOCK).orderBy(*order)
    within = (F.lag if direction == "prev" else F.lead)(col, 1).over(w)
    j = join_by(base, blocks, [*by, BLOCK], "left")
    return j.withColumn(out, F.coalesce(within, F.col("_across"))).drop(BLOCK, "_across")


def carry_last(df: DataFrame, values: DataFrame, by, order: Sequence[str], col: str, out: str, block: Column) -> DataFrame:
    """The last non-NULL ``col`` at or before each row per key in ``order``, skew-safe.

    ``values`` holds just the rows of ``df`` that have one (the smaller part). Inside a block a window carries the
    value; what earlier blocks left is read from one short array per key: the last value of each block that has any.
    The array meets the rows after the window, so that no sorted row carries it.
    """
    by = _by(by)
    order = list(order)
    ends = values.withColumn(BLOCK, block).groupBy(*by, BLOCK).agg(F.max_by(col, F.struct(*[F.col(o) for o in order])).alias("_end"))
    ends = ends.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(BLOCK).alias("b"), F.col("_end").alias("v")))).alias("_ends"))
    inside = Window.partitionBy(*by, BLOCK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = df.withColumn(BLOCK, block).withColumn("_here", F.last(col, True).over(inside))
    here = join_by(here, ends, by, "left") if by else with_scalars(here, ends, ["_ends"])
    earlier = F.filter("_ends", lambda e: e["b"] < F.col(BLOCK))
    across = F.try_element_at(earlier, F.lit(-1))["v"]
    return here.withColumn(out, F.when(F.col("_here").isNull(), across).otherwise(F.col("_here"))).drop(BLOCK, "_ends", "_here")


# Splitters are searched in two steps: every so many first, then those between.
_STRIDE = 16


def auto_block(df: DataFrame, c: str, blocks: int = 256) -> Column:
    """A deterministic, order-preserving block for an ungrouped scan over any orderable column ``c``.

    Of each of ``blocks`` hash classes of the values, the value with the least hash is a splitter: a fixed-size
    sample of the distinct values, whatever their type and spread. A row's block is the number of splitters below
    its value. The splitters are one scalar subquery; no action runs while the plan is built.
    """
    h = F.xxhash64(c)
    picked = df.where(F.col(c).isNotNull()).groupBy(F.pmod(h, F.lit(blocks)).alias("_class")).agg(F.min_by(c, h).alias("_s"))
    every = F.array_sort(F.collect_list("_s"))
    packed = picked.select(every.alias("fine")).select(F.struct(
        "fine", F.filter("fine", lambda _, i: i % _STRIDE == _STRIDE - 1).alias("coarse"))).scalar()

    def below(values: Column) -> Column:
        """How many values are below: the place of the row's value, put in and sorted (a subquery must stay out of
        lambdas)."""
        return F.array_position(F.sort_array(F.array_append(values, F.col(c))), F.col(c)) - 1

    group = below(packed.getField("coarse"))
    inside = below(F.slice(packed.getField("fine"), (group * _STRIDE + 1).cast("int"), _STRIDE))
    return F.coalesce(group * _STRIDE + inside, F.lit(-1)).cast("bigint")


def range_block(df: DataFrame, c: str, blocks: int) -> Column:
    """Deterministic block over ``[min, max]`` of a numeric column: ``blocks`` equal-width ranges.

    min and max are exact scalar aggregates, so every recomputation assigns the same block; the block count
    (not the data size) sets the number of chunks, and with it the per-chunk work.
    """
    lo = df.select(F.min(c)).scalar()
    hi = df.select(F.max(c)).scalar()
    width = F.greatest((hi - lo).cast("double") / F.lit(float(blocks)), F.lit(1.0))
    return F.floor((F.col(c) - lo).cast("double") / width).cast("bigint")
