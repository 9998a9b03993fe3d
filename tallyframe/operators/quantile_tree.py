"""Quantile trees: counts and sums over dyadic ranges, compressed to a bounded number of nodes, merged like sets.

A node (level, place) stands for the range [place * 2**level, (place + 1) * 2**level) of whole numbers and holds the
number and the sum of the values that no node below it describes more finely. Building puts each value at level 0;
compression moves what lies below a node into it as long as that is less than 2**-k of the tree's values. A path from
the root then keeps at most 2**k nodes per level, whatever the range of the values, and a quantile's rank is known to
within levels * 2**-k of all values. Trees merge by adding equal nodes, so each task compresses its own values, trees
of neighbouring tasks merge next, and those merge per key; no step sees the rows of a key together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.exprs import col_of
from tallyframe.operators.pmf import _by

#: Compression: nodes below 2**-K of a tree's values go into their parents.
K = 10
#: Levels of the tree: values from -2**(LEVELS-1) to 2**(LEVELS-1) - 1.
LEVELS = 64
#: Neighbouring tasks whose trees merge first, and nodes a task holds of all its keys before it sends them on.
FAN, NODES = 64, 2_000_000
_NODE = "level int, place long, n long, total double"


def added(level: np.ndarray, place: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nodes with equal ones added up, by level and place."""
    order = np.lexsort((place, level))
    level, place, n, total = level[order], place[order], n[order], total[order]
    if not len(level):
        return level, place, n, total
    first = np.flatnonzero(np.r_[True, (np.diff(level) != 0) | (np.diff(place) != 0)])
    return level[first], place[first], np.add.reduceat(n, first), np.add.reduceat(total, first)


def compressed(level: np.ndarray, place: np.ndarray, n: np.ndarray, total: np.ndarray, k: int = K) -> tuple[np.ndarray, ...]:
    """The tree with every node whose subtree holds fewer than 2**-k of all values moved into its parent."""
    level, place, n, total = added(level, place, n, total)
    least = int(n.sum()) >> k
    if not len(n):
        return level, place, n, total
    out = []
    up_place, up_n, up_total = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    below_place, below_n = np.zeros(0, np.int64), np.zeros(0, np.int64)  # subtrees that stay where they are
    for at in range(int(level.min()), LEVELS):
        own = level == at
        _, p, c, t = added(np.zeros(own.sum() + len(up_n), np.int64), np.r_[place[own], up_place], np.r_[n[own], up_n], np.r_[total[own], up_total])
        # What hangs below a node counts for it, too.
        places = np.union1d(p, below_place)
        whole = np.zeros(len(places), np.int64)
        np.add.at(whole, np.searchsorted(places, p), c)
        np.add.at(whole, np.searchsorted(places, below_place), below_n)
        small = whole[np.searchsorted(places, p)] <= least
        hangs = np.isin(p, below_place)
        move = small & ~hangs & (at < LEVELS - 1)
        out.append((np.full((~move).sum(), at), p[~move], c[~move], t[~move]))
        up_place, up_n, up_total = p[move] >> 1, c[move], t[move]
        stays = ~np.isin(places, p[move])
        below_place, slot = np.unique(places[stays] >> 1, return_inverse=True)
        below_n = np.bincount(slot, weights=whole[stays], minlength=len(below_place)).astype(np.int64)
        if not len(up_n) and not (level > at).any():
            break
    return tuple(np.concatenate(c) for c in zip(*out))


def _frame(nodes: tuple[np.ndarray, ...]) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(("level", "place", "n", "total"), nodes)))


def _arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, ...]:
    return (pdf["level"].to_numpy(np.int64), pdf["place"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), pdf["total"].to_numpy(float))


def build(df: DataFrame, by, value: str | Column, k: int = K, fan: int = FAN) -> DataFrame:
    """``(by..., level, place, n, total)``: the compressed tree of each key's whole values; NULL values are skipped."""
    by = _by(by)
    keys = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in by)
    rows = df.select(*by, col_of(value).cast("bigint").alias("_v")).where(F.col("_v").isNotNull())

    def trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, size = TaskContext.get().partitionId(), {}, 0
        for pdf in batches:
            for key, own in (pdf.groupby(by, dropna=False, sort=False) if by else [((), pdf)]):
                v = own["_v"].to_numpy(np.int64)
                new = (np.zeros(len(v), np.int64), v, np.ones(len(v), np.int64), v.astype(float))
                key = tuple(None if x != x else x for x in key)
                old = held.get(key)
                size -= len(old[0]) if old else 0
                held[key] = compressed(*(np.concatenate(c) for c in zip(old, new)), k) if old else compressed(*new, k)
                size += len(held[key][0])
            if size > NODES:
                yield from (_labelled(key, tree, part) for key, tree in held.items())
                held, size = {}, 0
        yield from (_labelled(key, tree, part) for key, tree in held.items())

    def _labelled(key: tuple, tree: tuple, part: int) -> pd.DataFrame:
        return _frame(tree).assign(**dict(zip(by, key)), _part=part)[[*by, "_part", "level", "place", "n", "total"]]

    partial = rows.mapInPandas(trees, f"{keys}_part long, {_NODE}")
    near = F.floor(F.col("_part") / F.lit(fan)).cast("bigint")
    return merge(merge(partial.withColumn("_near", near).drop("_part"), [*by, "_near"], k).drop("_near"), by, k)


def merge(trees: DataFrame, by, k: int = K) -> DataFrame:
    """One compressed tree per key from the nodes of several (of this run or stored ones)."""
    by = _by(by)
    keys = "".join(f"`{c}` {trees.schema[c].dataType.simpleString()}, " for c in by)
    nodes = trees.groupBy(*by, "level", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _frame(compressed(*_arrays(pdf), k))
        return out.assign(**{c: pdf[c].iloc[0] for c in by})[[*by, "level", "place", "n", "total"]]

    return nodes.groupBy(*by).applyInPandas(one, keys + _NODE)


def _low(level: np.ndarray, place: np.ndarray) -> list[int]:
    return [int(p) << int(at) for at, p in zip(level, place)]


def quantile_bounds(trees: DataFrame, by, ps: Sequence[float]) -> DataFrame:
    """``(by..., p, lower, upper)``: the value of rank ceil(p * n) (at least 1) lies between lower and upper, both included."""
    by, ps = _by(by), [float(p) for p in ps]
    keys = "".join(f"`{c}` {trees.schema[c].dataType.simpleString()}, " for c in by)

    def bounds(pdf: pd.DataFrame) -> pd.DataFrame:
        level, place, n, _ = _arrays(pdf)
        low = np.array(_low(level, place), object)
        high = np.array([b + (1 << int(at)) - 1 for b, at in zip(low, level)], object)
        count, most = int(n.sum()), (1 << 63) - 1

        def edge(ends: np.ndarray, rank: int) -> int:
            # The least value that ``rank`` values cannot all lie below, with each node's values at one end of its range.
            order = sorted(range(len(ends)), key=ends.__getitem__)
            at = int(np.searchsorted(np.cumsum(n[order]), rank))
            return max(-most - 1, min(most, ends[order[at]]))

        ranks = [max(1, -int(-p * count // 1)) for p in ps]
        out = pd.DataFrame({"p": ps, "lower": [edge(low, r) for r in ranks], "upper": [edge(high, r) for r in ranks]})
        return out.assign(**{c: pdf[c].iloc[0] for c in by})[[*by, "p", "lower", "upper"]]

    return trees.groupBy(*by).applyInPandas(bounds, f"{keys}p double, lower long, upper long") if by else (
        trees.groupBy(F.lit(0).alias("_g")).applyInPandas(bounds, "p double, lower long, upper long"))


def range_bounds(trees: DataFrame, by, start: int, end: int) -> DataFrame:
    """``(by..., n_low, n_high, total_low, total_high)``: bounds of the number and the sum (of values that are not
    negative) of the values from ``start`` up to, not including, ``end``. Nodes inside count for both bounds, nodes
    that stick out for the upper ones only."""
    by = _by(by)
    width = F.expr("shiftleft(CAST(1 AS BIGINT), level)")
    top = F.col("level") >= 62  # ranges wider than a long holds inside no range
    low = F.when(top, F.lit(None)).otherwise(F.col("place") * width)
    inside = F.coalesce((low >= start) & (low + width <= end), F.lit(False))
    touches = F.coalesce((low < end) & (low + width > start), F.lit(True))
    part = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    return trees.groupBy(*by).agg(part("n", inside).alias("n_low"), part("n", touches).alias("n_high"),
                                  part("total", inside).cast("double").alias("total_low"), part("total", touches).cast("double").alias("total_high"))
