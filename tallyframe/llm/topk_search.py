"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is summarised by the mean and deviation of its segments, coarse (one segment) to fine. For two vectors the
segment-wise (difference of means)^2 + (difference of deviations)^2 times the segment's length is a lower bound of their
squared distance; with the two norms this bounds the inner product from above. Bounds act twice. Rows lie in cells
around a bounded number of pivots; a cell keeps the least and greatest statistics of its rows, and a query goes to the
cells only whose bound reaches its k-th best score in a bounded sample, so cells that none of a block's queries needs are
not sent to it. Within a block, pairs below the k-th best score known so far are dropped level by level, finer bounds are
worked out for the pairs alive only, and so are the exact integer scores.

Pivots and sample are drawn by hash, CELLS and SAMPLE rows; they decide what can be dropped early, never the result.
Results for odd rows: vectors that are null, empty of id, or hold null or non-finite components take no part; vectors of
different lengths are compared as if the shorter ended in zeros; rows with the same vec_id count as the same vector,
none a candidate of the other; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import stored

SCALE, TOP = 64, 20
SEGMENTS = (1, 4, 16, 32)
#: Bounds of the two samples: pivots of cells, and rows that give each query a first k-th score.
CELLS, SAMPLE = 64, 1024
#: Segments of a cell's statistics.
CELL_SEGMENTS = 16
#: Queries and candidates in one block; a task holds one block of each.
QUERY_BLOCK, ROW_BLOCK = 2048, 8192
#: Sums of products up to this are exact in a double.
_EXACT = float(1 << 53)


def quantised(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the array of floor(scale * x) as doubles; vectors that take no part are left out."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("double"))
    return docs.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False))).select("vec_id", v.alias("v"))


def statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """Per segment the mean and the deviation times the root of the segment's length; rows' products bound scores."""
    size = -(-v.shape[1] // segments)
    parts = np.pad(v, ((0, 0), (0, size * segments - v.shape[1]))).reshape(len(v), segments, size)
    return np.concatenate([parts.mean(axis=2), parts.std(axis=2)], axis=1) * size**0.5


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise integer inner products; sums that doubles do not hold are added up as Python integers and held
    within the range of a long."""
    if not len(a):
        return np.zeros(0, np.int64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < _EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    held = lambda x: max(1 - (1 << 63), min((1 << 63) - 1, x))
    return np.array([held(sum(int(x) * int(y) for x, y in zip(r, s))) for r, s in zip(a, b)], np.int64)


def _scores(q: np.ndarray, rows: np.ndarray, x: np.ndarray, y: np.ndarray, exact: bool) -> np.ndarray:
    """Exact scores of the pairs (x, y), x ascending, and of no others."""
    if not exact:
        return exact_scores(q[x], rows[y])
    out = np.empty(len(x), np.int64)
    edges = np.searchsorted(x, np.arange(len(q) + 1))
    for i in range(len(q)):
        own = slice(edges[i], edges[i + 1])
        if own.start < own.stop:
            out[own] = rows[y[own]] @ q[i]
    return out


def best(
    q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, floors: np.ndarray | None = None,
    kept: Counter | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of at least each query's top k among the rows, ties by smaller vec_id; of those of at least
    its floor, if given. ``kept`` counts the pairs alive before each level and those that get exact scores."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    width = max(q.shape[1], rows.shape[1])
    q, rows = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, rows))
    most = np.abs(q).max(initial=0) * np.abs(rows).max(initial=0) * max(width, 1)
    exact = most < _EXACT
    whole_q, whole_rows = (q.astype(np.float32), rows.astype(np.float32)) if most < 1 << 24 else (q, rows)
    with np.errstate(over="ignore", invalid="ignore"):
        levels = [(s, statistics(q, s), statistics(rows, s)) for s in SEGMENTS if s < max(width, 2)] if width else []
        longest = np.linalg.norm(rows, axis=1).max(initial=0)
    for start in range(0, len(q), 128):
        at = np.arange(start, min(start + 128, len(q)))
        alive = ids[None, :] != q_ids[at, None]
        floor = np.full(len(at), -np.inf) if floors is None else floors[at].astype(float)

        def lead_floors(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, floor: np.ndarray) -> np.ndarray:
            """The k-th exact score among the 2k + 1 alive rows with the best bounds, of queries that have as many."""
            out = np.full(len(floor), -np.inf)
            edges = np.searchsorted(x, np.arange(len(floor) + 1))
            lead = [a + np.argpartition(-bounds[a:b], 2 * k)[:2 * k + 1] for a, b in zip(edges, edges[1:]) if b - a > 2 * k + 1]
            if lead:
                some = np.concatenate(lead)
                scores = _scores(whole_q[at], whole_rows, x[some], y[some], exact).astype(float).reshape(-1, 2 * k + 1)
                out[x[some][::2 * k + 1]] = np.sort(scores, axis=1)[:, -k]
            return out

        with np.errstate(over="ignore", invalid="ignore"):
            # Slack for rounding: bounds are sums of products of doubles.
            slack = 1e-9 * (1 + np.linalg.norm(q[at], axis=1) * longest)
            for s, left, right in levels:
                if kept is not None:
                    kept[f"before {s}"] += int(alive.sum())
                if alive.size and alive.mean() > 0.1:
                    columns = np.flatnonzero(alive.any(axis=0))
                    x, y = np.nonzero(alive[:, columns])
                    bounds, y = (left[at] @ right[columns].T)[x, y], columns[y]
                else:
                    x, y = np.nonzero(alive)
                    bounds = np.einsum("ij,ij->i", left[at][x], right[y])
                floor = np.fmax(floor, lead_floors(x, y, bounds, floor))
                alive[x, y] = ~(bounds + slack[x] < floor[x])
        x, y = np.nonzero(alive)
        if kept is not None:
            kept["exact"] += len(x)
            kept["pairs"] += alive.size
        scores = _scores(whole_q[at], whole_rows, x, y, exact) if exact else exact_scores(q[at][x], rows[y])
        keep = scores >= floor[x]
        x, y, scores = x[keep], y[keep], scores[keep]
        order = np.lexsort((ids[y], -scores, x))  # held scores are above the lowest long
        x, y, scores = x[order], y[order], scores[order]
        top = np.arange(len(x)) - np.searchsorted(x, x, side="left") < k
        found.append((q_ids[at][x[top]], ids[y[top]], scores[top]))
    return tuple(np.concatenate(c) for c in zip(*found))


def home_cells(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The nearest pivot of each row (a choice that only decides what can be dropped early)."""
    with np.errstate(over="ignore", invalid="ignore"):
        far = (pivots**2).sum(axis=1) - 2 * (v @ pivots.T)
    return np.argmin(np.where(np.isnan(far), np.inf, far), axis=1)


def query_groups(pivots: np.ndarray, in_cell: np.ndarray) -> np.ndarray:
    """The block group of each cell's queries: cells in a row of near ones, cut where a block is full."""
    order, left = [0], set(range(1, len(pivots)))
    while left:
        far = {c: float(np.abs(pivots[c] - pivots[order[-1]]).sum()) for c in left}
        order.append(min(left, key=lambda c: (far[c], c)))
        left.remove(order[-1])
    out, group, held = np.zeros(len(pivots), np.int64), 0, 0
    for c in order:
        if held and held + in_cell[c] > QUERY_BLOCK:
            group, held = group + 1, 0
        out[c], held = group, held + in_cell[c]
    return out


def cell_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Upper bounds of the products of each query with any row whose statistics lie between ``low`` and ``high``."""
    with np.errstate(over="ignore", invalid="ignore"):
        own = statistics(q, CELL_SEGMENTS)
        return np.maximum(own, 0) @ high.T + np.minimum(own, 0) @ low.T


def _matrix(values: pd.Series) -> np.ndarray:
    sizes = set(map(len, values))
    if len(sizes) == 1:
        return np.stack(list(values)).astype(float)
    width = max(sizes, default=0)
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def _padded(values: pd.Series, width: int) -> np.ndarray:
    m = _matrix(values)
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def topk(vectors: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest scores among all other rows, in blocks of both."""
    rows = stored(quantised(vectors, scale).dropDuplicates(["vec_id", "v"]), "topk-vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    drawn = rows.orderBy(F.xxhash64("vec_id", "v")).limit(max(CELLS, SAMPLE)).collect()
    ids = np.array([r["vec_id"] for r in drawn], np.int64)
    sample = _padded(pd.Series([r["v"] for r in drawn], dtype=object), width)
    pivots = sample[:CELLS] if len(drawn) else np.zeros((1, width))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(cell=home_cells(_padded(pdf["v"], width), pivots))

    placed = stored(rows.mapInPandas(place, "vec_id long, v array<double>, cell long"), "topk-cells")

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low = np.full((len(pivots), 2 * CELL_SEGMENTS), np.inf)
        high, count = -low, np.zeros(len(pivots), np.int64)
        for pdf in batches:
            with np.errstate(over="ignore", invalid="ignore"):
                own = np.nan_to_num(statistics(_padded(pdf["v"], width), CELL_SEGMENTS), nan=np.inf)
            cell = pdf["cell"].to_numpy()
            np.minimum.at(low, cell, own)
            np.maximum.at(high, cell, own)
            count += np.bincount(cell, minlength=len(pivots))
        held = np.flatnonzero(count)
        yield pd.DataFrame({"cell": np.repeat(held, 2 * CELL_SEGMENTS), "i": np.tile(np.arange(2 * CELL_SEGMENTS), len(held)),
                            "low": low[held].ravel(), "high": high[held].ravel(), "n": np.repeat(count[held], 2 * CELL_SEGMENTS)})

    # At most CELLS * 2 * CELL_SEGMENTS rows come back, whatever the table's size.
    boxes = placed.mapInPandas(summarise, "cell long, i long, low double, high double, n long").groupBy("cell", "i").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    low, high = np.zeros((len(pivots), 2 * CELL_SEGMENTS)), np.zeros((len(pivots), 2 * CELL_SEGMENTS))
    size = np.zeros(len(pivots), np.int64)
    for r in boxes.collect():
        low[r["cell"], r["i"]], high[r["cell"], r["i"]], size[r["cell"]] = r["low"], r["high"], r["n"]
    blocks = np.maximum(1, -(-size // ROW_BLOCK))
    queries = placed.where(is_query)
    in_cell = np.zeros(len(pivots), np.int64)
    for r in queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        in_cell[r["cell"]] = r["n"]
    query_blocks = np.maximum(1, -(-in_cell // QUERY_BLOCK))
    groups = query_groups(pivots, in_cell)

    def of_cell(values: np.ndarray, cell: str = "cell") -> Column:
        return F.element_at(F.array(*map(F.lit, values.tolist())), (F.col(cell) + 1).cast("int"))

    def dealt(n: np.ndarray) -> Column:
        """A number below that of the row's cell."""
        return F.pmod(F.xxhash64("vec_id"), of_cell(n)).cast("int")

    def wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row per query and cell whose bound reaches the query's floor."""
        for pdf in batches:
            q, q_ids = _padded(pdf["v"], width), pdf["vec_id"].to_numpy(np.int64)
            floors = np.full(len(q), -np.inf)
            if len(ids) > k:
                a, _, score = best(q_ids, q, ids, sample, k)
                last = pd.Series(score, dtype=float).groupby(a).agg(["size", "min"])
                floors = pd.Series(q_ids).map(last["min"].where(last["size"] >= k)).fillna(-np.inf).to_numpy(float)
            with np.errstate(over="ignore", invalid="ignore"):
                slack = 1e-9 * (1 + np.linalg.norm(q, axis=1) * np.abs(high).max(initial=0) * CELL_SEGMENTS)
            x, y = np.nonzero(~(cell_bounds(q, low, high) + slack[:, None] < floors[:, None]) & (size > 0))
            yield pdf.iloc[x].assign(target=y, floor=floors[x])

    left = queries.withColumn("qb", dealt(query_blocks)).mapInPandas(
        wanted, "vec_id long, v array<double>, cell long, qb int, target long, floor double")
    left = stored(left.withColumn("qcell", of_cell(groups).cast("long")).drop("cell"), "topk-queries")
    # Blocks of queries and the cells that they need.
    pairs = left.select(F.col("qcell").alias("pc"), F.col("qb").alias("pb"), F.col("target").alias("cell")).distinct()
    right = placed.withColumn("rb", dealt(blocks)).join(pairs, "cell").select(
        "vec_id", "v", F.col("pc").alias("qcell"), F.col("pb").alias("qb"), F.col("cell").alias("target"), "rb")
    left = left.withColumn("rb", F.explode(F.sequence(F.lit(0), (of_cell(blocks, "target") - 1).cast("int"))))
    keys = ["qcell", "qb", "target", "rb"]

    def search(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if len(q) and len(r):
            a, b, s = best(q["vec_id"].to_numpy(np.int64), _matrix(q["v"]), r["vec_id"].to_numpy(np.int64), _matrix(r["v"]), k, q["floor"].to_numpy())
        else:
            a = b = s = np.zeros(0, np.int64)
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": s})

    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, "query_id long, vec_id long, score long")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
