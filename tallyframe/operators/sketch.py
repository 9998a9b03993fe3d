"""Mergeable sketches: HyperLogLog (built-in), Bloom filter, dyadic quantile bounds, KLL (built-in),
count-min sketch and heavy hitters.

Hand-built sketches hash by md5 slices (double hashing ``h1 + i*h2``), so a second engine reproduces every
position. Items are pre-counted before hashing: each distinct item is hashed once per group, whatever its
frequency.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyframe.functions.exprs import col_of, hash_positions, join_by, with_scalars
from tallyframe.operators.pmf import _by
from tallyframe.sources.tables import materialize

def _hash_halves(item: Column) -> list[Column]:
    """h1, h2: the first two 8-hex-digit slices of md5(item), from one digest per item."""
    hx = F.md5(item.cast("string"))
    return [F.conv(F.substring(hx, 1, 8), 16, 10).cast("bigint").alias("_h1"),
            F.conv(F.substring(hx, 9, 8), 16, 10).cast("bigint").alias("_h2")]


# ---------------------------------------------------------------- HyperLogLog


def checked_lg_k(lg_k: int) -> int:
    """Spark's sketches have 4 to 21 register bits; others raise an error."""
    if not 4 <= lg_k <= 21:
        raise ValueError(f"register bits must be 4 to 21, not {lg_k}")
    return int(lg_k)


def hll_rse(lg_k: int) -> float:
    """Relative standard error of an HLL estimate with 2^lg_k registers: 1.04 / sqrt(2^lg_k)."""
    return 1.04 / math.sqrt(2 ** checked_lg_k(lg_k))


def hll_sketch(df: DataFrame, by, item: str | Column, lg_k: int = 12, out: str = "sketch") -> DataFrame:
    """One HLL sketch (BINARY) per group; NULL items are skipped, an empty group estimates 0."""
    by = _by(by)
    return df.groupBy(*by).agg(F.hll_sketch_agg(col_of(item), checked_lg_k(lg_k)).alias(out))


def hll_merge(sketches: DataFrame, by, sketch: str = "sketch", out: str = "sketch") -> DataFrame:
    """Union of stored sketches per group (sketches of different sizes are allowed and merged down)."""
    by = _by(by)
    return sketches.groupBy(*by).agg(F.hll_union_agg(F.col(sketch), True).alias(out))


def hll_estimate(sketch: str | Column) -> Column:
    return F.hll_sketch_estimate(col_of(sketch))


def within_bound(est: Column, exact: Column, rse: float, sigmas: float = 4.0) -> Column:
    """Accuracy contract of an estimate: ``|est − exact| <= sigmas·rse·exact + 1``."""
    return F.abs(est.cast("double") - exact) <= F.lit(sigmas * rse) * exact + F.lit(1.0)


# ---------------------------------------------------------------- Bloom filter


def bloom_params(n: Column, fpp: float) -> tuple[Column, Column]:
    """Bits ``m = ceil(-n ln p / ln² 2)`` and hash count ``k = max(1, round(m/n · ln 2))``."""
    ln2 = math.log(2.0)
    m = F.greatest(F.ceil(-n * F.lit(math.log(fpp)) / F.lit(ln2 * ln2)), F.lit(1)).cast("bigint")
    k = F.greatest(F.round(m / F.greatest(n, F.lit(1)) * F.lit(ln2)), F.lit(1)).cast("bigint")
    return m, k


def bloom_build(df: DataFrame, by, item: str | Column, fpp: float = 0.01, n: int | None = None):
    """Build a Bloom filter per group. Returns ``(filter, params)``:

    * ``params``: ``(by..., m, k)``; ``n`` defaults to the group's exact distinct item count;
    * ``filter``: ``(by..., word, bits)``: bit ``pos % 64`` of 64-bit word ``pos div 64`` is set for each of
      the k positions (1..m) of each item. Words merge with ``bit_or`` (any order); the filter holds m/64
      rows of 8 bytes, independent of the data size, and a probe joins only the 8-byte word it needs.
    """
    by = _by(by)
    items = df.select(*by, col_of(item).alias("_item")).where(F.col("_item").isNotNull()).distinct()
    if n is None:
        counts = items.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = items.select(*by).distinct().withColumn("_n", F.lit(int(n)))
    m, k = bloom_params(F.col("_n"), fpp)
    params = counts.select(*by, m.alias("m"), k.alias("k"))
    pos = items.join(params, by) if by else with_scalars(items, params, ["m", "k"])
    pos = pos.select(*by, "k", "m", *_hash_halves(F.col("_item")))
    pos = pos.select(*by, F.explode(hash_positions(F.col("_h1"), F.col("_h2"), F.col("k"), F.col("m"))).alias("pos"))
    filt = pos.groupBy(*by, _word(F.col("pos")).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col("pos")))).alias("bits")
    )
    return filt, params


def _word(pos: Column) -> Column:
    return F.floor(pos / 64).cast("bigint")


def _bit(pos: Column) -> Column:
    return F.pmod(pos, F.lit(64)).cast("int")


def bloom_bits_set(filt: DataFrame, by=None) -> DataFrame:
    """Number of set bits per group (fill of the filter)."""
    by = _by(by)
    return filt.groupBy(*by).agg(F.sum(F.bit_count("bits")).cast("bigint").alias("bits_set"))


def bloom_contains(filt: DataFrame, params: DataFrame, probes: DataFrame, by, item: str, out: str = "in_filter"):
    """Membership of each distinct probe item: all k positions set. No false negatives."""
    by = _by(by)
    items = probes.select(*by, F.col(item).alias("_item")).where(F.col("_item").isNotNull()).distinct()
    x = items.join(params, by) if by else with_scalars(items, params, ["m", "k"])
    x = x.select(*by, "_item", "k", "m", *_hash_halves(F.col("_item")))
    x = x.select(*by, "_item", F.explode(hash_positions(F.col("_h1"), F.col("_h2"), F.col("k"), F.col("m"))).alias("pos"))
    x = x.select(*by, "_item", _word(F.col("pos")).alias("word"), _bit(F.col("pos")).alias("bit"))
    hit = x.join(filt, [*by, "word"], "left").withColumn(
        "_set", F.coalesce(F.getbit(F.col("bits"), F.col("bit")), F.lit(0))
    )
    member = hit.groupBy(*by, "_item").agg((F.min("_set") == 1).alias(out))
    return member.withColumnRenamed("_item", item)


def bloom_semi_join(filt: DataFrame, params: DataFrame, probes: DataFrame, by, item: str) -> DataFrame:
    """Approximate semi-join: probe rows whose item may be in the filter."""
    by = _by(by)
    member = bloom_contains(filt, params, probes, by, item).where(F.col("in_filter")).select(*by, item)
    return probes.join(member, [*by, item], "left_semi")


# ---------------------------------------------------------------- quantile bounds


def qtree_bounds(df: DataFrame, by, value: str | Column, ps: Sequence[float], level: int = 16) -> DataFrame:
    """Guaranteed bounds for nearest-rank quantiles from a dyadic histogram with buckets of 2^level.

    Counts per bucket are mergeable (any order, partial aggregation); the bucket that holds rank
    ``ceil(p·n)`` gives ``[lower, upper]`` with the exact quantile inside. ``value`` must be integral.
    """
    by = _by(by)
    v = col_of(value).cast("bigint")
    width = 1 << int(level)
    hist = df.select(*by, F.floor(v / F.lit(width)).cast("bigint").alias("_b")).where(F.col("_b").isNotNull())
    hist = hist.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = hist.withColumn("_cum", F.sum("_c").over(w)).withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    aggs = []
    for i, p in enumerate(ps):
        rank = F.greatest(F.ceil(F.lit(float(p)) * F.col("_n")), F.lit(1))
        aggs.append(F.struct(F.lit(float(p)).alias("p"), F.min(F.when(F.col("_cum") >= rank, F.col("_b"))).alias("b"))
                    .alias(f"_q{i}"))
    wide = cum.groupBy(*by).agg(*aggs)
    long = wide.select(*by, F.explode(F.array(*[F.col(f"_q{i}") for i in range(len(ps))])).alias("_q"))
    return long.select(*by, F.col("_q.p").alias("p"), (F.col("_q.b") * width).alias("lower"),
                       (F.col("_q.b") * width + (width - 1)).alias("upper"))


def kll_sketch(df: DataFrame, by, value: str | Column, k: int = 200, out: str = "sketch") -> DataFrame:
    by = _by(by)
    return df.groupBy(*by).agg(F.kll_sketch_agg_bigint(col_of(value).cast("bigint"), k).alias(out))


# ---------------------------------------------------------------- count-min sketch


def cms_shape(eps: float, delta: float) -> tuple[int, int]:
    """Width ``ceil(e/eps)`` and depth ``ceil(ln(1/delta))``."""
    return int(math.ceil(math.e / eps)), int(math.ceil(math.log(1.0 / delta)))


def cms_buckets(item: Column, width: int, depth: int) -> Column:
    """Array of (depth, bucket) cells of an item: bucket_i = (h1 + i·h2) mod width."""
    return cms_cells(md5_int(item, 1), md5_int(item, 9), width, depth)


def cms_cells(h1: Column, h2: Column, width: int, depth: int) -> Column:
    """Cells from the two hash halves (computed once per item by the caller)."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(depth - 1)),
        lambda i: F.struct(i.alias("depth"), F.pmod(h1 + i.cast("bigint") * h2, F.lit(width)).alias("bucket")),
    )


def cms_build(df: DataFrame, by, item: str | Column, eps: float, delta: float) -> DataFrame:
    """Long-table sketch ``(by..., depth, bucket, cnt)``; items are pre-counted, then hashed once each."""
    by = _by(by)
    counts = df.groupBy(*by, col_of(item).alias("_item")).agg(F.count(F.lit(1)).alias("_c"))
    return cms_from_counts(counts, by, "_item", "_c", eps, delta)


def cms_from_counts(counts: DataFrame, by, item: str, cnt: str, eps: float, delta: float) -> DataFrame:
    """Sketch from pre-aggregated ``(by..., item, cnt)`` rows (partial sketches merge by summing cells)."""
    by = _by(by)
    width, depth = cms_shape(eps, delta)
    counts = counts.select(*by, F.col(cnt).alias("_c"), *_hash_halves(F.col(item)))
    cells = counts.select(*by, "_c", F.explode(cms_cells(F.col("_h1"), F.col("_h2"), width, depth)).alias("_cell"))
    return cells.groupBy(*by, F.col("_cell.depth").alias("depth"), F.col("_cell.bucket").alias("bucket")).agg(
        F.sum("_c").alias("cnt")
    )


def cms_estimate(sketch: DataFrame, probes: DataFrame, by, item: str, eps: float, delta: float,
                 out: str = "est") -> DataFrame:
    """Estimated frequency per distinct probe item: the minimum count over its cells (never below the truth).

    The sketch has depth × width rows per group, a size fixed by (eps, delta) and not by the data; an ungrouped one of up
    to BROADCAST_CELLS is broadcast.
    """
    by = _by(by)
    width, depth = cms_shape(eps, delta)
    keep = [c for c in probes.columns if c not in by and c != item]
    items = probes.select(*by, item, *keep).dropDuplicates([*by, item])
    cells = items.select(*by, item, *keep, *_hash_halves(F.col(item)))
    cells = cells.select(*by, item, *keep, F.explode(cms_cells(F.col("_h1"), F.col("_h2"), width, depth)).alias("_cell"))
    cells = cells.select(*by, item, *keep, F.col("_cell.depth").alias("depth"), F.col("_cell.bucket").alias("bucket"))
    sk = F.broadcast(sketch) if not by and width * depth <= BROADCAST_CELLS else sketch
    hit = cells.join(sk, [*by, "depth", "bucket"], "left")
    return hit.groupBy(*by, item, *keep).agg(F.min(F.coalesce(F.col("cnt"), F.lit(0))).alias(out))


def cms_partials(df: DataFrame, by, item: str, eps: float, delta: float) -> DataFrame:
    """The same sketch as :func:`cms_build` without shuffling items: each task adds its rows to a sketch of its own (one
    per group it holds), and the tasks' cells are added up, a fixed number per task and group."""
    by = _by(by)
    width, depth = cms_shape(eps, delta)
    held = max(1, CELLS // (width * depth))
    n = len(by)
    schema = StructType([*(df.schema[c] for c in by), *StructType.fromDDL("depth int, bucket long, cnt long")])
    target = to_arrow_schema(schema)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, np.ndarray] = {}
        halves = _Halves()
        for batch in _gathered(batches):
            for key, items, counts in _counted(batch, n):
                cells = groups.setdefault(key, np.zeros((depth, width), np.int64))
                for i, at in enumerate(_cells(halves, items, width, depth)):
                    np.add.at(cells[i], at, counts)
            if len(groups) > held:
                yield from (_cell_rows(key, cells, target) for key, cells in groups.items())
                groups = {}
        yield from (_cell_rows(key, cells, target) for key, cells in groups.items())

    cells = df.select(*by, F.col(item).cast("string").alias("_item")).mapInArrow(sketch, schema)
    return cells.groupBy(*by, "depth", "bucket").agg(F.sum("cnt").alias("cnt"))


def item_counts(df: DataFrame, item: str) -> DataFrame:
    """``(_item, cnt)``: items counted within each task, without a shuffle. A task holds up to HASHES distinct items; an
    item that comes again after these went out has one more row. NULL items stay out."""
    schema = StructType.fromDDL("_item string, cnt long")
    target = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in _gathered(batches):
            found = pc.value_counts(pc.drop_null(batch.column(0)))
            held.append(pa.table([found.field("values").cast(pa.string()), found.field("counts").cast(pa.int64())], schema=target))
            size += len(found)
            if size > HASHES:
                held, size = [_summed(held, target)], 0
                if len(held[0]) > HASHES // 2:
                    yield from held.pop().to_batches()
                else:
                    size = len(held[0])
        if held:
            yield from _summed(held, target).to_batches()

    return df.select(F.col(item).cast("string").alias("_item")).mapInArrow(count, schema)


def _summed(tables: list[pa.Table], schema: pa.Schema) -> pa.Table:
    one = pa.concat_tables(tables).group_by("_item").aggregate([("cnt", "sum")])
    return pa.table([one["_item"], one["cnt_sum"]], schema=schema)


def heavy_hitters(df: DataFrame, by, item: str, eps: float, delta: float, pct: float) -> DataFrame:
    """Items whose CMS estimate reaches ``pct`` of the group's total count: ``(by..., item, est, exact)``.

    Items are not grouped: a first pass stores what each task counts, a second adds up a sketch of these counts per task,
    and a third holds every stored item against the whole sketch and adds up those that reach the share, so the input is
    read once and rows do not meet the sketch. Without groups the sketch, depth x width cells, goes to the
    tasks as it is; with groups, or with more than CELLS cells, the distinct items are counted and joined to its cells."""
    by = _by(by)
    width, depth = cms_shape(eps, delta)
    if by or width * depth > CELLS:
        return _joined_heavy_hitters(df, by, item, eps, delta, pct)
    counted = materialize(item_counts(df, item), "item-counts")
    whole = np.zeros((depth, width), np.int64)
    schema = StructType.fromDDL("depth int, bucket long, cnt long")
    cells_of = to_arrow_schema(schema)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, halves = np.zeros((depth, width), np.int64), _Halves()
        for batch in batches:
            for i, at in enumerate(_cells(halves, batch.column(0).to_pylist(), width, depth)):
                np.add.at(cells[i], at, batch.column(1).to_numpy())
        yield _cell_rows((), cells, cells_of)

    for r in counted.mapInArrow(sketch, schema).groupBy("depth", "bucket").agg(F.sum("cnt").alias("cnt")).collect():  # depth x width rows at most
        whole[r["depth"], r["bucket"]] = r["cnt"]
    least = float(pct) * int(whole[0].sum())
    schema = StructType([StructField("_item", StringType()), StructField("est", LongType()), StructField("n", LongType())])
    target = to_arrow_schema(schema)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, list[int]] = {}
        halves = _Halves()
        for batch in batches:
            items, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            est = np.min([whole[i, at] for i, at in enumerate(_cells(halves, items, width, depth))], axis=0)
            for j in np.flatnonzero(est >= least):
                found.setdefault(items[j], [int(est[j]), 0])[1] += int(counts[j])
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([e for e, _ in found.values()], pa.int64()),
                                          pa.array([c for _, c in found.values()], pa.int64())], schema=target)

    hits = counted.mapInArrow(verify, schema)
    out = hits.groupBy("_item", "est").agg(F.sum("n").alias("exact"))
    return out.select(F.col("_item").cast(df.schema[item].dataType).alias(item), "exact", "est")


def _joined_heavy_hitters(df: DataFrame, by: list[str], item: str, eps: float, delta: float, pct: float) -> DataFrame:
    # One per-item count table feeds the sketch, the candidate items and the total, so the input is read once.
    counts = df.groupBy(*by, item).agg(F.count(F.lit(1)).alias("_c"))
    sk = cms_from_counts(counts, by, item, "_c", eps, delta)
    est = cms_estimate(sk, counts, by, item, eps, delta).withColumnRenamed("_c", "exact")
    total = counts.groupBy(*by).agg(F.sum("_c").alias("_N"))
    est = join_by(est, total, by) if by else with_scalars(est, total, ["_N"])
    return est.where(F.col("est") >= F.lit(float(pct)) * F.col("_N")).drop("_N")


# ---------------------------------------------------------------- frequent items


def misra_gries(df: DataFrame, by, item: str | Column, counters: int) -> DataFrame:
    """``(by..., item, count, missed)``: mergeable summaries of at most ``counters`` counts per task and group. An item's
    true count lies between the sum of its counts and that plus the group's sum of ``missed``, which is at most a group's
    rows divided by ``counters``. One row with a NULL ``item`` per task and group holds ``missed`` and, as its count, the
    group's rows in the task; NULL items count for these only."""
    by = _by(by)
    n = len(by)
    rows = df.select(*by, col_of(item).cast("string").alias("item"))
    schema = StructType([*(rows.schema[c] for c in by), *StructType.fromDDL("item string, count long, missed long")])
    target = to_arrow_schema(schema)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[dict[str, int], list[int]]] = {}  # counts; missed and rows
        size = 0
        for batch in _gathered(batches):
            for key, items, counts in _counted(batch, n, nulls=True):
                held, missed = groups.setdefault(key, ({}, [0, 0]))
                size -= len(held)
                missed[1] += int(counts.sum())
                for x, c in zip(items, counts.tolist()):
                    if x is not None:
                        held[x] = held.get(x, 0) + c
                if len(held) > 4 * counters:
                    _cut(held, missed, counters)
                size += len(held)
            if size > COUNTERS:
                yield from _summary_rows(groups, counters, target, n)
                groups, size = {}, 0
        yield from _summary_rows(groups, counters, target, n)

    return rows.mapInArrow(summarise, schema)


def frequent_items(df: DataFrame, by, item: str, pct: float, counters: int | None = None) -> DataFrame:
    """``(by..., item, cnt)``: exactly the items that make up at least ``pct`` of their group's rows, with exact counts.

    The summaries of the first pass name every such item and not many more (fewer than 2 / ``pct`` per group) and are
    stored; a second pass counts these only. No pass groups all items. NULL items count for the group's rows but are no
    item."""
    by = _by(by)
    counters = counters or math.ceil(2 / pct)
    parts = materialize(misra_gries(df, by, item, counters), "frequent-items")
    summed = parts.where(F.col("item").isNotNull()).groupBy(*by, "item").agg(F.sum("count").alias("_low"))
    whole = parts.where(F.col("item").isNull()).groupBy(*by).agg(F.sum("missed").alias("_missed"), F.sum("count").alias("_n"))
    j = join_by(summed, whole, by) if by else with_scalars(summed, whole, ["_missed", "_n"])
    total = whole.drop("_missed")
    could = j.where(F.col("_low") + F.col("_missed") >= F.lit(float(pct)) * F.col("_n")).select(*by, F.col("item").cast(df.schema[item].dataType).alias(item))
    rows = df.select(*by, item)
    if by:
        counted = join_by(rows.where(F.col(item).isNotNull()), could.withColumn("_", F.lit(1)), [*by, item]).groupBy(*by, item).agg(F.count(F.lit(1)).alias("cnt"))
        whole = join_by(counted, total, by)
    else:  # fewer than 2 / pct rows
        counted = rows.join(F.broadcast(could), item, "left_semi").groupBy(item).agg(F.count(F.lit(1)).alias("cnt"))
        whole = with_scalars(counted, total, ["_n"])
    return whole.where(F.col("cnt") >= F.lit(float(pct)) * F.col("_n")).select(*by, item, "cnt")


# ---------------------------------------------------------------- what a task holds of its rows

#: Cells and counters that a task holds of all its groups, and item hashes that it remembers.
CELLS, COUNTERS, HASHES = 4_000_000, 1_000_000, 400_000
#: Cells of a sketch that is broadcast (about 30 bytes each).
BROADCAST_CELLS = 400_000


class _Halves(dict):
    """h1 and h2 (two 8-hex-digit slices of md5) of an item, remembered."""

    def __missing__(self, item: str | None) -> tuple[int, int]:
        digest = hashlib.md5(item.encode()).digest() if item is not None else None
        out = (int.from_bytes(digest[:4], "big"), int.from_bytes(digest[4:8], "big")) if digest else (0, 0)
        if len(self) >= HASHES:
            self.clear()
        self[item] = out
        return out


def _cells(halves: _Halves, items: list[str], width: int, depth: int) -> list[np.ndarray]:
    """The bucket of each item in each row of the sketch."""
    h = np.array([halves[x] for x in items], np.int64).reshape(-1, 2)
    return [(h[:, 0] + i * h[:, 1]) % width for i in range(depth)]


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Batches put together up to ``rows`` rows, so that frequent items are counted once in more rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _counted(batch: pa.RecordBatch, n: int, nulls: bool = False) -> Iterator[tuple[tuple, list[str], np.ndarray]]:
    """(key, distinct items, counts) of the groups in a batch of ``n`` key columns and one of items; NULL items stay out
    unless ``nulls``."""
    if not n:
        counts = pc.value_counts(batch.column(0) if nulls else pc.drop_null(batch.column(0)))
        yield (), counts.field("values").to_pylist(), counts.field("counts").to_numpy()
        return
    table = pa.Table.from_batches([batch]).rename_columns([*(f"k{i}" for i in range(n)), "x"])
    table = (table if nulls else table.filter(pc.is_valid(table["x"]))).group_by([*(f"k{i}" for i in range(n)), "x"]).aggregate([([], "count_all")])
    groups: dict[tuple, tuple[list, list]] = {}
    for *key, x, c in zip(*(table[name].to_pylist() for name in [*(f"k{i}" for i in range(n)), "x", "count_all"])):
        items, counts = groups.setdefault(tuple(key), ([], []))
        items.append(x)
        counts.append(c)
    for key, (items, counts) in groups.items():
        yield key, items, np.array(counts, np.int64)


def _cell_rows(key: tuple, cells: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    depth, bucket = np.nonzero(cells)
    keys = [pa.array([k] * len(depth), f.type) for k, f in zip(key, schema)]
    return pa.RecordBatch.from_arrays(
        [*keys, pa.array(depth.astype(np.int32)), pa.array(bucket), pa.array(cells[depth, bucket])], schema=schema)


def _cut(held: dict[str, int], missed: list[int], counters: int) -> None:
    """Lowers all counts by the largest that does not stay among ``counters``, and drops those that end at zero."""
    if len(held) > counters:
        by = int(np.partition(np.fromiter(held.values(), np.int64, len(held)), len(held) - counters - 1)[len(held) - counters - 1])
        missed[0] += by
        for x in [x for x, c in held.items() if c <= by]:
            del held[x]
        for x in held:
            held[x] -= by


def _summary_rows(groups: dict, counters: int, schema: pa.Schema, n: int) -> Iterator[pa.RecordBatch]:
    for key, (held, missed) in groups.items():
        _cut(held, missed, counters)
        keys = [pa.array([k] * (len(held) + 1), f.type) for k, f in zip(key, schema)]
        yield pa.RecordBatch.from_arrays([
            *keys, pa.array([*held, None], pa.string()), pa.array([*held.values(), missed[1]], pa.int64()),
            pa.array([0] * len(held) + missed[:1], pa.int64())], schema=schema)
