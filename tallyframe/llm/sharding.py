"""Sharding by sampled splitters: near-equal bytes per shard, equal texts together.

A row's key is (hash of the text, hash of the id and the row's number). A size-weighted sample of keys gives quantile
splitters, which range-partition the rows; ranges that an exact count finds overfull are sampled again, more densely
each time, and split until none can be. A text whose copies fill whole ranges gets ranges of its own, split by the second
hash; every other splitter is moved to the start of its text, so that equal texts lie in one range. Ranges go to shards
by their exact bytes, largest first, the ranges of a heavy text together if a shard can hold them. The number of ranges,
and with it all that the driver holds, follows the number of shards, not the rows; slots are numbered in parts of about
PART_ROWS rows of a range. Results for odd rows: a null text has size 1 and the CRC of no bytes; long texts count whole;
repeated rows are rows of their own, also without a doc_id, and split like any others; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import stored, text_or_empty

SHARDS, LAW = 8, "bytes"
#: Ranges of each shard, sampled keys for each range, and rows of a range that are numbered in one window on average.
RANGES, KEYS_PER_RANGE, PART_ROWS = 256, 16, 50_000
#: A range of more than so many times the mean is overfull.
OVERFULL = 2.0
#: Resolution of the hash that draws the sample.
_DRAW = 1 << 32
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _sample(rows: DataFrame, wanted: int, total: int, turn: int = 0) -> pd.DataFrame:
    """Keys drawn with a chance by size, from a hash of the row: the same rows whenever a task runs again."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(wanted / max(total, 1)))
    draw = F.pmod(F.xxhash64("h1", "h2", F.lit(11 + turn)), F.lit(_DRAW)) / F.lit(float(_DRAW))
    weight = F.greatest(F.lit(1.0), F.col("size") * F.lit(wanted / max(total, 1)))
    found = rows.where(draw < chance).select("h1", "h2", weight.alias("w"), *[c for c in rows.columns if c == "range"]).toPandas()
    return found.sort_values(["h1", "h2"], ignore_index=True)


def _quantiles(sample: pd.DataFrame, ranges: int) -> list[tuple[int, int]]:
    """Splitters at the weighted quantiles of a sorted sample."""
    if not len(sample) or ranges < 2:
        return []
    reach = np.cumsum(sample["w"].to_numpy())
    at = np.searchsorted(reach, reach[-1] * np.arange(1, ranges) / ranges)
    return [(int(sample["h1"][i]), int(sample["h2"][i])) for i in np.minimum(at, len(sample) - 1)]


def settle(splitters: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Splitters at the starts of texts, but for texts that hold two or more: those are fenced and keep theirs."""
    seen: dict[int, set[int]] = {}
    for h1, h2 in splitters:
        seen.setdefault(h1, set()).add(h2)
    out = set()
    for h1, inner in seen.items():
        out.add((h1, LOWEST))
        if len(inner) > 1:
            out.update((h1, h2) for h2 in inner)
            if h1 < HIGHEST:
                out.add((h1 + 1, LOWEST))
    return sorted(out)


def range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of the range of (h1, h2): how many splitters are at or below it, by binary search in batches."""
    texts = np.array([s[0] for s in splitters], np.int64)
    ids = np.array([s[1] for s in splitters], np.int64)

    @F.pandas_udf("long")
    def number(h1: pd.Series, h2: pd.Series) -> pd.Series:
        a, b = h1.to_numpy(np.int64), h2.to_numpy(np.int64)
        low, high = np.searchsorted(texts, a, "left"), np.searchsorted(texts, a, "right")
        found = high.copy()
        for i in np.flatnonzero(high - low > 1):  # only rows of a heavy text look at the second part
            found[i] = low[i] + np.searchsorted(ids[low[i]:high[i]], b[i], "right")
        return pd.Series(found)

    return number("h1", "h2")


def place(ranges: list[tuple[int, int]], heavy: dict[int, int], shards: int) -> dict[int, int]:
    """Shard of each (range, bytes): largest first into the least loaded shard. The ranges of a heavy text go
    together unless they exceed a shard's mean."""
    size = dict(ranges)
    texts: dict[tuple, list[int]] = {}
    for r in size:
        texts.setdefault(("heavy", heavy[r]) if r in heavy else ("light", r), []).append(r)
    units, mean = [], sum(size.values()) / shards
    for own in texts.values():
        units += [own] if sum(size[r] for r in own) <= mean else [[r] for r in own]
    loads, found = [(0, s) for s in range(shards)], {}
    for unit in sorted(units, key=lambda u: (-sum(size[r] for r in u), u)):
        load, least = heapq.heappop(loads)
        found |= dict.fromkeys(unit, least)
        heapq.heappush(loads, (load + sum(size[r] for r in unit), least))
    return found


def shard(docs: DataFrame, shards: int = SHARDS, ranges: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null: the law is not by key), text_hash."""
    text = text_or_empty(F.col("text"))
    rows = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h1"), F.monotonically_increasing_id().alias("row"),
        ), "shard-keys",
    ).withColumn("h2", F.xxhash64("doc_id", "row"))
    count, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    wanted = min(ranges or shards * RANGES, max(1, count))
    limit = OVERFULL * (total or 0) / wanted
    # Texts that overfill a range alone stand between splitters of their own; there are fewer than ranges.
    single = [r["h1"] for r in rows.where(F.col("size") > limit).select("h1").distinct().collect()]
    fences = [(h1 + i, LOWEST) for h1 in single for i in (0, 1) if h1 + i <= HIGHEST]
    splitters, turn = settle(sorted({*fences, *_quantiles(_sample(rows, wanted * KEYS_PER_RANGE, total or 0), wanted)})), 0
    while True:
        counted = rows.groupBy(range_of(splitters).alias("range")).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).toPandas()
        over = counted[(counted["b"] > limit) & (counted["n"] > 1)]
        if not len(over):
            break
        inside = rows.withColumn("range", range_of(splitters)).where(F.col("range").isin(over["range"].tolist()))
        turn += 1
        dense = wanted * KEYS_PER_RANGE << 2 * turn  # a draw that hits every row of the range in the end
        fresh = []
        extra = dict(list(_sample(inside, dense, total, turn).groupby("range")))
        for r, b in zip(over["range"], over["b"]):
            if r in extra:
                fresh += _quantiles(extra[r].reset_index(drop=True), math.ceil(b * wanted / total))
        grown = settle(sorted({*splitters, *fresh}))
        if grown == splitters and dense >= total:
            break
        splitters = grown
    dealt = stored(rows.withColumn("range", range_of(splitters)), "shard-ranges")
    counted = [tuple(r) for r in dealt.groupBy("range").agg(F.sum("size"), F.count(F.lit(1))).orderBy("range").collect()]
    heavy = {}
    for i in range(len(splitters) - 1):  # range i + 1 lies between splitters i and i + 1
        if splitters[i][0] == splitters[i + 1][0] or splitters[i][1] != LOWEST:
            heavy[i + 1] = splitters[i][0]
    where = place([(r, b) for r, b, _ in counted], heavy, shards)
    filled, bases = [0] * shards, []
    for r, _, n in counted:
        bases.append(filled[where[r]])
        filled[where[r]] += n
    table = docs.sparkSession.createDataFrame(pa.table({
        "range": pa.array([r for r, *_ in counted], pa.int64()),
        "shard": pa.array([where[r] for r, *_ in counted], pa.int32()), "base": pa.array(bases, pa.int64())}))
    parts = max(1, -(-count // (wanted * PART_ROWS)))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = dealt.groupBy("range", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("range").orderBy("part")) - F.col("n")
    sizes = sizes.select("range", "part", earlier.alias("earlier"))
    order = Window.partitionBy("range", "part").orderBy("row")
    numbered = dealt.withColumn("at", F.row_number().over(order) - 1).join(sizes, ["range", "part"]).join(F.broadcast(table), "range")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("base") + F.col("earlier") + F.col("at")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("h1").alias("text_hash"))
