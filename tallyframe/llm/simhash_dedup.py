"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked by tiled exact comparison.

Distinct fingerprints lie in tiles by the bit counts of their equal parts. Two fingerprints within the radius
differ by at most the radius in the sum of those counts, so all other tile pairs are skipped; the rest are
compared in full with exclusive-or and bit counts. Results for odd rows: a null text counts as empty and gets
fingerprint zero, linked like any other; a null doc_id never is the smallest unless a component has no other;
repeated rows get the same result; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import LOWER, UPPER, arrow_map, hinted, kind_of, stored

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
#: Fingerprints in a chunk of a tile on average at most; a task compares two chunks at a time.
CHUNK = 1 << 14
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def simhash(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint as an unsigned integer; a bit is 1 if set in over half of the shingles' hashes."""
    tokens = (text or "").encode().translate(_FOLD).split()  # bytes split at 0x20 and 0x09 to 0x0D only
    if not tokens:
        return 0
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return digest(joined, seed)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(tokens) - words + 1].tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash (of the raw text) and fp (the fingerprint as a signed long)."""

    def run(cols: dict[str, list]) -> dict[str, list]:
        fps = np.array([simhash(t, words) for t in cols["text"]], np.uint64).view(np.int64)
        return {"doc_id": cols["doc_id"], "text_hash": cols["text_hash"], "fp": fps}

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return arrow_map(rows, run, f"doc_id {kind_of(docs, 'doc_id')}, text_hash long, fp long")


def _part_counts(fp: Column, parts: int) -> list[Column]:
    width = 64 // parts
    mask = F.lit(-1 if width == 64 else (1 << width) - 1).cast("long")
    return [F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(mask)).cast("long") for i in range(parts)]


def _near_offsets(parts: int, radius: int) -> list[int]:
    """Differences of tile numbers for count vectors within ``radius``; of each opposite pair, one."""

    def vectors(n: int, left: int) -> Iterator[tuple[int, ...]]:
        if n == 0:
            yield ()
            return
        for d in range(-left, left + 1):
            for rest in vectors(n - 1, left - abs(d)):
                yield (d, *rest)

    numbers = {sum(d * 128**i for i, d in enumerate(v)) for v in vectors(parts, radius)}
    return sorted(x for x in numbers if x >= 0)


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links that join what exact comparison of all of ``a`` with all of ``b`` joins, without further pairs."""
    values = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    root = np.arange(len(values))
    block = max(1, (1 << 18) // max(len(b), 1))
    left, right = a.view(np.uint64), b.view(np.uint64)
    for start in range(0, len(a), block):
        near = np.bitwise_count(left[start:start + block, None] ^ right[None, :]) <= radius
        if same:
            near[np.arange(near.shape[0]), start + np.arange(near.shape[0])] = False
        for i in np.flatnonzero(near.any(axis=1)):
            members = np.append(np.flatnonzero(near[i]) + shift, start + i)
            tops = root[members]
            while (up := root[tops]).tolist() != tops.tolist():
                tops = up
            top = tops.min()
            root[tops] = top
            root[members] = top
    tops = root
    while (up := root[tops]).tolist() != tops.tolist():
        tops = up
    moved = np.flatnonzero(tops != np.arange(len(tops)))
    return list(zip(values[moved].tolist(), values[tops[moved]].tolist()))


def tile_parts(distinct: int) -> int:
    """Parts whose bit counts number a tile: more for more fingerprints, which changes the work, not the links."""
    return 2 if distinct <= 1 << 21 else 4 if distinct <= 1 << 28 else 8


def links(distinct: DataFrame, radius: int = MAX_BITS, parts: int | None = None, chunk_rows: int = CHUNK) -> DataFrame:
    """(u, v) pairs of distinct fingerprints ``fp`` that connect all those within ``radius`` bits."""
    parts = parts or tile_parts(distinct.count())
    tile = sum((c * F.lit(128**i).cast("long") for i, c in enumerate(_part_counts(F.col("fp"), parts))), F.lit(0).cast("long"))
    tiled = distinct.select("fp", tile.alias("tile"))
    largest = tiled.groupBy("tile").count().agg(F.max("count")).first()[0] or 0
    chunks = max(1, -(-largest // chunk_rows))
    cells = stored(
        tiled.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.lit(chunks)).cast("int"))
        .groupBy("tile", "chunk").agg(F.sort_array(F.collect_list("fp")).alias("fps")), "simhash-tiles",
    )
    offsets = F.array(*[F.lit(x).cast("long") for x in _near_offsets(parts, radius)])
    sent = (
        cells.select(F.col("tile").alias("t"), F.col("chunk").alias("c"), F.col("fps").alias("a"), F.explode(offsets).alias("d"))
        .select("t", "c", "a", "d", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
        .where("d != 0 OR chunk >= c")
        .select((F.col("t") + F.col("d")).alias("tile"), "chunk", "a",
                ((F.col("d") == 0) & (F.col("chunk") == F.col("c"))).alias("same"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in ("a", "b"))
                found = forest(a, b, radius, batch.column("same")[i].as_py())
                if found:
                    yield pa.RecordBatch.from_pylist([{"u": u, "v": v} for u, v in found],
                                                     schema=pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    pairs = sent.join(cells, ["tile", "chunk"]).select("a", F.col("fps").alias("b"), "same")
    return pairs.mapInArrow(compare, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating stars; only linked nodes other than roots have a row."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v")
    edges = stored(edges.distinct(), "component-edges")
    mark = None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u != v").distinct(), "component-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").where("u != v")
        edges = stored(small.distinct(), "component-edges")


def simhash_dedup(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, text_hash."""
    marked = stored(fingerprints(docs, words), "simhash-prints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    placed = stored(placed, "simhash-placed")
    groups = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("size")).where("size > 1")
    table = stored(placed.join(groups, "root").select("fp", "component_id"), "simhash-components")
    return marked.join(hinted(table), "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        "text_hash",
    )
