"""Target-distribution importance resampling: documents drawn by hashed n-gram weights and Gumbel noise.

The words of every text become bucket numbers, kept as arrays. The counts per bucket of the documents and of the
target texts (sums over all rows) give one gain per bucket; a document's weight is the sum of its buckets' gains,
taken from an array, and its score adds keyed Gumbel noise. Ranks come from parallel sorting by regular sampling:
every run of scored rows is sorted where it lies and gives a sample at regular places, splitters at regular places
of the samples cut the keys into ranges, the segments of a range are exchanged and merged by a sort, and prefix
counts of the ranges make local places exact ranks. Keys are (score, doc_id, row), so a score or a doc_id that a
third of the rows share is cut like any other; ranges that lie wholly behind the draw are not exchanged.

Results for odd rows: a null or empty text has no features, weight 0 and no rank; long texts are used whole;
repeated rows count, score and rank as rows of their own (a row of the lower partition first); a null doc_id is
hashed as empty text and comes after all others of its score; without target texts all gains follow from T = 0; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import stored

BUCKETS, RUN, SEED, MIN_WORDS, PERCENT = 10_000, 1, 2024, 20, 10
#: Sort ranges a shuffle partition gets, and samples a range gets, on average: both follow the cluster, not the data.
RANGES, SAMPLES = 8, 8
#: Word buckets that a Python worker keeps.
MEMO = 500_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class _Buckets(dict):
    """The bucket of a feature's bytes, remembered."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def feature_buckets(text: bytes, run: int, memo: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """(words, bucket of every feature): runs of 1 to ``run`` words of the text, A-Z lower-cased, in UTF-8."""
    words = _WORD.findall(text.lower())  # bytes.lower() changes A-Z only
    found = [memo[w] for w in words]
    for n in range(2, run + 1):
        found += [memo[b" ".join(words[i:i + n])] for i in range(len(words) - n + 1)]
    return len(words), np.array(found, np.uint16)


def features(docs: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """doc_id, row (a number of its own), n_words, n_features and buckets (16-bit integers) of every document."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, row = _Buckets(buckets), TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [feature_buckets(t or b"", run, memo) for t in part.column(1).cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.arange(row, row + len(found))), pa.array([n for n, _ in found], pa.int64()),
                    pa.array([len(b) for _, b in found], pa.int64()), pa.array([b.tobytes() for _, b in found], pa.binary())],
                    ["doc_id", "row", "n_words", "n_features", "buckets"])
                row += len(found)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        extract, "doc_id long, row long, n_words long, n_features long, buckets binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bucket numbers of a binary column, and where each row ends in them."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint16), np.cumsum([len(b) // 2 for b in rows], dtype=np.int64)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features each bucket holds: one row per bucket and task is shuffled, one per bucket collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0))[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of a bucket's shares in the target and in the source)."""
    big_s, big_t, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (big_s + n)) / float((s + 1) * (big_t + n))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Keyed Gumbel noise in thousandths."""
    key = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(key).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(found: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, row, n_words, n_features, weight and score, from the bucket arrays and the array of gains."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _flat(batch.column("buckets"))
            sums = np.concatenate([[0], np.cumsum(gain[flat])])
            weight = sums[ends] - sums[np.concatenate([[0], ends[:-1]])] if len(ends) else np.zeros(0, np.int64)
            drawn = np.array([noise(d, seed) for d in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "row", "n_words", "n_features")), pa.array(weight), pa.array(weight + drawn)],
                ["doc_id", "row", "n_words", "n_features", "weight", "score"])

    return found.select("doc_id", "row", "n_words", "n_features", "buckets").mapInArrow(
        score, "doc_id long, row long, n_words long, n_features long, weight long, score long")


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """What orders rows, the first key first: falling score, null doc_ids last, doc_id, row."""
    doc = batch.column("doc_id")
    return (-batch.column("score").to_numpy(), doc.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
            doc.fill_null(0).to_numpy(), batch.column("row").to_numpy())


def range_of(keys: tuple[np.ndarray, ...], splitters: np.ndarray) -> np.ndarray:
    """How many splitters (rows of keys, in order) lie before each row: both are put in one order."""
    n = len(keys[0])
    both = [np.concatenate([splitters[:, i], k]) for i, k in enumerate(keys)]
    order = np.lexsort([np.arange(len(both[0])), *reversed(both)])  # an equal splitter comes first
    before = np.cumsum(order < len(splitters))
    out = np.empty(len(both[0]), np.int64)
    out[order] = before
    return out[len(splitters):] if n else np.zeros(0, np.int64)


def regular_splitters(rows: DataFrame, count: int, ranges: int) -> np.ndarray:
    """``ranges`` - 1 keys at regular places of the samples that sorted runs give at regular places.

    At most ``ranges`` * SAMPLES rows come to the driver, whatever the table's size."""
    stride = max(1, count // (ranges * SAMPLES))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skip = stride // 2 if stride < 3 else zlib.crc32(b"%d" % TaskContext.get().partitionId()) % stride
        for batch in batches:
            at = np.arange(skip, batch.num_rows, stride)
            skip = (skip if not len(at) else at[-1] + stride) - batch.num_rows
            yield batch.take(pa.array(at, pa.int64()))

    runs = rows.select("score", "doc_id", "row").coalesce(ranges).sortWithinPartitions(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    found = runs.mapInArrow(sample, "score long, doc_id long, row long").collect()
    ordered = sorted((-r["score"], int(r["doc_id"] is None), r["doc_id"] or 0, r["row"]) for r in found)
    chosen = [ordered[i * len(ordered) // ranges] for i in range(1, ranges)] if ordered else []
    return np.array(sorted(set(chosen)), np.int64).reshape(-1, 4)


def ranked(rows: DataFrame, draw_of, ranges: int | None = None) -> DataFrame:
    """Adds rank, from 1, to the first ``draw_of(count)`` of the rows by falling score, then doc_id; else null."""
    spark = rows.sparkSession
    count = rows.count()
    draw = draw_of(count)
    if not draw:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    ranges = ranges or RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters = regular_splitters(rows, count, ranges)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(splitters) + 1, np.int64)
        for batch in batches:
            total += np.bincount(range_of(_keys(batch), splitters), minlength=len(total))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["segment", "n"])

    segments = rows.select("score", "doc_id", "row").mapInArrow(sizes, "segment long, n long").groupBy("segment").agg(F.sum("n").alias("n"))
    size = np.zeros(len(splitters) + 1, np.int64)
    for r in segments.collect():  # one row per range
        size[r["segment"]] = r["n"]
    start = np.cumsum(size) - size
    names = rows.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "__tf_segment long", "__tf_start long"])

    def dealt(inside: bool) -> DataFrame:
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                segment = range_of(_keys(batch), splitters)
                at = pa.array(np.flatnonzero((start[segment] < draw) == inside))
                segment = segment[at.to_numpy()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.take(at).columns, pa.array(segment), pa.array(start[segment])], [*names, "__tf_segment", "__tf_start"])

        return rows.mapInArrow(deal, schema)

    order = Window.partitionBy("__tf_segment").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row")
    rank = F.col("__tf_start") + F.row_number().over(order)
    first = dealt(True).withColumn("__tf_rank", rank).select(*names, F.when(F.col("__tf_rank") <= draw, F.col("__tf_rank")).alias("rank"))
    return first.unionByName(dealt(False).select(*names, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, buckets: int = BUCKETS, run: int = RUN,
             seed: int = SEED, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null unless drawn) of every document; ``target`` has a column text."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets must be 1 to 65536")
    found = stored(features(docs, buckets, run), "resampling-features")
    wanted = features(target.select(F.lit(0).alias("doc_id"), "text"), buckets, run)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    rows = stored(scored(found, gain, seed), "resampling-scores")
    long_enough = rows.where(F.col("n_words") >= min_words)
    drawn = ranked(long_enough, lambda n: n * percent // 100)
    rest = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
