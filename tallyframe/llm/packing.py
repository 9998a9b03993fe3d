"""Packing by minimum bin slack: documents' tokens into sequences of at most ``capacity``.

Whole windows are cut off each document; of the rest only the number of documents of each remaining length (at
most capacity - 1 numbers) decides the plan: a bitset subset-sum dynamic programme picks the multiset of lengths
that fills a window closest to capacity, counts are backtracked, and the pick is repeated while its lengths
last. Lengths that no exact window takes follow each other in a stream that is cut at window ends, the last
window into powers of two, so padding is zero. Results for odd rows: a null or empty text has the end id only;
repeated rows are documents of their own; an empty table gives an empty result; a doc_id may be null; other
columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import arrow_map, kind_of, stored

CAPACITY, END_ID = 1024, 0
# Fixed value: the pattern of byte-level pre-tokens.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Rows that one ranking window holds on average.
BUCKET_ROWS = 50_000


#: White space in a row from which a text goes to the library; tiktoken's matcher fails on about a million.
SPACES = 20_000
_SPACES = re.compile(rf"\s{{{SPACES}}}")
#: Texts that both encoders must agree on before the faster one is used.
SAMPLES = ["", "Plain words, 12 numbers and it's done.\n\n  \t x", "Ünïcödé ß é e\u0301 漢字 한글 العربية 😀\u200d\x00\x85\xa0 end  ", "<|endoftext|>a <|endoftext|>"]


class Tokenizer:
    """The ids that the tokenizers library gives for a definition file.

    Byte-level byte-pair definitions whose merges are in the order of their results run on tiktoken, from the
    same vocabulary, which is several times faster; that follows from the definition and from SAMPLES alone, so every
    worker decides alike, and the library checks a text of every batch: a difference raises an error. Texts with a
    run of white space of SPACES characters or more, which the pattern matches by backtracking, and other definitions
    run on the library itself.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library = Library.from_str(definition)
        self.fast = self._fast(json.loads(definition))
        if self.fast is not None and any(self._quick(t) != self._library(t) for t in SAMPLES):
            self.fast = None

    @staticmethod
    def _fast(definition: dict):
        import tiktoken

        model, before = definition["model"], definition.get("pre_tokenizer") or {}
        added = definition.get("added_tokens") or []
        plain = (
            model.get("type", "BPE") == "BPE" and not definition.get("normalizer") and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space", True) and before.get("use_regex", True)
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        if not plain:
            return None
        # Byte-level files write a byte as itself if printable, else as a character from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of_char = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        special = {t["content"]: t["id"] for t in added}
        ranks = {bytes(of_char[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in merges]
        if order != sorted(order) or len(ranks) != 256 + len(merges):
            return None
        return tiktoken.Encoding("definition", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _quick(self, text: str) -> bytes:
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if self.fast is None:
            return list(map(self._library, texts))
        out = [self._library(t) if len(t) >= SPACES and _SPACES.search(t) else self._quick(t) for t in texts]
        probe = min(range(len(texts)), key=lambda i: abs(len(texts[i]) - 1000), default=None)
        if probe is not None and out[probe] != self._library(texts[probe]):
            raise ValueError("the two encoders of the definition differ; the definition needs the tokenizers library")
        return out


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset (length: number) within ``counts`` whose sum is the largest up to ``capacity``.

    Bit s of ``reach`` tells whether sum s can be had; lengths come from the largest down, each in powers of two
    of its count, and the reach before every such item is kept to backtrack the numbers taken.
    """
    limit = (1 << capacity + 1) - 1
    reach, items = 1, []
    for length in sorted(counts, reverse=True):
        left, power = min(counts[length], capacity // length), 1
        while left:
            take = min(power, left)
            items.append((length, take, reach))
            reach |= reach << length * take & limit
            left, power = left - take, power * 2
        if reach >> capacity & 1:
            break
    at, picked = reach.bit_length() - 1, {}
    for length, take, before in reversed(items):
        if not before >> at & 1:
            picked[length] = picked.get(length, 0) + take
            at -= length * take
    return picked


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], dict[int, int]]:
    """(windows, rest): windows rows are (length, first rank, end rank, number in each window, first sequence,
    offset in it); rest has the ranks of each length from which documents go to the cut stream."""
    left, used, windows, sequence = {k: v for k, v in histogram.items() if v}, {k: 0 for k in histogram}, [], 0
    while left:
        picked = fill(left, capacity)
        if sum(k * n for k, n in picked.items()) < capacity:
            break
        times, offset = min(left[k] // n for k, n in picked.items()), 0
        for k, n in sorted(picked.items(), reverse=True):
            windows.append((k, used[k], used[k] + times * n, n, sequence, offset))
            offset += k * n
            used[k] += times * n
            left[k] -= times * n
            if not left[k]:
                del left[k]
        sequence += times
    return windows, used


def stream_cuts(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the sequences of the stream's last, partial window: falling powers of two."""
    at, cuts = total // capacity * capacity, []
    while at < total:
        size = 1 << (total - at).bit_length() - 1
        cuts.append((at, at + size))
        at += size
    return cuts


@functools.lru_cache(maxsize=2)
def _tokenizer(definition: str) -> Tokenizer:
    """Kept while the Python worker lives."""
    return Tokenizer(definition)


def tokenized(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """doc_id, doc_tokens, rest (tokens after whole windows), CRCs of windows and rest, rest_ids; maybe all ids."""
    tail = np.array([end_id], "<u4").tobytes()
    window = 4 * capacity

    def run(cols: dict[str, list]) -> dict[str, list]:
        all_ids = [b + tail for b in _tokenizer(definition).encode([t or "" for t in cols["text"]])]
        ends = [len(b) // window * window for b in all_ids]
        out = {
            "doc_id": cols["doc_id"],
            "doc_tokens": [len(b) // 4 for b in all_ids],
            "rest": [(len(b) - e) // 4 for b, e in zip(all_ids, ends)],
            "rest_crc": [zlib.crc32(b[e:]) for b, e in zip(all_ids, ends)],
            "window_crcs": [[zlib.crc32(b[a:a + window]) for a in range(0, e, window)] for b, e in zip(all_ids, ends)],
            "rest_ids": [b[e:] for b, e in zip(all_ids, ends)],
        }
        return out | ({"ids": all_ids} if ids else {})

    schema = (f"doc_id {kind_of(docs, 'doc_id')}, doc_tokens long, rest long, rest_crc long, window_crcs array<long>, "
              "rest_ids binary" + (", ids binary" if ids else ""))
    return arrow_map(docs.select("doc_id", "text"), run, schema, rows=256)


def _ranked(df: DataFrame, keys: list[str], name: str, weight: str | None = None) -> DataFrame:
    """Adds the 0-based rank (or the sum of ``weight`` over earlier rows) within ``keys``: rows are dealt to
    buckets by their number, the totals of earlier buckets are added, and no window holds a whole hot key."""
    buckets = max(1, -(-df.count() // BUCKET_ROWS))
    value = F.col(weight) if weight else F.lit(1)
    spread = df.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    before = spread.groupBy(*keys, "bucket").agg(F.sum(value).alias("n"))
    order = Window.partitionBy(*keys).orderBy("bucket")
    before = before.select(*keys, "bucket", (F.sum("n").over(order) - F.col("n")).alias("earlier"))
    inside = F.sum(value).over(Window.partitionBy(*keys, "bucket").orderBy("row")) - value
    return (
        spread.withColumn("inside", inside).join(before, [*keys, "bucket"])
        .withColumn(name, F.col("earlier") + F.col("inside")).drop("bucket", "inside", "earlier")
    )


def _table(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small table of longs, from Arrow."""
    columns = zip(*rows) if rows else [()] * len(names.split())
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names.split(), columns)}))


def pack(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``ids`` adds the
    piece's ids (little-endian 32-bit integers)."""
    spark = docs.sparkSession
    done = stored(tokenized(docs, definition, capacity, end_id, ids).withColumn("row", F.monotonically_increasing_id()),
                  "packing-ids")
    counted = done.where("rest > 0").groupBy("rest").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["rest"]: r["n"] for r in counted.collect()}  # at most capacity - 1 rows
    windows, used = plan(histogram, capacity)

    # The stream of documents without an exact window; positions in it are in closed form.
    streamed, heads = 0, []
    for k in sorted(histogram):
        heads.append((k, used[k], streamed - used[k] * k))
        streamed += (histogram[k] - used[k]) * k
    full, last = streamed // capacity, stream_cuts(streamed, capacity)
    first_stream = max((w[4] + (w[2] - w[1]) // w[3] for w in windows), default=0)
    first_whole = first_stream + full + len(last)

    rests = done.where("rest > 0").select("row", "doc_id", "doc_tokens", "rest", "rest_crc")
    ranked = _ranked(rests, ["rest"], "rank")
    within = F.col("rank") - F.col("low")
    exact = ranked.join(F.broadcast(_table(spark, windows, "rest low high each sequence at")), "rest").where(
        "rank >= low AND rank < high"
    ).select(
        "row", "doc_id", (F.col("doc_tokens") - F.col("rest")).alias("start"), F.col("rest").alias("length"),
        F.col("rest_crc").alias("ids_crc32"), "doc_tokens",
        (F.col("sequence") + F.floor(within / F.col("each"))).alias("sequence_id"),
        (F.col("at") + within % F.col("each") * F.col("rest")).alias("offset"),
    )

    first = F.col("base") + F.col("rank") * F.col("rest")
    spans = ranked.join(F.broadcast(_table(spark, heads, "rest used base")), "rest").where("rank >= used").select(
        "row", "doc_id", "doc_tokens", "rest", "rest_crc", first.alias("a"), (first + F.col("rest")).alias("b"))
    ends = [F.lit(x).cast("long") for x in (full * capacity, *(e for _, e in last))]
    window_end = (F.floor(F.col("a") / capacity) + 1) * capacity
    cuts = F.filter(F.array(window_end, *ends), lambda c: (c > F.col("a")) & (c < F.col("b")))
    spans = spans.withColumn("cuts", F.array_sort(F.array_distinct(F.concat(F.array("a", "b"), cuts))))
    pieces = spans.select(
        "*", F.posexplode(F.slice("cuts", 1, F.size("cuts") - 1)).alias("i", "x"),
    ).withColumn("y", F.element_at("cuts", F.col("i") + 2))
    number, inside = F.floor(F.col("x") / capacity), F.col("x") % capacity
    for i, (low, _) in enumerate(last):
        number = F.when(F.col("x") >= low, F.lit(full + i)).otherwise(number)
        inside = F.when(F.col("x") >= low, F.col("x") - low).otherwise(inside)
    length = F.col("y") - F.col("x")

    def streams(rows: DataFrame, crc: Column) -> DataFrame:
        return rows.select(
            "row", "doc_id", (F.col("doc_tokens") - F.col("rest") + F.col("x") - F.col("a")).alias("start"),
            length.alias("length"), crc.alias("ids_crc32"), "doc_tokens",
            (F.lit(first_stream) + number).alias("sequence_id"), inside.alias("offset"))

    part = F.substring("rest_ids", ((F.col("x") - F.col("a")) * 4 + 1).cast("int"), (length * 4).cast("int"))
    cut = pieces.where("size(cuts) > 2").join(done.select("row", "rest_ids"), "row")
    out = exact.unionByName(streams(pieces.where("size(cuts) = 2"), F.col("rest_crc"))).unionByName(streams(cut, F.crc32(part)))

    wholes = done.where("size(window_crcs) > 0").select(
        "row", "doc_id", "doc_tokens", "window_crcs", F.size("window_crcs").cast("long").alias("n"))
    wholes = _ranked(wholes, [], "earlier_windows", "n").select(
        "row", "doc_id", "doc_tokens", "earlier_windows", F.posexplode("window_crcs").alias("i", "ids_crc32"))
    out = out.unionByName(wholes.select(
        "row", "doc_id", (F.col("i") * F.lit(capacity).cast("long")).alias("start"), F.lit(capacity).cast("long").alias("length"),
        "ids_crc32", "doc_tokens", (F.lit(first_whole) + F.col("earlier_windows") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset")))
    if ids:
        piece = F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
        out = out.join(done.select("row", "ids"), "row").withColumn("ids", piece)
    return out.drop("row")
