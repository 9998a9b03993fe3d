"""Line dedup by winnowing: runs of ``run`` lines, or of ``words`` words, that occur earlier in the corpus are deleted.

All work is in DataFrame functions. The non-blank lines of a document, trimmed of spaces, are hashed. What goes is every
maximal run of lines that equals a run earlier in the corpus (by doc_id, then by place) and has ``run`` lines or
``words`` words. Windows are the runs of ``run`` lines and all shorter runs that hold ``words`` words. The minimum of a
window's line hashes (the rightmost of equals) is its fingerprint. Any repeated run that holds a window holds its
fingerprint at the same place in both, so only windows whose fingerprint occurs more than once are joined by position,
each with the first place of its lines. A match extends both ways from window to window, line by line, as far as the
lines agree: a run of ``run`` lines or more is the union of the windows of ``run`` lines in it, and a shorter one that
holds ``words`` words is a window itself, so the union of all matched windows is exactly the union of the maximal runs
(of whichever earlier documents). Results for odd rows: a null text counts as empty; documents with fewer lines and
words than a window stay; a null doc_id comes before all others; rows that repeat both doc_id and text count as one and
get the same result; blank lines stay; long texts are used whole; an empty table gives an empty one; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import hinted, stored, text_or_empty

#: Lines of the shortest run that counts as repeated.
RUN_LINES = 3
#: Words of the shortest run of fewer lines that counts as repeated.
RUN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"
_WHERE = ["doc_id", "text_hash"]


def _lines(text: Column) -> Column:
    return F.split(text_or_empty(text), "\n")


def hashed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and hashes: of each non-blank line two independent 64-bit hashes, its line number and words."""
    numbered = F.transform(_lines(F.col("text")), lambda x, i: F.struct(F.trim(x).alias("line"), i.alias("at")))
    pairs = F.transform(F.filter(numbered, lambda x: x["line"] != ""), lambda x: F.struct(
        F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(17), x["line"]).alias("b"), x["at"].alias("at"),
        F.regexp_count(x["line"], F.lit(_WORD)).alias("words")))
    return docs.select("doc_id", F.xxhash64(text_or_empty(F.col("text"))).alias("text_hash"), pairs.alias("hashes"))


def windows(lines: DataFrame, run: int, words: int) -> DataFrame:
    """One row per window: where it starts, its fingerprint and the fingerprint's line, its key and its lines."""
    rows = lines.select(*_WHERE, "hashes", F.posexplode("hashes").alias("start", "_line"))
    ahead = F.slice("hashes", F.col("start") + 1, run)
    total = [F.aggregate(F.slice(ahead, 1, n), F.lit(0), lambda t, x: t + x["words"]) for n in range(1, run)]
    sizes = F.array_compact(F.array(F.lit(run), *[F.when((F.size(ahead) >= n) & (t >= words), n) for n, t in enumerate(total, 1)]))
    rows = rows.select(*_WHERE, "start", ahead.alias("ahead"), F.explode(sizes).alias("size")).where(F.size("ahead") >= F.col("size"))
    inside = F.slice("ahead", F.lit(1), F.col("size"))
    least = F.array_min(F.transform(inside, lambda x: x["a"]))
    last = F.col("size") - F.array_position(F.reverse(F.transform(inside, lambda x: x["a"])), least)
    key = F.struct(F.xxhash64(F.transform(inside, lambda x: x["a"])).alias("x"), F.xxhash64(F.transform(inside, lambda x: x["b"])).alias("y"))
    return rows.select(*_WHERE, "start", least.alias("print"), (F.col("start") + last.cast("int")).alias("anchor"), key.alias("key"),
                       F.transform(inside, lambda x: x["at"]).alias("at"))


def repeated_lines(docs: DataFrame, run: int = RUN_LINES, words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, text_hash, gone): the sorted numbers of the lines to delete, for documents that lose any."""
    lines = stored(hashed_lines(docs).dropDuplicates(_WHERE), "line-hashes")
    found = stored(windows(lines, run, words), "line-windows")
    # Fingerprints are counted once per place: neighbouring windows mostly share theirs.
    places = found.groupBy("print", "anchor", *_WHERE).agg(F.count(F.lit(1)))
    prints = places.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print")
    joined = stored(found.join(hinted(stored(prints, "line-prints")), "print", "left_semi").select(*_WHERE, "start", "key", "at"), "line-joined")
    place = F.struct("doc_id", "text_hash", "start")
    first = joined.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    later = joined.join(hinted(stored(first, "line-first")), "key").where(~place.eqNullSafe(F.col("first")))
    gone = F.array_sort(F.array_distinct(F.flatten(F.collect_list("at"))))
    return later.groupBy(*_WHERE).agg(gone.alias("gone"))


def line_dedup(docs: DataFrame, run: int = RUN_LINES, words: int = RUN_WORDS) -> DataFrame:
    """doc_id, text (without the deleted lines), n_lines and n_removed (both of non-blank lines)."""
    gone = repeated_lines(docs, run, words).select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"), "gone")
    gone = hinted(stored(gone, "line-gone"))
    rows = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    joined = rows.withColumn("h", F.xxhash64("text")).join(
        gone, F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("h") == F.col("g_hash")), "left")
    lines = F.split("text", "\n")
    # The stretches of lines between deleted ones.
    edges = F.arrays_zip(F.concat(F.array(F.lit(-1)), "gone").alias("low"), F.concat("gone", F.array(F.size(lines))).alias("high"))
    stretches = F.filter(edges, lambda e: e["high"] - e["low"] > 1)
    kept = F.array_join(F.flatten(F.transform(stretches, lambda e: F.slice(lines, e["low"] + 2, e["high"] - e["low"] - 1))), "\n")
    return joined.select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.size(F.filter(lines, lambda x: F.trim(x) != "")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
