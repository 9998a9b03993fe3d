"""Mergeable aggregates: sums, extrema, set union, multi-column aggregators, map merge, counts, top-k, words.

All of these merge in any order, so they are plain Spark aggregates with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.exprs import col_of
from tallyframe.operators.pmf import _by

# The whitespace characters that separate words (those of the regex class \\s).
WHITESPACE = "\t\n\x0b\x0c\r"

_AGGS = {
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
    "avg": F.avg,
    "count": F.count,
    "stddev_pop": F.stddev_pop,
    "var_pop": F.var_pop,
}


def multi_aggregate(df: DataFrame, by, spec: Sequence[tuple[str, str, str | Column]]) -> DataFrame:
    """One pass of several aggregators: ``spec`` is ``[(out_name, aggregator, column_or_expression), ...]``.

    ``aggregator`` is one of sum/max/min/avg/count/stddev_pop/var_pop or ``set`` (sorted distinct values).
    A pre-projection ("prepare") is simply an expression as the column; a post-projection ("present") is a
    ``select`` on the result.
    """
    by = _by(by)
    aggs = []
    for name, kind, c in spec:
        c = col_of(c)
        if kind == "set":
            aggs.append(F.sort_array(F.collect_set(c)).alias(name))
        else:
            aggs.append(_AGGS[kind](c).alias(name))
    return df.groupBy(*by).agg(*aggs)


def set_union(df: DataFrame, by, c: str | Column, out: str = "items", arrays: bool = False,
              as_rows: bool = False) -> DataFrame:
    """Union of values (or of array elements when ``arrays``) per group.

    ``as_rows=True`` returns the set as distinct ``(by..., out)`` rows, which is the scalable form for
    unbounded domains. Otherwise it returns one sorted distinct array per group, meant for bounded domains
    (types, flags, tags).
    """
    by = _by(by)
    src = df.select(*by, F.explode(col_of(c)).alias("_e")) if arrays else df.select(*by, col_of(c).alias("_e"))
    if as_rows:
        return src.where(F.col("_e").isNotNull()).distinct().withColumnRenamed("_e", out)
    return src.groupBy(*by).agg(F.sort_array(F.collect_set("_e")).alias(out))


def map_merge(*counts: DataFrame, key: str, value: str) -> DataFrame:
    """Key-wise sum of several ``(key, value)`` tables (map monoid)."""
    u = counts[0].select(key, value)
    for c in counts[1:]:
        u = u.unionByName(c.select(key, value))
    return u.groupBy(key).agg(F.sum(value).alias(value))


def count_by_key(df: DataFrame, key: str | Sequence[str], out: str = "cnt") -> DataFrame:
    keys = _by(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def top_k(counts: DataFrame, by, k: int, score: str, tie: str, buckets: int = 64) -> DataFrame:
    """The ``k`` highest ``score`` rows per group (ties: smallest ``tie`` first), exactly.

    Without groups this is ``orderBy().limit()`` (per-partition top-k, then a k-row merge). With groups it
    runs in two phases so that a group with very many items is never sorted in one task: the top ``k`` of
    each (group, hash bucket of ``tie``) first, then the top ``k`` among those candidates (at most
    ``k × buckets`` rows per group). The group's true top ``k`` is always among the candidates.
    """
    by = _by(by)
    if not by:
        return counts.orderBy(F.col(score).desc(), F.col(tie).asc()).limit(k)
    rank = [F.col(score).desc(), F.col(tie).asc()]
    b = F.pmod(F.xxhash64(F.col(tie)), F.lit(buckets))
    first = counts.withColumn("_b", b).withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*rank)))
    cand = first.where(F.col("_r") <= k).drop("_b", "_r")
    w = Window.partitionBy(*by).orderBy(*rank)
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def word_rows(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per lower-cased whitespace token of the whole text (empty tokens dropped).

    Whitespace (space, tab, newline, vertical tab, form feed, carriage return) is mapped to spaces with a
    character translation and split on a single space (no regex per document); the array is exploded and
    empty tokens are removed by a plain, code-generated filter rather than a per-element lambda.
    """
    flat = F.translate(F.lower(F.col(text)), WHITESPACE, " " * len(WHITESPACE))
    tokens = df.select(*keep, F.explode(F.split(flat, " ")).alias("word"))
    return tokens.where(F.col("word") != "")


def distinct_words(df: DataFrame, by, text: str) -> DataFrame:
    """Exact distinct and total word counts per group.

    Two plain aggregates instead of a distinct aggregate: per (group, word) counts (combined map-side, so
    a frequent word costs one row per task), then per group the number of words and their total.
    """
    by = _by(by)
    per_word = word_rows(df, text, by).groupBy(*by, "word").agg(F.count(F.lit(1)).alias("_n"))
    return per_word.groupBy(*by).agg(F.count(F.lit(1)).alias("distinct_words"), F.sum("_n").alias("words"))
