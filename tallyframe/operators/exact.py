"""Exact laws of sums and maxima of many independent variables, where pairs of outcomes would be too many.

Sums: outcomes lie on a lattice; a law is cut into blocks of lattice points, each one row with its masses. Two laws are
convolved block by block (short ones directly, others by the fast Fourier transform), blocks that fall on the same place
are added, and many laws are summed by halving their number round by round, repeated ones by doubling. No call holds
more than two blocks, however wide the support grows.

Maxima: the distribution function of the largest is the product of all the functions. Each law's steps become changes of
the logarithm, which are summed in outcome order over all laws at once, so every law's last value is carried forward to
the other laws' outcomes without joining them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.exprs import join_by
from tallyframe.operators import ordered
from tallyframe.operators.pmf import _by, normalize
from tallyframe.sources.tables import materialize

#: Lattice points of a block, and masses up to which two blocks are convolved directly.
BLOCK, DIRECT = 4096, 64
#: Masses that rounding may leave where there is none: what a Fourier product gives below it is no outcome.
NOISE = 1e-18


def _fields(df: DataFrame, names) -> list[T.StructField]:
    return [df.schema[n] for n in names]


_BLOCK = [T.StructField("_blk", T.LongType()), T.StructField("_mass", T.BinaryType())]


def _blocks(pmf: DataFrame, keys: list[str], outcome: str, prob: str, step: float, block: int) -> DataFrame:
    """(keys..., _blk, _mass): the masses of each block of lattice points that holds any, as doubles."""
    at = F.round(F.col(outcome).cast("double") / F.lit(float(step))).cast("bigint")
    rows = pmf.select(*keys, at.alias("_k"), F.col(prob).cast("double").alias("_p")).where(F.col("_p") > 0)
    rows = rows.groupBy(*keys, "_k").agg(F.sum("_p").alias("_p"))
    rows = rows.withColumn("_blk", F.floor(F.col("_k") / F.lit(block)).cast("bigint"))

    def dense(pdf: pd.DataFrame) -> pd.DataFrame:
        mass = np.zeros(block)
        mass[(pdf["_k"] - pdf["_blk"] * block).to_numpy()] = pdf["_p"].to_numpy()
        return pdf[[*keys, "_blk"]].iloc[:1].assign(_mass=[mass.tobytes()])

    return rows.groupBy(*keys, "_blk").applyInPandas(dense, T.StructType([*_fields(rows, keys), *_BLOCK]))


def convolved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The masses of the sum of two blocks, twice as long; reachable points only."""
    n = len(a)
    few = min(np.count_nonzero(a), np.count_nonzero(b)) <= DIRECT
    if few:
        if np.count_nonzero(a) > np.count_nonzero(b):
            a, b = b, a
        out = np.zeros(2 * n)
        for i in np.flatnonzero(a):
            out[i:i + n] += a[i] * b
        return out
    out = np.fft.irfft(np.fft.rfft(a, 2 * n) * np.fft.rfft(b, 2 * n), 2 * n)
    reach = np.fft.irfft(np.fft.rfft((a > 0).astype(float), 2 * n) * np.fft.rfft((b > 0).astype(float), 2 * n), 2 * n) > 0.5
    return np.where(reach & (out > NOISE), out, 0.0)


def _convolve(left: DataFrame, right: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Block rows of the sum of two laws per ``keys``; both sides hold (keys..., _blk, _mass)."""
    a = left.select(*keys, F.col("_blk").alias("_ba"), F.col("_mass").alias("_ma"))
    b = right.select(*keys, F.col("_blk").alias("_bb"), F.col("_mass").alias("_mb"))
    pairs = join_by(a, b, keys)
    schema = T.StructType([*_fields(left, keys), *_BLOCK])

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), 256):
                part = pdf.iloc[i:i + 256]
                both = [convolved(np.frombuffer(x), np.frombuffer(y)) for x, y in zip(part["_ma"], part["_mb"])]
                low = part[keys].assign(_blk=part["_ba"] + part["_bb"], _mass=[m[:block].tobytes() for m in both])
                high = part[keys].assign(_blk=part["_ba"] + part["_bb"] + 1, _mass=[m[block:].tobytes() for m in both])
                yield pd.concat([low, high[[m[block:].any() for m in both]]], ignore_index=True)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        mass = np.zeros(block)
        for m in pdf["_mass"]:
            mass += np.frombuffer(m)
        return pdf[[*keys, "_blk"]].iloc[:1].assign(_mass=[mass.tobytes()])

    return pairs.mapInPandas(multiply, schema).groupBy(*keys, "_blk").applyInPandas(add, schema)


def sum_law(pmfs: DataFrame, by, comp: str, outcome: str = "outcome", prob: str = "prob", times: str | None = None,
            step: float = 1.0, block: int = BLOCK) -> DataFrame:
    """``(by..., outcome, prob)``: the law of the sum of one independent draw from each ``comp`` of the group, or of
    ``times`` draws (a whole-number column, the same in all rows of a component; 0 leaves it out).

    Outcomes must be multiples of ``step``. Masses are exact up to rounding (about 1e-15 of the largest); those below
    NOISE are left out where the Fourier transform is used. The result is normalised."""
    by = _by(by)
    g = by or ["_g"]
    source = pmfs if by else pmfs.withColumn("_g", F.lit(0))
    many = F.col(times).cast("bigint") if times else F.lit(1).cast("bigint")
    whole = materialize(_blocks(source, [*g, comp], outcome, prob, step, block), "sum-blocks")
    counts = source.groupBy(*g, comp).agg(F.max(many).alias("_n")).where(F.col("_n") > 0)
    order = F.row_number().over(Window.partitionBy(*g).orderBy(comp)) - 1
    counts = materialize(counts.withColumn("_i", order.cast("bigint")), "sum-components")
    most = counts.agg(F.max("_n"), F.max("_i")).first()
    base = join_by(whole, counts, [*g, comp]).select(*g, "_i", "_n", "_blk", "_mass")
    keys = [*g, "_i"]
    if (most[0] or 0) > 1:  # repeated draws: squares of the law, multiplied where the number's binary digit is 1
        left, square = base.select(*keys, "_n").distinct(), base.drop("_n")
        power = None
        for digit in range(int(most[0]).bit_length()):
            bit = left.where(F.col("_n").bitwiseAND(F.lit(1 << digit)) != 0).select(*keys)
            taken = join_by(square, bit, keys)
            if power is None:
                power = taken
            else:
                has = power.select(*keys).distinct()
                new = join_by(taken, has.withColumn("_has", F.lit(True)), keys, "left")
                both = join_by(taken, has, keys)
                marked = join_by(power, bit.withColumn("_bit", F.lit(True)), keys, "left")
                product = _convolve(join_by(power, bit, keys), both, keys, block)
                power = product.unionByName(marked.where(F.col("_bit").isNull()).drop("_bit")).unionByName(new.where(F.col("_has").isNull()).drop("_has"))
            power = materialize(power, "sum-powers")
            if digit + 1 < int(most[0]).bit_length():
                more = left.where(F.col("_n") >= 1 << digit + 1).select(*keys)
                need = join_by(square, more, keys)
                square = materialize(_convolve(need, need.select("*"), keys, block), "sum-squares")
        base = power
    else:
        base = base.drop("_n")
    for _ in range(int(most[1] or 0).bit_length()):
        half = F.floor(F.col("_i") / 2).cast("bigint")
        even = base.where(F.col("_i") % 2 == 0).withColumn("_i", half)
        odd = base.where(F.col("_i") % 2 == 1).withColumn("_i", half)
        partners = odd.select(*keys).distinct()
        alone = join_by(even, partners.withColumn("_odd", F.lit(True)), keys, "left").where(F.col("_odd").isNull()).drop("_odd")
        base = materialize(_convolve(join_by(even, partners, keys), odd, keys, block).unionByName(alone), "sum-halves")

    def points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                mass = np.frombuffer(row[-1])
                at = np.flatnonzero(mass)
                own = {c: [row[i]] * len(at) for i, c in enumerate(g)}
                yield pd.DataFrame({**own, outcome: (row[len(g)] * block + at) * float(step), prob: mass[at]})

    out = base.select(*g, "_blk", "_mass").mapInPandas(points, T.StructType(
        [*_fields(source, g), T.StructField(outcome, T.DoubleType()), T.StructField(prob, T.DoubleType())]))
    out = normalize(out, g, weight=prob)
    return out if by else out.drop("_g")


def max_law(cdfs: DataFrame, by, comp: str, outcome: str = "outcome", cdf: str = "cdf", block: Column | None = None,
            times: str | None = None) -> DataFrame:
    """``(by..., outcome, cdf)``: the distribution function of the largest of one independent draw from each ``comp`` of
    the group (or of ``times`` draws), at every outcome where it is above 0.

    ``cdfs`` holds (by..., comp, outcome, cdf), one row per step; ``block`` (see :mod:`ordered`) spreads a hot group."""
    by = _by(by)
    power = F.col(times).cast("double") if times else F.lit(1.0)
    steps = ordered.neighbour(cdfs, [*by, comp], [outcome], cdf, "_before", "prev")
    steps = steps.where(F.col(cdf) > F.coalesce(F.col("_before"), F.lit(0.0)))
    starts = F.coalesce(F.col("_before"), F.lit(0.0)) <= 0
    change = power * (F.log(F.col(cdf)) - F.when(starts, F.lit(0.0)).otherwise(F.log(F.col("_before"))))
    merged = steps.groupBy(*by, outcome).agg(F.sum(change).alias("_log"), F.sum(starts.cast("bigint")).alias("_starts"))
    run = ordered.running(merged, by, [outcome], {"_sum": ("sum", F.col("_log")), "_on": ("sum", F.col("_starts"))}, block, {"_on": "_all"})
    value = F.least(F.exp(F.col("_sum")), F.lit(1.0))
    return run.where(F.col("_on") == F.col("_all")).select(*by, outcome, value.alias(cdf))
