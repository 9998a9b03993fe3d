"""Column-expression building blocks (JVM side, inside whole-stage codegen).

Hashes are md5 slices so that a second SQL engine computes the very same positions; uniforms for sampling are
md5-derived so that draws do not depend on partitioning or task retries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of",
    "with_scalars",
    "join_by",
    "ntz_micros",
    "utc_instant",
    "utc_day",
    "normalise_weight",
    "md5_int",
    "hash_positions",
    "md5_uniform",
    "lgamma",
    "ln_factorial",
    "ln_choose",
    "ln_beta",
    "normal_pdf",
    "exponential_pdf",
    "normal_cdf",
    "erf",
    "TWO_POW_32",
]

TWO_POW_32 = 4294967296.0


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp's wall-clock value (TIMESTAMP_NTZ arithmetic), the same
    whatever the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def utc_instant(ts: Column) -> Column:
    """TIMESTAMP whose UTC reading equals the wall-clock value: event time for watermarks and windows,
    aligned to UTC days in any session time zone."""
    return F.timestamp_micros(ntz_micros(ts))


def utc_day(instant: Column) -> Column:
    """'yyyy-MM-dd' of an instant read in UTC (from epoch days; no session time zone involved)."""
    days = F.floor(F.unix_micros(instant) / F.lit(86_400_000_000)).cast("int")
    return F.date_format(F.date_from_unix_date(days), "yyyy-MM-dd")


def join_by(left, right, by, how="inner"):
    """Equi-join on the key columns ``by`` in which NULL keys match each other; the keys of ``left`` stay."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in by})
    cond = None
    for c in by:
        same = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = same if cond is None else cond & same
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in by])


def with_scalars(df, one_row, cols):
    """Attach the columns of a one-row DataFrame (e.g. a global aggregate) through one scalar subquery (a
    struct of all the values): computed once, reused wherever it appears, and no join at all."""
    packed = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return df.withColumns({c: packed.getField(c) for c in cols})


def normalise_weight(weight: Column, total: Column) -> Column:
    """``w / total``, except that a zero total leaves the weights alone (a zero sum is never divided)."""
    return F.when(total == 0, weight).otherwise(weight / total)


def md5_int(item: Column, offset: int) -> Column:
    """Unsigned 32-bit integer from the 8 hex digits of ``md5(item)`` starting at 1-based ``offset``."""
    return F.conv(F.substring(F.md5(item.cast("string")), offset, 8), 16, 10).cast("bigint")


def hash_positions(h1: Column, h2: Column, k: Column | int, m: Column | int) -> Column:
    """Array of ``k`` positions in ``1..m`` by double hashing: ``1 + (h1 + i*h2) mod m`` for i in 0..k-1.

    h1 and h2 are columns of their own (two slices of one md5 per item), so no digest is taken for each of the k
    positions. Positions start at 1 (bitmap position 0 would share a bit with 1).
    """
    k = F.lit(k) if isinstance(k, int) else k
    m = F.lit(m) if isinstance(m, int) else m
    return F.transform(F.sequence(F.lit(0).cast("bigint"), k.cast("bigint") - 1), lambda i: F.pmod(h1 + i * h2, m) + 1)


def md5_uniform(*parts: Column) -> Column:
    """A uniform in [0, 1) from md5 of the '|'-joined parts; identical in any engine with md5."""
    key = F.concat_ws("|", *[p.cast("string") for p in parts])
    return md5_int(key, 1) / F.lit(TWO_POW_32)


# Lanczos approximation of the gamma function, g = 7, nine coefficients (public constants).
_LANCZOS_G = 7.0
_LANCZOS = [
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
]


def _lgamma_ge_half(x: Column) -> Column:
    z = x - F.lit(1.0)
    a = F.lit(_LANCZOS[0])
    for i, c in enumerate(_LANCZOS[1:], start=1):
        a = a + F.lit(c) / (z + F.lit(float(i)))
    t = z + F.lit(_LANCZOS_G + 0.5)
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + F.lit(0.5)) * F.log(t) - t + F.log(a)


def lgamma(x: Column) -> Column:
    """ln Γ(x) for x > 0 as a Column expression (Lanczos; reflection below 1/2). Spark SQL has no lgamma."""
    x = x.cast("double")
    reflected = F.lit(math.log(math.pi)) - F.log(F.abs(F.sin(F.lit(math.pi) * x))) - _lgamma_ge_half(F.lit(1.0) - x)
    return F.when(x < 0.5, reflected).otherwise(_lgamma_ge_half(x))


def ln_factorial(k: Column) -> Column:
    return lgamma(k.cast("double") + F.lit(1.0))


def ln_choose(n: Column, k: Column) -> Column:
    return ln_factorial(n) - ln_factorial(k) - ln_factorial(n - k)


def ln_beta(a: Column, b: Column) -> Column:
    return lgamma(a) + lgamma(b) - lgamma(a + b)


def normal_pdf(x: Column, mu: Column, sigma: Column) -> Column:
    z = (x - mu) / sigma
    return F.exp(-(z * z) / F.lit(2.0)) / (sigma * F.lit(math.sqrt(2 * math.pi)))


def exponential_pdf(x: Column, lam: Column) -> Column:
    return F.when(x < 0, F.lit(0.0)).otherwise(lam * F.exp(-lam * x))


# Series lengths of the erf evaluation (Taylor up to |x| = 3, continued fraction beyond).
ERF_TAYLOR_TERMS = 60
ERFC_FRACTION_DEPTH = 60
ERF_SWITCH = 3.0
TWO_OVER_SQRT_PI = 2.0 / math.sqrt(math.pi)
INV_SQRT_PI = 1.0 / math.sqrt(math.pi)
INV_SQRT2 = 1.0 / math.sqrt(2.0)


def _erf_taylor(x: Column) -> Column:
    """erf by its Maclaurin series, summed term by term in a sequential fold (|x| <= 3)."""
    start = F.struct(x.alias("t"), x.alias("s"))

    def step(acc, n):
        t = acc["t"] * (-(x * x)) / n
        return F.struct(t.alias("t"), (acc["s"] + t / (n * 2 + 1)).alias("s"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ERF_TAYLOR_TERMS)), start, step)["s"] * F.lit(TWO_OVER_SQRT_PI)


def _erfc_fraction(x: Column) -> Column:
    """erfc for x > 3 by its continued fraction, evaluated from the innermost level outwards."""
    f = F.aggregate(F.sequence(F.lit(ERFC_FRACTION_DEPTH), F.lit(1), F.lit(-1)), x,
                    lambda acc, k: x + (k / 2.0) / acc)
    return F.exp(-(x * x)) * F.lit(INV_SQRT_PI) / f


def erf(x: Column) -> Column:
    """The error function as a Column expression (Spark SQL has none), to an absolute error of about 1e-14."""
    x = x.cast("double")
    ax = F.abs(x)
    tail = F.lit(1.0) - _erfc_fraction(ax)
    return F.when(ax <= ERF_SWITCH, _erf_taylor(x)).otherwise(F.when(x > 0, tail).otherwise(-tail))


def erfc(x: Column) -> Column:
    """``1 − erf(x)``, with full relative precision in the upper tail, where it is not a difference."""
    x = x.cast("double")
    return F.when(x > ERF_SWITCH, _erfc_fraction(x)).otherwise(F.lit(1.0) - erf(x))


def normal_cdf(x: Column, mu: Column, sigma: Column) -> Column:
    return F.lit(0.5) * erfc(-(x - mu) / sigma * F.lit(INV_SQRT2))
