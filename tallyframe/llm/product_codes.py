"""Vector code compression: product codes from integer codebooks, searched exactly by Walsh-Hadamard sums.

Vectors of integers are cut into equal consecutive parts; every part position has a codebook of up to 256 entries,
trained by rounds of assignment to the nearest entry and integer means. The nearest entry is found without floating
point: part and entries, padded with zeros to a power of two, go through the integer Walsh-Hadamard transform, whose
squared differences add up to the padded length times the squared distance. They are accumulated in sequency order
(slow changes first); an entry whose partial sum already exceeds the full sum of the best entry known is dropped.
Sums run in 32- or 64-bit integers as far as the lengths of parts and entries prove that these hold them, else in
Python's integers.

Per round only codebooks (bounded by parts x 256 entries) go to the tasks and per-entry sums come back.

Results for odd rows: vectors that are null or hold null or non-finite components take no part; a null vec_id comes
after all others; repeated rows count each; shorter vectors end in zeros up to the longest one's length, rounded up
to whole parts; with fewer than 256 vectors a codebook has as many entries as there are vectors; errors beyond a
long are held at its end; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import kind_of, stored

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows of a block whose sums are held at a time; coefficients that all entries get, in quarters of all; coefficients
#: between two eliminations after them.
BLOCK, DENSE, STEP = 128, 3, 2
_LONG = (1 << 63) - 1


def sequency_order(n: int) -> np.ndarray:
    """Rows of the Walsh-Hadamard transform of length n by their number of sign changes."""
    rows = transform(np.eye(n, dtype=np.int64))
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform along the last axis, a power of two long, by sums and differences."""
    n, half = x.shape[-1], 1
    while half < n:
        y = x.reshape(*x.shape[:-1], n // (2 * half), 2, half)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], axis=-2).reshape(x.shape)
        half *= 2
    return x


def _ordered(x: np.ndarray) -> np.ndarray:
    """Coefficients of zero-padded rows in sequency order."""
    width = 1 << max(x.shape[1] - 1, 0).bit_length()
    padded = np.concatenate([x, np.zeros((len(x), width - x.shape[1]), x.dtype)], axis=1)
    return transform(padded)[:, sequency_order(width)] if width > 1 else padded


def _norm(x: np.ndarray) -> int:
    """A bound of the rows' lengths, as an integer."""
    return int(np.abs(x).max(initial=0)) * x.shape[1]


def nearest(parts: np.ndarray, entries: np.ndarray, kept: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each row's nearest entry, ties to the lower index; integers throughout.

    ``kept``, if given, collects how many (row, entry) pairs each elimination leaves."""
    width = 1 << max(parts.shape[1] - 1, 0).bit_length()
    bound = width * (_norm(parts) + _norm(entries)) ** 2
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object
    a, b = _ordered(parts).astype(kind), _ordered(entries).astype(kind)
    columns = np.ascontiguousarray(b.T)
    dense = max(width * DENSE // 4, 1)
    index, far = np.zeros(len(a), np.int64), np.zeros(len(a), kind)
    for start in range(0, len(a), BLOCK):
        rows = a[start:start + BLOCK]
        sums = np.zeros((len(rows), len(b)), kind)
        d = np.empty_like(sums)
        for k in range(dense):
            np.subtract(rows[:, k, None], columns[k], out=d)
            np.multiply(d, d, out=d)
            sums += d
        # The full sum of the entry that leads after the first coefficients bounds the least sum.
        lead = sums.argmin(axis=1) if kind is not object else np.array([min(range(len(b)), key=s.__getitem__) for s in sums], np.int64)
        d = rows - b[lead]
        best = (d * d).sum(axis=1)
        x, y = np.nonzero(sums <= best[:, None])
        partial = sums[x, y]
        for k in range(dense, width, STEP):
            if kept is not None:
                kept.append(len(x))
            for i in range(k, min(k + STEP, width)):
                d = rows[x, i] - columns[i][y]
                partial = partial + d * d
            alive = partial <= best[x]
            x, y, partial = x[alive], y[alive], partial[alive]
        order = np.lexsort((y, partial, x)) if kind is not object else np.array(sorted(range(len(x)), key=lambda i: (x[i], partial[i], y[i])), np.int64)
        first = order[np.searchsorted(x[order], np.arange(len(rows)))]
        index[start:start + BLOCK], far[start:start + BLOCK] = y[first], partial[first]
    return index, far // width


def quantised(values: list[list[float]], width: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of each component, exactly, as long or, beyond it, as Python integers; zeros up to ``width``."""
    x = np.zeros((len(values), width))
    for i, v in enumerate(values):
        x[i, :len(v)] = v
    if np.abs(x).max(initial=0) * scale < 2.0**52:  # the products' floors are exact: their factor is a power of two or checked
        if scale & (scale - 1) == 0:
            return np.floor(x * scale).astype(np.int64)
    return np.array([[floor(Fraction(c) * scale) for c in row] for row in x.tolist()], object).reshape(x.shape)


def _vectors(batches: Iterator[pa.RecordBatch], width: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            column = part.column("v")
            flat = column.flatten().to_numpy()
            if len(flat) == len(column) * width:
                values = flat.reshape(len(column), width)
                small = np.abs(values).max(initial=0) * scale < 2.0**52 and scale & (scale - 1) == 0
                yield part, np.floor(values * scale).astype(np.int64) if small else quantised(values.tolist(), width, scale)
            else:
                yield part, quantised(column.to_pylist(), width, scale)


def _split(v: np.ndarray, parts: int) -> list[np.ndarray]:
    size = v.shape[1] // parts
    return [v[:, p * size:(p + 1) * size] for p in range(parts)]


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id, label and v (doubles) of the vectors that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.select("vec_id", label.alias("label"), "embedding").where(x.isNotNull() & F.coalesce(fine, F.lit(False))).select(
        "vec_id", "label", F.transform(x, lambda c: c.cast("double")).alias("v"))


def updated(rows: DataFrame, books: list[np.ndarray], width: int, scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks after one round: each entry the floored mean of the parts assigned to it, unused ones as before."""
    parts, size = len(books), width // len(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, max(map(len, books))), np.int64)
        total = np.zeros((parts, max(map(len, books)), size), object if any(b.dtype == object for b in books) else np.int64)
        for _, v in _vectors(batches, width, scale):
            if v.dtype == object or int(np.abs(v).max(initial=0)) * len(v) + int(np.abs(total).max(initial=0)) > _LONG:
                total = total.astype(object)
            for p, (x, book) in enumerate(zip(_split(v, parts), books)):
                index, _ = nearest(x, book)
                np.add.at(count[p], index, 1)
                order = np.argsort(index, kind="stable")
                starts = np.flatnonzero(np.diff(index[order], prepend=-1))
                if len(starts) and size:
                    total[p, index[order][starts]] += np.add.reduceat(x[order], starts, axis=0)
        at = [(p, e) for p, e in zip(*np.nonzero(count))]
        yield pa.RecordBatch.from_arrays([
            pa.array([p * ENTRIES + e for p, e in at], pa.int64()), pa.array([int(count[p, e]) for p, e in at], pa.int64()),
            pa.array([[str(s) for s in total[p, e].tolist()] for p, e in at], pa.list_(pa.string()))], ["entry", "n", "sums"])

    found = rows.select("v").mapInArrow(sums, "entry long, n long, sums array<string>")
    # Decimal sums per component are exact up to 38 digits; larger ones (components beyond 1e27) come as single rows.
    small = F.forall("sums", lambda s: F.length(s) < 28)
    added = found.where(small).groupBy("entry").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.element_at("sums", i + 1).cast("decimal(28,0)")).cast("string") for i in range(size)]).cast("array<string>").alias("sums"))
    out = [b.copy() for b in books]
    taken: dict[int, tuple[int, list[int]]] = {}
    for r in added.unionByName(found.where(~small)).toLocalIterator():
        n, s = taken.get(r["entry"], (0, [0] * size))
        taken[r["entry"]] = n + r["n"], [a + int(b) for a, b in zip(s, r["sums"])]
    for entry, (n, s) in taken.items():
        mean = [x // n for x in s]
        p, e = divmod(entry, ENTRIES)
        if out[p].dtype != object and any(abs(x) > _LONG for x in mean):
            out[p] = out[p].astype(object)
        out[p][e] = mean
    return out


def fitted(rows: DataFrame, width: int, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> list[np.ndarray]:
    """One codebook per part position: the parts of the vectors with the smallest vec_ids, after ``rounds`` rounds."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    books = _split(quantised([r["v"] for r in first], width, scale), parts)
    for _ in range(rounds):
        books = updated(rows, books, width, scale)
    return books


def books_sha256(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(c) for b in books for entry in b.tolist() for c in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode(vectors: DataFrame, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error and codebooks_sha256 of every vector that takes part."""
    rows = stored(valid(vectors), "codes-vectors")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts) * parts
    books = fitted(rows, width, parts, rounds, scale) if longest else [np.zeros((1, 0), np.int64)] * parts
    digest = books_sha256(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, v in _vectors(batches, width, scale):
            found = [nearest(x, b) for x, b in zip(_split(v, parts), books)]
            code = np.stack([i for i, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            error = [min(sum(e), _LONG) for e in zip(*[d.tolist() for _, d in found])]
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id"), part.column("label"),
                pa.array([code[i:i + 2 * parts] for i in range(0, len(code), 2 * parts)], pa.string()), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"])

    coded = stored(rows.mapInArrow(
        assign, f"vec_id {kind_of(rows, 'vec_id')}, label {kind_of(rows, 'label')}, code string, error long"), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy("label").agg(F.least(total, F.lit(_LONG)).cast("long").alias("label_error"))
    # A label may hold a third of all rows: its total is copied to every salt, and the salts share its rows.
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = labels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumnRenamed("label", "l")
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    joined = salted.join(spread, (salted["salt"] == spread["salt"]) & salted["label"].eqNullSafe(spread["l"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
