"""Exact dedup: counting quotient filters built per partition, merged losslessly by sorted remainders.

Fingerprints that the merged filters count more than once go to byte verification; nothing else reads a text
twice. Results for odd rows: a null text counts as empty; a null doc_id is below every other; of rows that
repeat both doc_id and text exactly one stays; an empty table gives an empty result; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import ascii_lower, hinted, stored, text_or_empty

#: Keys that one merged filter holds on average; the number of filters follows the rows.
SEGMENT_KEYS = 1 << 15


class QuotientFilter:
    """Counting quotient filter over ``width``-bit fingerprints, with one slot per distinct fingerprint.

    A fingerprint's high ``q`` bits (the quotient) name its run; the low bits (the remainder) lie in the run in
    order. ``occupied`` marks the quotients that have a run, ``runend`` the last slot of each run, and counters
    above one are kept beside their slots. Nothing is lost, so ``items`` gives the sorted fingerprints back.
    """

    HEAD = struct.Struct("<BBQQ")

    def __init__(self, width: int, q: int, occupied: np.ndarray, runend: np.ndarray, remainders: np.ndarray,
                 slots: np.ndarray, counters: np.ndarray):
        self.width, self.q = width, q
        self.occupied, self.runend, self.remainders = occupied, runend, remainders
        self.slots, self.counters = slots, counters

    @classmethod
    def of(cls, values: np.ndarray, counts: np.ndarray, width: int) -> QuotientFilter:
        """From sorted distinct fingerprints and their counts."""
        q = min(width - 1, max(1, math.ceil(math.log2(max(len(values), 2)))))
        quotients = (values >> np.uint64(width - q)).astype(np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotients] = True
        runend = np.append(quotients[1:] != quotients[:-1], len(values) > 0)[: len(values)]
        slots = np.flatnonzero(counts > 1)
        return cls(width, q, occupied, runend, values & np.uint64((1 << (width - q)) - 1), slots, counts[slots])

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        run = np.concatenate([[0], np.cumsum(self.runend)[:-1]]).astype(np.int64)[: len(self.remainders)]
        quotients = np.flatnonzero(self.occupied).astype(np.uint64)[run]
        counts = np.ones(len(self.remainders), np.int64)
        counts[self.slots] = self.counters
        return (quotients << np.uint64(self.width - self.q)) | self.remainders, counts

    def to_bytes(self) -> bytes:
        size = (self.width - self.q + 7) // 8
        cells = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]
        return b"".join((
            self.HEAD.pack(self.width, self.q, len(self.remainders), len(self.slots)),
            np.packbits(self.occupied).tobytes(), np.packbits(self.runend).tobytes(), cells.tobytes(),
            self.slots.astype("<i8").tobytes(), self.counters.astype("<i8").tobytes(),
        ))

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        width, q, n, m = cls.HEAD.unpack_from(data)
        size, at = (width - q + 7) // 8, cls.HEAD.size

        def take(length: int) -> np.ndarray:
            nonlocal at
            at += length
            return np.frombuffer(data, np.uint8, length, at - length)

        occupied = np.unpackbits(take((1 << q) + 7 >> 3), count=1 << q).astype(bool)
        runend = np.unpackbits(take(n + 7 >> 3), count=n).astype(bool)
        cells = np.zeros((n, 8), np.uint8)
        cells[:, :size] = take(n * size).reshape(n, size)
        return cls(width, q, occupied, runend, cells.reshape(-1).view("<u8"),
                   np.frombuffer(take(8 * m).tobytes(), "<i8"), np.frombuffer(take(8 * m).tobytes(), "<i8"))

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter with the summed counts: the sorted remainders of the inputs are merged run by run."""
        parts = [f.items() for f in filters]
        values, counts = np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts])
        order = np.argsort(values, kind="stable")  # merges the sorted stretches
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
        return cls.of(values[first], np.add.reduceat(counts, first) if len(first) else counts, filters[0].width)


def segment_bits(rows: int) -> int:
    return max(0, math.ceil(math.log2(max(rows, 1) / SEGMENT_KEYS)))


def merged_filters(fingerprints: DataFrame, column: str, bits: int) -> DataFrame:
    """(segment, filter): a filter per partition and segment (the top ``bits`` of a fingerprint), then merged."""
    width = 64 - bits

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = [b[column].to_numpy(np.int64).view(np.uint64) for b in batches]
        values, counts = np.unique(np.concatenate(kept) if kept else np.zeros(0, np.uint64), return_counts=True)
        segments = values >> np.uint64(width) if bits else np.zeros(len(values), np.uint64)
        local = values & np.uint64((1 << width) - 1)
        edges = np.flatnonzero(np.append(True, segments[1:] != segments[:-1])[: len(values)]).tolist()
        rows = [
            (int(segments[a]), QuotientFilter.of(local[a:b], counts[a:b], width).to_bytes())
            for a, b in zip(edges, [*edges[1:], len(values)])
        ]
        yield pd.DataFrame(rows, columns=["segment", "filter"])

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        one = QuotientFilter.merged([QuotientFilter.from_bytes(b) for b in group["filter"]])
        return pd.DataFrame({"segment": [key[0]], "filter": [one.to_bytes()]})

    parts = fingerprints.select(column).mapInPandas(build, "segment long, filter binary")
    return parts.groupBy("segment").applyInPandas(merge, "segment long, filter binary")


def repeated_fingerprints(filters: DataFrame, bits: int) -> DataFrame:
    """(fp, copies) of the fingerprints that the merged filters count more than once."""
    width = 64 - bits

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for segment, data in zip(batch["segment"], batch["filter"]):
                values, counts = QuotientFilter.from_bytes(data).items()
                if bits:
                    values = values | (np.uint64(segment) << np.uint64(width))
                many = counts > 1
                yield pd.DataFrame({"fp": values[many].view(np.int64), "copies": counts[many]})

    return filters.mapInPandas(read, "fp long, copies long")


def exact_dedup(docs: DataFrame, fingerprint: Column | None = None, digest: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and text_hash (of the raw text).

    ``fingerprint`` and ``digest`` are expressions over the normalised text ``norm``; tests force collisions
    with them. Equal texts are those equal in every byte after A-Z is lower-cased, whatever the two say.
    """
    fingerprint = F.xxhash64("norm") if fingerprint is None else fingerprint
    digest = F.sha2("norm", 256) if digest is None else digest
    base = docs.select("doc_id", "text", ascii_lower(text_or_empty(F.col("text"))).alias("norm"))
    keyed = stored(
        base.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint.alias("fp"),
                    F.unhex(digest).alias("digest"), F.monotonically_increasing_id().alias("row")),
        "exact-keys",
    )
    bits = segment_bits(keyed.count())
    repeated = stored(repeated_fingerprints(merged_filters(keyed, "fp", bits), bits), "exact-repeated")
    few = hinted(repeated.select("fp"))

    # Byte verification: the distinct texts behind each repeated fingerprint and digest.
    texts = (
        base.select(fingerprint.alias("fp"), F.unhex(digest).alias("digest"), "norm")
        .join(few, "fp", "left_semi").groupBy("fp", "digest", "norm").agg(F.count(F.lit(1)).alias("n"))
    )
    clashes = stored(
        texts.groupBy("fp", "digest").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1"), "exact-clash"
    )
    keys = ["fp", "digest"]
    if clashes.limit(1).count():  # two texts share both hashes: the text itself joins the key
        variant = base.select("doc_id", "text", "norm", fingerprint.alias("fp"), F.unhex(digest).alias("digest"))
        variant = variant.join(hinted(clashes.select("fp", "digest")), keys, "left_semi").select(
            F.col("doc_id").alias("v_id"), F.xxhash64("text").alias("v_hash"), "fp", "digest", "norm").distinct()
        keyed = stored(keyed.alias("k").join(
            variant.alias("v"),
            F.col("k.doc_id").eqNullSafe(F.col("v.v_id")) & (F.col("k.text_hash") == F.col("v.v_hash"))
            & (F.col("k.fp") == F.col("v.fp")) & (F.col("k.digest") == F.col("v.digest")), "left",
        ).select("k.*", text_or_empty(F.col("v.norm")).alias("norm")), "exact-keys")
        keys = ["fp", "digest", "norm"]

    groups = keyed.join(few, "fp", "left_semi").groupBy(*keys).agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("size")
    ).where("size > 1")
    groups = hinted(stored(groups, "exact-groups"))
    joined = keyed.join(groups, keys, "left")
    stays = F.col("keep").isNull() | (F.col("keep.row") == F.col("row"))
    return joined.select(
        "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        stays.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "text_hash",
    )
