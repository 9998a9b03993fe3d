"""Best-fit packing by minimum bin slack: whole documents into as few sequences of at most ``capacity`` tokens as can be.

Only documents longer than a sequence are cut, into pieces of ``capacity`` tokens and a shorter last one. Pieces of
``capacity`` tokens fill a sequence each. Of the shorter ones the number of each length (at most capacity - 1
numbers) decides the plan: the longest length left opens a bin, a bitset subset-sum dynamic programme over all
lengths left finds the fullest combination that it can be completed to, the combination is removed as often as its
lengths last, and so on until nothing is left. A piece finds its bin by its rank among the pieces of its length,
which is its rank within its partition plus the counts of the earlier partitions.

Results for odd rows: a null or empty text has the end id only; long texts are encoded whole; repeated rows are
documents of their own; a doc_id may be null; an empty table gives an empty result; other columns are ignored.
Sequence ids below 0 belong to whole pieces of ``capacity`` tokens.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import kind_of, stored

CAPACITY, END_ID = 2048, 0
# The word pattern and the normal form of the definitions that the faster encoder knows.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMAL = ["NFC", "Replace", "Lowercase"]
#: Ends a word on its way to the faster encoder; texts that hold it go to the library.
END_OF_WORD = "\ue000"
# Characters whose normal form, class and lower case no version of Unicode changes: Latin letters, common marks.
_OTHER = re.compile("[^\x00-\u017f\u2010-\u2027\u2030-\u203a\u20ac]")
_L, _N, _S = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


def reachable(definition: dict) -> bool:
    """Whether each merge's result, merged on its own, comes from that merge. Then a merge of any two neighbours that
    form a known piece, lowest number first, is the definition's merge: before it, the piece's stretch has been merged
    as on its own, where only the definition's pair can be left."""
    model = definition["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rank = {m: i for i, m in enumerate(merges)}
    if len({a + b for a, b in merges}) < len(merges):
        return False
    for a, b in merges:
        parts = list((a + b).removesuffix("</w>"))
        parts[-1] += "</w>" * (a + b).endswith("</w>")
        while len(parts) > 2:
            i = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(rank)))
            if (parts[i], parts[i + 1]) not in rank:
                return False
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        if tuple(parts) != (a, b):
            return False
    return True


class Encoder:
    """The ids that the tokenizers library gives for a definition file.

    Byte-level byte-pair definitions with ends of words, whose results are all ``reachable``, run on tiktoken: the words
    of a lower-cased text get an end mark, whose bytes merge with a word's last byte before anything else. Texts with
    other than the plainest characters or with added tokens, and other definitions, run on the library itself.
    """

    def __init__(self, definition: str, fast: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        known = json.loads(definition)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in known["added_tokens"]) or r"(?!)")
        self.fast, self.id_of = self._fast(known) if fast else (None, None)

    @staticmethod
    def _fast(definition: dict):
        import tiktoken

        model = definition["model"]
        # Byte-level files write a byte as itself if printable, else as a character from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of_char = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        mark = END_OF_WORD.encode()
        ranks = {bytes([b]): b for b in range(256)}
        for n in range(1, len(mark) + 1):
            ranks |= {bytes([b]) + mark[:n]: len(ranks) + b for b in range(256)}
        ids = np.full(len(ranks) + len(model["merges"]), -1, np.int64)
        for c, b in of_char.items():
            ids[b], ids[ranks[bytes([b]) + mark]] = model["vocab"][c], model["vocab"][c + "</w>"]
        for merge in model["merges"]:
            token = merge.replace(" ", "") if isinstance(merge, str) else "".join(merge)
            word = token.removesuffix("</w>")
            ids[len(ranks)] = model["vocab"][token]
            ranks[bytes(of_char[c] for c in word) + mark * (word != token)] = len(ranks)
        pattern = f"[^{END_OF_WORD}]+{END_OF_WORD}"
        return tiktoken.Encoding("definition", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), ids.astype("<u4")

    def _library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _quick(self, text: str) -> bytes:
        words = _PIECES.findall(text.lower())
        if not words:
            return b""
        words.append("")
        return self.id_of[self.fast.encode_to_numpy(END_OF_WORD.join(words))].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if self.fast is None:
            return list(map(self._library, texts))
        return [self._library(t) if _OTHER.search(t) or self.special.search(t) else self._quick(t) for t in texts]


def plain_words(definition: str) -> bool:
    """Whether the faster encoder gives a definition's ids; worked out once, before the job."""
    known = json.loads(definition)
    model, steps = known["model"], (known.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split, level = steps[0], steps[-1]
    return (
        model.get("type", "BPE") == "BPE" and model.get("end_of_word_suffix") == "</w>"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "byte_fallback", "unk_token"))
        and [n["type"] for n in (known.get("normalizer") or {}).get("normalizers", [])] == NORMAL and not known.get("post_processor")
        and known["normalizer"]["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        and len(steps) == 2 and split.get("pattern") == {"Regex": WORDS} and split.get("behavior") == "Removed" and bool(split.get("invert"))
        and level.get("type") == "ByteLevel" and not level.get("add_prefix_space") and not level.get("use_regex")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in known["added_tokens"])
        and reachable(known)
    )


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination (length: number) within ``counts`` that holds the longest length and is the fullest of these.

    Bit s of ``reach`` tells whether sum s can be had; lengths come from the longest down, each in powers of two
    of its count, and the reach before every such item is kept to backtrack the numbers taken.
    """
    longest = max(counts)
    room = capacity - longest
    limit, reach, items = (1 << room + 1) - 1, 1, []
    for length in sorted((k for k in counts if k <= room), reverse=True):
        left, power = min(counts[length] - (length == longest), room // length), 1
        while left > 0:
            take = min(power, left)
            items.append((length, take, reach))
            reach |= reach << length * take & limit
            left, power = left - take, power * 2
        if reach >> room & 1:
            break
    at, picked = reach.bit_length() - 1, {longest: 1}
    for length, take, before in reversed(items):
        if not before >> at & 1:
            picked[length] = picked.get(length, 0) + take
            at -= length * take
    return picked


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """(spans, bins): rows of spans are (length, first rank, number in each bin, first bin, offset in it), by length and rank."""
    left = {k: n for k, n in histogram.items() if n}
    used, spans, bins = dict.fromkeys(left, 0), [], 0
    while left:
        picked = fullest(left, capacity)
        times, offset = min(left[k] // n for k, n in picked.items()), 0
        for k, n in sorted(picked.items(), reverse=True):
            spans.append((k, used[k], n, bins, offset))
            offset += k * n
            used[k] += times * n
            left[k] -= times * n
            if not left[k]:
                del left[k]
        bins += times
    return np.array(sorted(spans), np.int64).reshape(-1, 5), bins


@functools.lru_cache(maxsize=2)
def _encoder(definition: str, fast: bool) -> Encoder:
    """Kept while the Python worker lives."""
    return Encoder(definition, fast)


def tokenized(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row per document: doc_id, doc_tokens, the CRCs of its whole pieces, the first one's number among those of
    the partition, length and CRC of the rest, the partition and the rest's rank among those of its length in it."""
    tail, window, fast = np.array([end_id], "<u4").tobytes(), 4 * capacity, plain_words(definition)
    names = ["doc_id", "doc_tokens", "whole_crcs", "whole", "rest", "rest_crc", "part", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, wholes, places = TaskContext.get().partitionId(), 0, np.zeros(capacity, np.int64)
        encoder = _encoder(definition, fast)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = [b + tail for b in encoder.encode([t or "" for t in rows.column(1).to_pylist()])]
                ends = [len(b) // window * window for b in found]
                rest = [(len(b) - e) // 4 for b, e in zip(found, ends)]
                place, first = [], []
                for n, e in zip(rest, ends):
                    place.append(int(places[n]))
                    places[n] += 1
                    first.append(wholes)
                    wholes += e // window
                out = [
                    rows.column(0), pa.array([len(b) // 4 for b in found], pa.int64()),
                    pa.array([[zlib.crc32(b[i:i + window]) for i in range(0, e, window)] for b, e in zip(found, ends)], pa.list_(pa.int64())),
                    pa.array(first, pa.int64()), pa.array(rest, pa.int64()),
                    pa.array([zlib.crc32(b[e:]) for b, e in zip(found, ends)], pa.int64()),
                    pa.array([part] * len(found), pa.int64()), pa.array(place, pa.int64())]
                yield pa.RecordBatch.from_arrays(out + [pa.array(found, pa.binary())] * ids, names + ["ids"] * ids)

    schema = f"doc_id {kind_of(docs, 'doc_id')}, doc_tokens long, whole_crcs array<long>, whole long, rest long, rest_crc long, part long, place long"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids binary" * ids)


def _binned(rests: DataFrame, spans: np.ndarray) -> DataFrame:
    """Adds sequence_id and offset: the span of a length that holds the rank, found by binary search."""
    length, first, each, sequence, at = spans.T
    key = length << 48 | first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, rank = batch.column("rest").to_numpy(), batch.column("rank").to_numpy()
            i = np.searchsorted(key, rest << 48 | rank, side="right") - 1
            inside = rank - first[i]
            columns = dict(zip(batch.schema.names, batch.columns)) | {
                "sequence_id": pa.array(sequence[i] + inside // each[i]), "offset": pa.array(at[i] + inside % each[i] * rest)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rests.schema)
    return rests.mapInArrow(run, fields + ", sequence_id long, offset long")


def pack(docs: DataFrame, definition: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``ids`` adds the
    piece's ids (little-endian 32-bit integers)."""
    extra = ["ids"] if ids else []
    done = stored(tokenized(docs, definition, capacity, end_id, ids), "bins-ids")
    rests = done.where("rest > 0").select(
        "doc_id", "doc_tokens", "rest", "rest_crc", "part", "place",
        *[F.substring("ids", ((F.col("doc_tokens") - F.col("rest")) * 4 + 1).cast("int"), (F.col("rest") * 4).cast("int")).alias("ids") for _ in extra])
    counts = rests.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"))
    spans, _ = plan({r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}, capacity)
    earlier = F.sum("n").over(Window.partitionBy("rest").orderBy("part")) - F.col("n")
    ranked = rests.join(counts.select("part", "rest", earlier.alias("earlier")), ["part", "rest"]).withColumn(
        "rank", F.col("earlier") + F.col("place")).drop("part", "place", "earlier")
    pieces = _binned(ranked, spans).select(
        "doc_id", F.floor(F.col("doc_tokens") / capacity).cast("int").alias("piece"), (F.col("doc_tokens") - F.col("rest")).alias("start"),
        F.col("rest").alias("length"), F.col("rest_crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", *extra)
    wholes = done.where("size(whole_crcs) > 0").select("*", F.posexplode("whole_crcs").alias("piece", "ids_crc32"))
    start = F.col("piece") * F.lit(capacity).cast("long")
    return pieces.unionByName(wholes.select(
        "doc_id", "piece", start.alias("start"), F.lit(capacity).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (-1 - (F.shiftleft(F.col("part"), 40) + F.col("whole") + F.col("piece"))).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *[F.substring("ids", (start * 4 + 1).cast("int"), 4 * capacity).alias("ids") for _ in extra]))
