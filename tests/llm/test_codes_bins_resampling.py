"""Product codes, best-fit packing and importance resampling: brute force in plain Python, bounds, odd rows."""

import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import bin_packing, importance_resampling, product_codes, queries

from ..conftest import SF01, SF001
from .helpers import empty_documents, odd_documents, odd_texts, rows_of

# --- product codes ---


def codes_by_hand(vectors, parts=4, rounds=4, entries=256):
    """vectors: (vec_id, label, floats) that take part, in codebook order."""
    width = -(-max(len(v) for *_, v in vectors) // parts) * parts
    size = width // parts
    whole = [[math.floor(Fraction(x) * 1024) for x in v] + [0] * (width - len(v)) for *_, v in vectors]
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for v in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for c in cut:
                members[near(c[p], books[p])[1]].append(c[p])
            for i, xs in members.items():
                books[p][i] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors, label_errors = [sum(d for d, _ in f) for f in found], Counter()
    for (_, label, _), e in zip(vectors, errors):
        label_errors[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    most = (1 << 63) - 1
    return [(vec_id, "".join(f"{i:02x}" for _, i in f), min(e, most), min(label_errors[label], most), digest)
            for (vec_id, label, _), f, e in zip(vectors, found, errors)]


def test_transform_keeps_distances_and_orders_by_sign_changes():
    order = product_codes.sequency_order(16)
    rows = product_codes.transform(np.eye(16, dtype=np.int64))[order]
    assert [(r[1:] != r[:-1]).sum() for r in rows] == list(range(16))
    assert (rows @ rows.T == 16 * np.eye(16)).all()


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 9), st.integers(1, 12), st.sampled_from([3, 2000, 1 << 18, 1 << 40, 1 << 90]), st.integers(0, 10**6))
def test_nearest_equals_brute_force(size, n_entries, most, seed):
    rng = random.Random(seed)
    kind = np.int64 if most < 1 << 50 else object
    parts, entries = ([[rng.randint(-most, most) for _ in range(size)] for _ in range(n)] for n in (20, n_entries))
    entries += entries[:2]  # ties go to the lower index
    index, far = product_codes.nearest(np.array(parts, kind), np.array(entries, kind))
    for x, i, d in zip(parts, index.tolist(), far.tolist()):
        assert (d, i) == min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(entries))


def test_elimination_drops_entries_of_clustered_parts():
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (64, 16))
    parts = centres[rng.integers(0, 64, 2000)] + rng.integers(-40, 41, (2000, 16))
    kept: list[int] = []
    product_codes.nearest(parts, centres, kept)
    assert kept[0] < 0.05 * 64 * product_codes.BLOCK


def test_codes_equal_brute_force(spark):
    vectors = spark.read.parquet(f"{SF001}/embeddings.parquet").orderBy("vec_id").limit(330)
    rows = [(r["vec_id"], r["label"], list(r["embedding"])) for r in vectors.collect()]
    want = codes_by_hand([(i, lab, [v[k] for k in range(0, 64, 8)]) for i, lab, v in rows])
    narrow = vectors.withColumn("embedding", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.element_at("embedding", k * 8 + 1)))
    assert rows_of(product_codes.encode(narrow.repartition(5)), "vec_id", "code", "error", "label_error", "codebooks_sha256") == sorted(want, key=repr)


SCHEMA = "vec_id long, embedding array<double>, label int, v string, code string, salt int, n long"


def odd_vectors(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], rng.choice([1, 2, None])) for i in range(40)]
    rows += [(100, None, 1), (101, [], 1), (102, [1.0, None] * 4, 1), (103, [float("nan")] * 8, 1), (104, [float("inf")] * 8, 1),
             (105, [0.0] * 8, 1), (105, [0.0] * 8, 1), (106, [2.0, 3.0], None), (107, [-0.0004] * 8, 5), (None, [0.5] * 7, 5)]
    return rows


@pytest.mark.parametrize("huge", [False, True])
def test_codes_of_odd_rows(spark, huge):
    rows = odd_vectors(spark) + ([(50, [1e300, -1e300, 1e17, 3.0] * 2, 1), (51, [1e300] * 8, 1)] if huge else [])
    df = spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA).repartition(4)
    fine = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    got = rows_of(product_codes.encode(df), "vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert got == sorted(codes_by_hand([(r[0], r[2], r[1]) for r in fine]), key=repr)


def test_codes_of_an_empty_table(spark):
    for df in (spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, None, 1, None, None, None, None)], SCHEMA)):
        out = product_codes.encode(df)
        assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert [r["error"] for r in product_codes.encode(spark.createDataFrame([(1, [], 1, None, None, None, None)], SCHEMA)).collect()] == [0]


# --- best-fit packing ---


@pytest.fixture(scope="module")
def encoder():
    definition = queries.byte_model(queries.WORD_MODEL)
    return bin_packing.Encoder(definition, bin_packing.plain_words(definition))


def library_ids(encoder, text):
    return encoder.library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abAB'stdlI.,;:!?() \n\t\r\x0b\x1c\x85\xa0 ßÜééİΣσ漢😀9½<|endoftext|>"), max_size=60), max_size=6))
def test_words_encode_like_the_library(encoder, texts):
    assert encoder.fast is not None
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(encoder, text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x20AF, exclude_categories=["Cs"]), max_size=80))
def test_any_text_encodes_like_the_library(encoder, text):
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library_ids(encoder, text)


def test_every_plain_character_encodes_like_the_library(encoder):
    plain = [c for c in map(chr, range(0x20B0)) if not bin_packing._OTHER.search(c)]
    texts = [c for c in plain] + [f"a{c}b {c}{c}1{c}'s" for c in plain]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [library_ids(encoder, t) for t in texts]


def test_encoder_of_odd_and_long_texts(encoder):
    texts = [t or "" for t in odd_texts()] + [" " * 1_100_000 + "end.", "<|endoftext|>, <|startoftext|>.x", "don't! I'LL, we'd.", "a" * 200_000 + "."]
    texts += ["a" * 1_100_000, "7" * 1_100_000, "!?" * 500_000, "ab\ue000c", "ΣΑΣ i̇İ"]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [library_ids(encoder, t) for t in texts]


def test_all_documents_encode_like_the_library(encoder):
    texts = [t or "" for t in pq.read_table(f"{SF01}/documents.parquet")["text"].to_pylist()]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)] == [library_ids(encoder, t) for t in texts]


def test_other_definitions_run_on_the_library():
    definition = queries.byte_model()
    assert not bin_packing.plain_words(definition)
    other = bin_packing.Encoder(definition, False)
    assert np.frombuffer(other.encode(["a b  c\n"])[0], "<u4").tolist() == library_ids(other, "a b  c\n")
    hidden = json.loads(queries.byte_model(queries.WORD_MODEL))
    merges = hidden["model"]["merges"]
    hidden["model"]["merges"] = merges[::-1]  # most results cannot be reached in this order
    assert bin_packing.reachable(json.loads(queries.byte_model(queries.WORD_MODEL))) and not bin_packing.reachable(hidden)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 14), st.integers(1, 3), min_size=1, max_size=6))
def test_fullest_is_the_fullest_with_the_longest(counts):
    capacity, longest = 14, max(counts)
    picked = bin_packing.fullest(counts, capacity)
    assert picked[longest] >= 1 and all(n <= counts[k] for k, n in picked.items())
    best = max(s for c in itertools.product(*(range(n + 1) for n in counts.values()))
               if c[list(counts).index(longest)] and (s := sum(a * b for a, b in zip(c, counts))) <= capacity)
    assert sum(k * n for k, n in picked.items()) == best


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=20))
def test_plan_places_every_piece_once(histogram):
    spans, bins = bin_packing.plan(histogram, 64)
    load, seen = defaultdict(list), Counter()
    for i, (length, first, each, sequence, at) in enumerate(spans.tolist()):
        end = spans[i + 1][1] if i + 1 < len(spans) and spans[i + 1][0] == length else histogram[length]
        for rank in range(first, end):
            seen[length] += 1
            load[sequence + (rank - first) // each].append((at + (rank - first) % each * length, length))
    assert dict(seen) == histogram and len(load) == bins
    for pieces in load.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def check_packed(encoder, docs, rows, capacity, ids=True):
    want = Counter()
    for d in docs:
        tokens = library_ids(encoder, d["text"]) + [0]
        for i in range(0, len(tokens), capacity):
            piece = np.array(tokens[i:i + capacity], "<u4").tobytes()
            want[d["doc_id"], i // capacity, i, len(piece) // 4, zlib.crc32(piece), len(tokens)] += 1
            if ids:
                want[d["doc_id"], i, piece] += 1
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    if ids:
        got += Counter((r["doc_id"], r["start"], bytes(r["ids"])) for r in rows)
    assert got == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing_of_odd_rows(spark, encoder, capacity):
    docs = odd_documents(spark)
    rows = bin_packing.pack(docs, queries.byte_model(queries.WORD_MODEL), capacity, ids=True).collect()
    check_packed(encoder, docs.collect(), rows, capacity)
    assert bin_packing.pack(empty_documents(spark), queries.byte_model(queries.WORD_MODEL)).count() == 0


def test_packing_needs_hardly_more_than_the_least_number(spark, encoder):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id = 7").crossJoin(spark.range(150)).drop("id"))  # one length holds a third
    rows = queries.bin_packing.pack(docs.repartition(7), queries.byte_model(queries.WORD_MODEL)).collect()
    bins = check_packed(encoder, docs.collect(), rows, 2048, ids=False)
    assert bins <= -(-sum(r["length"] for r in rows) // 2048) + 2


# --- importance resampling ---


def resampled_by_hand(docs, target, percent=10, run=1, buckets=10_000):
    def found(text):
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        grams = [" ".join(words[i:i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]

    s, t = Counter(), Counter()
    for d in docs:
        s.update(found(d["text"])[1])
    for x in target:
        t.update(found(x)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for d in docs:
        words, b = found(d["text"])
        weight = sum(math.floor(1000 * math.log((t[x] + 1) * (S + buckets) / ((s[x] + 1) * (T + buckets)))) for x in b)
        key = "2024:" + ("" if d["doc_id"] is None else str(d["doc_id"]))
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        out.append((d["doc_id"], len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    eligible = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = defaultdict(list)
    for i, r in enumerate(eligible[:len(eligible) * percent // 100]):
        rank[r].append(i + 1)
    return sorted(((*r[:4], rank[r].pop(0) if rank[r] else None) for r in out), key=repr)


@pytest.mark.parametrize("run, percent", [(1, 10), (3, 70)])
def test_resampling_of_odd_rows(spark, run, percent):
    docs = odd_documents(spark)
    target = spark.createDataFrame([("river stone GAMMA 漢字 delta",), (None,), ("",)], "text string")
    got = importance_resampling.resample(docs, target, percent=percent, run=run)
    want = resampled_by_hand(docs.collect(), [r["text"] for r in target.collect()], percent, run)
    assert rows_of(got, "doc_id", "n_features", "weight", "score", "rank") == want
    assert rows_of(importance_resampling.resample(docs, target.limit(0)), "doc_id", "n_features", "weight", "score", "rank") == resampled_by_hand(docs.collect(), [])


def test_resampling_of_an_empty_table(spark):
    target = spark.createDataFrame([("a",)], "text string")
    out = importance_resampling.resample(empty_documents(spark), target)
    assert out.count() == 0 and out.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_ranks_where_one_key_holds_a_third(spark):
    n = 6000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.hash("id"), F.lit(900))).cast("long").alias("score"),
        F.when(F.col("id") % 9 == 0, None).when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") % 50).cast("long").alias("doc_id"),
        F.col("id").alias("row")).repartition(6)
    got = importance_resampling.ranked(rows, lambda c: c * 9 // 10, ranges=40).collect()
    ordered = sorted(got, key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0, r["row"]))
    assert [r["rank"] for r in ordered] == [i + 1 if i < n * 9 // 10 else None for i in range(n)]
    splitters = importance_resampling.regular_splitters(rows, n, 40)
    keys = tuple(np.array(k, np.int64) for k in zip(*[(-r["score"], int(r["doc_id"] is None), r["doc_id"] or 0, r["row"]) for r in got]))
    sizes = np.bincount(importance_resampling.range_of(keys, splitters))
    assert len(sizes) == 40 and sizes.max() < 2.5 * n / 40
