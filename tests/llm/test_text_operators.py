"""Codec, language ID, packing, sharding: brute force, round trips, held-out accuracy, odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import language_id, packing, queries, sentencepiece_codec, sharding

from ..conftest import SF001
from .helpers import empty_documents, odd_documents, odd_texts


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec._tools(queries.piece_model())


@pytest.fixture(scope="module")
def tokenizer():
    return packing._tokenizer(queries.byte_model())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab the ▁\n\t\réß漢😀\x00<s>x"), max_size=40), max_size=5))
def test_codec_equals_library(codec, texts):
    own, library = codec
    for text, (ids, decoded, agrees) in zip(texts, own.encode_batch(texts, library)):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == library.decode(want) == own.decode(want)
        assert agrees


def test_side_by_side_merging_equals_the_agenda(codec):
    own = codec[0]
    cuts = sorted({c for t in odd_texts() if t for c in own.cuts.findall("▁" + t.replace(" ", "▁"))})
    for cut, ids in zip(cuts, own.merge_short(cuts)):
        if ids is not None:
            assert np.frombuffer(ids, "<u4").tolist() == own.merge(cut)


def test_memo_generations(codec, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "MEMO", 50)
    own = sentencepiece_codec.Codec(queries.piece_model())
    for _ in range(2):
        for text in filter(None, odd_texts()):
            assert np.frombuffer(own.encode_batch([text])[0][0], "<u4").tolist() == codec[1].encode(text, add_bos=True, add_eos=True)


def test_codec_rows(spark, codec):
    docs = odd_documents(spark)
    got = sentencepiece_codec.encode_documents(docs, queries.piece_model(), texts=True).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(got) == docs.count()
    for r in got:
        want = codec[1].encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert r["ids"] == want and r["n_tokens"] == len(want) and r["library_agrees"]
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(codec[1].decode(want).encode()).hexdigest()
    assert sentencepiece_codec.encode_documents(empty_documents(spark), queries.piece_model()).count() == 0


def test_unsupported_models_are_rejected():
    with pytest.raises(ValueError):
        sentencepiece_codec.Vocabulary(b"\x0a\x05\x0a\x03abc")


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1


def test_language_uses_text_alone(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    held = (language_id.fold(F.col("doc_id")) == 1)
    other = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    assert sorted(map(tuple, language_id.identify(docs).collect())) == sorted(map(tuple, language_id.identify(other).collect()))


def test_language_odd_rows(spark):
    docs = odd_documents(spark)
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    for r in docs.collect():
        none = not any(map(str.isalpha, r["text"] or ""))
        assert (got[r["doc_id"]]["lang_pred"] == "und") == none
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}
    assert language_id.identify(empty_documents(spark)).count() == 0


def _ideographic(rng, own, common):
    return "".join(chr(rng.choice(own if rng.random() < 0.4 else common)) for _ in range(80))


def test_languages_of_many_letters_are_told_apart():
    """Two ideographic languages that share their 70 most common characters."""
    rng = random.Random(9)
    common = range(0x4E00, 0x4E00 + 70)
    own = {"qa": range(0x5000, 0x5400), "qb": range(0x6000, 0x6400)}
    texts = [(_ideographic(rng, own[lang], common), lang) for _ in range(150) for lang in own]
    model = language_id.fit(texts[:200], 60)
    names, _ = model.predict([t for t, _ in texts[200:]])
    assert sum(a == lang for a, (_, lang) in zip(names, texts[200:])) >= 0.95 * 100


def test_kernel_of_many_letters_by_brute_force():
    rng = random.Random(3)
    texts = ["".join(chr(rng.choice([*range(0x4E00, 0x4E50), *range(0x61, 0x71), 0x20, 0x20000])) for _ in range(rng.randint(1, 60))) for _ in range(30)]
    model = language_id.fit([(t, "a" if i % 2 else "b") for i, t in enumerate(texts)], 20)

    def grams(text):
        c = [0, *(ord(ch) if ch.isalpha() else 0 for ch in text.lower()), 0]
        return {g for n in (1, 2, 3) for i in range(len(c) - n + 1) if any(g := tuple(c[i:i + n]))}

    chosen = [t for pair in zip(texts[::2], texts[1::2]) for t in pair[::-1]][:20]
    want = [[len(grams(t) & grams(u)) / (max(1, len(grams(t))) * max(1, len(grams(u)))) ** 0.5 for u in chosen] for t in texts]
    assert np.allclose(model.kernel(texts), want, atol=1e-5)


def test_presence_kernel_by_brute_force():
    spectrum = language_id.Spectrum(["abc abd", "xyz"])
    flags = np.zeros(language_id.FEATURES, bool)

    def grams(text):
        c = [0, *(int(spectrum.numbers[ord(ch)]) for ch in text.lower()), 0]
        found = {tuple(c[i:i + n]) for n in (1, 2, 3) for i in range(len(c) - n + 1)}
        return {g for g in found if any(g)}

    for text in ("abc", "a", "Abd xyz!", "ab ab ab"):
        assert spectrum.present(text, flags) == len(grams(text))


def _check_packing(rows, ids_of, capacity):
    """Every id in one piece, gapless offsets, sizes within capacity; returns the padding."""
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        documents.setdefault(r["doc_id"], []).append(r)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & at - 1 == 0 else capacity - at
    for doc_id, own in documents.items():
        want = ids_of[doc_id]
        copies = sum(r["start"] == 0 for r in own)
        assert sum(r["length"] for r in own) == copies * len(want)
        for r in own:
            assert r["doc_tokens"] == len(want)
            piece = np.array(want[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(piece) and bytes(r["ids"]) == piece
    return padding


@pytest.mark.parametrize("capacity", [1024, 64, 16])
def test_packing_rows(spark, tokenizer, capacity):
    docs = odd_documents(spark)
    ids_of = {r["doc_id"]: tokenizer.library.encode(r["text"] or "", add_special_tokens=False).ids + [0] for r in docs.collect()}
    got = packing.pack(docs, queries.byte_model(), capacity=capacity, ids=True).collect()
    assert {r["doc_id"] for r in got} == set(ids_of)
    assert _check_packing(got, ids_of, capacity) == 0
    assert packing.pack(empty_documents(spark), queries.byte_model()).count() == 0


def test_packing_one_hot_length(spark, tokenizer):
    text = " river" * 699
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    want = tokenizer.library.encode(text, add_special_tokens=False).ids + [0]
    got = packing.pack(docs, queries.byte_model(), ids=True).collect()
    assert _check_packing(got, dict.fromkeys(range(200), want), 1024) == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 4), min_size=1, max_size=6), st.integers(5, 40))
def test_fill_is_closest_to_capacity(counts, capacity):
    picked = packing.fill(counts, capacity)
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1)}
    assert sum(k * n for k, n in picked.items()) == max(s for s in sums if s <= capacity)
    assert all(n <= counts[k] for k, n in picked.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 50), max_size=20))
def test_plan_windows_are_full(histogram):
    windows, used = packing.plan(histogram, 64)
    total = {}
    for length, low, high, each, sequence, _ in windows:
        assert (high - low) % each == 0
        for i in range((high - low) // each):
            total[sequence + i] = total.get(sequence + i, 0) + each * length
    assert set(total.values()) <= {64} and sorted(total) == list(range(len(total)))
    assert all(0 <= used[k] <= n for k, n in histogram.items())


def test_tokenizer_fast_path_equals_library(tokenizer):
    texts = [t or "" for t in odd_texts()] + ["a<|endoftext|> b", "\x85 q", "　w", "it's\n\n  x"]
    assert tokenizer.fast is not None
    assert tokenizer.encode(texts) == [tokenizer._library(t) for t in texts]


def _check_shards(docs, rows, shards, slack):
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert len(rows) == docs.count()
    loads, slots = [0] * shards, {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads) - min(loads) <= slack
    return loads


def test_sharding_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = sharding.shard(docs).collect()
    sizes = [r["size"] for r in got]
    _check_shards(docs, got, 8, max(sizes))
    texts = {}
    for r in got:
        texts.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in texts.values())


def test_sharding_odd_rows(spark):
    docs = odd_documents(spark)
    _check_shards(docs, sharding.shard(docs).collect(), 8, 1 << 20)
    assert sharding.shard(empty_documents(spark)).count() == 0


def test_sharding_splits_a_text_that_holds_a_third(spark):
    copies = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("the same words again").alias("text"))
    others = spark.range(2000, 6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))
    docs = copies.unionByName(others)
    got = sharding.shard(docs, shards=8, ranges=200).collect()
    loads = _check_shards(docs, got, 8, 10_000)
    assert max(loads) <= 1.02 * sum(loads) / 8


@pytest.mark.parametrize("doc_id", [None, 7])
def test_sharding_splits_rows_without_an_id_of_their_own(spark, doc_id):
    docs = spark.range(3000).select(F.lit(doc_id).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    got = sharding.shard(docs, shards=8).collect()
    loads = _check_shards(docs, got, 8, 9 * 40)
    assert min(loads) > 0


def test_sharding_of_giant_and_tiny_texts(spark):
    rows = [(i, "x" * 300_000 + str(i % 3)) for i in range(12)] + [(i, f"t{i}") for i in range(12, 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    _check_shards(docs, sharding.shard(docs, shards=4).collect(), 4, 310_000)


def test_slots_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 7)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    _check_shards(docs, sharding.shard(docs, ranges=8).collect(), 8, 1 << 20)


def test_splitters_keep_light_texts_whole():
    assert sharding.settle([(5, 9), (7, 1), (7, 4), (9, 2)]) == [
        (5, sharding.LOWEST), (7, sharding.LOWEST), (7, 1), (7, 4), (8, sharding.LOWEST), (9, sharding.LOWEST)]


@pytest.mark.parametrize("make", [
    lambda n: "a" + " " * n + "end", lambda n: "\n" * n, lambda n: " \t\n" * (n // 3) + " ", lambda n: "a" * n, lambda n: "7" * n, lambda n: "!?" * n])
def test_long_runs_are_encoded_like_the_library(tokenizer, make):
    assert tokenizer.fast is not None
    for n in (packing.SPACES - 1, packing.SPACES, packing.SPACES + 1, 1_100_000):
        text = make(n)
        assert tokenizer.encode([text, "plain"])[0] == tokenizer._library(text)


def test_packing_of_a_million_spaces(spark):
    docs = spark.createDataFrame([(1, " " * 1_100_000), (2, "plain")], "doc_id long, text string")
    got = packing.pack(docs, queries.byte_model()).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == {1: 1_100_001, 2: 2}


def test_encoders_that_differ_raise_an_error(monkeypatch):
    own = packing.Tokenizer(queries.byte_model())
    monkeypatch.setattr(own, "_quick", lambda text: b"")
    with pytest.raises(ValueError, match="differ"):
        own.encode(["some text"])
    monkeypatch.setattr(packing.Tokenizer, "_quick", lambda self, text: b"")
    assert packing.Tokenizer(queries.byte_model()).fast is None
