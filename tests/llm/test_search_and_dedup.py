"""Top-k, exact and near dedup, line dedup against brute force, with odd rows."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import exact_dedup, line_dedup, simhash_dedup, topk_search

from ..conftest import SF001
from .helpers import empty_documents, odd_documents, odd_texts, rows_of

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _topk(rows, k):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in vectors:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2048, 8192), (3, 17)])
def test_topk_by_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk_search, "ROW_BLOCK", blocks[1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 24).tolist()) for i in range(160)]
    rows += [(i, rows[0][1]) for i in range(160, 220)]  # a very common vector: ties
    rows += [(300, None), (301, [None, 1.0]), (320, [float("nan")] * 24), (340, [float("inf")] * 24), (None, [0.1] * 24), (360, []), (361, [0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).repartition(5)
    exact = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    got = topk_search.topk(vectors, F.col("vec_id") % 20 == 0)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(_topk(exact, 20), key=repr)


def test_topk_large_values_and_few_rows(spark):
    big = [(0, [1e12, -1e12]), (20, [1e12, 1e12]), (3, [1.0, 2.0])]
    vectors = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    assert rows_of(topk_search.topk(vectors, F.col("vec_id") % 20 == 0), "query_id", "vec_id", "rank") == [
        (0, 20, 1), (0, 3, 2), (20, 0, 2), (20, 3, 1)]
    assert topk_search.topk(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_segment_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(20, 37)), rng.normal(size=(30, 37))
    last = np.inf
    for s in topk_search.SEGMENTS:
        bound = topk_search.statistics(a, s) @ topk_search.statistics(b, s).T
        assert (bound >= a @ b.T - 1e-9).all()
        assert bound.mean() <= last
        last = bound.mean()


def _exact(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(FOLD), []).append(doc_id)
    return groups


@pytest.mark.parametrize("fingerprint, digest", [(None, None), ("7L", None), ("bigint(length(norm))", "sha2('x', 256)")])
def test_exact_dedup_by_brute_force(spark, fingerprint, digest):
    force = {k: F.expr(v) for k, v in (("fingerprint", fingerprint), ("digest", digest)) if v}
    docs = odd_documents(spark)
    groups = _exact((r["doc_id"], r["text"]) for r in docs.collect())
    got = exact_dedup.exact_dedup(docs, **force).collect()
    texts = {r["doc_id"]: (r["text"] or "").translate(FOLD) for r in docs.collect()}
    kept = []
    for r in got:
        own = groups[texts[r["doc_id"]]]
        assert r["group_size"] == len(own)
        assert r["keep_id"] == (max(i for i in own if i is not None) if any(i is not None for i in own) else None)
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
            kept.append(texts[r["doc_id"]])
    assert sorted(kept) == sorted(groups) and len(got) == docs.count()
    assert exact_dedup.exact_dedup(empty_documents(spark)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**61 - 1) | st.integers(0, 40), max_size=60), min_size=1, max_size=4))
def test_quotient_filters_merge_losslessly(parts):
    def one(values):
        v, n = np.unique(np.array(values, np.uint64), return_counts=True)
        return exact_dedup.QuotientFilter.from_bytes(exact_dedup.QuotientFilter.of(v, n, 61).to_bytes())

    merged = exact_dedup.QuotientFilter.merged([one(p) for p in parts])
    values, counts = merged.items()
    want, n = np.unique(np.array(list(itertools.chain(*parts)), np.uint64), return_counts=True)
    assert values.tolist() == want.tolist() and counts.tolist() == n.tolist()


def test_filters_in_segments(spark, monkeypatch):
    rng = random.Random(2)
    values = [rng.randint(-2**63, 2**63 - 1) for _ in range(500)]
    rows = [(v,) for v in values + values[:60] + values[:5]]
    table = spark.createDataFrame(rows, "fp long").repartition(7)
    for bits in (0, 3):
        got = exact_dedup.repeated_fingerprints(exact_dedup.merged_filters(table, "fp", bits), bits)
        assert rows_of(got, "fp", "copies") == sorted([(v, 3) for v in values[:5]] + [(v, 2) for v in values[5:60]], key=repr)


def _simhash(text, k=4):
    import re

    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(FOLD).encode())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_by_brute_force(spark):
    for text in odd_texts():
        if len(text or "") < 6000:
            assert simhash_dedup.simhash(text) == _simhash(text)
    docs = odd_documents(spark)
    rows = [(r["doc_id"], simhash_dedup.simhash(r["text"])) for r in docs.collect()]
    top = _components(sorted({f for _, f in rows}), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, f in rows:
        if i is not None:
            least[top[f]] = min(i, least.get(top[f], i))
    want = sorted(((i, f"{f:016x}", least.get(top[f])) for i, f in rows), key=repr)
    assert rows_of(simhash_dedup.simhash_dedup(docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash_dedup.simhash_dedup(empty_documents(spark)).count() == 0


def _near_prints(n, seed):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            out.add(f)
            for _ in range(rng.randint(1, 6)):
                f ^= 1 << rng.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("parts", [2, 4])
@pytest.mark.parametrize("chunk", [1 << 14, 3])
def test_tiles_find_all_links(spark, parts, chunk):
    prints = _near_prints(220, parts * 10 + chunk)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash_dedup.links(table, parts=parts, chunk_rows=chunk)
    for r in edges.collect():
        assert r["u"] in signed and r["v"] in signed
    got = {r["node"]: r["root"] for r in simhash_dedup.components(edges).collect()}
    top = _components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert {p: got.get(p, p) for p in signed} == top


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(300, 300), (201, 200), (200, 201)]
    got = simhash_dedup.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in got} == {**dict.fromkeys(range(1, 61), 0), **dict.fromkeys(range(101, 180), 100), 201: 200}


def _line_dedup(rows, run, words):
    """Every maximal run that equals an earlier one, found by extending each pair of equal lines both ways."""
    docs = []
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = text.split("\n")
        docs.append((doc_id, lines, [(i, x.strip(" ")) for i, x in enumerate(lines) if x.strip(" ")]))
    places, out = {}, {}
    for d, (_, _, solid) in enumerate(docs):
        for i, (_, x) in enumerate(solid):
            places.setdefault(x, []).append((d, i))
    for d, (doc_id, lines, solid) in enumerate(docs):
        gone, done = set(), set()
        for i, (_, x) in enumerate(solid):
            for e, j in places[x]:
                if (e, j) >= (d, i) or (e, j - i, i) in done:
                    continue
                other, low, high = docs[e][2], 0, 0
                while high + 1 < len(solid) - i and high + 1 < len(other) - j and solid[i + high + 1][1] == other[j + high + 1][1]:
                    high += 1
                while low < min(i, j) and solid[i - low - 1][1] == other[j - low - 1][1]:
                    low += 1
                part = solid[i - low:i + high + 1]
                done.update((e, j - i, k) for k in range(i - low, i + high + 1))
                if len(part) >= run or len(re.findall(r"[^\x20\x09-\x0D]+", "\n".join(y for _, y in part))) >= words:
                    gone.update(k for k, _ in part)
        out[doc_id] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(solid), len(gone))
    return out


@pytest.mark.parametrize(("run", "words"), [(1, 50), (2, 2), (3, 50), (5, 3)])
def test_line_dedup_by_brute_force(spark, run, words):
    rng = random.Random(run)
    texts = ["\n".join(rng.choice(["a", "b", " c ", "", "  ", "d e"]) for _ in range(rng.randint(0, 14))) for _ in range(60)]
    docs = odd_documents(spark, [*odd_texts(), *texts])
    want = _line_dedup([(r["doc_id"], r["text"] or "") for r in docs.collect()], run, words)
    got = line_dedup.line_dedup(docs, run, words).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r["text"], r["n_lines"], r["n_removed"]) == want[r["doc_id"]], r["doc_id"]
    assert line_dedup.line_dedup(empty_documents(spark)).count() == 0


def test_one_common_line_run_in_a_third_of_the_documents(spark):
    common = "x y\nz\nw"
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(common)).otherwise(
        F.concat(F.lit("own "), F.col("id").cast("string"), F.lit("\nline\nmore"))).alias("text"))
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.line_dedup(docs).collect()}
    assert all(got[i] == (3 if i % 3 == 0 and i else 0) for i in range(300))


def test_a_passage_of_over_fifty_words_in_one_or_two_lines(spark):
    one, left, right = (" ".join(f"{p}{i}" for i in range(n)) for p, n in (("o", 51), ("l", 30), ("r", 30)))
    rows = [(1, f"first\n{one}\nend"), (2, f"{one}\nother"), (3, f"a\n{left}\n\n{right}"), (4, f"{left}\n{right}\nb"), (5, left)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs).collect()}
    assert got == {**dict(rows), 2: "other", 4: "b"}


def test_a_long_and_a_short_line_go_together(spark):
    long, short = " ".join(f"w{i}" for i in range(60)), "a short line"
    rows = [(1, f"x\n{long}\n{short}\ny"), (2, f"{long}\n{short}\nend"), (3, f"{short}\n{long}"), (4, f"q\n{short}"), (5, f"{short}\n{long}\nr")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "end", 3: short, 4: rows[3][1], 5: "r"}


def test_simhash_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], _simhash(r["text"])) for r in docs.collect()]
    top = _components(sorted({f for _, f in rows}), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, f in rows:
        least[top[f]] = min(i, least.get(top[f], i))
    assert rows_of(simhash_dedup.simhash_dedup(docs), "doc_id", "fingerprint", "component_id") == sorted(
        ((i, f"{f:016x}", least[top[f]]) for i, f in rows), key=repr)


def _clustered(seed=5, clusters=40, rows=6000, width=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (clusters, width)).repeat(4, axis=1)[:, :width] * rng.uniform(0.5, 2, (clusters, 1))
    return np.floor(64 * (centres[rng.integers(0, clusters, rows)] + rng.normal(0, 0.02, (rows, width))))


def test_bounds_save_exact_scores_on_clustered_vectors():
    rows, kept = _clustered(), collections.Counter()
    ids = np.arange(len(rows))
    a, b, s = topk_search.best(ids[::20], rows[::20], ids, rows, 20, kept=kept)
    assert kept["exact"] < 0.1 * kept["pairs"] and kept["before 4"] < kept["before 1"]
    full = rows[::20] @ rows.T
    for i, q in enumerate(ids[::20]):
        order = sorted((-full[i, j], j) for j in ids if j != q)[:20]
        assert [(-score, j) for score, j in order] == list(zip(s[a == q].tolist(), b[a == q].tolist()))


def test_cells_that_no_query_needs_are_not_sent():
    rows = _clustered(seed=6)
    pivots = rows[:64]
    cell = topk_search.home_cells(rows, pivots)
    stats = topk_search.statistics(rows, topk_search.CELL_SEGMENTS)
    low, high = np.full((64, stats.shape[1]), np.inf), np.full((64, stats.shape[1]), -np.inf)
    np.minimum.at(low, cell, stats)
    np.maximum.at(high, cell, stats)
    used = np.unique(cell)
    bounds = topk_search.cell_bounds(rows[::50], low[used], high[used])
    scores = rows[::50] @ rows.T
    for j, c in enumerate(used):
        assert (scores[:, cell == c].max(axis=1) <= bounds[:, j] * (1 + 1e-9) + 1e-6).all()
    kth = np.sort(scores, axis=1)[:, -21]
    assert (bounds >= kth[:, None]).mean() < 0.3


def test_topk_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "ROW_BLOCK", 100)
    monkeypatch.setattr(topk_search, "CELLS", 8)
    monkeypatch.setattr(topk_search, "SAMPLE", 50)
    rows = [(i, (v / 64).tolist()) for i, v in enumerate(_clustered(seed=7, clusters=6, rows=500, width=32))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert rows_of(topk_search.topk(vectors, F.col("vec_id") % 20 == 0), "query_id", "rank", "vec_id", "score") == sorted(_topk(rows, 20), key=repr)
