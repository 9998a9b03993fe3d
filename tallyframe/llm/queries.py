"""The operators applied to their whole tables with production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import (
    bin_packing,
    exact_dedup,
    html_extract,
    importance_resampling,
    language_id,
    line_dedup,
    packing,
    pii_surrogates,
    product_codes,
    sentencepiece_codec,
    sharding,
    simhash_dedup,
    topk_search,
)
from tallyframe.sources.tables import load

#: Files of public tokenizers: read on the driver, sent to the tasks by content.
PIECE_MODEL, BYTE_MODEL = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def piece_model(path: str = PIECE_MODEL) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def byte_model(path: str = BYTE_MODEL) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(load(spark, sf_dir, "documents"), piece_model())


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(load(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(load(spark, sf_dir, "documents")).drop("text_hash")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace_entities(load(spark, sf_dir, "documents", ["doc_id", "text"]))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), byte_model())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(load(spark, sf_dir, "documents")).drop("text_hash")


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.topk(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(load(spark, sf_dir, "documents")).drop("text_hash")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(load(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(load(spark, sf_dir, "documents")).drop("text_hash")


def op11_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_codes.encode(load(spark, sf_dir, "embeddings"))


def op12_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.pack(load(spark, sf_dir, "documents"), byte_model(WORD_MODEL))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_html_extraction, op3_sharding, op4_pii_surrogates, op5_packing, op6_language_id,
        op7_topk_search, op8_simhash_dedup, op9_line_dedup, op10_exact_dedup, op11_product_codes, op12_bin_packing,
        op13_importance_resampling,
    )
}

def _codes_sql(rounds: int = 4) -> str:
    """Exact product codes: every part against every entry of its position, round by round."""
    steps = ["""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT r, CAST(p AS INTEGER) AS p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x FROM (SELECT r, v, unnest(range(4)) AS p FROM v)
), b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM x WHERE r <= 256)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, x.p, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}}) AS m
  FROM x JOIN b{i} b ON x.p = b.p GROUP BY r, x.p
)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
  SELECT p, e, list(c ORDER BY j) AS c FROM (
    SELECT p, e, j, CAST(floor(sum(y) / count(*)) AS BIGINT) AS c
    FROM (SELECT a.p, m.e AS e, unnest(x) AS y, unnest(range(len(x))) AS j FROM a{i} a JOIN x USING (r, p)) GROUP BY p, e, j) GROUP BY p, e
), b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(s.c, b.c) AS c FROM b{i} b LEFT JOIN s{i} s USING (p, e))""")
    steps.append(f"""f AS (
  SELECT vec_id, label, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{rounds} JOIN v USING (r) GROUP BY r, vec_id, label
), h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM f, h""")
    return ",\n".join(steps)


ORACLE = {
    "op11_product_codes": _codes_sql(),
    "op13_importance_resampling": """
WITH tab AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS tab
  FROM (SELECT unnest(range(256)) AS b)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents
), goal AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark
), n AS MATERIALIZED (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(ws) AS w FROM docs) GROUP BY r, w),
u AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_transform(range(octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)),
    lambda c, y: xor(c // 256, tab[CAST(xor(c % 256, y) + 1 AS INTEGER)]), 4294967295), 4294967295) % 10000 AS b
  FROM (SELECT DISTINCT w FROM (SELECT w FROM n UNION ALL SELECT w FROM goal)), tab
), s AS (SELECT b, sum(n) AS s FROM n JOIN u USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM goal JOIN u USING (w) GROUP BY b),
big AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS s, coalesce((SELECT sum(t) FROM t), 0) AS t),
g AS (
  SELECT b, CAST(floor(1000 * ln(CAST((coalesce(t.t, 0) + 1) * (big.s + 10000) AS DOUBLE) / CAST((coalesce(s.s, 0) + 1) * (big.t + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM (SELECT DISTINCT b FROM u) LEFT JOIN s USING (b) LEFT JOIN t USING (b), big
), w AS (SELECT r, CAST(sum(n.n * g.g) AS BIGINT) AS weight FROM n JOIN u USING (w) JOIN g USING (b) GROUP BY r),
d AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN w USING (r)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS all_n FROM d
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * all_n // 100 THEN place END AS rank FROM o""",
    "op7_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20""",
    "op9_line_dedup": """
WITH l AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(list_zip(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)),
    range(len(string_split(coalesce(text, ''), chr(10))))), lambda p: p[1] <> '') AS ls FROM documents
), c AS MATERIALIZED (
  SELECT doc_id, i, ls[i + 1][2] AS line_no, ls[i + 1][1] AS line, len(regexp_extract_all(ls[i + 1][1], '[^\\x20\\x09-\\x0D]+')) AS words
  FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS i FROM l)
), pairs AS (
  -- Equal lines of a later and an earlier place, side by side along their diagonal.
  SELECT b.doc_id, b.i, b.line_no, b.words, a.doc_id AS other, b.i - a.i AS diagonal
  FROM c b JOIN c a ON a.line = b.line AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.i < b.i)
), runs AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, other, diagonal ORDER BY i) AS run FROM pairs
), maximal AS (
  SELECT doc_id, list(line_no) AS ats FROM runs GROUP BY doc_id, other, diagonal, run HAVING count(*) >= 3 OR sum(words) >= 50
), g AS (SELECT doc_id, list(DISTINCT a) AS gone FROM (SELECT doc_id, unnest(ats) AS a FROM maximal) GROUP BY doc_id)
SELECT l.doc_id, CAST(len(l.ls) AS BIGINT) AS n_lines, CAST(coalesce(len(g.gone), 0) AS BIGINT) AS n_removed,
  CASE WHEN g.gone IS NULL THEN l.text ELSE coalesce(array_to_string(list_transform(list_filter(
    list_zip(string_split(l.text, chr(10)), range(len(string_split(l.text, chr(10))))),
    lambda p: NOT list_contains(g.gone, p[2])), lambda p: p[1]), chr(10)), '') END AS text
FROM l LEFT JOIN g USING (doc_id)""",
    "op10_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, CAST(count(*) OVER w AS BIGINT) AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)""",
}
