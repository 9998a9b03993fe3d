"""Sketch plans. Class C plans return (group, exact, within_bound): the estimate's accuracy contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import monoid, quantile_tree, sketch
from tallyframe.plans.catalog import register
from tallyframe.sources import load, materialize


def _exact_vs(est_df, exact_df, keys, rse):
    j = est_df.join(exact_df, keys)
    return j.select(*keys, "exact", sketch.within_bound(F.col("est"), F.col("exact"), rse).alias("within_bound"))


@register(
    "hll_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS exact, true AS within_bound FROM events GROUP BY event_type",
)
def q_hll_distinct(spark, sf):
    ev = load(spark, sf, "events", ["event_type", "user_id"])
    # Apart: one aggregate with both would build a sketch for every (type, user) pair.
    est = ev.groupBy("event_type").agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 12)).alias("est"))
    exact = ev.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    return _exact_vs(est, exact, ["event_type"], sketch.hll_rse(12))


@register(
    "hll_rollup",
    "SELECT event_type, count(DISTINCT user_id) AS exact, true AS within_bound FROM events GROUP BY event_type",
)
def q_hll_rollup(spark, sf):
    """Daily sketches per event type are stored, then merged to the month without touching raw rows."""
    ev = load(spark, sf, "events", ["event_type", "user_id", "ts"])
    daily = sketch.hll_sketch(ev.withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id", 14)
    stored = materialize(daily, "hll-daily")  # one sketch per (type, day), kept as a table
    month = sketch.hll_merge(stored, ["event_type"]).select("event_type", sketch.hll_estimate("sketch").alias("est"))
    exact = ev.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    return _exact_vs(month, exact, ["event_type"], sketch.hll_rse(14))


@register(
    "hll_error",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS exact, true AS within_bound FROM lineitem GROUP BY 1",
)
def q_hll_error(spark, sf):
    """Distinct-count error rate in percent, (estimate / exact − 1)·100, checked against 4 standard errors."""
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_partkey"])
    est = li.groupBy("l_returnflag").agg(F.hll_sketch_estimate(F.hll_sketch_agg("l_partkey", 12)).alias("est"))
    exact = li.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("exact"))
    agg = est.join(exact, "l_returnflag")
    err_pct = (F.col("est") / F.col("exact") - 1) * 100
    return agg.select("l_returnflag", "exact",
                      (F.abs(err_pct) <= F.lit(400 * sketch.hll_rse(12)) + F.lit(100.0) / F.col("exact")).alias("within_bound"))


BLOOM_SQL = """
    WITH items AS (SELECT DISTINCT o_custkey AS item FROM orders WHERE o_custkey IS NOT NULL),
    prm AS (SELECT CAST(ceil(-count(*) * ln(0.01) / (ln(2.0) * ln(2.0))) AS BIGINT) AS m, count(*) AS n FROM items),
    prm2 AS (SELECT m, CAST(greatest(round(m / n * ln(2.0)), 1) AS BIGINT) AS k FROM prm),
    hashed AS (SELECT i.item, ('0x' || substr(md5(CAST(i.item AS VARCHAR)), 1, 8))::BIGINT AS h1,
                      ('0x' || substr(md5(CAST(i.item AS VARCHAR)), 9, 8))::BIGINT AS h2, p.m, p.k
               FROM items i, prm2 p),
    bits AS (SELECT DISTINCT 1 + ((h1 + j * h2) % m) AS pos FROM hashed, range(0, k) r(j)),
    probes AS (SELECT DISTINCT c_custkey AS item FROM customer),
    ph AS (SELECT q.item, p.k, 1 + ((('0x' || substr(md5(CAST(q.item AS VARCHAR)), 1, 8))::BIGINT
                     + j * ('0x' || substr(md5(CAST(q.item AS VARCHAR)), 9, 8))::BIGINT) % p.m) AS pos
           FROM probes q, prm2 p, range(0, p.k) r(j)),
    mem AS (SELECT ph.item, count(b.pos) = max(ph.k) AS in_filter FROM ph LEFT JOIN bits b ON ph.pos = b.pos GROUP BY ph.item)
"""


@register(
    "bloom_build",
    BLOOM_SQL + "SELECT m, k, count(*) AS bits_set FROM bits, prm2 GROUP BY m, k",
)
def q_bloom_build(spark, sf):
    o = load(spark, sf, "orders", ["o_custkey"])
    filt, params = sketch.bloom_build(o, [], "o_custkey", 0.01)
    return params.withColumn("bits_set", sketch.bloom_bits_set(filt).scalar())


@register(
    "bloom_semi_join",
    BLOOM_SQL + """
    SELECT m.item AS c_custkey, m.in_filter, EXISTS (SELECT 1 FROM items i WHERE i.item = m.item) AS has_orders
    FROM mem m
    """,
)
def q_bloom_semi_join(spark, sf):
    """Customers probed against a Bloom filter of ordering customers: no false negatives, few false positives."""
    o = load(spark, sf, "orders", ["o_custkey"])
    c = load(spark, sf, "customer", ["c_custkey"])
    filt, params = sketch.bloom_build(o, [], "o_custkey", 0.01)
    member = sketch.bloom_contains(filt, params, c, [], "c_custkey")
    has = o.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has_orders", F.lit(True))
    out = member.join(has, "c_custkey", "left")
    return out.select("c_custkey", "in_filter", F.coalesce("has_orders", F.lit(False)).alias("has_orders"))


@register(
    "qtree_bounds",
    """
    WITH v AS (SELECT CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
    h AS (SELECT CAST(floor(cents / 65536) AS BIGINT) AS b, count(*) AS c FROM v GROUP BY 1),
    cum AS (SELECT b, sum(c) OVER (ORDER BY b ROWS UNBOUNDED PRECEDING) AS cum, sum(c) OVER () AS n FROM h),
    ps AS (SELECT unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS p)
    SELECT p, min(b) FILTER (WHERE cum >= greatest(ceil(p * n), 1)) * 65536 AS lower,
           min(b) FILTER (WHERE cum >= greatest(ceil(p * n), 1)) * 65536 + 65535 AS upper
    FROM cum, ps GROUP BY p
    """,
)
def q_qtree_bounds(spark, sf):
    o = load(spark, sf, "orders", ["o_totalprice"])
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return sketch.qtree_bounds(o, [], cents, [0.25, 0.5, 0.75], level=16)


@register(
    "kll_quantile",
    "SELECT unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS p, true AS within_bound",
)
def q_kll_quantile(spark, sf):
    """KLL quantiles of order prices (cents); contract: the estimate's true rank is within 2% of p."""
    o = load(spark, sf, "orders", ["o_totalprice"]).select(F.round(F.col("o_totalprice") * 100).cast("bigint").alias("v"))
    sk = sketch.kll_sketch(o, [], "v")
    ps = [0.25, 0.5, 0.75]
    # each estimate is a scalar subquery; its true rank is one conditional count, all three in one pass
    packed = sk.select(F.struct(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(f"q{i}")
                                  for i, p in enumerate(ps)])).scalar()
    qs = [packed.getField(f"q{i}") for i in range(len(ps))]
    ranks = o.agg(F.count(F.lit(1)).alias("n"),
                  *[F.sum(F.when(F.col("v") <= q, 1).otherwise(0)).alias(f"r{i}") for i, q in enumerate(qs)])
    rows = F.array(*[F.struct(F.lit(p).alias("p"), (F.col(f"r{i}") / F.col("n")).alias("f")) for i, p in enumerate(ps)])
    return ranks.select(F.inline(rows)).select("p", (F.abs(F.col("f") - F.col("p")) <= 0.02).alias("within_bound"))


CMS_EPS, CMS_DELTA = 0.01, 1e-3


def _cms_sql(src, item, eps_w, depth):
    return f"""
    WITH items AS (SELECT {item} AS item, count(*) AS c FROM {src} GROUP BY 1),
    h AS (SELECT item, c, ('0x' || substr(md5(CAST(item AS VARCHAR)), 1, 8))::BIGINT AS h1,
                 ('0x' || substr(md5(CAST(item AS VARCHAR)), 9, 8))::BIGINT AS h2 FROM items),
    cells AS (SELECT item, c, CAST(j AS INTEGER) AS depth, (h1 + j * h2) % {eps_w} AS bucket FROM h, range(0, {depth}) r(j)),
    sk AS (SELECT depth, bucket, CAST(sum(c) AS BIGINT) AS cnt FROM cells GROUP BY 1, 2),
    est AS (SELECT x.item, CAST(min(sk.cnt) AS BIGINT) AS est, max(x.c) AS exact
            FROM cells x JOIN sk ON x.depth = sk.depth AND x.bucket = sk.bucket GROUP BY x.item)
"""


@register("cms_build", _cms_sql("lineitem", "l_partkey", 272, 7) + "SELECT depth, bucket, cnt FROM sk")
def q_cms_build(spark, sf):
    li = load(spark, sf, "lineitem", ["l_partkey"])
    return sketch.cms_build(li, [], F.col("l_partkey"), CMS_EPS, CMS_DELTA)


@register(
    "cms_frequency",
    _cms_sql("lineitem", "l_partkey", 272, 7)
    + "SELECT item AS l_partkey, exact, est, est >= exact AND est <= exact + 0.01 * (SELECT sum(c) FROM items) AS within_bound FROM est",
)
def q_cms_frequency(spark, sf):
    """Frequency of every part from the sketch, with the exact count and the (eps·N) error contract."""
    li = load(spark, sf, "lineitem", ["l_partkey"])
    sk = sketch.cms_build(li, [], F.col("l_partkey"), CMS_EPS, CMS_DELTA)
    est = sketch.cms_estimate(sk, li, [], "l_partkey", CMS_EPS, CMS_DELTA)
    exact = monoid.count_by_key(li, "l_partkey", "exact")
    n = li.select(F.count(F.lit(1))).scalar()
    j = est.join(exact, "l_partkey")
    ok = (F.col("est") >= F.col("exact")) & (F.col("est") <= F.col("exact") + F.lit(CMS_EPS) * n)
    return j.select("l_partkey", "exact", "est", ok.alias("within_bound"))


WORDS_SQL = r"(SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents)"


@register(
    "heavy_hitters",
    _cms_sql(f"(SELECT word FROM {WORDS_SQL} w0 WHERE word <> '') w", "word", 2719, 7)
    + "SELECT item AS word, est, exact FROM est WHERE est >= 0.001 * (SELECT sum(c) FROM items)",
)
def q_heavy_hitters(spark, sf):
    """Words whose count-min estimate is at least 0.1% of all words (eps 0.001, delta 1e-3)."""
    words = monoid.word_rows(load(spark, sf, "documents", ["text"]), "text")
    return sketch.heavy_hitters(words, [], "word", 0.001, 1e-3, 0.001)


@register(
    "approx_top_k",
    f"""
    SELECT word, count(*) AS exact, true AS within_bound FROM {WORDS_SQL} w WHERE word <> ''
    GROUP BY word ORDER BY exact DESC, word LIMIT 5
    """,
)
def q_approx_top_k(spark, sf):
    """Top 5 words by the built-in frequent-items sketch; counts checked against exact ones."""
    words = monoid.word_rows(load(spark, sf, "documents", ["text"]), "text")
    top = words.agg(F.expr("approx_top_k(word, 5, 10000)").alias("t")).select(F.explode("t").alias("e"))
    top = top.select(F.col("e.item").alias("word"), F.col("e.count").alias("est"))
    exact = monoid.count_by_key(words.join(top.select("word"), "word", "left_semi"), "word", "exact")
    n = words.select(F.count(F.lit(1))).scalar()
    j = top.join(exact, "word")
    return j.select("word", "exact", (F.abs(F.col("est") - F.col("exact")) <= n / 10000.0).alias("within_bound"))


@register(
    "heavy_hitters_top10",
    _cms_sql(f"(SELECT word FROM {WORDS_SQL} w0 WHERE word <> '') w", "word", 2719, 7)
    + """SELECT item AS word, est FROM est WHERE est >= 0.001 * (SELECT sum(c) FROM items)
         ORDER BY est DESC, word LIMIT 10""",
)
def q_heavy_hitters_top10(spark, sf):
    """The 10 heaviest words by count-min estimate (ties: alphabetical)."""
    words = monoid.word_rows(load(spark, sf, "documents", ["text"]), "text")
    hh = sketch.heavy_hitters(words, [], "word", 0.001, 1e-3, 0.001)
    return monoid.top_k(hh, [], 10, "est", "word").select("word", "est")


@register(
    "qtree_tree",
    """
    WITH v AS (SELECT o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY cents) AS i, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM v),
    ps AS (SELECT unnest([0.25, 0.5, 0.75, 0.99]::DOUBLE[]) AS p)
    SELECT o_orderpriority, p, cents AS exact, true AS inside, true AS narrow FROM r, ps WHERE i = greatest(1, CAST(ceil(p * n) AS BIGINT))
    """,
)
def q_qtree_tree(spark, sf):
    """Quantile bounds of order prices (cents) per priority from compressed trees (k = 10): the exact quantile lies
    inside them, and no more than levels * 2^-k of the values lie between them."""
    o = load(spark, sf, "orders", ["o_orderpriority", "o_totalprice"])
    o = o.select("o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    ps = [0.25, 0.5, 0.75, 0.99]
    bounds = quantile_tree.quantile_bounds(quantile_tree.build(o, ["o_orderpriority"], "cents"), ["o_orderpriority"], ps)
    counts = o.groupBy("o_orderpriority", "cents").agg(F.count(F.lit(1)).alias("c"))  # the exact side of the contract
    j = counts.join(bounds, "o_orderpriority").groupBy("o_orderpriority", "p", "lower", "upper").agg(
        F.sum("c").alias("n"), F.sum(F.when(F.col("cents") < F.col("lower"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("cents") <= F.col("upper"), F.col("c")).otherwise(0)).alias("upto"))
    exact = o.groupBy("o_orderpriority").agg(F.array(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY cents)") for p in ps]).alias("x"))
    exact = exact.select("o_orderpriority", F.explode(F.arrays_zip(F.array(*map(F.lit, ps)).alias("p"), F.col("x").alias("x"))).alias("q"))
    exact = exact.select("o_orderpriority", F.col("q.p").alias("p"), F.col("q.x").cast("bigint").alias("exact"))
    rank = F.greatest(F.ceil(F.col("p") * F.col("n")), F.lit(1))
    return j.join(exact, ["o_orderpriority", "p"]).select(
        "o_orderpriority", "p", "exact",
        (F.col("exact").between(F.col("lower"), F.col("upper")) & (F.col("below") < rank) & (rank <= F.col("upto"))).alias("inside"),
        (F.col("upto") - F.col("below") <= F.col("n") * (quantile_tree.LEVELS / 2.0**quantile_tree.K) + 1).alias("narrow"))


@register(
    "qtree_range",
    """
    WITH v AS (SELECT o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
    SELECT o_orderpriority, count(*) FILTER (WHERE cents >= 10000000 AND cents < 25000000) AS n,
      CAST(coalesce(sum(cents) FILTER (WHERE cents >= 10000000 AND cents < 25000000), 0) AS BIGINT) AS total, true AS inside
    FROM v GROUP BY 1
    """,
)
def q_qtree_range(spark, sf):
    """Number and sum of order prices from 100,000 up to 250,000 per priority: bounds from the tree around the exact values."""
    o = load(spark, sf, "orders", ["o_orderpriority", "o_totalprice"])
    o = o.select("o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    low, high = 10_000_000, 25_000_000
    found = quantile_tree.range_bounds(quantile_tree.build(o, ["o_orderpriority"], "cents"), ["o_orderpriority"], low, high)
    held = (F.col("cents") >= low) & (F.col("cents") < high)
    exact = o.groupBy("o_orderpriority").agg(F.count(F.when(held, 1)).alias("n"), F.coalesce(F.sum(F.when(held, F.col("cents"))), F.lit(0)).alias("total"))
    return exact.join(found, "o_orderpriority").select(
        "o_orderpriority", "n", "total",
        (F.col("n").between(F.col("n_low"), F.col("n_high")) & F.col("total").between(F.col("total_low"), F.col("total_high"))).alias("inside"))


@register(
    "frequent_words",
    f"""
    WITH w AS (SELECT word FROM {WORDS_SQL} w0 WHERE word <> '')
    SELECT word, count(*) AS cnt FROM w GROUP BY word HAVING count(*) >= 0.001 * (SELECT count(*) FROM w)
    """,
)
def q_frequent_words(spark, sf):
    """Exactly the words that make up 0.1% of all words: Misra-Gries summaries per task, then one counting pass."""
    words = monoid.word_rows(load(spark, sf, "documents", ["text"]), "text")
    return sketch.frequent_items(words, [], "word", 0.001)


@register(
    "frequent_parts",
    """
    WITH n AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT l_returnflag, l_partkey, count(*) AS cnt FROM lineitem JOIN n USING (l_returnflag)
    GROUP BY l_returnflag, l_partkey, n HAVING count(*) >= 0.0002 * n
    """,
)
def q_frequent_parts(spark, sf):
    """Exactly the parts that make up 0.02% of a return flag's rows."""
    return sketch.frequent_items(load(spark, sf, "lineitem", ["l_returnflag", "l_partkey"]), ["l_returnflag"], "l_partkey", 0.0002)
