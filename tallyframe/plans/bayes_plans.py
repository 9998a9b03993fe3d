"""Bayes plans: latent user types from event types, and document quality rates per source."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import bayes, combine, ordered, pmf
from tallyframe.plans.catalog import register
from tallyframe.sources import literal_table, load

# Latent user types, their prior, and P(event_type | type). A bot never purchases (zero
# likelihood), so one purchase rules that type out.
USER_TYPES = [("browser", 0.5), ("buyer", 0.3), ("bot", 0.2)]
EVENT_LIKELIHOOD = [
    ("browser", "view", 0.4), ("browser", "click", 0.3), ("browser", "signup", 0.1), ("browser", "purchase", 0.1),
    ("browser", "error", 0.1),
    ("buyer", "view", 0.2), ("buyer", "click", 0.2), ("buyer", "signup", 0.1), ("buyer", "purchase", 0.4),
    ("buyer", "error", 0.1),
    ("bot", "view", 0.3), ("bot", "click", 0.3), ("bot", "signup", 0.1), ("bot", "purchase", 0.0),
    ("bot", "error", 0.3),
]
QUALITY_RATES = [i / 10 for i in range(1, 10)]


def _prior_of(groups, prior):
    """The same prior for every group."""
    return groups.select("*", F.inline(prior.select(F.collect_list(F.struct("hypo", "prior"))).scalar()))


def _values_sql(rows, cols):
    body = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{float(v)!r}::DOUBLE" for v in r) + ")"
                     for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


PRIOR_SQL = _values_sql(USER_TYPES, ["hypo", "prior"])
LIK_SQL = _values_sql(EVENT_LIKELIHOOD, ["hypo", "event_type", "lik"])


def user_type_tables(spark):
    prior = literal_table(spark, USER_TYPES, "hypo string, prior double")
    lik = literal_table(spark, EVENT_LIKELIHOOD, "hypo string, event_type string, lik double")
    return prior, lik


BAYES_SET_SQL = f"""
    WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
    x AS (SELECT c.user_id, l.hypo, p.prior, min(l.lik) AS minlik,
                 sum(CASE WHEN l.lik > 0 THEN c.n * ln(l.lik) END) AS ll0
          FROM c JOIN {LIK_SQL.replace(' AS t(', ' AS l(')} ON c.event_type = l.event_type
          JOIN {PRIOR_SQL.replace(' AS t(', ' AS p(')} ON l.hypo = p.hypo
          GROUP BY 1, 2, 3),
    y AS (SELECT user_id, hypo, prior, CASE WHEN minlik > 0 THEN ll0 END AS ll FROM x),
    z AS (SELECT user_id, hypo, coalesce(prior * exp(ll - max(ll) OVER (PARTITION BY user_id)), 0.0) AS w FROM y)
    SELECT user_id, hypo,
           round(CASE WHEN sum(w) OVER (PARTITION BY user_id) = 0 THEN w ELSE w / sum(w) OVER (PARTITION BY user_id) END, 6) AS prob
    FROM z
"""


@register("bayes_set", BAYES_SET_SQL)
def q_bayes_set(spark, sf):
    prior, lik = user_type_tables(spark)
    ev = load(spark, sf, "events", ["user_id", "event_type"])
    post = bayes.posterior(prior, ev, ["user_id"], "event_type", "hypo", lik)
    return post.withColumn("prob", F.round("prob", 6))


@register(
    "bayes_sequential",
    f"""
    WITH x AS (SELECT e.user_id, e.event_id, e.ts, l.hypo, p.prior, l.lik FROM events e
               JOIN {LIK_SQL.replace(' AS t(', ' AS l(')} ON e.event_type = l.event_type
               JOIN {PRIOR_SQL.replace(' AS t(', ' AS p(')} ON l.hypo = p.hypo),
    r AS (SELECT user_id, event_id, hypo, prior,
                 sum(CASE WHEN lik > 0 THEN ln(lik) END) OVER w AS lls,
                 sum(CASE WHEN lik <= 0 THEN 1 ELSE 0 END) OVER w AS zeros
          FROM x WINDOW w AS (PARTITION BY user_id, hypo ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    y AS (SELECT user_id, event_id, hypo, prior, CASE WHEN zeros = 0 THEN lls END AS ll FROM r),
    z AS (SELECT user_id, event_id, hypo,
                 coalesce(prior * exp(ll - max(ll) OVER (PARTITION BY user_id, event_id)), 0.0) AS w FROM y)
    SELECT user_id, event_id, hypo,
           round(CASE WHEN sum(w) OVER (PARTITION BY user_id, event_id) = 0 THEN w
                      ELSE w / sum(w) OVER (PARTITION BY user_id, event_id) END, 6) AS prob
    FROM z
    """,
)
def q_bayes_sequential(spark, sf):
    prior, lik = user_type_tables(spark)
    ev = load(spark, sf, "events", ["user_id", "event_id", "ts", "event_type"])
    post = bayes.sequential(prior, ev, ["user_id"], ["ts", "event_id"], "event_type", "hypo", lik,
                            block=ordered.time_block("ts", 7 * 86400))
    return post.select("user_id", "event_id", "hypo", F.round("prob", 6).alias("prob"))


# A chain of two updates is one update with all data, for users with events in either half.
@register("bayes_chain", BAYES_SET_SQL)
def q_bayes_chain(spark, sf):
    """Posterior of the first half of the month becomes the prior of the second half (update keeping the model)."""
    prior, lik = user_type_tables(spark)
    ev = load(spark, sf, "events", ["user_id", "event_type", "ts"])
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    everyone = _prior_of(ev.select("user_id").distinct(), prior)
    first = bayes.posterior(everyone, ev.where(F.col("ts") < cut), ["user_id"], "event_type", "hypo", lik)
    second = bayes.posterior(first.withColumnRenamed("prob", "prior"), ev.where(F.col("ts") >= cut), ["user_id"],
                             "event_type", "hypo", lik)
    return second.withColumn("prob", F.round("prob", 6))


@register(
    "bayes_prior_only",
    f"""
    WITH u AS (SELECT DISTINCT user_id FROM events),
    c AS (SELECT user_id, event_type, count(*) AS n FROM events
          WHERE ts < TIMESTAMP '2024-01-03' AND event_type <> 'view' GROUP BY 1, 2),
    x AS (SELECT u.user_id, p.hypo, p.prior, min(l.lik) AS minlik, sum(CASE WHEN l.lik > 0 THEN c.n * ln(l.lik) END) AS ll0
          FROM u CROSS JOIN {PRIOR_SQL.replace(' AS t(', ' AS p(')} LEFT JOIN c ON u.user_id = c.user_id
          LEFT JOIN {LIK_SQL.replace(' AS t(', ' AS l(')} ON c.event_type = l.event_type AND l.hypo = p.hypo
          GROUP BY 1, 2, 3),
    z AS (SELECT user_id, hypo, CASE WHEN minlik = 0 THEN 0.0 ELSE prior * exp(coalesce(ll0, 0.0)) END AS w FROM x)
    SELECT user_id, hypo, round(w / sum(w) OVER (PARTITION BY user_id), 6) AS prob FROM z
    """,
)
def q_bayes_prior_only(spark, sf):
    """All users' posterior after the rare events of two days: users without any keep their prior."""
    prior, lik = user_type_tables(spark)
    ev = load(spark, sf, "events", ["user_id", "event_type", "ts"])
    early = ev.where((F.col("ts") < F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")) & (F.col("event_type") != "view"))
    everyone = _prior_of(ev.select("user_id").distinct(), prior)
    return bayes.posterior(everyone, early, ["user_id"], "event_type", "hypo", lik).withColumn("prob", F.round("prob", 6))


@register(
    "bayes_quality",
    f"""
    WITH d AS (SELECT d.source, l.quality FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
    c AS (SELECT source, quality, count(*) AS n FROM d GROUP BY 1, 2),
    h AS (SELECT unnest([{', '.join(repr(q) for q in QUALITY_RATES)}]::DOUBLE[]) AS hypo),
    x AS (SELECT c.source, h.hypo, CASE WHEN c.quality = 1 THEN h.hypo ELSE 1.0 - h.hypo END AS lik, c.n FROM c, h),
    y AS (SELECT source, hypo, CASE WHEN min(lik) > 0 THEN sum(n * ln(lik)) END AS ll FROM x GROUP BY 1, 2),
    z AS (SELECT source, hypo, coalesce((1.0 / 9) * exp(ll - max(ll) OVER (PARTITION BY source)), 0.0) AS w FROM y)
    SELECT source, hypo,
           round(CASE WHEN sum(w) OVER (PARTITION BY source) = 0 THEN w ELSE w / sum(w) OVER (PARTITION BY source) END, 6) AS prob
    FROM z
    """,
)
def q_bayes_quality(spark, sf):
    """Posterior over a source's good-document rate, from labels joined to documents; likelihood as an expression."""
    lab = load(spark, sf, "labels", ["doc_id", "quality"])
    docs = load(spark, sf, "documents", ["doc_id", "source"])
    data = lab.join(docs, "doc_id").select("source", "quality")
    prior = literal_table(spark, [(q, 1.0 / 9) for q in QUALITY_RATES], "hypo double, prior double")
    lik = lambda x: F.when(F.col("quality") == 1, F.col("hypo")).otherwise(F.lit(1.0) - F.col("hypo"))
    post = bayes.posterior(prior, data, ["source"], "quality", "hypo", lik)
    return post.withColumn("prob", F.round("prob", 6))


QTY2_SQL = """
    WITH c AS (SELECT l_returnflag, l_quantity AS outcome, count(*) AS n FROM lineitem GROUP BY 1, 2),
    p AS (SELECT l_returnflag, outcome, n / sum(n) OVER (PARTITION BY l_returnflag) AS prob FROM c),
    a AS (SELECT outcome, prob FROM p WHERE l_returnflag = 'A'),
    b AS (SELECT outcome, prob FROM p WHERE l_returnflag = 'R')
"""


def _flag_pmfs(spark, sf):
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_quantity"])
    p = pmf.from_keys(li, ["l_returnflag"], "l_quantity")
    return (p.where(F.col("l_returnflag") == "A").select("outcome", "prob"),
            p.where(F.col("l_returnflag") == "R").select("outcome", "prob"))


@register(
    "pmf_sum",
    QTY2_SQL + """
    , j AS (SELECT a.outcome + b.outcome AS outcome, sum(a.prob * b.prob) AS prob FROM a, b GROUP BY 1)
    SELECT outcome, round(prob / sum(prob) OVER (), 9) AS prob FROM j
    """,
)
def q_pmf_sum(spark, sf):
    a, b = _flag_pmfs(spark, sf)
    return combine.add(a, b, []).withColumn("prob", F.round("prob", 9))


@register(
    "pmf_diff",
    QTY2_SQL + """
    , j AS (SELECT a.outcome - b.outcome AS outcome, sum(a.prob * b.prob) AS prob FROM a, b GROUP BY 1)
    SELECT outcome, round(prob / sum(prob) OVER (), 9) AS prob FROM j
    """,
)
def q_pmf_diff(spark, sf):
    a, b = _flag_pmfs(spark, sf)
    return combine.sub(a, b, []).withColumn("prob", F.round("prob", 9))


@register(
    "pmf_join",
    """
    WITH c AS (SELECT l_linestatus, l_returnflag, l_quantity AS outcome, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
    p AS (SELECT l_linestatus, l_returnflag, outcome, n / sum(n) OVER (PARTITION BY l_linestatus, l_returnflag) AS prob FROM c),
    a AS (SELECT l_linestatus, outcome, prob FROM p WHERE l_returnflag = 'N'),
    b AS (SELECT l_linestatus, outcome, prob FROM p WHERE l_returnflag <> 'N'),
    j AS (SELECT a.l_linestatus, greatest(a.outcome, b.outcome) AS outcome, sum(a.prob * b.prob) AS prob
          FROM a JOIN b ON a.l_linestatus = b.l_linestatus GROUP BY 1, 2)
    SELECT l_linestatus, outcome, round(prob / sum(prob) OVER (PARTITION BY l_linestatus), 9) AS prob FROM j
    """,
)
def q_pmf_join(spark, sf):
    """Per line status: PMF of max(X, Y), X the quantity of an 'N' line and Y of a returned line (any flag)."""
    li = load(spark, sf, "lineitem", ["l_linestatus", "l_returnflag", "l_quantity"])
    p = pmf.from_keys(li, ["l_linestatus", "l_returnflag"], "l_quantity")
    a = p.where(F.col("l_returnflag") == "N").select("l_linestatus", "outcome", "prob")
    b = p.where(F.col("l_returnflag") != "N").select("l_linestatus", "outcome", "prob")
    j = combine.join(a, b, ["l_linestatus"], lambda x, y: F.greatest(x, y))
    return j.withColumn("prob", F.round("prob", 9))


@register(
    "pmf_mixture",
    """
    WITH oc AS (SELECT c.c_mktsegment, o.o_orderpriority FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
    w AS (SELECT c_mktsegment, count(*) / sum(count(*)) OVER () AS weight FROM oc GROUP BY 1),
    comp AS (SELECT c_mktsegment, o_orderpriority AS outcome,
                    count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment) AS prob FROM oc GROUP BY 1, 2),
    m AS (SELECT outcome, sum(weight * prob) AS prob FROM w JOIN comp USING (c_mktsegment) GROUP BY 1)
    SELECT outcome, round(prob / sum(prob) OVER (), 9) AS prob FROM m
    """,
)
def q_pmf_mixture(spark, sf):
    """Order-priority PMF per market segment, mixed with the segments' order shares."""
    o = load(spark, sf, "orders", ["o_custkey", "o_orderpriority"])
    c = load(spark, sf, "customer", ["c_custkey", "c_mktsegment"])
    oc = o.join(c, o.o_custkey == c.c_custkey).select("c_mktsegment", "o_orderpriority")
    # one count table feeds both the components and the weights, so the join and its aggregate run once
    counts = oc.groupBy("c_mktsegment", F.col("o_orderpriority").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    comps = pmf.normalize(counts, ["c_mktsegment"], weight="n", out="prob")
    seg = counts.groupBy("c_mktsegment").agg(F.sum("n").alias("n"))
    weights = pmf.normalize(seg, [], weight="n", out="weight")
    m = combine.mixture(weights, comps, [], "c_mktsegment")
    return m.withColumn("prob", F.round("prob", 9))
