"""PMF plans: event-type PMFs per user (``events``) and quantity PMFs per return flag (``lineitem``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import pmf
from tallyframe.plans.catalog import register
from tallyframe.sources import load


def _events(spark, sf, cols):
    return load(spark, sf, "events", cols)


def _lineitem(spark, sf, cols):
    return load(spark, sf, "lineitem", cols)


def event_type_pmf(spark, sf):
    return pmf.from_keys(_events(spark, sf, ["user_id", "event_type"]), ["user_id"], "event_type")


def quantity_pmf(spark, sf):
    return pmf.from_keys(_lineitem(spark, sf, ["l_returnflag", "l_quantity"]), ["l_returnflag"], "l_quantity")


@register(
    "pmf_from_keys",
    """
    SELECT user_id, event_type AS outcome, count(*) AS n,
           round(count(*) / sum(count(*)) OVER (PARTITION BY user_id), 9) AS prob
    FROM events GROUP BY user_id, event_type
    """,
)
def q_pmf_from_keys(spark, sf):
    return event_type_pmf(spark, sf).withColumn("prob", F.round("prob", 9))


@register(
    "pmf_mode",
    """
    SELECT user_id, outcome, n, prob FROM (
      SELECT user_id, event_type AS outcome, count(*) AS n,
             round(count(*) / sum(count(*)) OVER (PARTITION BY user_id), 9) AS prob,
             row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
      FROM events GROUP BY user_id, event_type) t
    WHERE rn = 1
    """,
)
def q_pmf_mode(spark, sf):
    best = pmf.mode(event_type_pmf(spark, sf), ["user_id"], weight="n", carry=["prob"])
    return best.select("user_id", "outcome", "n", F.round("prob", 9).alias("prob"))


@register(
    "pmf_from_weights",
    """
    SELECT user_id, event_type AS outcome, round(sum(value), 6) AS weight
    FROM events GROUP BY user_id, event_type
    """,
)
def q_pmf_from_weights(spark, sf):
    w = pmf.from_weights(_events(spark, sf, ["user_id", "event_type", "value"]), ["user_id"], "event_type", "value")
    return w.withColumn("weight", F.round("weight", 6))


@register(
    "pmf_normalize",
    """
    WITH w AS (SELECT user_id, event_type AS outcome, sum(value) AS weight FROM events GROUP BY 1, 2)
    SELECT user_id, outcome,
           round(CASE WHEN sum(weight) OVER (PARTITION BY user_id) = 0 THEN weight
                      ELSE weight / sum(weight) OVER (PARTITION BY user_id) END, 9) AS prob
    FROM w
    """,
)
def q_pmf_normalize(spark, sf):
    w = pmf.from_weights(_events(spark, sf, ["user_id", "event_type", "value"]), ["user_id"], "event_type", "value")
    p = pmf.normalize(w, ["user_id"], weight="weight", out="prob")
    return p.select("user_id", "outcome", F.round("prob", 9).alias("prob"))


_QTY_PMF_SQL = """
    WITH c AS (SELECT l_returnflag, l_quantity AS outcome, count(*) AS n FROM lineitem GROUP BY 1, 2),
    p AS (SELECT l_returnflag, outcome, n, n / sum(n) OVER (PARTITION BY l_returnflag) AS prob FROM c)
"""


@register(
    "pmf_moments",
    _QTY_PMF_SQL
    + """
    SELECT l_returnflag, round(sum(outcome * prob), 6) AS mean,
           round(sum(outcome * outcome * prob) - pow(sum(outcome * prob), 2), 6) AS variance
    FROM p GROUP BY l_returnflag
    """,
)
def q_pmf_moments(spark, sf):
    m = pmf.moments(quantity_pmf(spark, sf), ["l_returnflag"])
    return m.select("l_returnflag", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"))


@register(
    "pmf_filter_keys",
    _QTY_PMF_SQL + "SELECT l_returnflag, outcome, round(prob, 9) AS prob FROM p WHERE outcome <= 10",
)
def q_pmf_filter_keys(spark, sf):
    kept = pmf.filter_keys(quantity_pmf(spark, sf), F.col("outcome") <= 10)
    return kept.select("l_returnflag", "outcome", F.round("prob", 9).alias("prob"))


@register(
    "pmf_map_keys",
    _QTY_PMF_SQL
    + """
    SELECT l_returnflag, CAST(floor(outcome / 10) AS BIGINT) AS outcome, round(sum(prob), 9) AS prob
    FROM p GROUP BY 1, 2
    """,
)
def q_pmf_map_keys(spark, sf):
    p = quantity_pmf(spark, sf)
    merged = pmf.map_keys(p, ["l_returnflag"], lambda k: F.floor(k / 10).cast("bigint"), weight="prob")
    return merged.withColumn("prob", F.round("prob", 9))


@register(
    "pmf_map_values",
    _QTY_PMF_SQL + "SELECT l_returnflag, outcome, round(sqrt(prob), 9) AS weight FROM p",
)
def q_pmf_map_values(spark, sf):
    p = quantity_pmf(spark, sf).select("l_returnflag", "outcome", F.col("prob").alias("weight"))
    return pmf.map_values(p, lambda w: F.round(F.sqrt(w), 9))


@register(
    "pmf_add_mass",
    """
    WITH w AS (SELECT l_returnflag, l_quantity AS outcome, CAST(count(*) AS DOUBLE) AS weight
               FROM lineitem GROUP BY 1, 2),
    adds AS (SELECT l_returnflag, max(l_quantity) + 1 AS outcome, 0.5::DOUBLE AS weight FROM lineitem GROUP BY 1
             UNION ALL
             SELECT l_returnflag, min(l_quantity) AS outcome, 0.5::DOUBLE AS weight FROM lineitem GROUP BY 1)
    SELECT l_returnflag, outcome, round(sum(weight), 6) AS weight
    FROM (SELECT * FROM w UNION ALL SELECT * FROM adds) u GROUP BY 1, 2
    """,
)
def q_pmf_add_mass(spark, sf):
    li = _lineitem(spark, sf, ["l_returnflag", "l_quantity"])
    w = pmf.from_weights(li, ["l_returnflag"], "l_quantity", F.lit(1.0))
    ext = li.groupBy("l_returnflag").agg(F.max("l_quantity").alias("hi"), F.min("l_quantity").alias("lo"))
    adds = ext.select("l_returnflag", (F.col("hi") + 1).alias("outcome"), F.lit(0.5).alias("weight")).unionByName(
        ext.select("l_returnflag", F.col("lo").alias("outcome"), F.lit(0.5).alias("weight"))
    )
    out = pmf.add_mass(w, adds, ["l_returnflag"])
    return out.withColumn("weight", F.round("weight", 6))


@register(
    "pmf_remove",
    """
    WITH p AS (SELECT user_id, event_type AS outcome, count(*) AS n,
                      count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS prob
               FROM events GROUP BY 1, 2),
    first_type AS (SELECT user_id, arg_min(event_type, event_id) AS outcome FROM events GROUP BY 1)
    SELECT user_id, outcome, n, round(prob, 9) AS prob
    FROM p WHERE NOT EXISTS (SELECT 1 FROM first_type f WHERE f.user_id = p.user_id AND f.outcome = p.outcome)
    """,
)
def q_pmf_remove(spark, sf):
    ev = _events(spark, sf, ["user_id", "event_type", "event_id"])
    first = ev.groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("outcome"))
    kept = pmf.remove(event_type_pmf(spark, sf), first, ["user_id"])
    return kept.select("user_id", "outcome", "n", F.round("prob", 9).alias("prob"))


@register(
    "pmf_prob_key",
    _QTY_PMF_SQL
    + """
    , probes AS (SELECT DISTINCT l_returnflag, round(l_discount * 100) AS outcome FROM lineitem)
    SELECT q.l_returnflag, q.outcome, round(coalesce(p.prob, 0.0), 9) AS prob
    FROM probes q LEFT JOIN p ON q.l_returnflag = p.l_returnflag AND q.outcome = p.outcome
    """,
)
def q_pmf_prob_key(spark, sf):
    li = _lineitem(spark, sf, ["l_returnflag", "l_discount"])
    probes = li.select("l_returnflag", F.round(F.col("l_discount") * 100).alias("outcome")).distinct()
    hit = pmf.prob_of(quantity_pmf(spark, sf), probes, ["l_returnflag"])
    return hit.select("l_returnflag", "outcome", F.round("prob", 9).alias("prob"))


@register(
    "pmf_prob_pred",
    """
    WITH p AS (SELECT user_id, event_type AS outcome,
                      count(*) / sum(count(*)) OVER (PARTITION BY user_id) AS prob
               FROM events GROUP BY 1, 2)
    SELECT user_id, round(sum(CASE WHEN outcome IN ('click', 'purchase') THEN prob ELSE 0.0 END), 9) AS p
    FROM p GROUP BY user_id
    """,
)
def q_pmf_prob_pred(spark, sf):
    p = pmf.prob_where(event_type_pmf(spark, sf), ["user_id"], F.col("outcome").isin("click", "purchase"))
    return p.withColumn("p", F.round("p", 9))
