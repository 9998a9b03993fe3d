"""CDF plans: quantity CDFs per return flag, price-band CDFs per order priority, value quantiles per type."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import cdf, pmf
from tallyframe.plans.catalog import register
from tallyframe.sources import load


def quantity_cdf(spark, sf):
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_quantity"])
    return cdf.to_cdf(pmf.from_keys(li, ["l_returnflag"], "l_quantity"), ["l_returnflag"])


QTY_CDF_SQL = """
    WITH c0 AS (SELECT l_returnflag, l_quantity AS outcome, count(*) AS n FROM lineitem GROUP BY 1, 2),
    c AS (SELECT l_returnflag, outcome, n,
                 CAST(sum(n) OVER (PARTITION BY l_returnflag ORDER BY outcome ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum,
                 CAST(sum(n) OVER (PARTITION BY l_returnflag) AS BIGINT) AS total
          FROM c0)
"""


@register("pmf_to_cdf", QTY_CDF_SQL + "SELECT l_returnflag, outcome, cum, total, round(cum / total, 9) AS cdf FROM c")
def q_pmf_to_cdf(spark, sf):
    c = quantity_cdf(spark, sf)
    return c.select("l_returnflag", "outcome", "cum", "total", F.round("cdf", 9).alias("cdf"))


@register(
    "cdf_from_keys",
    """
    WITH c0 AS (SELECT o_orderpriority, CAST(floor(o_totalprice / 10000) AS BIGINT) AS outcome, count(*) AS n
                FROM orders GROUP BY 1, 2)
    SELECT o_orderpriority, outcome,
           round(sum(n) OVER (PARTITION BY o_orderpriority ORDER BY outcome ROWS UNBOUNDED PRECEDING)
                 / sum(n) OVER (PARTITION BY o_orderpriority), 9) AS cdf
    FROM c0
    """,
)
def q_cdf_from_keys(spark, sf):
    o = load(spark, sf, "orders", ["o_orderpriority", "o_totalprice"])
    band = F.floor(F.col("o_totalprice") / 10000).cast("bigint")
    c = cdf.to_cdf(pmf.from_keys(o, ["o_orderpriority"], band), ["o_orderpriority"])
    return c.select("o_orderpriority", "outcome", F.round("cdf", 9).alias("cdf"))


@register(
    "cdf_to_pmf",
    QTY_CDF_SQL
    + """
    SELECT l_returnflag, outcome,
           round((cum - coalesce(lag(cum) OVER (PARTITION BY l_returnflag ORDER BY outcome), 0)) / total, 9) AS prob
    FROM c
    """,
)
def q_cdf_to_pmf(spark, sf):
    back = cdf.to_pmf(quantity_cdf(spark, sf), ["l_returnflag"])
    return back.select("l_returnflag", "outcome", F.round("prob", 9).alias("prob"))


@register("cdf_pow", QTY_CDF_SQL + "SELECT l_returnflag, outcome, round(pow(cum / total, 2), 9) AS cdf_max2 FROM c")
def q_cdf_pow(spark, sf):
    c = cdf.power(quantity_cdf(spark, sf), 2, out="cdf_max2")
    return c.select("l_returnflag", "outcome", F.round("cdf_max2", 9).alias("cdf_max2"))


@register(
    "cdf_prob",
    QTY_CDF_SQL
    + """
    , probes AS (SELECT DISTINCT l_returnflag, l_quantity - 1 + l_discount * 10 AS k FROM lineitem)
    SELECT q.l_returnflag, q.k, round(coalesce(c.cum / c.total, 0.0), 9) AS cdf
    FROM probes q ASOF LEFT JOIN c ON q.l_returnflag = c.l_returnflag AND q.k >= c.outcome
    """,
)
def q_cdf_prob(spark, sf):
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_quantity", "l_discount"])
    probes = li.select("l_returnflag", (F.col("l_quantity") - 1 + F.col("l_discount") * 10).alias("k")).distinct()
    hit = cdf.lookup(quantity_cdf(spark, sf), probes, ["l_returnflag"], "k")
    return hit.select("l_returnflag", "k", F.round("cdf", 9).alias("cdf"))


@register(
    "cdf_value",
    QTY_CDF_SQL
    + """
    SELECT l_returnflag, p, coalesce(min(outcome) FILTER (WHERE cum >= p * total), max(outcome)) AS value
    FROM c, (SELECT unnest([0.25, 0.5, 0.75]::DOUBLE[]) AS p) ps
    GROUP BY l_returnflag, p
    """,
)
def q_cdf_value(spark, sf):
    return cdf.inverse(quantity_cdf(spark, sf), ["l_returnflag"], [0.25, 0.5, 0.75])


@register(
    "pmf_quantile",
    """
    WITH c0 AS (SELECT event_type, CAST(round(value) AS BIGINT) AS outcome, count(*) AS n FROM events GROUP BY 1, 2),
    c AS (SELECT event_type, outcome,
                 sum(n) OVER (PARTITION BY event_type ORDER BY outcome ROWS UNBOUNDED PRECEDING) AS cum,
                 sum(n) OVER (PARTITION BY event_type) AS total FROM c0)
    SELECT event_type, 0.9::DOUBLE AS p,
           coalesce(min(outcome) FILTER (WHERE cum >= 0.9::DOUBLE * total), max(outcome)) AS value
    FROM c GROUP BY event_type
    """,
)
def q_pmf_quantile(spark, sf):
    ev = load(spark, sf, "events", ["event_type", "value"])
    c = cdf.to_cdf(pmf.from_keys(ev, ["event_type"], F.round("value").cast("bigint")), ["event_type"])
    return cdf.inverse(c, ["event_type"], [0.9])


@register(
    "credible_interval",
    QTY_CDF_SQL
    + """
    SELECT l_returnflag,
           coalesce(min(outcome) FILTER (WHERE cum >= 0.05::DOUBLE * total), max(outcome)) AS lower,
           coalesce(min(outcome) FILTER (WHERE cum >= 0.95::DOUBLE * total), max(outcome)) AS upper
    FROM c GROUP BY l_returnflag
    """,
)
def q_credible_interval(spark, sf):
    return cdf.credible_interval(quantity_cdf(spark, sf), ["l_returnflag"], 0.9)


@register(
    "series_table",
    QTY_CDF_SQL
    + """
    SELECT 'pmf_' || l_returnflag AS series, outcome AS k, round(n / total, 9) AS v FROM c
    UNION ALL
    SELECT 'cdf_' || l_returnflag AS series, outcome AS k, round(cum / total, 9) AS v FROM c
    """,
)
def q_series_table(spark, sf):
    """Plot series per return flag: its PMF and its CDF as one long (series, k, v) table."""
    c = quantity_cdf(spark, sf)
    return pmf.series([
        (F.concat(F.lit("pmf_"), "l_returnflag"), c.withColumn("v", F.round(F.col("n") / F.col("total"), 9))),
        (F.concat(F.lit("cdf_"), "l_returnflag"), c.withColumn("v", F.round("cdf", 9))),
    ], "outcome", "v")


@register(
    "cdf_by_ranges",
    """
    WITH k AS (SELECT l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, count(*) AS n FROM lineitem GROUP BY 1, 2)
    SELECT l_returnflag, cents, CAST(sum(n) OVER w AS BIGINT) AS cum, round(sum(n) OVER w / sum(n) OVER (PARTITION BY l_returnflag), 9) AS cdf
    FROM k WINDOW w AS (PARTITION BY l_returnflag ORDER BY cents)
    """,
)
def q_cdf_by_ranges(spark, sf):
    """CDF of line prices per return flag, where a group holds half of all outcomes: sums run in ranges of outcomes."""
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_extendedprice"])
    prices = pmf.from_keys(li, ["l_returnflag"], F.round(F.col("l_extendedprice") * 100).cast("bigint"), outcome="cents")
    c = cdf.ranged_cdf(prices.select("l_returnflag", "cents", "n"), ["l_returnflag"], outcome="cents")
    return c.select("l_returnflag", "cents", "cum", F.round("cdf", 9).alias("cdf"))
