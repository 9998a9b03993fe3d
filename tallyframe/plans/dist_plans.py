"""Distribution, KDE and sampling plans; every parameter table is estimated from the data."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallyframe.functions import special
from tallyframe.operators import cdf, dist, exact, kde, pmf, sample
from tallyframe.plans.catalog import register
from tallyframe.sources import load


def _type_stats(spark, sf):
    ev = load(spark, sf, "events", ["event_type", "value"])
    return ev.groupBy("event_type").agg(F.avg("value").alias("mu"), F.stddev_pop("value").alias("sigma"),
                                        F.min("value").alias("lo"), F.max("value").alias("hi"))


def _source_labels(spark, sf):
    lab = load(spark, sf, "labels", ["doc_id", "quality"])
    docs = load(spark, sf, "documents", ["doc_id", "source"])
    j = lab.join(docs, "doc_id")
    return j.groupBy("source").agg(
        F.count(F.lit(1)).alias("labelled"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good")
    ).withColumn("alpha", F.col("good") + 1.0).withColumn("beta", F.col("labelled") - F.col("good") + 1.0)


TYPE_STATS_SQL = """
    WITH s AS (SELECT event_type, avg(value) AS mu, stddev_pop(value) AS sigma, min(value) AS lo, max(value) AS hi
               FROM events GROUP BY 1)
"""
SOURCE_SQL = """
    WITH sl AS (SELECT d.source, count(*) AS labelled, sum(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END) AS good
                FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY 1),
    s AS (SELECT source, labelled, good, good + 1.0 AS alpha, labelled - good + 1.0 AS beta FROM sl)
"""


@register(
    "dist_normal",
    TYPE_STATS_SQL + """
    , g AS (SELECT event_type, mu, sigma, i, (mu - 4.0 * sigma) + i * ((8.0 * sigma) / 2000.0) AS x
            FROM s, range(0, 2001) r(i))
    SELECT event_type, CAST(i AS INTEGER) AS i, round(x, 9) AS x,
           round(exp(-((x - mu) / sigma) * ((x - mu) / sigma) / 2.0) / (sigma * sqrt(2 * pi())), 9) AS density
    FROM g
    """,
)
def q_dist_normal(spark, sf):
    """Normal PMF grid (±4σ, 2000 steps, raw densities) per event type, μ and σ estimated from values."""
    g = dist.normal_pmf(_type_stats(spark, sf), "mu", "sigma")
    return g.select("event_type", "i", F.round("x", 9).alias("x"), F.round("density", 9).alias("density"))


@register(
    "dist_exponential",
    TYPE_STATS_SQL + f"""
    , g AS (SELECT event_type, 1.0 / mu AS lam, i, 0.0 + i * (({-math.log(1e-4)!r} / (1.0 / mu) - 0.0) / 2000.0) AS x
            FROM s, range(0, 2001) r(i))
    SELECT event_type, CAST(i AS INTEGER) AS i, round(x, 9) AS x, round(lam * exp(-lam * x), 12) AS density FROM g
    """,
)
def q_dist_exponential(spark, sf):
    """Exponential PMF grid on [0, −ln(1e-4)/λ] per event type, λ = 1 / mean value."""
    p = _type_stats(spark, sf).withColumn("lam", 1.0 / F.col("mu"))
    g = dist.exponential_pmf(p, "lam")
    return g.select("event_type", "i", F.round("x", 9).alias("x"), F.round("density", 12).alias("density"))


@register(
    "dist_cdf",
    TYPE_STATS_SQL + f"""
    , g AS (SELECT event_type, 1.0 / mu AS lam, i, 0.0 + i * (({-math.log(1e-4)!r} / (1.0 / mu) - 0.0) / 2000.0) AS x
            FROM s, range(0, 2001) r(i))
    SELECT event_type, CAST(i AS INTEGER) AS i, round(1.0 - exp(-lam * x), 9) AS cdf FROM g
    """,
)
def q_dist_cdf(spark, sf):
    """Closed-form exponential CDF on the same grid."""
    p = _type_stats(spark, sf).withColumn("lam", 1.0 / F.col("mu"))
    g = dist.exponential_pmf(p, "lam")
    return g.select("event_type", "i", F.round(dist.exponential_cdf(F.col("x"), F.col("lam")), 9).alias("cdf"))


def _erf_sql(x: str) -> str:
    """The same erf recipe as the Spark expression: Taylor fold up to |x| = 3, continued fraction beyond."""
    from tallyframe.functions.exprs import (
        ERF_SWITCH, ERF_TAYLOR_TERMS, ERFC_FRACTION_DEPTH, INV_SQRT_PI, TWO_OVER_SQRT_PI)

    taylor = (f"list_reduce(range(1, {ERF_TAYLOR_TERMS + 1}), lambda acc, n: "
              f"{{'t': acc.t * (-({x} * {x})) / n, 's': acc.s + (acc.t * (-({x} * {x})) / n) / (n * 2 + 1)}}, "
              f"{{'t': {x}, 's': {x}}}).s * {TWO_OVER_SQRT_PI!r}")
    ax = f"abs({x})"
    frac = f"list_reduce(range({ERFC_FRACTION_DEPTH}, 0, -1), lambda acc, k: {ax} + (k / 2.0) / acc, {ax})"
    tail = f"(1.0 - exp(-({ax} * {ax})) * {INV_SQRT_PI!r} / {frac})"
    return (f"CASE WHEN {ax} <= {ERF_SWITCH!r} THEN {taylor} "
            f"WHEN {x} > 0 THEN {tail} ELSE -{tail} END")


@register(
    "dist_normal_cdf",
    TYPE_STATS_SQL + f"""
    , g AS (SELECT event_type, mu, sigma, i,
                   (mu - 4.0 * sigma) + i * (((mu + 4.0 * sigma) - (mu - 4.0 * sigma)) / 2000.0) AS x
            FROM s, range(0, 2001) r(i)),
    z AS (SELECT event_type, i, (x - mu) / sigma * {1 / math.sqrt(2.0)!r} AS y FROM g)
    SELECT event_type, CAST(i AS INTEGER) AS i, round(0.5 * (1.0 + ({_erf_sql('y')})), 9) AS cdf FROM z
    """,
)
def q_dist_normal_cdf(spark, sf):
    """Normal CDF on the ±4σ grid, with erf as a Column expression (Spark SQL has no erf)."""
    g = dist.normal_pmf(_type_stats(spark, sf), "mu", "sigma")
    return g.select("event_type", "i", F.round(dist.normal_cdf_col(F.col("x"), F.col("mu"), F.col("sigma")), 9).alias("cdf"))


def _daily_rates(ev):
    days = ev.select((F.datediff(F.max("ts"), F.min("ts")) + 1).alias("d")).scalar()
    return ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).select("user_id", (F.col("_n") / days.cast("double")).alias("lam"))


@register(
    "dist_quantile",
    TYPE_STATS_SQL + """
    , e AS (SELECT event_type, 1.0 / mu AS lam FROM s),
    q AS (SELECT unnest([0.05, 0.5, 0.95]) AS p),
    c AS (SELECT event_type, count(*) / 1000.0 AS lam FROM events GROUP BY 1),
    k AS (SELECT event_type, k, exp(k * ln(lam) - lam - lgamma(k + 1.0)) AS m FROM c, range(0, CAST(ceil(lam * 3 + 200) AS BIGINT)) r(k)),
    w AS (SELECT event_type, k, sum(m) OVER (PARTITION BY event_type ORDER BY k) AS cum FROM k)
    SELECT event_type, 'exponential' AS law, CAST(p AS DOUBLE) AS p, round(-ln(1.0 - p) / lam, 9) AS value FROM e, q
    UNION ALL
    SELECT event_type, 'poisson' AS law, CAST(p AS DOUBLE) AS p, CAST(min(k) AS DOUBLE) AS value FROM w, q WHERE cum >= p GROUP BY 1, p
    """,
)
def q_dist_quantile(spark, sf):
    """Quantiles per event type: of the exponential law with the mean value, of the Poisson law of its events
    per thousand."""
    ps = [0.05, 0.5, 0.95]
    rates = _type_stats(spark, sf).select("event_type", (F.lit(1.0) / F.col("mu")).alias("lam"), F.explode(F.array(*map(F.lit, ps))).alias("p"))
    real = rates.select("event_type", F.lit("exponential").alias("law"), "p",
                        F.round(dist.exponential_quantile(F.col("p"), F.col("lam")), 9).alias("value"))
    counts = load(spark, sf, "events", ["event_type"]).groupBy("event_type").agg((F.count(F.lit(1)) / 1000.0).alias("lam"))
    counts = counts.select("event_type", "lam", F.explode(F.array(*map(F.lit, ps))).alias("p"))
    whole = special.poisson_quantile(F.col("p"), F.col("lam"))
    return real.unionByName(counts.select("event_type", F.lit("poisson").alias("law"), "p", whole.cast("double").alias("value")))


@register(
    "dist_poisson",
    """
    WITH d AS (SELECT date_diff('day', min(ts), max(ts)) + 1 AS days FROM events),
    p AS (SELECT user_id, count(*) / any_value(days)::DOUBLE AS lam FROM events, d GROUP BY 1),
    s AS (SELECT user_id, lam, k FROM p, range(0, CAST(ceil(lam + 12.0 * sqrt(lam) + 12.0) AS BIGINT) + 1) r(k) WHERE lam > 0),
    q AS (SELECT user_id, k, exp(k * ln(lam) - lam - lgamma(k + 1.0)) AS prob FROM s),
    c AS (SELECT user_id, k, prob, sum(prob) OVER (PARTITION BY user_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS cum FROM q)
    SELECT user_id, CAST(k AS BIGINT) AS k, round(prob, 9) AS prob FROM c WHERE cum - prob < 1.0 - 0.0001
    """,
)
def q_dist_poisson(spark, sf):
    """Poisson PMF per user, λ = events per day over the days that the table spans, cut at cumulative 0.9999."""
    p = _daily_rates(load(spark, sf, "events", ["user_id", "ts"]))
    out = dist.poisson_pmf(p, ["user_id"], "lam")
    return out.select("user_id", "k", F.round("prob", 9).alias("prob"))


@register(
    "dist_binomial",
    """
    WITH p AS (SELECT user_id, count(*) AS n, avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) AS p
               FROM events GROUP BY 1),
    s AS (SELECT user_id, n, p, k FROM p, range(0, n + 1) r(k))
    SELECT user_id, CAST(k AS BIGINT) AS k,
           round(CASE WHEN p <= 0 THEN (CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END)
                      WHEN p >= 1 THEN (CASE WHEN k = n THEN 1.0 ELSE 0.0 END)
                      ELSE exp(lgamma(n + 1.0) - lgamma(k + 1.0) - lgamma(n - k + 1.0) + k * ln(p) + (n - k) * ln(1.0 - p)) END, 9) AS prob
    FROM s
    """,
)
def q_dist_binomial(spark, sf):
    """Binomial PMF of a user's purchase count: n = the user's events, p = the user's purchase share."""
    ev = load(spark, sf, "events", ["user_id", "event_type"])
    p = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"),
                                  F.avg(F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0)).alias("p"))
    out = dist.binomial_pmf(p, "n", "p")
    return out.select("user_id", "k", F.round("prob", 9).alias("prob"))


@register(
    "dist_hypergeom",
    SOURCE_SQL + """
    , q AS (SELECT source, labelled AS pop, good AS succ, 5 AS samp FROM s),
    b AS (SELECT *, CASE WHEN samp = 0 OR succ = 0 THEN 0 WHEN pop = succ THEN samp ELSE greatest(0, samp - (pop - succ)) END AS lo,
                    CASE WHEN samp = 0 OR succ = 0 THEN 0 WHEN pop = succ THEN samp ELSE least(samp, succ) END AS hi FROM q),
    x AS (SELECT source, pop, succ, samp, r.k AS k FROM b, range(CAST(lo AS BIGINT), CAST(hi AS BIGINT) + 1) r(k))
    SELECT source, CAST(k AS BIGINT) AS k,
           round(CASE WHEN samp = 0 OR succ = 0 OR pop = succ THEN 1.0
                 ELSE exp((lgamma(succ + 1.0) - lgamma(k + 1.0) - lgamma(succ - k + 1.0))
                        + (lgamma(pop - succ + 1.0) - lgamma(samp - k + 1.0) - lgamma(pop - succ - (samp - k) + 1.0))
                        - (lgamma(pop + 1.0) - lgamma(samp + 1.0) - lgamma(pop - samp + 1.0))) END, 9) AS prob
    FROM x
    """,
)
def q_dist_hypergeom(spark, sf):
    """Good documents in a sample of 5 labelled documents of a source (population = its labelled documents)."""
    p = _source_labels(spark, sf).withColumn("n", F.lit(5))
    out = dist.hypergeom_pmf(p, "labelled", "good", "n")
    return out.select("source", "k", F.round("prob", 9).alias("prob"))


@register(
    "dist_beta",
    SOURCE_SQL + """
    , g AS (SELECT source, alpha, beta, i, 0.0 + i * ((1.0 - 0.0) / 100.0) AS x FROM s, range(0, 101) r(i))
    SELECT source, CAST(i AS INTEGER) AS i,
           round(exp(-(lgamma(alpha) + lgamma(beta) - lgamma(alpha + beta))) * pow(x, alpha - 1) * pow(1.0 - x, beta - 1), 9) AS density
    FROM g
    """,
)
def q_dist_beta(spark, sf):
    """Beta(1 + good, 1 + bad) density of each source's good-document rate on a 101-point grid."""
    out = dist.beta_pdf(_source_labels(spark, sf), "alpha", "beta")
    return out.select("source", "i", F.round("density", 9).alias("density"))


@register(
    "dist_betabinom",
    SOURCE_SQL + """
    , x AS (SELECT source, alpha, beta, 10 AS n, k FROM s, range(0, 11) r(k))
    SELECT source, CAST(k AS BIGINT) AS k,
           round(exp((lgamma(n + 1.0) - lgamma(k + 1.0) - lgamma(n - k + 1.0))
                     + (lgamma(k + alpha) + lgamma(n - k + beta) - lgamma(alpha + beta + n))
                     - (lgamma(alpha) + lgamma(beta) - lgamma(alpha + beta))), 9) AS prob
    FROM x
    """,
)
def q_dist_betabinom(spark, sf):
    """Beta-binomial PMF of good documents among the next 10 of each source."""
    out = dist.betabinom_pmf(_source_labels(spark, sf).withColumn("n", F.lit(10)), "n", "alpha", "beta")
    return out.select("source", "k", F.round("prob", 9).alias("prob"))


@register(
    "dist_moments",
    SOURCE_SQL + """
    , m AS (SELECT source, alpha, beta, k, lgamma(k + alpha) + lgamma(10 - k + beta) - lgamma(k + 1) - lgamma(11 - k) AS lm
            FROM s, range(0, 11) r(k)),
    top AS (SELECT source, max(lm) AS best FROM m GROUP BY 1)
    SELECT source, round(10 * any_value(alpha) / (any_value(alpha) + any_value(beta)), 9) AS mean,
           round(sum(exp(lm) * k * k) / sum(exp(lm)) - (sum(exp(lm) * k) / sum(exp(lm))) ** 2, 9) AS variance,
           CAST(min(CASE WHEN lm >= best - 1e-9 THEN k END) AS INTEGER) AS mode
    FROM m JOIN top USING (source) GROUP BY source
    """,
)
def q_dist_moments(spark, sf):
    """Closed-form beta-binomial mean, variance and mode (n = 10) per source."""
    p = _source_labels(spark, sf)
    m = dist.betabinom_moments(F.lit(10), F.col("alpha"), F.col("beta"))
    return p.select("source", F.round(m["mean"], 9).alias("mean"), F.round(m["variance"], 9).alias("variance"),
                    m["mode"].alias("mode"))


@register(
    "pdf_grid_pmf",
    TYPE_STATS_SQL + """
    , g AS (SELECT DISTINCT event_type, mu, sigma, lo + i * ((hi - lo) / 2000.0) AS x FROM s, range(0, 2001) r(i)),
    d AS (SELECT event_type, x, exp(-((x - mu) / sigma) * ((x - mu) / sigma) / 2.0) / (sigma * sqrt(2 * pi())) AS dens FROM g)
    SELECT event_type, round(x, 9) AS x, round(dens / sum(dens) OVER (PARTITION BY event_type), 12) AS prob FROM d
    """,
)
def q_pdf_grid_pmf(spark, sf):
    """A normal PDF bounded to each type's [min, max], tabulated at 2000 steps and normalised."""
    st = _type_stats(spark, sf)
    pts = dist.grid(st, F.col("lo"), F.col("hi"), 2000).select("event_type", "mu", "sigma", "x")
    d = dist.pdf_to_pmf(pts.select("event_type", "x", "mu", "sigma").distinct(), ["event_type", "mu", "sigma"],
                        lambda x: dist.normal_pdf(x, F.col("mu"), F.col("sigma")))
    return d.select("event_type", F.round("x", 9).alias("x"), F.round("prob", 12).alias("prob"))


@register(
    "kde_grid",
    """
    WITH v AS (SELECT event_type, value FROM events WHERE value IS NOT NULL),
    st AS (SELECT event_type, min(value) AS mn, max(value) AS mx, count(*) AS n, abs(max(value)) * 0.0001 AS prec
           FROM v GROUP BY 1),
    st2 AS (SELECT *, greatest((mx - mn) / sqrt(n), prec / 6.0) AS h, (mx - mn) / 100.0 AS step FROM st),
    cells AS (SELECT v.event_type, CASE WHEN prec > 0 THEN round(value / prec) * prec ELSE value END AS c, count(*) AS w
              FROM v JOIN st2 USING (event_type) GROUP BY 1, 2),
    g AS (SELECT event_type, i, mn + i * step AS x, n, h FROM st2, range(0, 101) r(i))
    SELECT g.event_type, CAST(g.i AS INTEGER) AS i, round(g.x, 9) AS x,
           round(sum(cells.w * exp(-((g.x - cells.c) / g.h) * ((g.x - cells.c) / g.h) / 2.0) / sqrt(2 * pi())) / (g.n * g.h), 9) AS density
    FROM g JOIN cells ON g.event_type = cells.event_type GROUP BY 1, 2, 3, g.n, g.h
    """,
)
def q_kde_grid(spark, sf):
    """Gaussian KDE of event values per type on a 101-point grid (precision max/10000)."""
    ev = load(spark, sf, "events", ["event_type", "value"])
    k = kde.kde_grid(ev, ["event_type"], "value", points=101)
    return k.select("event_type", "i", F.round("x", 9).alias("x"), F.round("density", 9).alias("density"))


def _u_sql(id_col, seed):
    return f"(('0x' || substr(md5(CAST({id_col} AS VARCHAR) || '|{seed}'), 1, 8))::BIGINT / 4294967296.0)"


@register(
    "pmf_sample",
    f"""
    WITH c0 AS (SELECT user_id, event_type AS outcome, count(*) AS n FROM events GROUP BY 1, 2),
    c AS (SELECT user_id, outcome, sum(n) OVER (PARTITION BY user_id ORDER BY outcome ROWS UNBOUNDED PRECEDING)
                 / sum(n) OVER (PARTITION BY user_id) AS cdf FROM c0),
    d AS (SELECT user_id, event_id, {_u_sql('event_id', 'z1')} AS u FROM events)
    SELECT d.user_id, c.outcome, count(*) AS draws
    FROM d ASOF JOIN c ON d.user_id = c.user_id AND d.u < c.cdf GROUP BY 1, 2
    """,
)
def q_pmf_sample(spark, sf):
    """One draw from each user's event-type PMF per event of the user (md5 uniforms), tallied."""
    ev = load(spark, sf, "events", ["user_id", "event_type", "event_id"])
    c = cdf.to_cdf(pmf.from_keys(ev, ["user_id"], "event_type"), ["user_id"])
    d = sample.draw(c, ev.select("user_id", "event_id"), ["user_id"], "event_id", "z1")
    return d.groupBy("user_id", "outcome").agg(F.count(F.lit(1)).alias("draws"))


def _flag_cdf(spark, sf, flag):
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_quantity"]).where(F.col("l_returnflag") == flag)
    # Quantities are whole numbers from 1 to 50: at most 50 outcomes, one scan.
    return cdf.to_cdf(pmf.from_keys(li, [], "l_quantity"), [], block=None)


def _sample_sql(comb):
    return f"""
    WITH c0 AS (SELECT l_returnflag, l_quantity AS outcome, count(*) AS n FROM lineitem GROUP BY 1, 2),
    c AS (SELECT l_returnflag, outcome, sum(n) OVER (PARTITION BY l_returnflag ORDER BY outcome ROWS UNBOUNDED PRECEDING)
                 / sum(n) OVER (PARTITION BY l_returnflag) AS cdf FROM c0),
    ca AS (SELECT outcome, cdf FROM c WHERE l_returnflag = 'A'),
    cr AS (SELECT outcome, cdf FROM c WHERE l_returnflag = 'R'),
    da AS (SELECT o_orderkey, {_u_sql('o_orderkey', 'a')} AS u FROM orders),
    dr AS (SELECT o_orderkey, {_u_sql('o_orderkey', 'r')} AS u FROM orders),
    xa AS (SELECT da.o_orderkey, ca.outcome FROM da ASOF JOIN ca ON da.u < ca.cdf),
    xr AS (SELECT dr.o_orderkey, cr.outcome FROM dr ASOF JOIN cr ON dr.u < cr.cdf),
    v AS (SELECT {comb} AS outcome FROM xa JOIN xr USING (o_orderkey))
    SELECT outcome, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS prob FROM v GROUP BY 1
    """


def _sample_two(spark, sf, comb):
    orders = load(spark, sf, "orders", ["o_orderkey"])
    out = sample.sample_join([_flag_cdf(spark, sf, "A"), _flag_cdf(spark, sf, "R")], orders, "o_orderkey",
                             ["a", "r"], comb)
    return out.withColumn("prob", F.round("prob", 9))


@register("sample_sum", _sample_sql("xa.outcome + xr.outcome"))
def q_sample_sum(spark, sf):
    """Monte-Carlo PMF of the sum of an 'A' and an 'R' line quantity, one draw pair per order."""
    return _sample_two(spark, sf, lambda c: c[0] + c[1])


@register("sample_max", _sample_sql("greatest(xa.outcome, xr.outcome)"))
def q_sample_max(spark, sf):
    """Monte-Carlo PMF of the larger of the two draws."""
    return _sample_two(spark, sf, lambda c: F.greatest(*c))


@register("sample_join", _sample_sql("xa.outcome - xr.outcome"))
def q_sample_join(spark, sf):
    """Monte-Carlo join with a general combiner (difference of the two draws)."""
    return _sample_two(spark, sf, lambda c: c[0] - c[1])


@register(
    "dist_beta_cdf",
    SOURCE_SQL + """
    , g AS (SELECT source, CAST(alpha AS INTEGER) AS a, CAST(alpha + beta - 1 AS INTEGER) AS n, i, i / 99.7::DOUBLE AS x FROM s, range(0, 100) r(i)),
    m AS (SELECT source, i, CASE WHEN x = 0 THEN 0.0 WHEN x = 1 THEN 1.0
                 ELSE exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln(x) + (n - j) * ln(1.0 - x)) END AS m, x
          FROM g, range(0, 100000) t(j) WHERE j BETWEEN a AND n)
    SELECT source, CAST(i AS INTEGER) AS i, round(CASE WHEN any_value(x) = 0 THEN 0.0 WHEN any_value(x) = 1 THEN 1.0 ELSE sum(m) END, 9) AS cdf FROM m GROUP BY source, i
    """,
)
def q_dist_beta_cdf(spark, sf):
    """Posterior CDF of a source's share of good documents at 100 points (i / 99.7, where no value is a tie in rounding), by the incomplete beta function; with whole
    parameters it equals a sum of binomial masses."""
    s = _source_labels(spark, sf).select("source", "alpha", "beta", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("i"))
    return s.select("source", "i", F.round(special.beta_cdf(F.col("i") / 99.7, F.col("alpha"), F.col("beta")), 9).alias("cdf"))


@register(
    "dist_binomial_quantile",
    """
    WITH p AS (SELECT user_id, count(*) AS n, avg(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END) AS p FROM events GROUP BY 1),
    s AS (SELECT user_id, k, CASE WHEN p <= 0 THEN (CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END) WHEN p >= 1 THEN (CASE WHEN k = n THEN 1.0 ELSE 0.0 END)
                 ELSE exp(lgamma(n + 1.0) - lgamma(k + 1.0) - lgamma(n - k + 1.0) + k * ln(p) + (n - k) * ln(1.0 - p)) END AS m
          FROM p, range(0, n + 1) r(k)),
    w AS (SELECT user_id, k, sum(m) OVER (PARTITION BY user_id ORDER BY k) AS cum FROM s)
    SELECT user_id, q, CAST(min(k) AS BIGINT) AS value FROM w, (SELECT unnest([0.05, 0.5, 0.95]::DOUBLE[]) AS q) WHERE cum >= q GROUP BY 1, 2
    """,
)
def q_dist_binomial_quantile(spark, sf):
    """Quantiles of a user's number of purchases, in closed form: no support is exploded."""
    ev = load(spark, sf, "events", ["user_id", "event_type"])
    p = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0)).alias("p"))
    p = p.select("user_id", "n", "p", F.explode(F.array(*map(F.lit, [0.05, 0.5, 0.95]))).alias("q"))
    return p.select("user_id", "q", special.binomial_quantile(F.col("q"), F.col("n"), F.col("p")).alias("value"))


FLAG_LAW_SQL = """
    WITH n AS (SELECT l_linestatus AS s, l_returnflag AS f, CAST(l_quantity AS BIGINT) AS k, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
    p AS (SELECT s, f, k, n / sum(n) OVER (PARTITION BY s, f) AS p, sum(n) OVER (PARTITION BY s, f ORDER BY k) / sum(n) OVER (PARTITION BY s, f) AS c FROM n)
"""


def _exact_sum_sql() -> str:
    """One convolution after the other; a flag that a status lacks adds 0."""
    steps = [FLAG_LAW_SQL + """, u AS (
      SELECT s, f, k, p FROM p UNION ALL
      SELECT s, f, 0 AS k, 1.0 AS p FROM (SELECT DISTINCT s FROM p), (SELECT DISTINCT f FROM p) WHERE (s, f) NOT IN (SELECT (s, f) FROM p)),
    c0 AS (SELECT DISTINCT s, 0 AS k, 1.0::DOUBLE AS p FROM p)"""]
    for i, flag in enumerate(["A", "A", "A", "N", "R"]):
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.s, c.k + u.k AS k, sum(c.p * u.p) AS p FROM c{i} c JOIN u ON c.s = u.s AND u.f = '{flag}' GROUP BY 1, 2)")
    return ", ".join(steps) + " SELECT s AS l_linestatus, CAST(k AS DOUBLE) AS outcome, round(p, 9) AS prob FROM c5"


def _flag_laws(spark, sf):
    li = load(spark, sf, "lineitem", ["l_linestatus", "l_returnflag", "l_quantity"])
    return pmf.from_keys(li, ["l_linestatus", "l_returnflag"], "l_quantity")


@register("exact_sum", _exact_sum_sql())
def q_exact_sum(spark, sf):
    """Exact law, per line status, of the summed quantity of three lines with flag A and one with each other flag."""
    laws = _flag_laws(spark, sf).withColumn("times", F.when(F.col("l_returnflag") == "A", 3).otherwise(1))
    out = exact.sum_law(laws, ["l_linestatus"], "l_returnflag", times="times", block=128)
    return out.select("l_linestatus", "outcome", F.round("prob", 9).alias("prob"))


@register(
    "exact_max",
    FLAG_LAW_SQL + """
    , x AS (SELECT DISTINCT s, k FROM p), g AS (SELECT DISTINCT s, f FROM p),
    w AS (SELECT x.s, x.k, g.f, coalesce(max(p.c), 0) AS c FROM x JOIN g ON x.s = g.s LEFT JOIN p ON p.s = g.s AND p.f = g.f AND p.k <= x.k GROUP BY 1, 2, 3)
    SELECT s AS l_linestatus, CAST(k AS DOUBLE) AS outcome, round(product(c), 9) AS cdf FROM w GROUP BY 1, 2 HAVING min(c) > 0
    """,
)
def q_exact_max(spark, sf):
    """Exact distribution function, per line status, of the largest quantity of one line with each return flag."""
    laws = cdf.to_cdf(_flag_laws(spark, sf), ["l_linestatus", "l_returnflag"])
    out = exact.max_law(laws, ["l_linestatus"], "l_returnflag")
    return out.select("l_linestatus", "outcome", F.round("cdf", 9).alias("cdf"))
