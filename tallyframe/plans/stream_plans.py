"""Streaming plans: the events (and customer) Parquet files read as a file stream with ``availableNow``.
Each returns the stream's result table, so batch SQL on the same rows is the oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.exprs import utc_day
from tallyframe.operators import monoid, sketch
from tallyframe.operators.bayes import _normalise_log
from tallyframe.plans.bayes_plans import BAYES_SET_SQL, USER_TYPES, user_type_tables
from tallyframe.plans.catalog import register
from tallyframe.plans.sketch_plans import _cms_sql
from tallyframe.sources import load
from tallyframe.streaming import event_time, file_stream, run_stream
from tallyframe.streaming import ops


@register(
    "stream_distinct_exact",
    """
    SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(DISTINCT user_id) AS distinct_users
    FROM events GROUP BY 1
    """,
)
def q_stream_distinct_exact(spark, sf):
    """Exact distinct users per day (tumbling event-time windows, dedup within the watermark)."""
    s = file_stream(spark, sf, "events")
    res = run_stream(ops.distinct_per_window(s, "ts", "user_id", "1 day", "25 hours"), "complete")
    return res.select(utc_day(F.col("window_start")).alias("day"),
                      F.col("distinct_keys").alias("distinct_users"))


@register("stream_distinct_running", "SELECT count(DISTINCT user_id) AS distinct_users FROM events")
def q_stream_distinct_running(spark, sf):
    """Exact running distinct users over the whole stream."""
    s = file_stream(spark, sf, "events")
    res = run_stream(ops.running_distinct(s, "user_id"), "complete")
    return res.select(F.col("distinct_keys").alias("distinct_users"))


@register(
    "stream_hll",
    "SELECT event_type, count(DISTINCT user_id) AS exact, true AS within_bound FROM events GROUP BY event_type",
)
def q_stream_hll(spark, sf):
    """Running HLL sketch per event type as streaming state; estimate checked against the exact count."""
    s = file_stream(spark, sf, "events")
    res = run_stream(ops.sketch_state(s, ["event_type"], "user_id", 12), "complete")
    est = res.select("event_type", sketch.hll_estimate("sketch").alias("est"))
    exact = load(spark, sf, "events", ["event_type", "user_id"]).groupBy("event_type").agg(
        F.count_distinct("user_id").alias("exact"))
    j = est.join(exact, "event_type")
    return j.select("event_type", "exact", sketch.within_bound(F.col("est"), F.col("exact"), sketch.hll_rse(12))
                    .alias("within_bound"))


@register(
    "stream_window_hll",
    """
    SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, count(DISTINCT user_id) AS exact,
           true AS within_bound
    FROM events GROUP BY 1, 2
    """,
)
def q_stream_window_hll(spark, sf):
    """Daily event-time window sketches per type (watermark 1 day, update mode)."""
    s = file_stream(spark, sf, "events")
    res = run_stream(ops.window_sketch(s, "ts", ["event_type"], "user_id", "1 day", "1 day", 12), "update")
    last = res.groupBy("window_start", "event_type").agg(F.hll_union_agg("sketch", True).alias("sketch"))
    est = last.select(utc_day(F.col("window_start")).alias("day"), "event_type",
                      sketch.hll_estimate("sketch").alias("est"))
    ev = load(spark, sf, "events", ["ts", "event_type", "user_id"])
    exact = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count_distinct("user_id").alias("exact"))
    j = est.join(exact, ["day", "event_type"])
    return j.select("day", "event_type", "exact",
                    sketch.within_bound(F.col("est"), F.col("exact"), sketch.hll_rse(12)).alias("within_bound"))


@register(
    "stream_topk",
    "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id ORDER BY cnt DESC, user_id LIMIT 10",
)
def q_stream_topk(spark, sf):
    """Running exact heavy hitters: the 10 most active users (complete mode, sort + limit on the stream)."""
    s = file_stream(spark, sf, "events")
    return run_stream(ops.top_counts(s, "user_id", 10), "complete")


@register(
    "stream_enrich_top5",
    """
    SELECT c.c_nationkey AS n_nationkey, n.n_name, count(DISTINCT c.c_custkey) AS exact, true AS within_bound
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    GROUP BY 1, 2 ORDER BY exact DESC, n_nationkey LIMIT 5
    """,
)
def q_stream_enrich_top5(spark, sf):
    """Keyed sketch state (distinct customers per nation) joined to the nation dimension, top 5."""
    s = file_stream(spark, sf, "customer")
    nation = load(spark, sf, "nation", ["n_nationkey", "n_name"])
    agg = s.groupBy("c_nationkey").agg(F.hll_sketch_estimate(F.hll_sketch_agg("c_custkey", 14)).alias("est"))
    top = agg.join(nation, agg.c_nationkey == nation.n_nationkey).orderBy(
        F.desc("est"), F.asc("c_nationkey")).limit(5)
    res = run_stream(top, "complete")
    exact = load(spark, sf, "customer", ["c_nationkey", "c_custkey"]).groupBy("c_nationkey").agg(
        F.count_distinct("c_custkey").alias("exact"))
    j = res.join(exact, "c_nationkey")
    return j.select(F.col("c_nationkey").alias("n_nationkey"), "n_name", "exact",
                    sketch.within_bound(F.col("est"), F.col("exact"), sketch.hll_rse(14)).alias("within_bound"))


@register("stream_bayes", BAYES_SET_SQL)
def q_stream_bayes(spark, sf):
    """Latent user-type posterior from streamed events. Per-user log-likelihood sums live in the state store
    and are appended to Parquet as a versioned changelog; the posterior normalises the latest state."""
    prior, lik = user_type_tables(spark)
    hyps = [h for h, _ in USER_TYPES]
    s = file_stream(spark, sf, "events").select("user_id", "event_type")
    log = run_stream(ops.bayes_changelog(s, "user_id", "event_type", lik, hyps), "append", sink="parquet")
    cur = ops.latest_version(log, "user_id")
    rows = cur.select("user_id", F.posexplode(F.arrays_zip("minlik", "ll")).alias("i", "z"))
    hyp_of = F.element_at(F.array(*[F.lit(h) for h in hyps]), F.col("i") + 1)
    ll = rows.select("user_id", hyp_of.alias("hypo"), F.col("z.minlik").alias("_minlik"), F.col("z.ll").alias("_ll0"))
    ll = ll.join(prior, "hypo").withColumn("_ll", F.when(F.col("_minlik") > 0, F.col("_ll0")))
    post = _normalise_log(ll, ["user_id"], "hypo")
    return post.withColumn("prob", F.round("prob", 6))


@register(
    "stream_fold",
    """
    SELECT user_id, event_id,
           round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS state
    FROM events
    """,
)
def q_stream_fold(spark, sf):
    """Per-user running sum emitted per event, with the state in the state store (append mode, Parquet sink)."""
    s = file_stream(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    res = run_stream(ops.ordered_fold(s, "user_id", ["ts", "event_id"], "value", ["event_id"]), "append",
                     sink="parquet")
    return res.select("user_id", "event_id", F.round("state", 6).alias("state"))


@register(
    "stream_heavy_hitters",
    """
    WITH c AS (SELECT strftime(time_bucket(INTERVAL 1 day, ts), '%Y-%m-%d') AS day, user_id, count(*) AS n FROM events GROUP BY 1, 2
               UNION ALL SELECT 'all' AS day, user_id, count(*) AS n FROM events GROUP BY 2),
    r AS (SELECT day, n, row_number() OVER (PARTITION BY day ORDER BY n DESC) AS rank FROM c)
    SELECT day, CAST(rank AS BIGINT) AS rank, n AS cnt FROM r WHERE rank <= 5
    """,
)
def q_stream_heavy_hitters(spark, sf):
    """Approximate heavy hitters per day and overall, from the mergeable frequent-items state alone: counts of the
    five most active users (exact while a group has fewer users than the sketch tracks)."""
    s = file_stream(spark, sf, "events").select("ts", "user_id")
    both = s.select("user_id", F.explode(F.array(utc_day(F.col("ts")), F.lit("all"))).alias("day"))
    res = run_stream(both.groupBy("day").agg(F.expr("approx_top_k(user_id, 5, 100000)").alias("top")), "complete")
    return res.select("day", F.posexplode("top").alias("i", "e")).select(
        "day", (F.col("i") + 1).cast("bigint").alias("rank"), F.col("e.count").alias("cnt"))


@register(
    "stream_cms_heavy_hitters",
    _cms_sql("events", "user_id", 272, 7)
    + "SELECT item AS user_id, est, exact FROM est WHERE est >= 0.001 * (SELECT sum(c) FROM items)",
)
def q_stream_cms_heavy_hitters(spark, sf):
    """Running count-min sketch of user ids as streaming state; heavy users (>= 0.1% of events) read from it."""
    s = file_stream(spark, sf, "events").select("user_id")
    cells = run_stream(ops.cms_state(s, "user_id", 0.01, 1e-3), "complete")
    ev = load(spark, sf, "events", ["user_id"])
    counts = monoid.count_by_key(ev, "user_id", "exact")
    est = sketch.cms_estimate(cells, counts, [], "user_id", 0.01, 1e-3)
    total = cells.where(F.col("depth") == 0).select(F.sum("cnt")).scalar()
    return est.where(F.col("est") >= F.lit(0.001) * total).select("user_id", "est", "exact")


@register(
    "stream_event_fold",
    """
    WITH RECURSIVE e AS (
      SELECT user_id, event_id, ts, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
    s AS (
      SELECT user_id, 0::BIGINT AS pos, NULL::BIGINT AS event_id, NULL::TIMESTAMP AS ts, 0::BIGINT AS run, 0::DOUBLE AS best FROM (SELECT DISTINCT user_id FROM events)
      UNION ALL
      SELECT e.user_id, e.pos, e.event_id, e.ts, CASE WHEN e.event_type = 'error' THEN 0 ELSE s.run + 1 END,
             CASE WHEN e.event_type = 'error' THEN 0 ELSE greatest(s.best, e.value) END
      FROM s JOIN e ON e.user_id = s.user_id AND e.pos = s.pos + 1)
    SELECT user_id, event_id, run, best FROM s WHERE pos > 0 AND ts < (SELECT max(ts) FROM events) - INTERVAL 1 day
    """,
)
def q_stream_event_fold(spark, sf):
    """Events since the last error and their greatest value, per user in event order, for all events that the watermark
    (one day behind the latest event) has passed."""

    def logic(state, row):
        _, kind, value = row
        state = (0, 0.0) if kind == "error" else (state[0] + 1, max(state[1], value))
        return state, state

    s = file_stream(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    with event_time.rocksdb_state(spark):
        out = run_stream(event_time.event_time_fold(
            s, "user_id", "ts", ["event_id"], ["event_type", "value"], logic, "run long, best double", (0, 0.0), "run long, best double", "1 day"),
            "append", sink="parquet")
    return out.select("user_id", "event_id", "run", "best")


@register(
    "stream_window_hitters",
    """
    WITH p AS (SELECT user_id, time_bucket(INTERVAL 6 hours, ts) AS pane FROM events),
    w AS (SELECT user_id, pane + i * INTERVAL 6 hours AS e FROM p, range(1, 5) r(i)),
    n AS (SELECT e, count(*) AS n FROM w GROUP BY 1)
    SELECT strftime(w.e, '%Y-%m-%d %H:%M') AS window_end, CAST(user_id AS VARCHAR) AS user_id, count(*) AS cnt
    FROM w JOIN n ON w.e = n.e WHERE w.e <= (SELECT max(ts) FROM events) - INTERVAL 1 hour
    GROUP BY w.e, user_id, n.n HAVING count(*) >= 0.02 * n.n
    """,
)
def q_stream_window_hitters(spark, sf):
    """Users with 2% of the events of the last 24 hours, every 6 hours, from a ring of pane summaries; windows end before
    the watermark (one hour behind the latest event)."""
    s = file_stream(spark, sf, "events").select("ts", "user_id")
    with event_time.rocksdb_state(spark):
        out = run_stream(event_time.pane_summaries(s, "ts", "user_id", 6 * 3600, 4, "1 hour", counters=100_000, buckets=8), "append", sink="parquet")
    hits = event_time.window_heavy_hitters(out, 0.02)
    shown = F.date_format(F.to_timestamp_ntz(F.date_format(F.timestamp_micros("end_us"), "yyyy-MM-dd HH:mm:ss")), "yyyy-MM-dd HH:mm")
    return hits.select(shown.alias("window_end"), F.col("item").alias("user_id"), "cnt")


@register(
    "stream_hll_error",
    "SELECT event_type, count(DISTINCT user_id) AS exact, true AS within_bound FROM events GROUP BY event_type",
)
def q_stream_hll_error(spark, sf):
    """Running distinct users per event type with the sketch's error in percent; contract: within 4 standard errors."""
    s = file_stream(spark, sf, "events").select("event_type", "user_id")
    out = run_stream(ops.distinct_error(s, ["event_type"], "user_id"), "complete")
    bound = F.lit(400 * sketch.hll_rse(12)) + F.lit(100.0) / F.col("exact")
    return out.select("event_type", "exact", (F.abs("error_pct") <= bound).alias("within_bound"))
