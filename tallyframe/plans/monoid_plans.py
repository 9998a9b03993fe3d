"""Mergeable-aggregate plans over lineitem, events and documents."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallyframe.functions.exprs import ntz_micros
from tallyframe.operators import aggregator, decay, monoid, ordered
from tallyframe.plans.catalog import register
from tallyframe.sources import load, parse_pairs

EPOCH_2024 = "2024-01-01 00:00:00"


def hours_since_2024(ts: str = "ts"):
    """Event time in hours from a fixed instant (wall-clock arithmetic, independent of the session zone)."""
    us = ntz_micros(F.col(ts)) - ntz_micros(F.lit(EPOCH_2024))
    return us / F.lit(3.6e9)


HOURS_SQL = "(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 3600000000.0"


@register(
    "mono_sum",
    """
    SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS sum_line, CAST(sum(l_orderkey) AS BIGINT) AS sum_orderkey,
           round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price
    FROM lineitem GROUP BY l_returnflag
    """,
)
def q_mono_sum(spark, sf):
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_linenumber", "l_orderkey", "l_quantity", "l_extendedprice"])
    out = monoid.multi_aggregate(
        li,
        ["l_returnflag"],
        [("sum_line", "sum", "l_linenumber"), ("sum_orderkey", "sum", "l_orderkey"),
         ("sum_qty", "sum", "l_quantity"), ("sum_price", "sum", "l_extendedprice")],
    )
    return out.withColumn("sum_qty", F.round("sum_qty", 2)).withColumn("sum_price", F.round("sum_price", 2))


@register(
    "mono_set_union",
    """
    SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types
    FROM events GROUP BY user_id
    """,
)
def q_mono_set_union(spark, sf):
    ev = load(spark, sf, "events", ["user_id", "event_type"])
    s = monoid.set_union(ev, ["user_id"], "event_type", out="types")
    return s.select("user_id", F.array_join("types", ",").alias("types"))


@register(
    "mono_tuple",
    """
    SELECT l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, max(l_discount) AS max_disc,
           array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags
    FROM lineitem GROUP BY l_linestatus
    """,
)
def q_mono_tuple(spark, sf):
    li = load(spark, sf, "lineitem", ["l_linestatus", "l_quantity", "l_discount", "l_returnflag"])
    out = monoid.multi_aggregate(
        li,
        ["l_linestatus"],
        [("n", "count", F.lit(1)), ("sum_qty", "sum", "l_quantity"), ("max_disc", "max", "l_discount"),
         ("flags", "set", "l_returnflag")],
    )
    return out.select("l_linestatus", "n", F.round("sum_qty", 2).alias("sum_qty"), "max_disc",
                      F.array_join("flags", ",").alias("flags"))


@register(
    "mono_sum_max_min",
    """
    SELECT event_type, round(sum(value), 2) AS sum_value, max(value) AS max_value, min(value) AS min_value
    FROM events GROUP BY event_type
    """,
)
def q_mono_sum_max_min(spark, sf):
    ev = load(spark, sf, "events", ["event_type", "value"])
    out = monoid.multi_aggregate(
        ev, ["event_type"], [("sum_value", "sum", "value"), ("max_value", "max", "value"), ("min_value", "min", "value")]
    )
    return out.withColumn("sum_value", F.round("sum_value", 2))


@register(
    "multi_agg",
    """
    SELECT l_linestatus, round(sum(l_quantity), 2) AS sum_qty, max(l_extendedprice) AS max_price,
           min(l_discount) AS min_disc, round(avg(l_tax), 9) AS avg_tax
    FROM lineitem GROUP BY l_linestatus
    """,
)
def q_multi_agg(spark, sf):
    li = load(spark, sf, "lineitem", ["l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    out = monoid.multi_aggregate(
        li,
        ["l_linestatus"],
        [("sum_qty", "sum", "l_quantity"), ("max_price", "max", "l_extendedprice"),
         ("min_disc", "min", "l_discount"), ("avg_tax", "avg", "l_tax")],
    )
    return out.withColumn("sum_qty", F.round("sum_qty", 2)).withColumn("avg_tax", F.round("avg_tax", 9))


@register(
    "moments",
    """
    SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS stddev
    FROM events GROUP BY event_type
    """,
)
def q_moments(spark, sf):
    ev = load(spark, sf, "events", ["event_type", "value"])
    out = monoid.multi_aggregate(
        ev, ["event_type"], [("n", "count", F.lit(1)), ("mean", "avg", "value"), ("stddev", "stddev_pop", "value")]
    )
    return out.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


@register(
    "map_merge",
    """
    SELECT user_id, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
      SELECT user_id, count(*) AS cnt FROM events WHERE event_type = 'click' GROUP BY user_id
      UNION ALL
      SELECT user_id, count(*) AS cnt FROM events WHERE event_type IS DISTINCT FROM 'click' GROUP BY user_id) u
    GROUP BY user_id
    """,
)
def q_map_merge(spark, sf):
    ev = load(spark, sf, "events", ["user_id", "event_type"])
    clicks = monoid.count_by_key(ev.where(F.col("event_type") == "click"), "user_id")
    others = monoid.count_by_key(ev.where(~F.col("event_type").eqNullSafe("click")), "user_id")
    return monoid.map_merge(clicks, others, key="user_id", value="cnt")


@register("count_by_key", "SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_partkey")
def q_count_by_key(spark, sf):
    return monoid.count_by_key(load(spark, sf, "lineitem", ["l_partkey"]), "l_partkey")


@register(
    "top10_exact",
    "SELECT l_partkey, count(*) AS cnt FROM lineitem GROUP BY l_partkey ORDER BY cnt DESC, l_partkey LIMIT 10",
)
def q_top10_exact(spark, sf):
    counts = monoid.count_by_key(load(spark, sf, "lineitem", ["l_partkey"]), "l_partkey")
    return monoid.top_k(counts, [], 10, "cnt", "l_partkey")


@register(
    "word_distinct",
    r"""
    WITH w AS (SELECT source, unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents)
    SELECT source, count(DISTINCT word) AS distinct_words, count(*) AS words FROM w WHERE word <> '' GROUP BY source
    """,
)
def q_word_distinct(spark, sf):
    return monoid.distinct_words(load(spark, sf, "documents", ["source", "text"]), ["source"], "text")


@register(
    "decayed_avg",
    f"""
    WITH e AS (SELECT user_id, value, {HOURS_SQL} AS t FROM events),
    m AS (SELECT user_id, value, t, max(t) OVER (PARTITION BY user_id) AS tmax FROM e)
    SELECT user_id, round(sum(value * pow(2.0, -(tmax - t) / 24.0)), 6) AS decayed,
           round(sum(value * pow(2.0, -(tmax - t) / 24.0)) * ln(2.0) / 24.0, 6) AS decayed_avg
    FROM m GROUP BY user_id
    """,
)
def q_decayed_avg(spark, sf):
    ev = load(spark, sf, "events", ["user_id", "value", "ts"])
    d = decay.decayed_value(ev, ["user_id"], "value", hours_since_2024(), 24.0)
    return d.select("user_id", F.round("decayed", 6).alias("decayed"), F.round("decayed_avg", 6).alias("decayed_avg"))


@register(
    "decayed_running",
    f"""
    WITH e AS (SELECT event_id, user_id, value, {HOURS_SQL} AS t FROM events)
    SELECT event_id, user_id,
           round(pow(2.0, -t / 24.0) * sum(value * pow(2.0, t / 24.0))
                 OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING), 6) AS decayed
    FROM e
    """,
)
def q_decayed_running(spark, sf):
    ev = load(spark, sf, "events", ["event_id", "user_id", "value", "ts"])
    d = decay.decayed_running(ev, ["user_id"], ["ts", "event_id"], "value", hours_since_2024(), 24.0)
    return d.select("event_id", "user_id", F.round("decayed", 6).alias("decayed"))


@register(
    "sort_per_key",
    """
    SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS pos
    FROM events
    """,
)
def q_sort_per_key(spark, sf):
    ev = load(spark, sf, "events", ["user_id", "event_id", "value"])
    r = ordered.rank_within(ev, ["user_id"], ["value", "event_id"], "pos", block=ordered.value_block("value", 50.0))
    return r.select("user_id", "event_id", "value", "pos")


@register(
    "parse_csv_message",
    """
    WITH m AS (SELECT CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) || ', x'
                      ELSE CAST(user_id AS VARCHAR) || ',  ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS msg
               FROM events),
    p AS (SELECT TRY_CAST(trim(split_part(msg, ',', 1)) AS INTEGER) AS userId,
                 TRY_CAST(trim(split_part(msg, ',', 2)) AS INTEGER) AS itemId FROM m)
    SELECT itemId, count(DISTINCT userId) AS users, count(*) AS ratings
    FROM p WHERE userId IS NOT NULL AND itemId IS NOT NULL GROUP BY itemId
    """,
)
def q_parse_csv_message(spark, sf):
    ev = load(spark, sf, "events", ["user_id", "event_type", "value"])
    msg = F.when(F.col("event_type") == "error", F.concat(F.col("user_id").cast("string"), F.lit(", x"))).otherwise(
        F.concat(F.col("user_id").cast("string"), F.lit(",  "), F.floor("value").cast("bigint").cast("string"))
    )
    parsed = ev.select(*parse_pairs(msg, "userId", "itemId")).dropna()
    return parsed.groupBy("itemId").agg(F.count_distinct("userId").alias("users"), F.count(F.lit(1)).alias("ratings"))


@register(
    "scan_json_props",
    """
    SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
    FROM events GROUP BY 1, 2
    """,
)
def q_scan_json_props(spark, sf):
    ev = load(spark, sf, "events", ["event_type", "props"])
    parsed = ev.select("event_type", F.from_json("props", "k BIGINT").alias("p"))
    return parsed.groupBy("event_type", F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


#: log of a sum of exponentials, kept as (number, greatest exponent, sum relative to it), so that nothing overflows.
LOG_SUM_EXP = aggregator.Aggregator(
    "n long, top double, total double", lambda v: (1, v, 1.0),
    lambda a, b: (a[0] + b[0], max(a[1], b[1]), a[2] * math.exp(a[1] - max(a[1], b[1])) + b[2] * math.exp(b[1] - max(a[1], b[1]))),
    "n long, log_mean_exp double", lambda s: (s[0], s[1] + math.log(s[2]) - math.log(s[0])))


@register(
    "user_aggregator",
    """
    WITH e AS (SELECT event_type, value * 10 AS v, user_id FROM events), t AS (SELECT event_type, max(v) AS top FROM e GROUP BY 1)
    SELECT event_type, count(*) AS n, round(top + ln(sum(exp(v - top))) - ln(count(*)), 6) AS log_mean_exp, min(user_id) AS first_user, max(user_id) AS last_user
    FROM e JOIN t USING (event_type) GROUP BY event_type, top
    """,
)
def q_user_aggregator(spark, sf):
    """User-defined aggregators side by side: log-mean-exp (a three-field state) and the range of users."""
    ev = load(spark, sf, "events", ["event_type", "value", "user_id"]).withColumn("value", F.col("value") * 10)
    span = aggregator.Aggregator("first_user long, last_user long", lambda u: (u, u), lambda a, b: (min(a[0], b[0]), max(a[1], b[1])))
    both = aggregator.together(LOG_SUM_EXP.prepared(lambda v, u: (v,)), span.prepared(lambda v, u: (u,)))
    out = aggregator.aggregate(ev, ["event_type"], ["value", "user_id"], both)
    return out.withColumn("log_mean_exp", F.round("log_mean_exp", 6))
