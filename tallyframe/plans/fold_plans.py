"""Ordered fold plans over events (per user, in time order) and SGD over lineitem (per return flag)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallyframe.operators import fold, fsm, ordered, sgd
from tallyframe.plans.catalog import register
from tallyframe.sources import load

WEEK = 7 * 86400


@register(
    "fold_scan",
    """
    SELECT user_id, row_number() OVER w AS pos, event_id, round(sum(value) OVER w, 6) AS state,
           round(2 * sum(value) OVER w, 6) AS output
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
    UNION ALL
    SELECT DISTINCT user_id, 0 AS pos, NULL::BIGINT AS event_id, 0.0 AS state, 0.0 AS output FROM events
    """,
)
def q_fold_scan(spark, sf):
    """Initial state 0, then state += value per event; every state is emitted with output = 2 × state."""
    ev = load(spark, sf, "events", ["user_id", "ts", "event_id", "value"])
    s = fold.scan(ev, ["user_id"], ["ts", "event_id"], F.col("value"), 0.0, "sum", lambda st: 2 * st,
                  block=ordered.time_block("ts", WEEK), keep=["event_id"])
    return s.select("user_id", "pos", "event_id", F.round("state", 6).alias("state"), F.round("output", 6).alias("output"))


@register(
    "fold_scan_semigroup",
    """
    SELECT user_id, row_number() OVER w AS pos, event_id, max(round(value)) OVER w AS state
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
    UNION ALL
    SELECT DISTINCT user_id, 0 AS pos, NULL::BIGINT AS event_id, 0.0 AS state FROM events
    """,
)
def q_fold_scan_semigroup(spark, sf):
    """prepare = round(value), plus = max, present = identity: the running maximum per user."""
    ev = load(spark, sf, "events", ["user_id", "ts", "event_id", "value"])
    s = fold.scan(ev, ["user_id"], ["ts", "event_id"], F.round("value"), 0.0, "max",
                  block=ordered.time_block("ts", WEEK), keep=["event_id"])
    return s.select("user_id", "pos", "event_id", "state")


@register(
    "state_reset_fold",
    """
    WITH r AS (SELECT user_id, max({'ts': ts, 'event_id': event_id}) AS last,
                      arg_max(value, {'ts': ts, 'event_id': event_id}) AS state0
               FROM events WHERE event_type = 'signup' GROUP BY 1),
    d AS (SELECT e.user_id, e.value FROM events e LEFT JOIN r ON e.user_id = r.user_id
          WHERE e.event_type <> 'signup' AND (r.last IS NULL OR {'ts': e.ts, 'event_id': e.event_id} > r.last)),
    s AS (SELECT user_id, sum(value) AS s, count(*) AS inputs FROM d GROUP BY 1),
    k AS (SELECT DISTINCT user_id FROM events)
    SELECT k.user_id, round(coalesce(r.state0, 0.0) + coalesce(s.s, 0.0), 6) AS state,
           CAST(coalesce(s.inputs, 0) AS BIGINT) AS inputs, r.last IS NOT NULL AS was_reset
    FROM k LEFT JOIN r ON k.user_id = r.user_id LEFT JOIN s ON k.user_id = s.user_id
    """,
)
def q_state_reset_fold(spark, sf):
    """A signup resets the state to its value; every other event adds its value."""
    ev = load(spark, sf, "events", ["user_id", "ts", "event_id", "event_type", "value"])
    out = fold.reset_fold(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") == "signup", F.col("value"),
                          F.col("value"))
    return out.withColumn("state", F.round("state", 6))


@register(
    "fold_last",
    """
    SELECT user_id, round(1.0 + sum(value), 6) AS state, count(*) AS inputs, round(2 * (1.0 + sum(value)), 6) AS output
    FROM events GROUP BY user_id
    """,
)
def q_fold_last(spark, sf):
    """Only the final state and the last output (start 1, state += value, output = 2 × state)."""
    ev = load(spark, sf, "events", ["user_id", "value"])
    out = fold.final(ev, ["user_id"], F.col("value"), 1.0, "sum", lambda st: 2 * st)
    return out.select("user_id", F.round("state", 6).alias("state"), "inputs", F.round("output", 6).alias("output"))


LEAK = math.exp(-0.1)  # what an event leaves of the state; no finite decimal, so rounding meets no ties


@register(
    "fold_affine",
    f"""
    WITH RECURSIVE e AS (
      SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
             CASE WHEN event_type = 'signup' THEN 0::DOUBLE ELSE {LEAK!r}::DOUBLE END AS a, value AS b FROM events),
    s AS (
      SELECT user_id, event_id, pos, b AS state FROM e WHERE pos = 1
      UNION ALL
      SELECT e.user_id, e.event_id, e.pos, e.a * s.state + e.b FROM s JOIN e ON e.user_id = s.user_id AND e.pos = s.pos + 1)
    SELECT user_id, event_id, round(state, 6) AS state FROM s
    """,
)
def q_fold_affine(spark, sf):
    """Every state of a leaky sum per user (state <- LEAK × state + value), which a signup resets to its value."""
    ev = load(spark, sf, "events", ["user_id", "ts", "event_id", "event_type", "value"])
    s = fold.affine_scan(ev, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", 0.0).otherwise(LEAK),
                         F.col("value"), block=ordered.time_block("ts", 86400))
    return s.select("user_id", "event_id", F.round("state", 6).alias("state"))


SGD_ORDER = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
SGD_STEP = 0.01
SGD_BLOCKS = 64  # ranges of order keys in which rows are numbered; chunks of rows are the unit of work
SGD_SQL = """
    list_reduce(list({'a': l_quantity / 50.0, 'b': l_extendedprice / 10000.0}
                     ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice),
                lambda w, r: {'a': w.a - 0.01 * (w.a * r.a + w.b - r.b) * r.a, 'b': w.b - 0.01 * (w.a * r.a + w.b - r.b)},
                {'a': 0.0, 'b': 0.0})
"""


def _sgd(spark, sf, by):
    li = load(spark, sf, "lineitem", ["l_returnflag", *SGD_ORDER])
    x = F.col("l_quantity") / 50.0
    y = F.col("l_extendedprice") / 1e4
    blk = ordered.range_block(li, "l_orderkey", SGD_BLOCKS)
    return sgd.sgd_linear(li, by, SGD_ORDER, y, [x], SGD_STEP, [0.0, 0.0], block=blk)


@register(
    "sgd_linear",
    f"""
    WITH f AS (SELECT l_returnflag, {SGD_SQL} AS w, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT l_returnflag, round(w.a, 6) AS w_x, round(w.b, 6) AS w_bias, n AS count FROM f
    """,
)
def q_sgd_linear(spark, sf):
    """One SGD pass per return flag: x = quantity/50, y = price/1e4, step 0.01, in (order, line, x, y) order."""
    w = _sgd(spark, sf, ["l_returnflag"])
    return w.select("l_returnflag", F.round(F.col("w")[0], 6).alias("w_x"), F.round(F.col("w")[1], 6).alias("w_bias"),
                    "count")


@register(
    "sgd_affine",
    f"""
    WITH f AS (SELECT {SGD_SQL} AS w, count(*) AS n FROM lineitem)
    SELECT round(w.a, 6) AS w_x, round(w.b, 6) AS w_bias, n AS count FROM f
    """,
)
def q_sgd_affine(spark, sf):
    """The same pass over the whole table as one key: blocks of order keys composed in order."""
    w = _sgd(spark, sf, [])
    return w.select(F.round(F.col("w")[0], 6).alias("w_x"), F.round(F.col("w")[1], 6).alias("w_bias"), "count")


@register(
    "linear_mse",
    f"""
    WITH f AS (SELECT l_returnflag, {SGD_SQL} AS w FROM lineitem GROUP BY 1)
    SELECT l.l_returnflag, round(avg(pow(l.l_extendedprice / 10000.0, 2)), 6) AS mse_zero,
           round(avg(pow(f.w.a * (l.l_quantity / 50.0) + f.w.b - l.l_extendedprice / 10000.0, 2)), 6) AS mse_fit
    FROM lineitem l JOIN f ON l.l_returnflag = f.l_returnflag GROUP BY 1
    """,
)
def q_linear_mse(spark, sf):
    """Mean squared error per flag at w = 0 and at the one-pass SGD weights."""
    w = _sgd(spark, sf, ["l_returnflag"])
    li = load(spark, sf, "lineitem", ["l_returnflag", "l_quantity", "l_extendedprice"])
    x = F.col("l_quantity") / 50.0
    y = F.col("l_extendedprice") / 1e4
    j = li.join(w, "l_returnflag")
    return j.groupBy("l_returnflag").agg(
        F.round(F.avg(F.pow(y, 2)), 6).alias("mse_zero"),
        F.round(sgd.mse(j, y, [x], F.col("w")), 6).alias("mse_fit"),
    )


FSM_STATES = ["new", "browsing", "interested", "buyer", "lapsed"]


def _life_cycle(state):
    """What an event makes of a user's state; a signup resets any, a purchase of a new user is not covered."""
    kind = F.col("event_type")
    return (
        F.when(kind == "signup", "new")
        .when((kind == "view") & state.isin("new", "lapsed"), "browsing")
        .when((kind == "click") & (state == "browsing"), "interested")
        .when((kind == "purchase") & (state != "new") & (F.col("value") > 20), "buyer")
        .when((kind == "error") & (state == "buyer"), "interested")
        .when((kind == "error") & (state == "interested"), "browsing")
        .when((kind == "error") & (state == "browsing"), "lapsed")
    )


@register(
    "fold_fsm",
    """
    WITH RECURSIVE e AS (
      SELECT user_id, event_id, event_type AS k, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
    s AS (
      SELECT user_id, 0::BIGINT AS pos, NULL::BIGINT AS event_id, 'new' AS state FROM (SELECT DISTINCT user_id FROM events)
      UNION ALL
      SELECT e.user_id, e.pos, e.event_id,
        CASE WHEN k = 'signup' THEN 'new'
             WHEN k = 'view' AND state IN ('new', 'lapsed') THEN 'browsing'
             WHEN k = 'click' AND state = 'browsing' THEN 'interested'
             WHEN k = 'purchase' AND state <> 'new' AND value > 20 THEN 'buyer'
             WHEN k = 'error' AND state = 'buyer' THEN 'interested'
             WHEN k = 'error' AND state = 'interested' THEN 'browsing'
             WHEN k = 'error' AND state = 'browsing' THEN 'lapsed' ELSE state END
      FROM s JOIN e ON e.user_id = s.user_id AND e.pos = s.pos + 1)
    SELECT user_id, event_id, state FROM s WHERE pos > 0
    """,
)
def q_fold_fsm(spark, sf):
    """Every state of a user's life cycle: a state machine with resets, folded in time order."""
    ev = load(spark, sf, "events", ["user_id", "ts", "event_id", "event_type", "value"])
    s = fsm.scan(ev, ["user_id"], ["ts", "event_id"], FSM_STATES, _life_cycle, "new", block=ordered.time_block("ts", 86400))
    return s.select("user_id", "event_id", "state")


LOGISTIC_CHUNK, LOGISTIC_STEP, LOGISTIC_ROUNDS = 2500, 0.05, 2


def _logistic_sql() -> str:
    """Every chunk's sequential pass and the weighted mean of its weights, round by round."""
    steps = [f"""
    WITH r AS (SELECT l_returnflag, l_quantity / 50.0 AS x, CASE WHEN l_extendedprice > 30000 THEN 1.0 ELSE 0.0 END AS y,
                      (row_number() OVER w - 1) // {LOGISTIC_CHUNK} AS chunk, row_number() OVER w AS i
               FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY {", ".join(SGD_ORDER)})),
    c AS MATERIALIZED (SELECT l_returnflag, chunk, count(*) AS n, list({{'a': x, 'b': y}} ORDER BY i) AS points FROM r GROUP BY 1, 2),
    w0 AS (SELECT DISTINCT l_returnflag, {{'a': 0.0::DOUBLE, 'b': 0.0::DOUBLE}} AS w FROM c)"""]
    for i in range(LOGISTIC_ROUNDS):
        miss = "(1.0 / (1.0 + exp(-(s.a * p.a + s.b))) - p.b)"
        steps.append(f"""p{i} AS MATERIALIZED (
      SELECT l_returnflag, c.n, list_reduce(list_prepend(w, list_transform(points, lambda p: {{'a': CAST(p.a AS DOUBLE), 'b': CAST(p.b AS DOUBLE)}})), lambda s, p:
        {{'a': s.a - {LOGISTIC_STEP} * {miss} * p.a, 'b': s.b - {LOGISTIC_STEP} * {miss}}}) AS w
      FROM c JOIN w{i} USING (l_returnflag)),
    w{i + 1} AS (SELECT l_returnflag, {{'a': sum(n * w.a) / sum(n), 'b': sum(n * w.b) / sum(n)}} AS w, sum(n) AS n FROM p{i} GROUP BY 1)""")
    last = f"w{LOGISTIC_ROUNDS}"
    return ", ".join(steps) + f" SELECT l_returnflag, round(w.a, 6) AS w_x, round(w.b, 6) AS w_bias, CAST(n AS BIGINT) AS count FROM {last}"


@register("sgd_logistic", _logistic_sql())
def q_sgd_logistic(spark, sf):
    """A logistic model of dear lines per return flag (x = quantity/50): two rounds of passes over chunks of 2500 rows,
    mixed by their rows."""
    li = load(spark, sf, "lineitem", ["l_returnflag", *SGD_ORDER])
    label = F.when(F.col("l_extendedprice") > 30000, 1.0).otherwise(0.0)
    blk = ordered.range_block(li, "l_orderkey", SGD_BLOCKS)
    w = sgd.sgd_mixed(li, ["l_returnflag"], SGD_ORDER, label, [F.col("l_quantity") / 50.0], LOGISTIC_STEP, rounds=LOGISTIC_ROUNDS,
                      block=blk, chunk_rows=LOGISTIC_CHUNK)
    return w.select("l_returnflag", F.round(F.col("w")[0], 6).alias("w_x"), F.round(F.col("w")[1], 6).alias("w_bias"), "count")
