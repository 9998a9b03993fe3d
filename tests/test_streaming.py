"""Streaming equals batch, and a restarted query resumes from its checkpointed state."""

import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tallyframe.session import scratch_path
from tallyframe.streaming import event_time, file_stream, run_stream
from tallyframe.streaming import ops


def _write(folder, name, rows):
    t = pa.table({"user_id": pa.array([r[0] for r in rows], pa.int64()),
                  "event_id": pa.array([r[1] for r in rows], pa.int64()),
                  "value": pa.array([r[2] for r in rows], pa.float64())})
    pq.write_table(t, f"{folder}/{name}")


def test_restart_resumes_state(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write(src, "a-events.parquet", [(1, 1, 1.0), (1, 2, 2.0), (2, 3, 5.0)])
    ckpt = scratch_path(spark, "test-restart")
    s = file_stream(spark, str(src), "events")
    q1 = run_stream(ops.top_counts(s, "user_id", 10), "complete", checkpoint=ckpt, name="restart_a")
    assert {r["user_id"]: r["cnt"] for r in q1.collect()} == {1: 2, 2: 1}
    _write(src, "b-events.parquet", [(2, 4, 1.0), (2, 5, 1.0), (3, 6, 1.0)])
    s2 = file_stream(spark, str(src), "events")
    q2 = run_stream(ops.top_counts(s2, "user_id", 10), "complete", checkpoint=ckpt, name="restart_b")
    assert {r["user_id"]: r["cnt"] for r in q2.collect()} == {1: 2, 2: 3, 3: 1}


def test_ordered_fold_state_across_batches(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _write(src, "a-events.parquet", [(1, 2, 2.0), (1, 1, 1.0)])
    _write(src, "b-events.parquet", [(1, 3, 4.0), (2, 4, 1.0)])
    s = file_stream(spark, str(src), "events", max_files=1).withColumn("ts", F.col("event_id"))
    res = run_stream(ops.ordered_fold(s, "user_id", ["event_id"], "value", ["event_id"]), "append", sink="parquet")
    got = {r["event_id"]: r["state"] for r in res.collect()}
    assert got == {1: 1.0, 2: 3.0, 3: 7.0, 4: 1.0}


def test_bayes_changelog_latest_equals_batch(spark, tmp_path):
    import math

    import pyarrow as pa
    import pyarrow.parquet as pq

    from tallyframe.sources import literal_table

    src = tmp_path / "in"
    src.mkdir()
    for name, rows in [("a-events.parquet", [(1, "x"), (1, "y"), (2, "x")]), ("b-events.parquet", [(1, "x"), (2, "z")])]:
        pq.write_table(pa.table({"user_id": pa.array([r[0] for r in rows], pa.int64()),
                                 "event_type": pa.array([r[1] for r in rows])}), f"{src}/{name}")
    lik = literal_table(spark, [("h1", "x", 0.5), ("h1", "y", 0.5), ("h1", "z", 0.0),
                                ("h2", "x", 0.2), ("h2", "y", 0.3), ("h2", "z", 0.5)],
                        "hypo string, event_type string, lik double")
    s = file_stream(spark, str(src), "events", max_files=1)
    log = run_stream(ops.bayes_changelog(s, "user_id", "event_type", lik, ["h1", "h2"]), "append", sink="parquet")
    assert log.where("user_id = 1").agg(F.max("version")).first()[0] == 2
    cur = {r["user_id"]: (r["minlik"], r["ll"]) for r in ops.latest_version(log, "user_id").collect()}
    assert cur[1][0] == [0.5, 0.2]
    assert cur[1][1][0] == math.log(0.5) * 3 and abs(cur[1][1][1] - (2 * math.log(0.2) + math.log(0.3))) < 1e-12
    assert cur[2][0] == [0.0, 0.2]


def _events(folder, name, rows):
    """rows: (user_id, event_id, seconds, value)"""
    pq.write_table(pa.table({
        "user_id": pa.array([r[0] for r in rows], pa.int64()), "event_id": pa.array([r[1] for r in rows], pa.int64()),
        "ts": pa.array([r[2] * 1_000_000 for r in rows], pa.timestamp("us")), "value": pa.array([r[3] for r in rows], pa.float64())}), f"{folder}/{name}")


def _trail(state, row):
    """Order matters: the values seen so far, as a text of at most 40 characters."""
    state = ((state[0] + f",{row[1]:g}")[-40:], state[1] + 1)
    return state, (state[0],)


def _fold(spark, src, ckpt, max_files=1):
    s = file_stream(spark, str(src), "events", max_files=max_files)
    with event_time.rocksdb_state(spark):
        return run_stream(event_time.event_time_fold(
            s, "user_id", "ts", ["event_id"], ["value"], _trail, "trail string, n long", ("", 0), "trail string", "100 seconds"),
            "append", checkpoint=ckpt, sink="parquet")


def test_rows_out_of_order_fold_in_event_order_across_files_and_restarts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rng = random.Random(3)
    # Each row lies at most 90 seconds from its place; user 1 has more than a third of the rows.
    rows = [(rng.choice([1, 1, 2, 3]), i, 1000 + i * 10, float(rng.randint(0, 99))) for i in range(240)]
    mixed = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 90))
    for n in range(3):
        _events(src, f"{n}-events.parquet", mixed[n * 60:(n + 1) * 60])
    ckpt = scratch_path(spark, "event-fold")
    first = _fold(spark, src, ckpt).count()
    _events(src, "3-events.parquet", mixed[180:])
    got = _fold(spark, src, ckpt).collect()  # goes on from the stored state
    assert 0 < first < len(got)
    end, trails, want = max(r[2] for r in rows) - 100, {}, {}
    for user, event, at, value in sorted(rows, key=lambda r: (r[2], r[1])):
        trails[user] = (trails.get(user, "") + f",{value:g}")[-40:]
        if at < end:
            want[event] = (user, value, trails[user])
    assert {r["event_id"]: (r["user_id"], r["value"], r["trail"]) for r in got} == want and len(got) == len(want)


def test_rows_of_the_same_time_and_rows_behind_the_watermark(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    _events(src, "0-events.parquet", [(1, 3, 50, 3.0), (1, 1, 50, 1.0), (1, 2, 50, 2.0), (1, 9, 1000, 9.0)])
    _events(src, "1-events.parquet", [(1, 5, 950, 5.0), (1, 10, 5000, 10.0)])
    _events(src, "2-events.parquet", [(1, 4, 60, 4.0), (1, 11, 9000, 11.0)])  # the first is too late
    got = {r["event_id"]: r["trail"] for r in _fold(spark, src, scratch_path(spark, "event-fold")).collect()}
    assert got == {1: ",1", 2: ",1,2", 3: ",1,2,3", 5: ",1,2,3,5", 9: ",1,2,3,5,9", 10: ",1,2,3,5,9,10"}


def test_pane_rings_equal_a_batch_per_window(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rng = random.Random(8)
    rows = [(rng.choice([1, 1, 1, 2, 3, rng.randint(4, 40)]), i, 1000 + i * 7 + (3000 if i > 500 else 0), 0.0) for i in range(900)]
    mixed = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 50))
    for n in range(4):
        _events(src, f"{n}-events.parquet", mixed[n * 225:(n + 1) * 225])
    s = file_stream(spark, str(src), "events", max_files=1)
    with event_time.rocksdb_state(spark):
        out = run_stream(event_time.pane_summaries(s, "ts", "user_id", 300, 3, "60 seconds", buckets=5), "append", sink="parquet")
    got = {(r["end_us"] // 1_000_000, int(r["item"])): r["cnt"] for r in event_time.window_heavy_hitters(out, 0.1).collect()}
    last, want = max(r[2] for r in rows) - 60, {}
    for end in range(300, last + 1, 300):
        inside = Counter(r[0] for r in rows if end - 900 <= r[2] < end)
        want.update({(end, u): n for u, n in inside.items() if n >= 0.1 * inside.total()})
    assert got == want and len({e for e, _ in want}) > 10


def test_pane_summaries_with_few_counters_keep_their_bounds(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 2, rng.randint(3, 200)]), i, i + 1, 0.0) for i in range(1500)]
    _events(src, "0-events.parquet", rows)
    s = file_stream(spark, str(src), "events")
    with event_time.rocksdb_state(spark):
        out = run_stream(event_time.pane_summaries(s, "ts", "user_id", 300, 2, "10 seconds", counters=5, buckets=2), "append", sink="parquet")
    found = event_time.window_heavy_hitters(out, 0.15).collect()
    for end in range(300, 1490, 300):
        true = Counter(r[0] for r in rows if end - 600 <= r[2] < end)
        own = {int(r["item"]): r for r in found if r["end_us"] == end * 1_000_000}
        assert {u for u, n in true.items() if n >= 0.15 * true.total()} <= set(own)
        assert all(r["cnt"] <= true[u] <= r["cnt"] + r["missed"] for u, r in own.items())
