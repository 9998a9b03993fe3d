"""Event-time operators with state of their own: folds in event order, heavy hitters over the last panes.

Both run on ``transformWithState``: rows wait in the state store until the watermark has passed them, timers release
them, and what no later row can touch is dropped. The state store must be RocksDB; :func:`rocksdb_state` sets that for
the queries started inside it.
"""

from __future__ import annotations

import contextlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_MS = 1000


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's own choice comes back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class _OrderedFold(StatefulProcessor):
    """Buffers a key's rows and folds them in order once the watermark has passed them."""

    def __init__(self, key: str, row: T.StructType, state: T.StructType, init: tuple, logic: Callable, out: T.StructType):
        self.key, self.row, self.state, self.start, self.logic, self.out = key, row, state, init, logic, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.row)
        self.folded = handle.getValueState("folded", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [tuple(r) for pdf in rows for r in pdf[self.row.names].itertuples(index=False, name=None)]
        if new:
            new = [tuple(None if v is pd.NaT or v != v else v for v in r) for r in new]
            self.waiting.appendList(new)
            self.handle.registerTimer(min(r[0] for r in new) // _MS + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * _MS
        rows = sorted(tuple(r) for r in self.waiting.get())
        due = [r for r in rows if r[0] < passed]
        rest = rows[len(due):]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(rest[0][0] // _MS + 1)
        else:
            self.waiting.clear()
        state = tuple(self.folded.get()) if self.folded.exists() else self.start
        shown = []
        for r in due:
            state, output = self.logic(state, r[1:])
            shown.append((key[0], *r[1:], *output))
        if due:
            self.folded.update(state)
            yield pd.DataFrame(shown, columns=self.out.names)

    def close(self) -> None:
        pass


def event_time_fold(
    stream: DataFrame, key: str, ts: str, order: Sequence[str], keep: Sequence[str], logic: Callable[[tuple, tuple], tuple[tuple, tuple]],
    state: str, init: tuple, result: str, lateness: str,
) -> DataFrame:
    """``(key, order..., keep..., result fields)``: any per-key state logic over rows in event order.

    ``logic`` gets the state and a row's (order..., keep...) and returns the next state and the result's values; states
    are tuples of the DDL ``state``. A row waits until the watermark (the latest time less ``lateness``) has passed it,
    so rows that come out of order, also in later files, are folded in the order of (``ts``, ``order``...); rows behind
    the watermark (which starts at 1970) are dropped. ``order`` must tell rows of the same time apart and be without NULLs. A restart goes on
    from the stored state. Run it in append mode inside :func:`rocksdb_state`."""
    fields = [stream.schema[c] for c in [*order, *keep]]
    row = T.StructType([T.StructField("event_us", T.LongType()), *fields])
    out = T.StructType([stream.schema[key], *fields, *T.StructType.fromDDL(result)])
    x = stream.withWatermark(ts, lateness).select(key, ts, F.unix_micros(ts).alias("event_us"), *order, *keep).where(F.col(ts).isNotNull())
    fold = _OrderedFold(key, row, T.StructType.fromDDL(state), init, logic, out)
    return x.groupBy(key).transformWithStateInPandas(fold, out, "append", "eventTime")


# Built by hand: workers import this module without a session that could parse DDL.
_PANE = T.StructType([T.StructField("items", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType())),
                      T.StructField("total", T.LongType()), T.StructField("missed", T.LongType())])
_PANE_KEY = T.StructType([T.StructField("start", T.LongType())])


class _PaneRing(StatefulProcessor):
    """One bucket of items: a summary per pane, the window's panes added up when the watermark passes its end."""

    def __init__(self, pane_us: int, panes: int, counters: int, out: T.StructType):
        self.pane, self.panes, self.counters, self.out = pane_us, panes, counters, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getMapState("ring", _PANE_KEY, _PANE)

    def _cut(self, held: Counter, missed: int) -> int:
        """Misra-Gries: lower all counts by the largest that does not stay."""
        if len(held) > self.counters:
            by = sorted(held.values(), reverse=True)[self.counters]
            missed += by
            for x in list(held):
                held[x] -= by
                if held[x] <= 0:
                    del held[x]
        return missed

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new: dict[int, Counter] = {}
        for pdf in rows:
            for (start, item), n in pdf.groupby(["pane", "item"], dropna=False).size().items():
                new.setdefault(int(start), Counter())[item] += int(n)
        for start, counts in new.items():
            items, held, total, missed = self.ring.getValue((start,)) if self.ring.containsKey((start,)) else ([], [], 0, 0)
            summary = Counter(dict(zip(items, held)))
            summary.update(counts)
            missed = self._cut(summary, missed)
            self.ring.updateValue((start,), (list(summary), list(summary.values()), total + sum(counts.values()), missed))
            for i in range(1, self.panes + 1):  # the ends of all windows that hold the pane
                self.handle.registerTimer((start + i * self.pane) // _MS)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() * _MS
        first, held, total, missed = end - self.panes * self.pane, Counter(), 0, 0
        for start in sorted(k[0] for k in self.ring.keys()):
            if first <= start < end:
                items, counts, n, lost = self.ring.getValue((start,))
                held.update(dict(zip(items, counts)))
                total, missed = total + n, missed + lost
        if self.ring.containsKey((first,)):
            self.ring.removeKey((first,))  # no later window holds it
        missed = self._cut(held, missed)
        yield pd.DataFrame([(end, None, total, missed), *((end, x, c, 0) for x, c in held.items())], columns=self.out.names)

    def close(self) -> None:
        pass


def pane_summaries(stream: DataFrame, ts: str, item: str, pane_seconds: int, panes: int, lateness: str, counters: int = 1000, buckets: int = 64) -> DataFrame:
    """``(end_us, item, cnt, missed)``: for every window of ``panes`` panes that ends at a pane's end and holds rows, as the
    watermark passes its end: each bucket's counts of at most ``counters`` items, and a row with a NULL item that holds the
    bucket's rows and what its counts may lack. The state of a bucket is a ring of its last panes' summaries."""
    us = pane_seconds * 1_000_000
    x = stream.withWatermark(ts, lateness).where(F.col(ts).isNotNull() & F.col(item).isNotNull())
    micros = F.unix_micros(ts)
    x = x.select(ts, F.col(item).cast("string").alias("item"), (micros - F.pmod(micros, F.lit(us))).alias("pane"))
    x = x.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int"))
    out = T.StructType.fromDDL("end_us long, item string, cnt long, missed long")
    return x.groupBy("bucket").transformWithStateInPandas(_PaneRing(us, panes, counters, out), out, "append", "eventTime")


def window_heavy_hitters(summaries: DataFrame, pct: float) -> DataFrame:
    """``(end_us, item, cnt, missed)`` from the emitted summaries: the items that may reach ``pct`` of their window's rows.
    The true count lies between ``cnt`` and ``cnt + missed``; with ``missed`` 0 both list and counts are exact."""
    whole = summaries.where(F.col("item").isNull()).groupBy("end_us").agg(F.sum("cnt").alias("_n"), F.max("missed").alias("_missed"))
    items = summaries.where(F.col("item").isNotNull()).drop("missed").join(whole, "end_us")
    hit = F.col("cnt") + F.col("_missed") >= F.lit(float(pct)) * F.col("_n")
    return items.where(hit).select("end_us", "item", "cnt", F.col("_missed").alias("missed"))
