"""User-defined aggregators: prepare, plus, present, with partial states that merge by key and bucket.

``prepare`` makes a state of a row, ``plus`` (associative) merges two states, ``present`` makes the result of a state.
Each task folds its rows into one state per key as the Arrow batches come; a task that holds many keys sends its states
on and starts anew. Partial states merge in the order of their tasks, first those of ``FAN`` neighbouring tasks, then
the rest, so that no group of rows and no long list of states lies in one call, whatever its key holds. A ``plus`` that
is not commutative sees rows in the order of the table's partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyframe.operators.pmf import _by

#: Keys whose states a task holds at a time, and neighbouring tasks whose states merge first.
KEYS, FAN = 200_000, 256


@dataclass(frozen=True)
class Aggregator:
    """``state`` and ``result`` are the DDL of a state's and a result's fields; states and results are tuples."""

    state: str
    prepare: Callable[..., tuple]
    plus: Callable[[tuple, tuple], tuple]
    result: str = ""
    present: Callable[[tuple], tuple] | None = None

    def prepared(self, before: Callable[..., tuple]) -> Aggregator:
        """The aggregator of what ``before`` makes of a row's values."""
        return Aggregator(self.state, lambda *row: self.prepare(*before(*row)), self.plus, self.result, self.present)

    def presented(self, result: str, after: Callable[[tuple], tuple]) -> Aggregator:
        """The aggregator whose result goes through ``after``."""
        own = self.present or (lambda s: s)
        return Aggregator(self.state, self.prepare, self.plus, result, lambda s: after(own(s)))


def together(*parts: Aggregator) -> Aggregator:
    """One aggregator of several over the same row values: fields follow each other, their names must differ."""
    sizes = [len(StructType.fromDDL(p.state).fields) for p in parts]
    ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]

    def split(state: tuple) -> list[tuple]:
        return [tuple(state[e - n:e]) for n, e in zip(sizes, ends)]

    return Aggregator(
        ", ".join(p.state for p in parts),
        lambda *row: tuple(v for p in parts for v in p.prepare(*row)),
        lambda a, b: tuple(v for p, x, y in zip(parts, split(a), split(b)) for v in p.plus(x, y)),
        ", ".join(p.result or p.state for p in parts),
        lambda s: tuple(v for p, x in zip(parts, split(s)) for v in (p.present(x) if p.present else x)))


def _ddl(df: DataFrame, names: Sequence[str]) -> str:
    return "".join(f"`{n}` {df.schema[n].dataType.simpleString()}, " for n in names)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def partial_states(df: DataFrame, by, columns: Sequence[str], agg: Aggregator, keys: int = KEYS) -> DataFrame:
    """``(by..., _part, _turn, state fields)``: what each task makes of its rows, one state per key and turn."""
    by = _by(by)
    schema = _ddl(df, by) + "_part long, _turn long, " + agg.state
    target, n = to_arrow_schema(StructType.fromDDL(schema)), len(by)
    prepare, plus = agg.prepare, agg.plus

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn, states = TaskContext.get().partitionId(), 0, {}

        def rows() -> Iterator[tuple]:
            return ((*key, part, turn, *state) for key, state in states.items())

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                key, state = row[:n], prepare(*row[n:])
                old = states.get(key)
                states[key] = state if old is None else plus(old, state)
            if len(states) >= keys:
                yield from _batches(rows(), target)
                states, turn = {}, turn + 1
        yield from _batches(rows(), target)

    return df.select(*by, *columns).mapInArrow(fold, schema)


def merged(partial: DataFrame, by, agg: Aggregator, fan: int = FAN) -> DataFrame:
    """``(by..., result fields)`` from partial states (of this run or stored ones): sorted by key and task, merged as
    they come, first within ``fan`` neighbouring tasks, then per key."""
    by = _by(by)
    plus, n, near = agg.plus, len(by), F.floor(F.col("_part") / F.lit(fan)).cast("bigint")
    stated, shown = to_arrow_schema(StructType.fromDDL(agg.state)).names, agg.result or agg.state

    def merge(keys: int, schema: str, present: Callable[[tuple], tuple], skip: int):
        target = to_arrow_schema(StructType.fromDDL(schema))

        def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            key, state = None, None
            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns]):
                    if state is not None and row[:keys] == key:
                        state = plus(state, row[skip:])
                        continue
                    if state is not None:
                        yield (*key, *present(state))
                    key, state = row[:keys], row[skip:]
            if state is not None:
                yield (*key, *present(state))

        return lambda batches: _batches(runs(batches), target)

    around = partial.select(*by, near.alias("_near"), "_part", "_turn", *stated)
    around = around.repartition(*by, "_near").sortWithinPartitions(*by, "_near", "_part", "_turn")
    schema = _ddl(partial, by) + "_near long, "
    once = around.mapInArrow(merge(n + 1, schema + agg.state, lambda s: s, n + 3), schema + agg.state)
    once = (once.repartition(*by) if by else once.repartition(1)).sortWithinPartitions(*by, "_near")
    schema = _ddl(partial, by) + shown
    return once.mapInArrow(merge(n, schema, agg.present or (lambda s: s), n + 1), schema)


def aggregate(df: DataFrame, by, columns: Sequence[str], agg: Aggregator, keys: int = KEYS, fan: int = FAN) -> DataFrame:
    """``(by..., result fields)``: ``prepare`` gets a row's ``columns``. NULL is a key like any other; without ``by``
    an empty table gives no row."""
    return merged(partial_states(df, by, columns, agg, keys), by, agg, fan)
