"""Shared helpers of the operators: stored tables, size-checked broadcasts, Arrow batches and row identity."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType

from tallyframe.sources.tables import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of its values up to which a stored table is broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 12 << 20


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cuts lineage and survives lost executors."""
    return materialize(df, kind)


def hinted(table: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, marked for broadcast only if the summed bytes of its values allow it."""

    def width(field: StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 8
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
        return F.lit(8)

    row = sum((width(f) for f in table.schema.fields), F.lit(16))
    return F.broadcast(table) if (table.agg(F.sum(row.cast("long"))).first()[0] or 0) <= most else table


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def arrow_map(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str, rows: int = 512) -> DataFrame:
    """Run ``fn`` over Arrow batches of at most ``rows`` rows; it maps lists by column name to lists by column name."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def kind_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def keep_rows(docs: DataFrame, decisions: DataFrame, once: bool = False) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (doc_id, text_hash = xxhash64(text), kept) keep, with their columns.

    A row is known by its doc_id and text, so rows repeated in both share one fate; with ``once`` a kept row
    that is repeated stays once. Only the dropped keys are joined, so kept text is not shuffled for them.
    """
    votes = decisions.groupBy(F.col("doc_id").alias("__tf_id"), F.col("text_hash").alias("__tf_hash")).agg(
        F.max("kept").alias("__tf_kept"), F.count(F.lit(1)).alias("__tf_n")
    )
    votes = stored(votes.where(~F.col("__tf_kept") | (F.col("__tf_n") > 1)), "decisions")
    hashed = docs.withColumn("__tf_h", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__tf_id")) & (F.col("__tf_h") == F.col("__tf_hash"))
    dropped = votes.where(~F.col("__tf_kept"))
    kept = hashed.join(hinted(dropped), same, "left_anti")
    twice = votes.where("__tf_kept")
    if once and twice.limit(1).count():
        repeated = kept.join(hinted(twice), same, "left_semi").dropDuplicates(["doc_id", "__tf_h"])
        kept = kept.join(hinted(twice), same, "left_anti").unionByName(repeated)
    return kept.select(*[kept[f"`{c}`"] for c in docs.columns])
