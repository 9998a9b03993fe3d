"""Sources: the Parquet tables, JSON records, headerless x,y CSV, text lines and "a, b" message parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one Parquet table; selecting ``columns`` right away keeps the scan's ReadSchema narrow."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialize(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the session's shared checkpoint folder and read it back.

    Used for stored intermediate results (e.g. daily sketches that later jobs re-merge) and to cut long
    lineages: a lost executor then recomputes from the stored table, not from the raw input.
    """
    from tallyframe.session import scratch_path

    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table (model parameters, hypotheses) built in the JVM from literals: a local relation,
    no Python-side RDD. ``schema`` is a DDL string such as ``"hypo string, prior double"``."""
    fields = [f.strip().split()[:2] for f in schema.split(",")]
    structs = [
        F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def read_json_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON scan. A file holding one top-level array on one line yields one row per array element."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def read_xy_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``x, y`` CSV with each line's place, so order-dependent folds can follow file order.

    ``(file, block, seq)`` is that order for any number of files and however they are split: a block is read by one task
    from its first byte on, and ``seq`` rises within it. For a single file read as one block ``seq`` alone will do.
    """
    df = (
        spark.read.option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .schema("x double, y double")
        .csv(path)
    )
    return df.select("x", "y", F.monotonically_increasing_id().alias("seq"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_pairs(line: Column, first: str = "userId", second: str = "itemId") -> list[Column]:
    """Parse ``"1, 90001"`` style messages into two INT columns; malformed parts become NULL."""
    parts = F.split(line, ",")
    return [
        F.trim(F.element_at(parts, 1)).try_cast("int").alias(first),
        F.trim(F.element_at(parts, 2)).try_cast("int").alias(second),
    ]
