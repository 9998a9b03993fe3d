"""Structured Streaming plumbing: a Parquet file source and a run-to-completion helper.

Queries use ``trigger(availableNow=True)`` (process what is there, in bounded micro-batches, then stop) and
checkpoint their state under the session's shared checkpoint folder, so a restarted query resumes its state.
Aggregated results (one row per key) go to a memory table; per-event results go to Parquet files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.exprs import utc_instant
from tallyframe.session import scratch_path


# Files of one micro-batch: bounds the rows that a stateful step sees at once, whatever the backlog.
MAX_FILES = 64


def file_stream(spark: SparkSession, folder: str, table: str, max_files: int = MAX_FILES) -> DataFrame:
    """Stream the Parquet files named ``*<table>.parquet`` under ``folder``; ``ts`` becomes a TIMESTAMP whose
    UTC reading is the recorded wall clock (watermarks reject TIMESTAMP_NTZ, and days must not depend on the
    session time zone)."""
    pattern = f"{folder.rstrip('/')}/*{table}.parquet"
    schema = spark.read.parquet(pattern).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", int(max_files))
    df = reader.parquet(pattern)
    if "ts" in df.columns:
        df = df.withColumn("ts", utc_instant(F.col("ts")))
    return df


def run_stream(
    df: DataFrame, mode: str, checkpoint: str | None = None, sink: str = "memory", name: str | None = None,
) -> DataFrame:
    """Run ``df`` until the available input is consumed; return the result as a batch DataFrame.

    ``sink="memory"`` (complete/update aggregates) or ``"parquet"`` (append; rows written under the
    checkpoint folder). Pass the same ``checkpoint`` again to resume from the stored state.
    """
    spark = df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True)
    if sink == "memory":
        name = name or f"stream_{uuid.uuid4().hex[:10]}"
        q = w.format("memory").queryName(name).start()
        q.awaitTermination()
        return spark.table(name)
    out = f"{checkpoint}/out"
    q = w.format(sink).option("path", out).start()
    q.awaitTermination()
    return spark.read.format(sink).load(out)
