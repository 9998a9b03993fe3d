"""Sessions as deployments start them: without a checkpoint setting, without optional parts."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PLAIN = """
from pyspark.sql import SparkSession
import __spark_entry__ as entry
from tallyframe.session import ensure_checkpoint_dir
from tallyframe.sources.tables import materialize
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert entry.entry(spark).count() > 0
folder = ensure_checkpoint_dir(spark)
assert folder == ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
assert materialize(spark.range(5), "kept").count() == 5
assert spark.range(5).checkpoint().count() == 5
print("fine")
"""

WITHOUT_TOKENIZERS = """
import sys
sys.modules["public_tokenizers"] = None  # an import of it fails
import __spark_entry__ as entry
names = entry.queries()
assert "pmf_mode" in names and len(names) >= 92 and not any(n.startswith("op") or n == "pipeline" for n in names), names
assert set(entry.oracle_sql()) <= set(names)
print("fine")
"""


def run(code, **env):
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, env={**os.environ, "PYTHONPATH": REPO, **env}, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("fine"), out.stderr[-3000:]


def test_session_without_checkpoint_setting(tmp_path):
    run(PLAIN, SPARK_CONF_DIR=str(tmp_path))


def test_core_plans_without_the_optional_parts():
    run(WITHOUT_TOKENIZERS)


def test_csv_lines_keep_their_order_over_files_and_splits(spark, tmp_path):
    from tallyframe.sources import read_xy_csv

    for name, start in (("a", 0), ("b", 3000)):
        (tmp_path / f"{name}.csv").write_text("".join(f"{start + i}, {i % 7}\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_xy_csv(spark, str(tmp_path))
        rows = df.orderBy("file", "block", "seq").collect()
        assert df.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["x"] for r in rows] == [float(i) for i in range(6000)]
