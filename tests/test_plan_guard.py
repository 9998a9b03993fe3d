"""Physical-plan guard: no Cartesian products or nested-loop joins (an ungrouped PMF product
is an equi-join on block pairs, hypotheses are exploded from one packed row)."""

import pytest

import __spark_entry__ as entry
from tallyframe.plans import all_queries

from .conftest import SF01

ALLOWED_PAIRINGS: set[str] = set()
# Python runs in batch plans only over Arrow batches: SGD and scans by chunks of fixed size, and states that a task
# keeps of its rows (user aggregators, compressed trees, counter summaries), and
# blocks of lattice points.
ALLOWED_PYTHON = {"sgd_linear", "sgd_affine", "sgd_logistic", "linear_mse", "fold_affine", "fold_fsm", "user_aggregator", "qtree_tree", "qtree_range",
                  "heavy_hitters", "heavy_hitters_top10", "frequent_words", "frequent_parts", "exact_sum"}
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "AggregateInPandas")
BATCH = sorted(n for n in all_queries() if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_pair_explosion(spark, name):
    df = entry.queries()[name](spark, SF01)
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in plan]
    if name not in ALLOWED_PAIRINGS:
        assert not found, f"{name}: {found}"
    py = [k for k in PYTHON_NODES if k in plan]
    if name not in ALLOWED_PYTHON:
        assert not py, f"{name}: Python in the plan {py}"
