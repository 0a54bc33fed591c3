"""Every registered query against its SQL twin, and a look at every plan."""

import re

import oracle
import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()

# the only window over a whole frame: finished reports of at most a few hundred or thousand rows
REPORTS = {"i5_i6_pairwise_holm"}


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert oracle.compare(df, duck, ORACLES[name]) == ""
    else:
        rows = df.collect()
        assert rows or name.startswith("l5")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in REPORTS:
        # a window that gathers everything in one task may only run over band counts
        gathered = re.findall(r"Window \[([^\n]*)\n[^\n]*Sort[^\n]*\n[^\n]*SinglePartition", plan)
        assert all("_band0" in w or "_b#" in w for w in gathered), gathered
