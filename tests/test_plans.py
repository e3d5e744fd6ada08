"""Scale invariants of every registered query's physical plan (planned, not
executed): no cartesian / nested-loop joins, no Python UDFs, pruned scans,
and map-side partial aggregation before every aggregate shuffle."""

import re

import pytest

from storelens.queries import QUERIES
from tests.conftest import SF_SMALL

WRITES_WHILE_BUILDING = {"csv_roundtrip", "pipeline_fact_keyed", "raw_csv_apps", "raw_csv_reviews",
                         "csv_roundtrip_apps", "landing_refresh", "warehouse_fact"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_WHILE_BUILDING))
def test_plan_is_scale_safe(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"
    for cols in re.findall(r"FileScan parquet \[([^\]]*)\].*?lineitem\.parquet", plan):
        assert len(cols.split(",")) <= 6, f"{name}: lineitem scan not pruned: {cols}"
    for cols in re.findall(r"FileScan parquet \[([^\]]*)\].*?part\.parquet", plan):
        data = [c for c in cols.split(",") if not c.startswith(("_tmp_metadata_row_index", "file_path"))]
        assert len(data) <= 6  # a row's position is no column of the file
    if "HashAggregate" in plan:
        assert "partial_" in plan or re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[\]", plan), \
            f"{name}: no map-side partial aggregation"
