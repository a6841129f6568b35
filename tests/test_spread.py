"""Scans stay as they are: pruned columns, and no exchange that depends on an input's size."""

import re

from vigil.sources.catalog import Catalog


def test_scans_are_pruned_and_not_dealt_anew(spark):
    plan = Catalog(spark, "/root/testdata/sf0.1").inspections.select("inspection_id")._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "REPARTITION" not in plan
    scanned = re.findall(r"FileScan parquet \[([^\]]*)\].*?lineitem", plan)
    assert scanned and all(len(cols.split(",")) <= 3 for cols in scanned), scanned
