"""Plan-shape assertions: column pruning and partition pruning reach the scans."""

import re

from stocktake.plans import pipeline as P
from stocktake.plans.queries import QUERIES
from stocktake.operators import rules as R
from stocktake.sources.readers import read_listing_table
from tests import fixtures as X

SF = "/root/testdata/sf0.001"


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln.strip() for ln in plan.splitlines() if "FileScan parquet" in ln]


def test_map_reads_two_columns_of_documents(spark):
    from stocktake.operators import uri_map as M
    from stocktake.plans import documents as D

    # Before materialization: the map's own scan of documents.
    scans = _scans(M.unpivot_map(M.clean_map(D.wide_map_from_documents(D.table(spark, SF, "documents")))))
    cols = [re.search(r"FileScan parquet \[([^\]]*)\]", s).group(1) for s in scans]
    assert cols and all(re.sub(r"#\d+L?", "", c) in ("lang,source", "source,lang") for c in cols)


def test_map_is_read_from_its_checkpoint(spark):
    plan = QUERIES["analysis_full"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan or "LogicalRDD" in plan or "RDDScan" in plan
    assert "FileScan parquet [lang" not in plan and "FileScan parquet [source" not in plan


def test_url_parts_never_read_html(spark):
    scans = _scans(QUERIES["url_parts_pages"](spark, SF))
    assert scans and all("html" not in s.split("]")[0] for s in scans)


def test_run_filter_is_a_partition_filter(spark, tmp_root):
    P.full_diff(X.wide_map(spark), R.RuleConfig(origin="pro"), raw=X.raw_entries(spark), out_root=tmp_root, run_id="r1")
    scans = _scans(read_listing_table(spark, f"{tmp_root}/accounts", "r1"))
    assert scans and "PartitionFilters: [isnotnull(run_id" in scans[0] and "(run_id" in scans[0].split("PartitionFilters:")[1]


def test_analysis_sorts_no_objects_and_reads_them_once(spark):
    df = QUERIES["analysis_full"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    nodes = [re.sub(r"^[\s:+\-*()\d]*", "", line).split(" ")[0].split("(")[0] for line in plan.splitlines()]
    assert not {"Sort", "Window", "SortAggregate", "SortMergeJoin"} & set(nodes), plan
    assert "ReusedExchange" in nodes and sum("FileScan parquet" in line and "text" in line for line in plan.splitlines()) == 1, plan
