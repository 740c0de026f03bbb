"""Plan shape: pruning and pushdown reach the scan, no cross products, no
row-at-a-time Python in the hot path."""

from assay.plans import QUERIES

from conftest import SMOKE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_reaches_scan(spark):
    p = plan(QUERIES["project_allowlist"](spark, SMOKE))
    read = [line for line in p.split("\n") if "ReadSchema" in line or "FileScan" in line]
    assert any("o_orderkey" in r for r in read)
    assert not any("o_orderpriority" in r or "o_custkey" in r for r in read)


def test_filters_pushed_to_parquet(spark):
    p = plan(QUERIES["run_filter"](spark, SMOKE))
    pushed = [line for line in p.split("\n") if "PushedFilters" in line][0]
    assert "user_id" in pushed and "ts" in pushed


def test_month_range_prunes_partitions(spark):
    p = plan(QUERIES["usage_month_range"](spark, SMOKE))
    assert "PartitionFilters: [" in p and "month" in p.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_scorecard_reads_each_table_once(spark):
    p = plan(QUERIES["scorecard"](spark, SMOKE))
    assert p.count("lineitem.parquet") == 1 and p.count("orders.parquet") == 1
    assert "CartesianProduct" not in p and "BatchEvalPython" not in p


def test_no_cross_products_anywhere(spark):
    for name in ["scorecard", "snapshot_diff", "manifest_reconcile", "lint_findings", "membership_gap",
                 "completeness_vs_baseline", "required_groups_gate", "prefix_match_users", "dangling_links"]:
        p = plan(QUERIES[name](spark, SMOKE))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_wide_text_not_shuffled_in_snapshot_diff(spark):
    p = plan(QUERIES["snapshot_diff"](spark, SMOKE))
    # only digests and lengths cross the exchange
    for line in p.split("\n"):
        if "Exchange hashpartitioning" in line:
            assert "contents" not in line and "text" not in line
