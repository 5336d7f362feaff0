"""Plan properties: pushdown, pruning, no Python in the batch path."""

from candela.plans.queries import REGISTRY
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ticker_filter_reaches_parquet_scan(spark):
    p = plan(REGISTRY["batch_project_filter_sort"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in p
    assert "o_custkey" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_no_python_udf_in_batch_indicators(spark):
    p = plan(REGISTRY["indicators_wide"](spark, SF_SMALL))
    assert "Python" not in p and "ArrowEval" not in p


def test_windows_never_partition_by_ticker_alone(spark):
    p = plan(REGISTRY["indicators_wide"](spark, SF_SMALL))
    for line in p.splitlines():
        if "Window [" in line and "windowspecdefinition(ticker#" in line:
            spec = line.split("windowspecdefinition(")[1]
            # the first window spec element after the ticker must be another partition key
            assert not spec.split(",")[1].strip().startswith(("date", "_pos")) or "_chunk" in line


def test_one_shuffle_and_one_sort_for_a_pass(spark):
    """Rolling frames and the local part of all averages share one partitioning and one order."""
    from candela.functions import indicators as I
    from candela.functions import series as S
    from candela.plans.queries import closes
    positioned = S.materialize(S.with_position(closes(spark, SF_SMALL), "ticker", "date"))
    seen = []
    real = S.materialize
    try:
        S.materialize = lambda df: seen.append(plan(df)) or real(df)
        I.scan_indicators(positioned).count()
    finally:
        S.materialize = real
    rows = seen[0]  # what the pass writes
    assert rows.count("Exchange ") == 1 and rows.count("Sort [") == 1 and "Window [" in rows


def test_indicator_stage_reads_needed_columns_only(spark):
    from candela.plans.queries import bars
    p = plan(bars(spark, SF_SMALL).select("date", "ticker", "close"))
    assert "o_custkey" not in p and p.count("FileScan") == 1
