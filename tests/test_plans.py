"""Plan-shape guards: no query may plan a cartesian product or a nested-loop
join (all pair generation must be equi-joins), and scans must prune columns."""
import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def test_no_cross_or_nested_loop_joins(spark):
    bad = {}
    for name, fn in entry.queries().items():
        if name in entry.LLM_QUERIES:              # guarded in tests/llm
            continue
        df = fn(spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


def _plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_feature_scan_prunes_columns(spark):
    plan = _plan(spark, "score_fixed_model")
    assert "GreaterThanOrEqual(ts," in plan
    assert "label" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_trailing_windows_prune_partitions(spark):
    for name in ("recent_60d", "recent_10d", "score_fixed_model"):
        assert "PartitionFilters: [isnotnull(date" in _plan(spark, name), name


def test_no_source_is_scanned_twice(spark):
    assert _plan(spark, "pair_features_rolling").count("FileScan") == 0      # one checkpoint, read twice
