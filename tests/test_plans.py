"""Plan properties that matter at scale (checked on the executed plans)."""
import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    plan = _plan(entry.queries()["ranked_search_batch"](spark, SF))
    # per-query top-k is limited before the shuffle, not after a full sort
    assert "WindowGroupLimit" in plan and "Partial" in plan
    # the bounded query side is broadcast; postings are never shuffled for it
    assert "BroadcastHashJoin" in plan
    # no Python in the hot path
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # postings read only the columns they need
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_page_range_prunes_folders(spark):
    df = entry.queries()["scan_page_range"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(page,2)" in plan and "LessThanOrEqual(page,9)" in plan


def test_listing_join_reduces_before_collect(spark):
    plan = _plan(entry.queries()["listing_parts"](spark, SF))
    # distinct (part, segment, priority) pairs are aggregated before collect_set
    assert plan.count("HashAggregate") >= 4
    assert "CartesianProduct" not in plan
