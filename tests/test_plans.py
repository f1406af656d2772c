"""Plan guards for every registered query: nothing that would not scale."""

import pytest

import __spark_entry__ as entry

FORBIDDEN = (
    "BatchEvalPython",  # row-at-a-time Python
    "ArrowEvalPython",
    "ExistingRDD",  # an RDD barrier
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "SinglePartition",  # everything through one task
)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_plan_has_no_unscalable_operator(spark, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name}: {found}"
