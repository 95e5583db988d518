"""What the optimised plans may and may not contain."""

import re

import pytest

import __spark_entry__ as contract
from workload.case import CASES

SF = "/root/testdata/sf0.001"
EAGER = {"replace_partition", "delete_append", "delete_append_by_metric", "merge_upsert", "decision_summary", "quantiles", "quantile_join"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CASES) - EAGER))
def test_no_python_and_no_product(spark, name):
    text = plan_of(contract.queries()[name](spark, SF))
    assert not re.search(r"Python|InPandas|InArrow|CartesianProduct", text)
    # The only nested loop allowed joins one aggregated row.
    assert "BroadcastNestedLoopJoin" not in text or name == "experiment_params"


def test_ab_shuffles_each_fact_once(spark):
    """Without broadcasts: one exchange per fact on (experiment, user), then only tiny ones."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(contract.queries()["ab_analysis"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    user_level = re.findall(r"Exchange hashpartitioning\(experiment_id#\d+, user_id#\d+", text)
    assert len(user_level) == 2
    assert len(re.findall(r"Exchange ", text)) == 4
    assert "SortMergeJoin" in text


def test_outcomes_are_combined_before_the_shuffle(spark):
    text = plan_of(contract.queries()["metric_daily"](spark, SF))
    assert re.search(r"Exchange hashpartitioning\(experiment_id#\d+, user_id#\d+, metric_name#\d+, day#\d+[^\n]*\n[^\n]*HashAggregate[^\n]*partial_sum", text)


def test_scan_reads_only_needed_columns(spark):
    text = plan_of(contract.queries()["assign_variants"](spark, SF))
    assert re.search(r"ReadSchema: struct<c_custkey:bigint>", text)
