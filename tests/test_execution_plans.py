"""What the physical plans must look like for the operators to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import joins, quality, ranking
from tallyforge.plans import scaling, schools
from workload import roles


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    return roles.table(spark, sf_dir, "orders")


@pytest.mark.parametrize("role", ["students", "usage", "enrollment", "scores", "schools", "survey"])
def test_roles_stay_in_the_jvm(spark, sf_dir, role):
    text = plan(getattr(roles, role)(spark, sf_dir))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(roles.students(spark, sf_dir).groupBy("field_of_study").agg(F.avg("gpa")))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("o_totalprice" in s and "o_orderpriority" not in s for s in schemas)


def test_rank_rows_shuffles_the_rows_once(orders):
    ranked = ranking.rank_rows(orders, ["o_orderstatus"], "o_totalprice", "o_orderkey", row_number="rn", rank="rk", ties="t", ntile={"q": 4})
    text = plan(ranked)
    # the range exchange ran before; what is left moves the rows to their runs
    assert "/table-" in text and "rangepartitioning" not in text
    assert not re.search(r"Window .*\[o_orderstatus", text)


def test_no_window_over_a_raw_group(orders):
    dist = plan(ranking.value_distribution(orders, ["o_orderstatus"], "o_totalprice"))
    assert "windowspecdefinition(o_orderstatus" not in dist


def test_top_n_is_limited_before_the_shuffle(orders):
    top = ranking.top_per_group(orders, ["o_orderstatus"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 10, "r")
    text = plan(top)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert "Partial" in text


def test_group_stats_are_joined_not_windowed(orders):
    text = plan(joins.with_group_stats(orders, ["o_orderstatus"], {"m": F.avg("o_totalprice")}))
    assert "Window" not in text and "BroadcastHashJoin" in text and "/table-" in text


def test_large_summaries_are_not_broadcast(spark, orders):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(joins.with_group_stats(orders, ["o_custkey"], {"m": F.avg("o_totalprice")}))
        assert "BroadcastHashJoin" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_range_filter_reaches_the_scan(orders):
    since, before = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-02-01").cast("timestamp_ntz")
    text = plan(scaling.monthly_trend(orders, "o_orderdate", since, before, "o_orderpriority", "o_totalprice", "o_custkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_top_k_does_not_sort_everything(orders):
    assert "TakeOrderedAndProject" in plan(orders.orderBy(F.desc("o_totalprice")).limit(10))


def test_quality_report_scans_the_table_once_for_all_rules(orders):
    checks = [*quality.null_checks(orders), *quality.blank_checks(orders), quality.range_rule("r", "o_totalprice", 0, 1)]
    assert plan(quality.run_checks(orders, "orders", checks)).count("FileScan") == 1


def test_school_pipeline_has_no_nested_loops(spark, sf_dir):
    profile = schools.school_profile(roles.scores(spark, sf_dir), roles.schools(spark, sf_dir), roles.economics(spark, sf_dir))
    text = plan(profile)
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_duplicates_collapse_before_the_shuffle(orders):
    text = plan(quality.duplicate_profile(orders, "orders"))
    assert text.count("partial_count(1)") == 1 and text.index("partial_count(1)") > text.index("Exchange")


def test_total_stats_join_is_a_hash_join(orders):
    text = plan(joins.with_total_stats(orders, {"m": F.avg("o_totalprice")}))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_no_registered_query_uses_python_or_cross_joins(spark, sf_dir):
    import workload

    for key in ["insights", "outliers", "school_ranking", "student_scores", "quality_report", "fill_mean_and_mode", "weighted_assignment", "window_bundle"]:
        text = plan(workload.QUERIES[key](spark, sf_dir))
        assert "PythonUDF" not in text and "EvalPython" not in text, key
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, key
