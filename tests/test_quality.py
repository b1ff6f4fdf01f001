import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tables
from helpers import rows_of, values
from tallyforge.operators import quality as q


def counts(df, checks):
    return {(r.check, r.column_name): r.invalid for r in q.run_checks(df, "t", checks).collect()}


def test_planted_defects_are_found_exactly(spark):
    df = tables.defects(spark)
    got = counts(
        df,
        [
            *q.null_checks(df),
            q.range_rule("gpa", "gpa", 0, 4),
            q.range_rule("age", "age", 17, 100),
            q.category_rule("major", "major", ["Law", "Music"]),
            q.pattern_rule("id", "student_id", "^STU_[0-9]{4}$"),
        ],
    )
    assert got["null_values", "email"] == 12
    assert got["gpa", "gpa"] == 9 and got["age", "age"] == 7 and got["major", "major"] == 4 and got["id", "student_id"] == 0
    dup = q.duplicate_profile(df, "t").first()
    assert (dup.invalid, dup.total, dup.percentage) == (6, 96, 6.25)


def test_checks_run_in_one_job(spark):
    df = tables.defects(spark)
    checks = [*q.null_checks(df), *q.blank_checks(df), q.range_rule("gpa", "gpa", 0, 4)]
    plan = q.run_checks(df, "t", checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_null_values_do_not_break_comparison_rules(spark):
    df = spark.createDataFrame([(None, None), (1.0, "x")], "a double, b string")
    got = counts(df, [q.range_rule("r", "a", 0, 4), q.category_rule("c", "b", ["x"]), q.pattern_rule("p", "b", "^x$")])
    assert set(got.values()) == {0}


def test_broken_rule_is_isolated(spark):
    df = spark.createDataFrame([(9.0,)], "a double")
    out = {r.check: r.status for r in q.run_checks(df, "t", [q.range_rule("ok", "a", 0, 4), q.range_rule("bad", "zz", 0, 4)]).collect()}
    assert out == {"ok": "FAIL", "bad": "ERROR"}
    only_bad = q.run_checks(df, "t", [q.range_rule("bad", "zz", 0, 4)]).collect()
    assert [r.status for r in only_bad] == ["ERROR"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, s string")
    out = q.full_report(df, "t", [q.range_rule("r", "a", 0, 1)])
    assert {r.percentage for r in out.collect()} == {0.0}
    assert q.verdict(out).first().overall_status == "PASS"


def test_consistency_checks_follow_the_schema(spark):
    df = spark.createDataFrame(
        [(1.0, 3.0, 0.5, 2), (2.0, 2.5, 1.5, 1)], "gpa double, major_gpa double, pass_rate double, rate_class int"
    ).withColumns({"start": F.lit("2024-02-01").cast("date"), "stop": F.lit("2024-01-01").cast("date")})
    got = counts(df, q.consistency_checks(df))
    assert got == {("date_consistency", "start"): 2, ("gpa_consistency", "gpa"): 1, ("pass_rate_range_consistency", "pass_rate"): 1}


def test_blank_strings(spark):
    df = spark.createDataFrame([("",), (" ",), ("  ",), ("x",), (None,)], "s string")
    assert counts(df, q.blank_checks(df))["empty_strings", "s"] == 2
    assert counts(df, q.blank_checks(df, trim=True))["empty_strings", "s"] == 3


def test_outlier_profile(spark):
    rows = [(float(i % 10), 0.0) for i in range(100)] + [(1000.0, 0.0)]
    out = q.outlier_profile(spark.createDataFrame(rows, "x double, flat double")).collect()
    assert [r.column_name for r in out] == ["x"]
    assert (out[0].zscore_outliers, out[0].iqr_outliers, out[0].q1, out[0].q3) == (1, 1, 2.0, 7.0)


def test_outlier_profile_keeps_zero_statistics(spark):
    df = spark.createDataFrame([(float(v),) for v in (-3, -1, 0, 0, 0, 1, 3)], "x double")
    row = q.outlier_profile(df).first()
    assert row.mean == 0.0 and row.q1 == -1.0


def test_reference_check(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "p long")
    r = q.reference_check(child, "k", parent, "p").first()
    assert (r.invalid, r.total, r.percentage, r.status) == (2, 5, 40.0, "FAIL")


def report(spark, rows):
    return spark.createDataFrame([("t", c, col, inv, 100, pct, "r", s) for c, col, inv, pct, s in rows], q.REPORT)


@pytest.mark.parametrize(
    "row, status, critical, warnings",
    [
        (("null_values", "a", 51, 51.0, None), "FAIL", 1, 0),
        (("null_values", "a", 50, 50.0, None), "PASS", 0, 1),
        (("null_values", "a", 20, 20.0, None), "PASS", 0, 0),
        (("duplicates", "*", 21, 21.0, None), "FAIL", 1, 0),
        (("duplicates", "*", 6, 6.0, None), "PASS", 0, 1),
        (("range", "a", 11, 11.0, "FAIL"), "FAIL", 1, 0),
        (("range", "a", 10, 10.0, "FAIL"), "PASS", 0, 1),
    ],
)
def test_verdict_limits(spark, row, status, critical, warnings):
    v = q.verdict(report(spark, [row])).first()
    assert (v.overall_status, v.critical_issues_count, v.warnings_count) == (status, critical, warnings)


def test_strict_verdict(spark):
    assert q.strict_verdict(report(spark, [("null_values", "a", 21, 21.0, None)])).first()[0] == "FAIL"
    assert q.strict_verdict(report(spark, [("range", "a", 90, 90.0, "FAIL")])).first()[0] == "PASS"


def test_recommendations(spark):
    rows = [("null_values", "a", 30, 30.0, None), ("duplicates", "*", 6, 6.0, None), ("zscore_outliers", "b", 1, 1.0, None), ("null_values", "c", 1, 1.0, None)]
    assert {r.column_name for r in q.recommendations(report(spark, rows)).collect()} == {"a", "*", "b"}


def test_gate(spark):
    df = tables.defects(spark)
    assert q.assert_quality(df, "t") is df
    with pytest.raises(q.QualityError, match="duplicate"):
        q.assert_quality(df.unionByName(df), "t")
    with pytest.raises(q.QualityError, match="email"):
        q.assert_quality(df, "t", max_null_pct=10.0)


def test_declared_rules_evaluate_every_key(spark):
    df = spark.createDataFrame([(1, -5, None, 120), (1, 5, 2.0, 50)], "k int, n int, r double, s int")
    rules = {
        "required_columns": ["k", "gone"],
        "null_tolerance": {"r": 0.4},
        "score_range": {"min": 0, "max": 100, "columns": ["s"]},
        "range_checks": {"r": {"min": 0, "max": 1}},
        "positive_values": ["n"],
        "duplicate_check": ["k"],
    }
    out = {(r.check, r.column_name) for r in q.declared_issues(df, "t", rules).collect()}
    assert out == {
        ("required_column", "gone"), ("null_tolerance", "r"), ("score_range", "s"), ("range_check", "r"),
        ("positive_value", "n"), ("duplicates", "k"),
    }
    tolerant = dict(rules, null_tolerance={"r": 0.5})
    assert ("null_tolerance", "r") not in {(r.check, r.column_name) for r in q.declared_issues(df, "t", tolerant).collect()}


def test_category_advice(spark):
    df = spark.range(300).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("few"), F.md5(F.col("id").cast("string")).alias("many"))
    assert [r.column_name for r in q.category_advice(df).collect()] == ["few"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=st.integers(1, 9))
def test_report_does_not_depend_on_partitioning(spark, parts):
    df = tables.defects(spark)
    rules = [q.range_rule("gpa", "gpa", 0, 4)]
    assert rows_of(q.full_report(df.repartition(parts), "t", rules, outliers=False)) == rows_of(q.full_report(df, "t", rules, outliers=False))


def test_type_profile(spark):
    assert values(q.type_profile(spark.createDataFrame([(1, "a")], "i int, s string"))) == [("i", "int"), ("s", "string")]


def test_rules_of_one_name_count_once_each(spark):
    df = spark.createDataFrame([(9.0,), (8.0,)], "a double")
    report = q.run_checks(df, "t", [q.range_rule("r", "a", 0, 4), q.range_rule("r", "a", 0, 5)])
    assert q.verdict(report).first().critical_issues_count == 2
    assert len(q.report_document(report).first().checks) == 2


def test_outliers_of_a_narrow_column(spark):
    df = spark.range(1000).select((F.col("id") / 1e8).alias("a"), F.lit(1.0).alias("b"))
    assert [r.column_name for r in q.outlier_profile(df).collect()] == ["a"]


def test_duplicates_by_hash_tell_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), (None, None), (None, None), ("a", "a")], "x string, y string")
    assert q.duplicate_profile(df).first().invalid == 1
    assert q.duplicate_profile(df, keys=["x"]).first().invalid == 3


def test_outlier_profile_has_exact_quartiles(spark):
    df = spark.range(40_000).select((F.hash("id") + F.col("id") / 40_000).alias("x"))
    held = sorted(r.x for r in df.collect())
    row = q.outlier_profile(df).first()
    assert (row.q1, row.q3) == (round(held[9_999], 4), round(held[29_999], 4))
