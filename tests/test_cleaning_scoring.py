import pytest
from pyspark.sql import functions as F

from helpers import rows_of, values
from tallyforge.functions import presets
from tallyforge.operators import aggregates, cleaning, scoring


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_drop_empty_columns(spark):
    df = frame(spark, [(1, None, None), (2, "x", None)], "a int, b string, c string")
    assert cleaning.drop_empty_columns(df).columns == ["a", "b"]


def test_cast_and_failures(spark):
    df = frame(spark, [("1", "x"), ("b", None), (None, "2")], "a string, b string")
    assert values(cleaning.cast_columns(df, {"a": "int"}).select("a")) == [(1,), (None,), (None,)]
    assert values(cleaning.cast_failures(df, {"a": "int", "b": "int"})) == [(1, 1)]


def test_parse_date_formats(spark):
    df = frame(spark, [("2024-02-29",), ("29/02/2024",), ("30/02/2024",), (None,)], "d string")
    out = [str(r.d) if r.d else None for r in cleaning.parse_date(df, "d", ["yyyy-MM-dd", "dd/MM/yyyy"]).collect()]
    assert out == ["2024-02-29", "2024-02-29", None, None]


def test_fill_constants_only_touches_present_columns(spark):
    df = frame(spark, [(None, None), (1.0, 5)], "gpa double, other int")
    assert values(cleaning.fill_constants(df)) == [(2.5, None), (1.0, 5)]


def test_fill_median_mean_mode(spark):
    rows = [(1.0, 1.0, "b"), (2.0, 2.0, "b"), (9.0, 6.0, "a"), (None, None, None), (None, 3.0, "a")]
    df = frame(spark, rows, "m double, a double, c string")
    out = cleaning.fill_mode(cleaning.fill_mean(cleaning.fill_median(df, ["m"]), ["a"]), ["c"])
    assert (2.0, 3.0, "a") in values(out)


def test_fill_mode_of_empty_column_keeps_null(spark):
    df = frame(spark, [(None, 1), (None, 2)], "c string, k int")
    assert {r.c for r in cleaning.fill_mode(df, ["c"]).collect()} == {None}


def outlier_frame(spark):
    rows = [(i, float(i % 10), 5.0 + i % 3) for i in range(50)] + [(100, 90.0, 500.0), (101, 5.0, 40.0), (102, None, 6.0)]
    return frame(spark, rows, "k int, x double, y double")


def test_remove_outliers_in_turn_and_nulls(spark):
    kept = {r.k for r in cleaning.remove_outliers(outlier_frame(spark), ["x", "y"]).collect()}
    assert kept == set(range(50))
    with_nulls = {r.k for r in cleaning.remove_outliers(outlier_frame(spark), ["x", "y"], keep_nulls=True).collect()}
    assert with_nulls == set(range(50)) | {102}


def test_remove_outliers_together_matches_when_columns_are_independent(spark):
    a = cleaning.remove_outliers(outlier_frame(spark), ["x", "y"], sequential=False)
    assert {r.k for r in a.collect()} == set(range(50))


def test_standardise_student(spark):
    df = frame(spark, [("CompSci", "DAILY"), ("Art", "sometimes"), (None, None)], "field_of_study string, frequency_of_use string")
    out = values(cleaning.standardise_student(df).select("field_of_study_clean", "frequency_of_use_clean"))
    assert out == [("Computer Science", "Daily"), ("Art", "sometimes"), (None, None)]


def test_normalise_courses(spark):
    df = frame(spark, [("Data_Structures", "CS201"), ("Physics_I", "PHYS101"), (None, "X1")], "course_name string, course_code string")
    out = values(cleaning.normalise_courses(df).select("course_name_normalized", "course_category"))
    assert out == [("Data Structures", "Computer Science"), ("Physics I", "Physics"), (None, "Other")]


def test_drop_duplicates_with_order(spark):
    df = frame(spark, [("a", 2, None), ("a", 1, "x"), ("b", 5, "y")], "k string, o int, v string")
    assert sorted(values(cleaning.drop_duplicates(df, ["k"], [F.col("o")]))) == [("a", 1, "x"), ("b", 5, "y")]
    assert cleaning.drop_duplicates(df.union(df)).count() == 3
    assert cleaning.drop_duplicates(df, ["k"]).count() == 2


def test_reconcile_is_stable_and_bounded(spark):
    df = spark.range(500).select(F.col("id"), F.lit(3.9).alias("gpa"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(3.0).alias("major_gpa"))
    a = cleaning.reconcile(df, "gpa", "major_gpa", "id")
    assert rows_of(a) == rows_of(cleaning.reconcile(df.repartition(7), "gpa", "major_gpa", "id"))
    for r in a.collect():
        assert r.major_gpa == 3.0 if r.id % 2 else 3.6 <= r.major_gpa <= 4.0


def test_samples_and_split(spark):
    df = spark.range(4000)
    kept = {r.id for r in cleaning.hash_sample(df, "id", 10).collect()}
    assert 300 < len(kept) < 500
    assert kept == {r.id for r in cleaning.hash_sample(df.repartition(5), "id", 10).collect()}
    split = {r.dataset_split: r["count"] for r in cleaning.train_test_split(df, "id").groupBy("dataset_split").count().collect()}
    assert sum(split.values()) == 4000 and 3000 < split["train"] < 3400
    assert 250 < cleaning.fraction_sample(df, 0.1).count() < 550


def test_protect_pii(spark):
    df = frame(spark, [("Ann", "ann@x.org", "ID-7")], "name string, email string, code string")
    out = cleaning.protect_pii(df, drop=["name"], hashed=["email"], masked=["code"]).first()
    assert len(out.email) == 64 and out.code == "XX-n" and "name" not in out.asDict()


def base(spark, **over):
    row = dict(
        student_id="STU_0001", field_of_study="CS", gpa=3.0, attendance_rate=0.9, assignment_submission_rate=0.95,
        num_ai_tools=2, usage_frequency_score=3, satisfaction_level=3, primary_use_case="Writing",
        total_courses=4, total_credits=12, academic_diversity=2,
    )
    row |= over
    schema = (
        "student_id string, field_of_study string, gpa double, attendance_rate double, assignment_submission_rate double,"
        "num_ai_tools int, usage_frequency_score int, satisfaction_level int, primary_use_case string,"
        "total_courses int, total_credits int, academic_diversity int"
    )
    return spark.createDataFrame([tuple(row.values())], schema)


@pytest.mark.parametrize("tools, usage, happy, score, level", [(5, 4, 3, 4.0, "Expert"), (0, 1, 1, 0.7, "Beginner"), (None, None, None, 0.7, "Beginner"), (4, 3, 3, 3.3, "Advanced"), (2, 2, 2, 2.0, "Intermediate")])
def test_proficiency(spark, tools, usage, happy, score, level):
    r = scoring.proficiency(base(spark, num_ai_tools=tools, usage_frequency_score=usage, satisfaction_level=happy)).first()
    assert (r.ai_proficiency_score, r.proficiency_level) == (score, level)


@pytest.mark.parametrize(
    "over, style, preference",
    [
        (dict(primary_use_case="Research", usage_frequency_score=4), "Research_Intensive", "Exploratory"),
        (dict(primary_use_case="Assignment_Help", satisfaction_level=4), "Assignment_Focused", "Task_Oriented"),
        (dict(num_ai_tools=3), "Multi_Tool_User", "Exploratory"),
        (dict(usage_frequency_score=5), "High_Frequency_User", "Casual"),
        (dict(num_ai_tools=None, usage_frequency_score=None), "Basic_User", "Casual"),
    ],
)
def test_learning_style(spark, over, style, preference):
    r = scoring.learning_style(base(spark, **over)).first()
    assert (r.learning_style, r.learning_preference) == (style, preference)


@pytest.mark.parametrize(
    "gpa, attend, submit, score, flag, level, action",
    [
        (1.9, 0.5, 0.6, 4.0, True, "High", "Immediate"),
        (2.4, 0.69, 0.79, 3.0, True, "Medium", "Monitor"),
        (3.5, 0.95, 0.99, 1.0, False, "None", "None"),
        (None, None, None, 1.0, False, "None", "None"),
        (2.9, 0.79, 0.89, 2.0, False, "Low", "None"),
    ],
)
def test_risk(spark, gpa, attend, submit, score, flag, level, action):
    r = scoring.risk(base(spark, gpa=gpa, attendance_rate=attend, assignment_submission_rate=submit)).first()
    assert (r.academic_risk_score, r.at_risk_flag, r.risk_level, r.intervention_needed) == (score, flag, level, action)


def test_risk_by_rule_needs_all_three(spark):
    low = scoring.risk_by_rule(base(spark, gpa=1.5, attendance_rate=0.5, assignment_submission_rate=0.5)).first()
    one_fine = scoring.risk_by_rule(base(spark, gpa=1.5, attendance_rate=0.9, assignment_submission_rate=0.5)).first()
    assert (low.at_risk_flag, low.risk_level) == (True, "High")
    assert (one_fine.at_risk_flag, one_fine.risk_level) == (False, "None")


@pytest.mark.parametrize("courses, credits, diversity, gpa, score, category, balance", [(10, 18, 2, 3.5, 60.0, "Heavy", 5), (10, 18, 2, 3.4, 60.0, "Heavy", 1), (4, 12, 3, 3.0, 40.0, "Moderate", 4), (2, 6, 2, 2.5, 22.0, "Light", 3), (None, None, None, 1.0, 0.0, "Minimal", 2)])
def test_workload(spark, courses, credits, diversity, gpa, score, category, balance):
    df = base(spark, total_courses=courses, total_credits=credits, academic_diversity=diversity, gpa=gpa)
    r = scoring.workload(df).first()
    assert (r.workload_score, r.workload_category, r.workload_balance_score) == (score, category, balance)
    plain = scoring.workload(base(spark, total_courses=10, total_credits=10, academic_diversity=5), plain=True).first()
    assert (plain.workload_score, plain.workload_category) == (50.0, "Heavy")


def test_usage_patterns(spark):
    r = scoring.usage_patterns(base(spark, usage_frequency_score=4, satisfaction_level=2, num_ai_tools=3)).first()
    assert (r.usage_consistency, r.adoption_stage) == ("Inconsistent", "Advanced_Adopter")


def test_success_indicators(spark):
    df = spark.createDataFrame([(f"s{i}", "f", float(i), 3.5) for i in range(11)], "student_id string, field_of_study string, gpa double, ai_proficiency_score double")
    out = {r.student_id: r for r in scoring.success_indicators(df).collect()}
    assert out["s10"].success_category == "Top_Performer" and out["s0"].success_category == "Low_Performer"
    assert out["s4"].improvement_potential == "High" and out["s6"].improvement_potential == "Medium"


def test_apply_all_gates_on_columns(spark):
    out = scoring.apply_all(base(spark), quality_fixes=True)
    assert "workload_score" in out.columns and "course_category" not in out.columns
    assert out.count() == 1
    without = scoring.apply_all(base(spark).drop("total_courses"), quality_fixes=False)
    assert "workload_score" not in without.columns


def test_clean_usage_and_academic(spark):
    usage = spark.createDataFrame(
        [("s1", "CS", 1, "a,b", "Daily", 4, "Research"), ("s2", "CS", 1, None, "Never", 4, "Research"), (None, "CS", 1, "a", "Daily", 4, "x")],
        "student_id string, field_of_study string, year_of_study int, ai_tools_used string, frequency_of_use string, satisfaction_level int, primary_use_case string",
    )
    out = {r.student_id: (r.num_ai_tools, r.usage_frequency_score, r.usage_intensity) for r in scoring.clean_usage(usage).collect()}
    assert out == {"s1": (2, 5, "High"), "s2": (0, 1, "Low")}
    academic = spark.createDataFrame(
        [("s1", "t", 3.5, 3.0, 12, 1.0, 0.5), ("s2", "t", 4.1, 3.0, 12, 1.0, 0.5), ("s3", "t", 2.0, 3.0, 12, None, 0.5)],
        "student_id string, semester string, gpa double, major_gpa double, credits_completed int, attendance_rate double, assignment_submission_rate double",
    )
    kept = scoring.clean_academic(academic).collect()
    assert [(r.student_id, r.performance_category, round(r.engagement_score, 6)) for r in kept] == [("s1", "High", 0.7)]


def test_enrollment_summary_lists_repeats(spark):
    rows = [("s", "t", "CS1", "Algo", "CS", "A+", 3), ("s", "t", "CS1", "Algo", "CS", "F", 3), ("s", "t", "M1", "Calc", "Math", "B", 4)]
    df = spark.createDataFrame(rows, "student_id string, semester string, course_code string, course_name string, department string, grade string, credit_hours int")
    r = aggregates.enrollment_summary(df).first()
    assert (r.total_courses, r.total_credits, r.academic_diversity) == (3, 10, 2)
    assert r.courses_taken == ["Algo", "Algo", "Calc"] and r.departments == ["CS", "CS", "Math"]
    assert r.calculated_gpa == pytest.approx(7.3 / 3)
    assert aggregates.enrollment_summary(df, repeats=False).first().courses_taken == ["Algo", "Calc"]


def test_score_tiers_need_a_strict_winner(spark):
    df = spark.createDataFrame([(90, 80, 80, 90.0), (80, 80, 70, 59.9)], "math_score int, reading_score int, writing_score int, average_score double")
    out = [(r.performance_tier, r.subject_strength) for r in scoring.score_tiers(df).collect()]
    assert out == [("Excellent", "Math"), ("Poor", "Balanced")]


def test_adjust_for_school(spark):
    row = [(1, 50, 99, 0, "private", 12.0, 13000, 9, 9)]
    df = spark.createDataFrame(row, "k int, math_score int, reading_score int, writing_score int, school_type string, student_teacher_ratio double, budget_per_student int, technology_score int, facility_score int")
    r = scoring.adjust_for_school(df, "k", ["math_score", "reading_score", "writing_score"], noise_sd=0).first()
    assert r.school_effect == 14.2
    assert (r.math_score, r.reading_score, r.writing_score, r.total_score) == (64, 100, 14, 178)


def test_mean_of_whole_numbers_is_rounded(spark):
    df = spark.createDataFrame([(1,), (4,), (None,), (3,)], "v int")
    assert [r.v for r in cleaning.fill_mean(df, ["v"]).collect()] == [1, 4, 3, 3]


@pytest.mark.parametrize("at_once", [1, 7, 10_000])
def test_bottom_sample_is_exact_stable_and_merges(spark, at_once):
    rows = [(i if i % 9 else None, f"k{i}", i) for i in range(700)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    ordered = [r.b for r in df.orderBy(cleaning.key_hash(["a", "b"], "s"), "a", "b").collect()]
    for size in (0, 1, 50, 699, 700, 900):
        got = cleaning.bottom_sample(df.repartition(5), ["a", "b"], size, salt="s", at_once=at_once)
        assert got.columns == df.columns and sorted(r.b for r in got.collect()) == sorted(ordered[:size])
    half, rest = df.filter("c < 300"), df.filter("c >= 300")
    both = cleaning.bottom_sample(half, ["a", "b"], 40, salt="s").unionByName(cleaning.bottom_sample(rest, ["a", "b"], 40, salt="s"))
    assert {r.b for r in cleaning.bottom_sample(both, ["a", "b"], 40, salt="s").collect()} == set(ordered[:40])
    assert cleaning.fraction_sample(df, 0.25, keys=["a", "b"]).count() == 175
    assert cleaning.bottom_sample(df.limit(0), ["a", "b"], fraction=0.5).count() == 0


def test_equal_hashes_are_cut_by_the_keys(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "key_hash", lambda keys, salt: F.lit(5).cast("long"))
    df = spark.createDataFrame([(None, "x"), (None, None), (1, "b"), (1, "a"), (2, "a")], "a int, b string")
    for size in range(6):
        want = df.orderBy("a", "b").limit(size)
        got = cleaning.bottom_sample(df, ["a", "b"], size, at_once=2)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_keys_become_lists_of_bounded_length(spark):
    rows = [("hot", i % 50, i, f"i{i % 7}" if i % 11 else None) for i in range(3000)] + [("cold", 1, 9000, "z"), (None, 1, 9001, "y")]
    df = spark.createDataFrame(rows, "k string, o int, u int, item string").repartition(6)
    out = aggregates.list_segments(df, ["k"], "o", "item", "u", 100).collect()
    assert max(len(r["items"]) for r in out) == 100 and len(out) == 32
    hot = [x for r in sorted((r for r in out if r.k == "hot"), key=lambda r: r.part) for x in r["items"]]
    assert hot == [x[3] for x in sorted((r for r in rows if r[0] == "hot"), key=lambda r: (r[1], r[2]))]
    sets = {(r.k, r.part): r["items"] for r in aggregates.set_segments(df, ["k"], "item", 4).collect()}
    assert sets == {("hot", 0): ["i0", "i1", "i2", "i3"], ("hot", 1): ["i4", "i5", "i6"], ("cold", 0): ["z"], (None, 0): ["y"]}


def test_fences_and_medians_are_exact(spark):
    df = spark.range(40_000).select((F.hash("id") * 40_000.0 + F.col("id")).alias("x"))
    df = df.withColumn("y", F.when(F.col("x") > 0, F.col("x")))
    held = sorted(r.x for r in df.select("x").collect())
    q1, q3 = held[9_999], held[29_999]
    assert cleaning.iqr_bounds(df, ["x"], 0.0) == {"x": (q1, q3)}
    assert cleaning.remove_outliers(df, ["x"], 0.0).count() == 20_001
    positive = [x for x in held if x > 0]
    assert cleaning.fill_median(df, ["y"]).filter(F.col("x") <= 0).select("y").distinct().collect()[0].y == positive[-(-len(positive) // 2) - 1]


def test_bottom_sample_is_exact_where_keys_repeat(spark):
    df = spark.range(60).select((F.col("id") % 4).alias("a"), F.when(F.col("id") % 8 > 3, 1).alias("b"), (F.col("id") % 3).alias("v"))
    for at_once in (1, 10_000):
        before = []
        for size in (1, 9, 22, 60):
            rows = sorted(map(str, cleaning.bottom_sample(df, ["a", "b"], size, at_once=at_once).collect()))
            assert len(rows) == size and all(rows.count(r) >= before.count(r) for r in before)
            before = rows


def test_schools_with_the_same_scores_tie_in_any_order(spark):
    marks = [0.1, 0.2, 0.3]
    rows = [(school, i, x, 1, 1, 1, "Poor") for school, scores in ((1, marks), (2, marks[::-1])) for i, x in enumerate(scores)]
    df = spark.createDataFrame(rows, "school_id int, student_id int, average_score double, math_score int, reading_score int, writing_score int, performance_tier string")
    assert aggregates.school_summary(df.coalesce(1)).select("avg_school_score").distinct().count() == 1


def test_repeated_courses_are_shuffled_once(spark):
    rows = [("s", 1, "c1", "a", "x", "A", 3), ("s", 1, "c1", "a", "x", "B", 3), ("s", 1, None, "b", "x", "A", 2)]
    df = spark.createDataFrame(rows, "student_id string, semester int, course_code string, course_name string, department string, grade string, credit_hours int")
    out = aggregates.enrollment_summary(df)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert out.select("total_courses", "total_credits", "courses_taken", "departments").collect() == [(2, 8, ["a", "a", "b"], ["x"] * 3)]


def test_box_plot_is_exact_in_large_groups(spark):
    df = spark.range(80_000).select(F.when(F.col("id") % 2 == 0, "a").alias("g"), (F.hash("id") * 40_000.0 + F.col("id")).alias("x"))
    rows = df.collect()
    for r in aggregates.box_plot(df, "g", "x").collect():
        held = sorted(x.x for x in rows if x.g == r.g)
        assert (r.n, r.min_value, r.q1, r.median, r.q3, r.max_value) == (40_000, *[held[i] for i in (0, 9_999, 19_999, 29_999, 39_999)])
