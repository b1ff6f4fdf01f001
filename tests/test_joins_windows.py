import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of, values
from tallyforge.functions.expr import hash_uniform
from tallyforge.operators import joins, windows
from tallyforge.plans.ranking import moving_statistics, with_trend
from tallyforge.plans.scaling import benchmark_grades, window_bundle


def test_with_group_stats_equals_window(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 7.0), (None, 9.0)], "g string, x double")
    got = joins.with_group_stats(df, ["g"], {"m": F.avg("x")})
    assert sorted(values(got), key=str) == sorted(
        [("a", 1.0, 2.0), ("a", 3.0, 2.0), ("b", 5.0, 5.0), (None, 7.0, 8.0), (None, 9.0, 8.0)], key=str
    )


def test_with_group_stats_having_drops_small_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, x double")
    out = joins.with_group_stats(df, ["g"], {"n": F.count("x")}, having=F.col("n") > 1)
    assert {r.g for r in out.collect()} == {"a"}


def test_join_small_broadcasts_only_below_the_limit(spark):
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.join_small(left, right, ["k"], max_rows=50)
        large = joins.join_small(left, right, ["k"], max_rows=49)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert small.count() == large.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k long")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "p long")
    assert values(joins.orphans(child, "k", parent, "p")) == [(9,)]


def test_weighted_assignment_equals_brute_force(spark):
    rng = random.Random(1)
    weights = {f"s{i:03d}": (0 if i % 17 == 3 else rng.randint(1, 400)) for i in range(60)}
    weights["s010"] = 6000  # about a third of all weight
    targets = spark.createDataFrame(list(weights.items()), "s string, w long")
    rows = spark.range(4000).withColumnRenamed("id", "k")
    got = joins.assign_weighted(rows, "k", targets, "s", "w").collect()
    assert len(got) == 4000 and len({r.k for r in got}) == 4000
    share = {s: 0 for s in weights}
    for r in got:
        share[r.s] += 1
    assert all(share[s] == 0 for s, w in weights.items() if w == 0)
    total = sum(weights.values())
    for s, w in weights.items():
        p = w / total
        assert abs(share[s] - 4000 * p) <= 6 * (4000 * p * (1 - p)) ** 0.5 + 1
    again = joins.assign_weighted(rows.repartition(7), "k", targets.repartition(3), "s", "w").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


@pytest.mark.parametrize("weights", [[1] * 9, [10**9, 1], [0.5, 0.25, 0.25], [3, 1, 1, 1], [0, 0, 5], [1, 2, 4, 8, 16, 32, 64], [7], [5, 5, 5, 1, 1, 1, 2, 2, 2, 11], [0.000001] * 5 + [10.5]])
def test_alias_table_holds_the_weights_exactly(spark, weights):
    """Every target's parts of all slots add up to its weight; no slot holds more than one weight's average."""
    from decimal import Decimal

    targets = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "s int, w double")
    table, slots, whole = joins.alias_table(targets, "s", "w")
    parts, found = {}, table.collect()
    for r in found:
        assert 0 <= r["upto"] <= whole
        parts[r["own"]] = parts.get(r["own"], 0) + r["upto"]
        if r["upto"] < whole:
            parts[r["other"]] = parts.get(r["other"], 0) + whole - r["upto"]
    exact = {i: Decimal(str(w)).quantize(Decimal("0.000001")) for i, w in enumerate(weights) if w}
    assert sorted(r["slot"] for r in found) == list(range(slots)) == list(range(len(exact)))
    assert parts == {i: w * slots for i, w in exact.items()}


def test_assignment_without_weights(spark):
    rows = spark.range(5).withColumnRenamed("id", "k")
    assert joins.assign_weighted(rows, "k", spark.createDataFrame([(1, 0.0), (2, None)], "s int, w double"), "s", "w").count() == 0


def test_counted_observes_rows(spark):
    df, seen = joins.counted(spark.range(37), "rows")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 37


def periods(spark):
    rows = [("s1", "cs", "2023-1", 3.0), ("s1", "cs", "2023-2", 3.4), ("s1", "cs", "2024-1", 3.4), ("s2", "cs", "2023-1", 2.0), ("s2", "cs", "2023-2", None)]
    return spark.createDataFrame(rows, "student_id string, field_of_study string, semester string, gpa double")


def test_moving_statistics(spark):
    out = {(r.student_id, r.semester): r for r in moving_statistics(periods(spark)).collect()}
    last = out["s1", "2024-1"]
    assert last.moving_avg_3_semesters == pytest.approx(3.267)
    assert last.performance_vs_best == 1.0 and last.improvement_from_first_semester == 0.4
    assert ("s2", "2023-2") not in out


def test_trend_labels(spark):
    rows = with_trend(periods(spark).filter("gpa is not null")).collect()
    out = {(r.student_id, r.semester): r.performance_trend for r in rows}
    assert out["s1", "2023-1"] == "First Semester"
    assert out["s1", "2023-2"] == "Significant Improvement"
    assert out["s1", "2024-1"] == "Stable"


def test_period_bundle_uses_one_sort(spark):
    df = windows.period_bundle(periods(spark), "student_id", "semester", "gpa")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1


def test_group_outliers_without_spread(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", None)], "g string, x double")
    out = windows.group_outliers(df, ["g"], "x", 2.0, "z", "far")
    assert all(r.z is None and r.far is False for r in out.collect())


def test_typed_outliers(spark):
    normal = [("f", 1, 3.0 + (i % 5) / 10, 3 + i % 2) for i in range(60)]
    rows = normal + [("f", 1, 0.0, 3), ("f", 1, 3.2, 30), ("f", 1, 0.0, 30)]
    df = spark.createDataFrame(rows, "field_of_study string, year_of_study int, gpa double, usage_frequency_score int")
    kinds = sorted(r.outlier_type for r in windows.typed_outliers(df).collect())
    assert kinds == ["Both", "GPA", "Usage"]


def test_window_bundle_equals_full_windows(spark):
    from pyspark.sql import Window

    rng = random.Random(5)
    rows = [
        (i, rng.choice(["x", "y"]), s, round(rng.random() * 4, 1), rng.randint(1, 5)) for i in range(300) for s in ("t1", "t2")
    ]
    df = spark.createDataFrame(rows, "student_id long, field_of_study string, semester string, gpa double, usage_frequency_score int")
    # a student keeps one field
    first = df.groupBy("student_id").agg(F.min("field_of_study").alias("field_of_study"))
    df = df.drop("field_of_study").join(first, "student_id")
    g = Window.partitionBy("field_of_study", "semester")
    want = (
        df.select(
            "field_of_study",
            "semester",
            "student_id",
            F.row_number().over(g.orderBy(F.desc("gpa"), "student_id")).cast("long").alias("gpa_rank"),
            F.dense_rank().over(g.orderBy(F.desc("gpa"))).cast("long").alias("gpa_dense_rank"),
            F.round(F.percent_rank().over(g.orderBy("gpa")), 3).alias("gpa_percentile"),
            F.round(F.avg("gpa").over(Window.partitionBy("student_id").orderBy("semester").rowsBetween(-1, 0)), 3).alias("moving_avg_gpa"),
        )
        .filter("gpa_rank <= 20")
    )
    assert rows_of(window_bundle(df).select(*want.columns)) == rows_of(want)


def test_benchmark_grades_needs_enough_rows(spark):
    rows = [(i, "big", float(i % 4), 1, 1, 0.9) for i in range(12)] + [(99, "small", 2.0, 1, 1, 0.9)]
    df = spark.createDataFrame(
        rows, "student_id long, field_of_study string, gpa double, usage_frequency_score int, satisfaction_level int, attendance_rate double"
    )
    out = benchmark_grades(df).collect()
    assert {r.field_of_study for r in out} == {"big"}
    assert {r.performance_grade for r in out if r.gpa == 3.0} == {"Above Average"}


def test_measured_summaries_stay_out_of_memory(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    out = joins.with_group_stats(spark.range(9).selectExpr("id % 3 AS g", "id AS v"), ["g"], {"n": F.count("v")})
    assert {r["n"] for r in out.collect()} == {3}
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_moments_roll_up_like_fresh_ones(spark):
    from tallyforge.operators import moments

    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(5), rng.choice([1e9 + rng.random(), None, float("nan")]), 3.0) for _ in range(3000)]
    rows += [("lonely", 1, 5.0, 3.0), ("empty", 1, None, None)]
    df = spark.createDataFrame(rows, "g string, h int, x double, c double").repartition(7)
    fine = moments.moments(df, ["g", "h"], ["x", "c"])
    for got, own in ((moments.rolled_up(fine, ["g"], ["x", "c"]), df.groupBy("g")), (moments.rolled_up(fine, [], ["x", "c"]), df.groupBy())):
        x = F.when(~F.isnan("x"), F.col("x"))
        want = {r.asDict().get("g"): r for r in own.agg(F.count(x).alias("n"), F.avg(x).alias("m"), F.stddev(x).alias("s"), F.count(F.lit(1)).alias("rows")).collect()}
        for r in got.withColumns({"m": moments.mean_of("x"), "s": moments.deviation_of("x"), "flat": moments.deviation_of("c")}).collect():
            w = want[r.asDict().get("g")]
            assert (r["x__n"], r["rows"]) == (w["n"], w["rows"])
            assert r["m"] == pytest.approx(w["m"], rel=1e-12) if w["n"] else r["m"] is None
            assert r["s"] == pytest.approx(w["s"], rel=1e-6) if w["n"] > 1 else r["s"] is None
            assert r["flat"] in (0.0, None)


def test_two_grains_take_one_aggregate_of_the_rows(spark, folder):
    rows = [("f" if i % 3 else None, i % 2, float(i % 11), i % 7) for i in range(200)]
    spark.createDataFrame(rows, "field_of_study string, year_of_study int, gpa double, usage_frequency_score int").write.parquet(f"{folder}/r")
    df = spark.read.parquet(f"{folder}/r")
    out = windows.typed_outliers(df, measure_limit=1.2, usage_limit=1.2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate") == 0 and plan.count("Join") == 1
    assert 0 < out.count() < 200
