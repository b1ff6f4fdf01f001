import math
import statistics

import pytest
from pyspark.sql import functions as F

from helpers import values
from tallyforge.operators import aggregates, modeling, tuning
from tallyforge.plans import scores, survey


def test_rank_features(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("y"), (-F.col("id")).cast("double").alias("down"), (F.col("id") % 3).cast("double").alias("noise"), F.lit(1.0).alias("flat"))
    out = modeling.rank_features(df, "y", ["noise", "down", "flat"]).collect()
    assert [r.feature for r in out] == ["down", "noise", "flat"]
    assert out[0].correlation == pytest.approx(-1.0) and out[2].correlation is None


def test_drift_is_zero_for_equal_slices_and_positive_for_shift(spark):
    base = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    same = modeling.drift(base, base, "x").agg(F.sum("psi"), F.max("mean_shift")).first()
    moved = modeling.drift(base, base.withColumn("x", F.col("x") + 500), "x")
    assert same[0] == pytest.approx(0.0) and same[1] == 0.0
    assert moved.agg(F.sum("psi")).first()[0] > 1 and moved.first().mean_shift == pytest.approx(500)
    assert moved.agg(F.sum("base_n"), F.sum("current_n")).first()[:] == (1000, 1000)


def test_ab_test_equals_welch(spark):
    a, b = [1.0, 2.0, 4.0, 5.0], [2.0, 6.0, 7.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b] + [("c", 99.0)], "arm string, v double")
    r = modeling.ab_test(df, "arm", "a", "b", "v").first()
    ea, eb = statistics.variance(a) / 4, statistics.variance(b) / 3
    assert r.t_statistic == pytest.approx((5 - 3) / math.sqrt(ea + eb))
    assert r.degrees_of_freedom == pytest.approx((ea + eb) ** 2 / (ea**2 / 3 + eb**2 / 2))


def test_regression_recovers_coefficients(spark):
    df = spark.range(200).select((F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"))
    df = df.withColumn("y", 2 * F.col("x") - F.col("z") + 5)
    model = modeling.fit_regression(df, ["x", "z"], "y", {"regParam": [0.0, 10.0]}, folds=2)
    fitted = model.bestModel.stages[-1]
    assert fitted.coefficients.toArray() == pytest.approx([2, -1], abs=1e-6)
    grid = modeling.grid_scores(model, df).collect()
    assert len(grid) == 2 and min(grid, key=lambda r: r.rmse).params == "regParam=0.0"


def test_share_within_sums_to_hundred(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] + [("b", "x")], "g string, h string")
    out = aggregates.share_within(df, ["g", "h"], ["g"])
    assert {r.g: r.s for r in out.groupBy("g").agg(F.sum("percentage").alias("s")).collect()} == {"a": 100.0, "b": 100.0}
    assert {r.g: r.percentage for r in aggregates.share_of_total(df, ["g"]).collect()} == {"a": 80.0, "b": 20.0}


def test_tool_share_splits_lists(spark):
    df = spark.createDataFrame([("A, B",), ("A",), (None,)], "ai_tools_used string")
    assert [(r.tool, r.mentions) for r in survey.tool_share(df).collect()] == [("A", 2), ("B", 1)]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.99,), (1.0,), (-0.1,)], "x double")
    assert sorted(values(survey.histogram(df, "x", 1.0))) == [(-1.0, 1), (0.0, 2), (1.0, 1)]


def test_box_plot(spark):
    df = spark.createDataFrame([("g", float(i)) for i in range(1, 6)], "g string, x double")
    assert values(aggregates.box_plot(df, "g", "x")) == [("g", 5, 1.0, 2.0, 3.0, 4.0, 5.0)]


@pytest.mark.parametrize("hours, label", [(0.5, "Light User (< 1h)"), (1.0, "Moderate User (1-3h)"), (5.0, "Very Heavy User (5h+)")])
def test_usage_level(spark, hours, label):
    assert spark.createDataFrame([(hours,)], "daily_usage_hours double").select(survey.usage_level()).first()[0] == label


def test_outlier_share(spark):
    out = spark.createDataFrame([("GPA",), ("GPA",), ("Both",)], "outlier_type string")
    assert sorted(values(survey.outlier_share(out, spark.range(30)))) == [("Both", 1, 3.33), ("GPA", 2, 6.67)]


def test_treatment_effects_are_symmetric(spark):
    rows = [("completed", "f", 80), ("none", "f", 60), ("completed", "m", 70), ("none", "m", 50)]
    df = spark.createDataFrame(rows, "test_preparation_course string, gender string, s int").select(
        "test_preparation_course", "gender", *[F.col("s").alias(f"{x}_score") for x in ("math", "reading", "writing")], F.col("s").cast("double").alias("average_score")
    )
    out = {(r.test_preparation_course, r.gender): r.prep_effect for r in scores.treatment_effect(df).collect()}
    assert out == {("completed", "f"): 10.0, ("none", "f"): -10.0, ("completed", "m"): 10.0, ("none", "m"): -10.0}


def test_lean_input_and_plan_text(spark):
    df = spark.createDataFrame([(None, 1, 2), ("a", 3, 4)], "g string, x int, y_temp int")
    assert values(tuning.lean_input(df, ["g"], ["x"])) == [("a", 3)]
    assert tuning.drop_temporary(df, level=None).columns == ["g", "x"]
    assert "== Physical Plan ==" in tuning.plan_text(df)


def test_drift_sees_a_rising_null_share(spark):
    from tallyforge.operators import modeling

    base = spark.createDataFrame([(float(i),) for i in range(100)], "v double")
    current = spark.createDataFrame([(float(i) if i % 2 else None,) for i in range(100)], "v double")
    rows = {r.bin: r for r in modeling.drift(base, current, "v", bins=4).collect()}
    assert rows[-1].current_n == 50 and rows[-1].base_n == 0 and rows[-1].psi > 1
    assert rows[0].mean_shift == pytest.approx(0.5)


def test_drift_cuts_at_exact_quantiles(spark):
    base = spark.range(40_000).select((F.hash("id") * 40_000.0 + F.col("id")).alias("v"))
    rows = modeling.drift(base, base, "v", bins=8).orderBy("bin").collect()
    # a bin starts at its edge, so the edge at place 5,000 belongs to the second
    assert [r.base_n for r in rows] == [4_999, *[5_000] * 6, 5_001]
