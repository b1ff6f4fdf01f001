import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tallyforge.operators import regression


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(4)
    made = []
    for i in range(900):
        x, z = pick.gauss(1e4, 3), pick.random()
        made.append((i, x, z, x * 2 + z, 7.0, 3 * x - 5 * z + pick.gauss(0, 2)))
    gaps = [(900, None, 1.0, 1.0, 7.0, 1.0), (901, 1.0, float("nan"), 1.0, 7.0, 1.0), (902, 1.0, 1.0, 1.0, 7.0, None)]
    return spark.createDataFrame(made + gaps, "id int, x double, z double, twice double, flat double, y double")


FEATURES = ["x", "z", "twice", "flat"]


@pytest.mark.parametrize(("penalty", "share"), [(0.1, 0.0), (2.0, 0.0), (0.3, 0.5), (0.5, 1.0)])
def test_fit_equals_spark_ml(rows, penalty, share):
    whole = VectorAssembler(inputCols=FEATURES, outputCol="f", handleInvalid="skip").transform(rows.na.drop())
    want = LinearRegression(featuresCol="f", labelCol="y", regParam=penalty, elasticNetParam=share, maxIter=5000, tol=1e-12).fit(whole)
    folds, left_out = regression.fold_moments(rows, FEATURES, "y")
    got = regression.fit(folds[0], penalty, share)
    assert left_out == 3 and folds[0].n == 900
    assert got.coefficients.tolist() == pytest.approx(want.coefficients.toArray().tolist(), rel=2e-3, abs=2e-3)
    assert (regression.squared_error(folds[0], got) / 900) ** 0.5 == pytest.approx(want.summary.rootMeanSquaredError, rel=1e-4)


def test_folds_equal_separate_fits(rows):
    grid = {(r["reg_param"], r["elastic_net"]): r for r in regression.cross_validated(rows, ["x", "z"], "y", F.col("id") % 3, [0.0, 1.0], [0.0, 1.0]).collect()}
    known = rows.na.drop()
    for (penalty, share), r in grid.items():
        errors = []
        for k in range(3):
            train, test = known.filter(f"id % 3 <> {k}"), known.filter(f"id % 3 = {k}")
            m = regression.fit(regression.fold_moments(train, ["x", "z"], "y")[0][0], penalty, share)
            error = F.pow(F.col("y") - m.intercept - F.col("x") * float(m.coefficients[0]) - F.col("z") * float(m.coefficients[1]), 2)
            errors.append(test.agg(F.sqrt(F.avg(error))).first()[0])
        assert r["rmse"] == pytest.approx(sum(errors) / 3, rel=1e-9)
        assert (r["rows_used"], r["rows_left_out"]) == (900, 3)


def test_one_scan(rows, folder):
    rows.write.parquet(f"{folder}/r")
    session = rows.sparkSession
    tracker = session.sparkContext.statusTracker()
    session.sparkContext.setJobGroup("one-scan", "")
    regression.cross_validated(session.read.schema(rows.schema).parquet(f"{folder}/r"), ["x", "z"], "y", F.col("id") % 9, [0.0, 0.1, 1.0], [0.0, 0.5, 1.0])
    assert len(tracker.getJobIdsForGroup("one-scan")) <= 2
    session.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_nothing_to_fit(spark, rows):
    empty = regression.cross_validated(rows.limit(0), ["x"], "y", F.lit(0)).first()
    assert (empty["rmse"], empty["coefficients"], empty["rows_used"], empty["rows_left_out"]) == (None, None, 0, 0)
    one = regression.cross_validated(spark.createDataFrame([(1.0, 5.0)], "x double, y double"), ["x"], "y", F.lit(1)).first()
    assert (one["rmse"], one["intercept"], one["coefficients"]) == (None, 5.0, {"x": 0.0})
