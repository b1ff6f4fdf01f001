"""Feature selection, drift, A/B comparison and a cross-validated regression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.expr import safe_corr, spread
from tallyforge.operators.joins import with_total_stats
from tallyforge.operators.ranking import quantiles


def rank_features(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Correlation of every feature with the target, in one pass, strongest first."""
    wide = df.agg(*[safe_corr(f, target).alias(f"__c{i}") for i, f in enumerate(features)])
    lines = [F.struct(F.lit(f).alias("feature"), F.col(f"__c{i}").alias("correlation")) for i, f in enumerate(features)]
    long = wide.select(F.explode(F.array(*lines)).alias("r")).select("r.*")
    return long.orderBy(F.abs("correlation").desc_nulls_last(), "feature")


def drift(
    base: DataFrame, current: DataFrame, value: str, bins: int = 10, floor: float = 1e-6
) -> DataFrame:
    """Population stability of ``value`` over exact quantile bins of ``base``, and the shift of its mean.

    One row per bin with both shares and its contribution ``psi``; sum it for the index. ``floor``
    replaces an empty share. NULL and NaN fill a bin of their own, -1, if there are any; the shift is that of the
    other values' mean.
    """
    probabilities = [i / bins for i in range(1, bins)]
    row = quantiles(base, [], F.col(value).cast("double"), probabilities).first() if probabilities else None
    edges = row[0] if row else []
    splits = [float("-inf"), *sorted(set(edges)), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="__v", outputCol="bin", handleInvalid="keep")

    def shares(df: DataFrame, name: str) -> DataFrame:
        binned = cut.transform(df.select(F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("__v")))
        known = F.when(~F.isnan("__v"), F.col("__v"))
        return binned.groupBy(F.when(known.isNull(), -1).otherwise(F.col("bin").cast("int")).alias("bin")).agg(
            F.count(F.lit(1)).alias(f"{name}_n"), F.count(known).alias(f"{name}_known"), F.sum(known).alias(f"{name}_sum")
        )

    both = shares(base, "base").join(shares(current, "current"), "bin", "full").fillna(0)
    totals = {f"__{n}_{m}": F.sum(f"{n}_{m}") for n in ("base", "current") for m in ("n", "known", "sum")}
    p = F.greatest(F.try_divide("base_n", "__base_n"), F.lit(floor))
    q = F.greatest(F.try_divide("current_n", "__current_n"), F.lit(floor))
    return with_total_stats(both, totals).select(
        "bin",
        "base_n",
        "current_n",
        p.alias("base_share"),
        q.alias("current_share"),
        ((q - p) * F.ln(q / p)).alias("psi"),
        (F.try_divide("__current_sum", "__current_known") - F.try_divide("__base_sum", "__base_known")).alias("mean_shift"),
    )


def ab_test(df: DataFrame, arm: str, control: str, treatment: str, value: str) -> DataFrame:
    """Difference of two means with Welch's t and degrees of freedom; one pass, one row."""
    out = {}
    for name, label in (("a", control), ("b", treatment)):
        v = F.when(F.col(arm) == label, F.col(value))
        out |= {f"n_{name}": F.count(v), f"mean_{name}": F.avg(v), f"var_{name}": F.pow(spread(v), F.lit(2.0))}
    stats = df.agg(*[c.alias(n) for n, c in out.items()])
    ea, eb = F.try_divide("var_a", "n_a"), F.try_divide("var_b", "n_b")
    df_parts = F.try_divide(ea * ea, F.col("n_a") - 1) + F.try_divide(eb * eb, F.col("n_b") - 1)
    return stats.select(
        "n_a",
        "n_b",
        "mean_a",
        "mean_b",
        (F.col("mean_b") - F.col("mean_a")).alias("difference"),
        F.try_divide(F.col("mean_b") - F.col("mean_a"), F.sqrt(ea + eb)).alias("t_statistic"),
        F.try_divide((ea + eb) * (ea + eb), df_parts).alias("degrees_of_freedom"),
    )


def fit_regression(
    df: DataFrame, features: Sequence[str], target: str, grid: Mapping[str, Sequence[float]] | None = None, folds: int = 3, seed: int = 42
) -> CrossValidatorModel:
    """Linear regression chosen from a parameter grid by k-fold RMSE."""
    model = LinearRegression(featuresCol="features", labelCol=target)
    grid = grid or {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 1.0]}
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    steps = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"), model])
    score = RegressionEvaluator(labelCol=target, metricName="rmse")
    return CrossValidator(
        estimator=steps, estimatorParamMaps=builder.build(), evaluator=score, numFolds=folds, seed=seed
    ).fit(df.select(*features, target))


def grid_scores(model: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """Mean RMSE per parameter combination as a DataFrame."""
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), float(s))
        for m, s in zip(model.getEstimatorParamMaps(), model.avgMetrics)
    ]
    return df.sparkSession.createDataFrame(rows, "params string, rmse double")
