"""Analyses written for very large tables: pruned, sampled, top-N and approximate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import presets as P
from tallyforge.functions.expr import band, margin_of_error, safe_corr, settled_round, share_where, spread, weighted_score, z_score
from tallyforge.operators.cleaning import hash_sample
from tallyforge.operators.joins import measured, with_group_stats
from tallyforge.operators.ranking import top_per_group, with_quantiles
from tallyforge.operators.windows import moving_average


def _rows() -> Column:
    return F.count(F.lit(1))


def only(df: DataFrame, wanted: Mapping[str, Sequence[Any]] | None) -> DataFrame:
    """Rows whose columns hold one of the wanted values; on partition columns this prunes folders."""
    for column, values in (wanted or {}).items():
        df = df.filter(F.col(column).isin(list(values)))
    return df


def pruned_summary(
    df: DataFrame,
    wanted: Mapping[str, Sequence[Any]],
    field: str = "field_of_study",
    measure: str = "gpa",
    usage: str = "usage_frequency_score",
    digits: int = 6,
) -> DataFrame:
    rows = only(df, wanted).filter(F.col(measure).isNotNull() & F.col(usage).isNotNull())
    return (
        rows.groupBy(field)
        .agg(
            _rows().alias("student_count"),
            settled_round(F.avg(measure), digits).alias("avg_gpa"),
            settled_round(F.avg(usage), digits).alias("avg_usage"),
            settled_round(F.stddev(measure), digits).alias("gpa_stddev"),
        )
        .orderBy(F.desc("avg_gpa"))
    )


def monthly_trend(
    df: DataFrame,
    date: str,
    since: str,
    before: str,
    field: str = "field_of_study",
    measure: str = "gpa",
    usage: str = "usage_frequency_score",
    digits: int = 6,
) -> DataFrame:
    """Monthly counts and means over ``[since, before)``; the range filter reaches the scan."""
    rows = df.filter((F.col(date) >= F.lit(since)) & (F.col(date) < F.lit(before)))
    rows = rows.filter(F.col(field).isNotNull() & F.col(measure).isNotNull())
    month = F.trunc(F.col(date).cast("date"), "month")
    return (
        rows.groupBy(month.alias("month"), field)
        .agg(
            _rows().alias("monthly_count"),
            settled_round(F.avg(measure), digits).alias("avg_monthly_gpa"),
            settled_round(F.avg(usage), digits).alias("avg_monthly_usage"),
        )
        .orderBy("month", field)
    )


def staged_statistics(df: DataFrame, wanted: Mapping[str, Sequence[Any]] | None = None, field: str = "field_of_study") -> DataFrame:
    """Means, spread, shares, correlation and a composite score per field.

    One partial and one final aggregate. Deviation and correlation use Spark's merging moments
    rather than sums of squares, which cancel.
    """
    gpa, usage, happy = F.col("gpa"), F.col("usage_frequency_score"), F.col("satisfaction_level")
    rows = only(df, wanted).filter(gpa.isNotNull() & usage.isNotNull())
    n = _rows()

    def per_row(column: str, digits: int) -> Column:
        # as in total / count of rows: a missing value counts as nothing, not as absent
        return settled_round(F.try_divide(F.sum(column), n), digits)

    stats = rows.groupBy(field).agg(
        n.alias("student_count"),
        per_row("gpa", 3).alias("avg_gpa"),
        settled_round(F.coalesce(F.stddev("gpa"), F.lit(0.0)), 3).alias("gpa_stddev"),
        per_row("usage_frequency_score", 2).alias("avg_usage"),
        per_row("satisfaction_level", 2).alias("avg_satisfaction"),
        per_row("num_ai_tools", 1).alias("avg_tools"),
        per_row("attendance_rate", 3).alias("avg_attendance"),
        share_where(gpa >= 3.5, 1).alias("high_performer_pct"),
        share_where(gpa < 2.5, 1).alias("low_performer_pct"),
        share_where(usage >= 4, 1).alias("high_user_pct"),
        share_where(happy >= 4, 1).alias("highly_satisfied_pct"),
        settled_round(safe_corr("gpa", "usage_frequency_score"), 4).alias("gpa_usage_correlation"),
        settled_round(F.max("gpa") - F.min("gpa"), 3).alias("gpa_range"),
        settled_round(F.max(usage) - F.min(usage), 2).alias("usage_range"),
    )
    composite = weighted_score(
        [
            ("avg_gpa", 0.3, None),
            ("avg_usage", 0.2, None),
            ("avg_satisfaction", 0.2, None),
            (F.col("avg_attendance") * 4, 0.15, None),
            (F.col("high_performer_pct") * 0.01, 0.15, None),
        ]
    )
    return stats.withColumn("composite_score", settled_round(composite, 3)).orderBy(F.desc("composite_score"))


def top_students(
    df: DataFrame, wanted: Mapping[str, Sequence[Any]] | None = None, field: str = "field_of_study", key: str = "student_id", n: int = 10
) -> DataFrame:
    rows = only(df, wanted).filter(F.col("gpa").isNotNull() & F.col("usage_frequency_score").isNotNull())
    order = [F.desc("gpa"), F.desc("usage_frequency_score"), F.asc(key)]
    columns = [key, field, "gpa", "usage_frequency_score", "satisfaction_level"]
    return top_per_group(rows.select(*columns), [field], order, n, "rank_in_field").orderBy(field, "rank_in_field")


def sampled_estimates(
    df: DataFrame,
    key: str = "student_id",
    field: str = "field_of_study",
    percent: int = 10,
    minimum: int = 20,
) -> DataFrame:
    """Estimates with a 95 per cent interval from a stable sample of the keys."""
    known = df.filter(F.col("gpa").isNotNull() & F.col("usage_frequency_score").isNotNull())
    n = F.col("sample_size")
    sample = hash_sample(known, key, percent)
    stats = (
        sample.groupBy(field)
        .agg(
            _rows().alias("sample_size"),
            F.avg("gpa").alias("mean"),
            F.stddev("gpa").alias("sd"),
            F.avg("usage_frequency_score").alias("usage_mean"),
            F.stddev("usage_frequency_score").alias("usage_sd"),
            safe_corr("gpa", "usage_frequency_score").alias("r"),
        )
        .filter(n >= minimum)
    )
    stats = with_quantiles(stats, sample, [field], "gpa", [0.5], "median").withColumn("median", F.col("median")[0])
    mean, error = F.col("mean"), margin_of_error(F.col("sd"), n)
    return stats.select(
        field,
        "sample_size",
        (n * F.lit(100 / percent)).cast("long").alias("estimated_total"),
        settled_round(mean, 3).alias("estimated_avg_gpa"),
        settled_round(F.col("sd"), 3).alias("estimated_gpa_stddev"),
        settled_round(F.col("usage_mean"), 2).alias("estimated_avg_usage"),
        settled_round(F.col("usage_sd"), 2).alias("estimated_usage_stddev"),
        settled_round(F.col("median"), 3).alias("estimated_median_gpa"),
        settled_round(F.col("r"), 4).alias("estimated_correlation"),
        settled_round(mean - error, 3).alias("gpa_ci_lower"),
        settled_round(mean + error, 3).alias("gpa_ci_upper"),
        settled_round(error, 3).alias("margin_of_error"),
        band(n, P.SAMPLE_QUALITY, P.SAMPLE_QUALITY_DEFAULT).alias("sample_quality"),
    ).orderBy(F.desc("estimated_total"))


def window_bundle(
    df: DataFrame,
    wanted: Mapping[str, Sequence[Any]] | None = None,
    entity: str = "student_id",
    field: str = "field_of_study",
    period: str = "semester",
    top: int = 20,
) -> DataFrame:
    """The top rows per (field, period) with dense rank, percent rank, moving average and position.

    The result needs only the top rows, so nothing else is ranked: the dense rank is the same
    among the top rows, the percent rank follows from the group size and the number of rows that
    share the value, and the moving average is computed for the entities in the result.
    """
    rows = only(df, wanted).filter(F.col("gpa").isNotNull() & F.col("usage_frequency_score").isNotNull())
    rows = rows.select(entity, field, period, "gpa", "usage_frequency_score")
    best = measured(top_per_group(rows, [field, period], [F.desc("gpa"), F.asc(entity)], top, "gpa_rank"))

    sizes = rows.groupBy(field, period).agg(_rows().alias("total_students_in_group"))
    # rows that share a top value, counted after a join with the few distinct top values
    tied = rows.join(best.select(field, period, "gpa").distinct(), [field, period, "gpa"])
    tied = tied.groupBy(field, period, "gpa").agg(_rows().alias("__tied"))
    history = rows.join(best.select(entity).distinct(), entity, "left_semi")
    history = moving_average(history, entity, period, "gpa", 1, "__ma").select(entity, period, field, "__ma")

    out = best.join(sizes, [field, period]).join(tied, [field, period, "gpa"]).join(history, [entity, field, period])
    among = Window.partitionBy(field, period).orderBy(F.desc("gpa"))
    size = F.col("total_students_in_group")
    # rank() among the top rows equals the rank in the group: all rows above a top row are top rows
    out = out.withColumns({"gpa_dense_rank": F.dense_rank().over(among), "__rank": F.rank().over(among)})
    smaller = size - F.col("__rank") - F.col("__tied") + 1
    percentile = F.when(size > 1, smaller / (size - 1)).otherwise(0.0)
    position = F.try_divide(F.col("gpa_rank") - 1.0, size - 1)
    return out.select(
        field,
        period,
        entity,
        "gpa",
        "usage_frequency_score",
        "gpa_rank",
        F.col("gpa_dense_rank").cast("long").alias("gpa_dense_rank"),
        settled_round(percentile, 3).alias("gpa_percentile"),
        settled_round(F.col("__ma"), 3).alias("moving_avg_gpa"),
        "total_students_in_group",
        settled_round(position, 3).alias("relative_position"),
        band(percentile, P.RANK_TIERS, P.RANK_TIER_DEFAULT).alias("performance_tier"),
    ).orderBy(field, period, "gpa_rank")


def benchmark_grades(
    df: DataFrame,
    wanted: Mapping[str, Sequence[Any]] | None = None,
    entity: str = "student_id",
    field: str = "field_of_study",
    minimum: int = 10,
) -> DataFrame:
    """Every row against the mean and deviation of its field, for fields with enough rows.

    The inner join with the field statistics is also the restriction to qualifying fields.
    """
    rows = only(df, wanted).filter(F.col("gpa").isNotNull())
    stats = {"total_students": _rows(), "field_avg_gpa": F.avg("gpa"), "field_stddev_gpa": spread("gpa")}
    joined = with_group_stats(rows, [field], stats, having=F.col("total_students") >= minimum)
    gpa, mean, sd = F.col("gpa"), F.col("field_avg_gpa"), F.col("field_stddev_gpa")
    z = F.when(sd > 0, settled_round(z_score("gpa", "field_avg_gpa", "field_stddev_gpa"), 3)).otherwise(0.0)
    grade = (
        F.when(gpa >= mean + sd, "Above Average")
        .when(gpa >= mean, "Average")
        .when(gpa >= mean - sd, "Below Average")
        .otherwise("Well Below Average")
    )
    return joined.filter(F.col("usage_frequency_score").isNotNull()).select(
        field,
        entity,
        "gpa",
        "usage_frequency_score",
        "satisfaction_level",
        "attendance_rate",
        "total_students",
        settled_round(mean, 6).alias("field_avg_gpa"),
        settled_round(sd, 6).alias("field_stddev_gpa"),
        settled_round(gpa - mean, 3).alias("gpa_vs_field_avg"),
        z.alias("gpa_z_score"),
        grade.alias("performance_grade"),
    )


def approximate_summary(
    df: DataFrame,
    wanted: Mapping[str, Sequence[Any]] | None = None,
    key: str = "student_id",
    field: str = "field_of_study",
    minimum: int = 20,
    rsd: float = 0.02,
) -> DataFrame:
    """Summary per field: distinct counts from fixed-size sketches in one aggregate, exact quartiles beside it."""
    gpa, usage = F.col("gpa"), F.col("usage_frequency_score")
    rows = only(df, wanted).filter(gpa.isNotNull() & usage.isNotNull())
    stats = (
        rows.groupBy(field)
        .agg(
            _rows().alias("total_students"),
            F.count("gpa").alias("valid_gpa_count"),
            settled_round(F.avg("gpa"), 3).alias("approx_avg_gpa"),
            settled_round(F.stddev("gpa"), 3).alias("approx_stddev_gpa"),
            F.approx_count_distinct(key, rsd).alias("approx_unique_students"),
            F.approx_count_distinct("usage_frequency_score", rsd).alias("approx_unique_usage_scores"),
            share_where(gpa >= 3.5, 1).alias("high_performer_pct"),
            share_where(usage >= 4, 1).alias("high_usage_pct"),
            settled_round(safe_corr("gpa", "usage_frequency_score"), 4).alias("gpa_usage_correlation"),
        )
        .filter(F.col("total_students") >= minimum)
    )
    stats = with_quantiles(stats, rows, [field], "gpa", [0.25, 0.5, 0.75], "__q")
    names = ["approx_gpa_q1", "approx_gpa_median", "approx_gpa_q3"]
    return (
        stats.withColumns({n: F.col("__q")[i] for i, n in enumerate(names)}).drop("__q").orderBy(F.desc("total_students"))
    )
