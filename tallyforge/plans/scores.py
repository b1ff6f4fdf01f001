"""Exam score analyses: basic statistics, group comparisons, effects, distribution, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import presets as P
from tallyforge.functions.expr import band, pct, safe_corr, settled_round, share_where
from tallyforge.plans.ranking import category_order

SUBJECTS = {"math": "math_score", "reading": "reading_score", "writing": "writing_score"}
AVERAGE = "average_score"


def _rows() -> Column:
    return F.count(F.lit(1))


def _means(digits: int = 2) -> list[Column]:
    return [settled_round(F.avg(c), digits).alias(f"avg_{name}") for name, c in SUBJECTS.items()]


def basic_statistics(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows().alias("total_students"),
        *_means(),
        settled_round(F.avg(AVERAGE), 2).alias("overall_avg"),
        settled_round(F.stddev(AVERAGE), 2).alias("score_stddev"),
    )


def group_comparison(df: DataFrame, group: str = "gender") -> DataFrame:
    gap = F.avg("reading_score") - F.avg("math_score")
    return (
        df.groupBy(group)
        .agg(
            _rows().alias("student_count"),
            *_means(),
            settled_round(F.avg(AVERAGE), 2).alias("avg_total"),
            settled_round(gap, 2).alias("reading_math_diff"),
        )
        .orderBy(F.desc("avg_total"))
    )


def group_impact(df: DataFrame, group: str = "parental_level_of_education", high: float = 80) -> DataFrame:
    """Groups ranked by mean score, with the share of high scorers; the window sees one row per group."""
    stats = df.groupBy(group).agg(
        _rows().alias("student_count"),
        F.avg(AVERAGE).alias("__mean"),
        settled_round(F.stddev(AVERAGE), 2).alias("score_stddev"),
        share_where(F.col(AVERAGE) >= high, 1).alias("high_scorer_pct"),
    )
    return (
        stats.withColumn("education_rank", F.rank().over(Window.partitionBy().orderBy(F.desc("__mean"))).cast("long"))
        .withColumn("avg_score", settled_round(F.col("__mean"), 2))
        .drop("__mean")
        .orderBy(F.desc("avg_score"))
    )


def treatment_effect(df: DataFrame, treatment: str = "test_preparation_course", within: str = "gender") -> DataFrame:
    """Mean of each treated group against the mean of the group means in its partition."""
    stats = df.groupBy(treatment, within).agg(_rows().alias("student_count"), *_means(), F.avg(AVERAGE).alias("__mean"))
    effect = F.col("__mean") - F.avg("__mean").over(Window.partitionBy(within))
    return (
        stats.withColumns({"avg_total": settled_round(F.col("__mean"), 2), "prep_effect": settled_round(effect, 2)})
        .drop("__mean")
        .orderBy(within, treatment)
    )


def two_factor_effect(df: DataFrame, factor: str = "lunch", within: str = "race_ethnicity") -> DataFrame:
    """Group means against the mean of all group means and of those in the same ``within`` group."""
    stats = df.groupBy(factor, within).agg(
        _rows().alias("student_count"), F.avg(AVERAGE).alias("__mean"), F.stddev(AVERAGE).alias("__sd")
    )
    mean = F.col("__mean")
    return (
        stats.withColumns(
            {
                "avg_score": settled_round(mean, 2),
                "score_stddev": settled_round(F.col("__sd"), 2),
                "vs_overall_avg": settled_round(mean - F.avg(mean).over(Window.partitionBy()), 2),
                "within_race_effect": settled_round(mean - F.avg(mean).over(Window.partitionBy(within)), 2),
            }
        )
        .drop("__mean", "__sd")
        .orderBy(within, factor)
    )


def grade_distribution(df: DataFrame) -> DataFrame:
    grades = df.groupBy(band(AVERAGE, P.GRADE_RANGES, P.GRADE_RANGE_DEFAULT).alias("grade_range")).agg(
        _rows().alias("student_count"), *_means()
    )
    share = pct(F.col("student_count"), F.sum("student_count").over(Window.partitionBy()), 1)
    return grades.withColumn("percentage", share).orderBy(
        category_order("grade_range", [label for _, label in P.GRADE_RANGES])
    )


def subject_correlations(df: DataFrame) -> DataFrame:
    names = list(SUBJECTS)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    return df.agg(
        _rows().alias("total_students"),
        *[settled_round(safe_corr(SUBJECTS[a], SUBJECTS[b]), 4).alias(f"{a}_{b}_corr") for a, b in pairs],
        *_means(),
        *[settled_round(F.stddev(c), 2).alias(f"stddev_{name}") for name, c in SUBJECTS.items()],
    )


def factor_comparison(df: DataFrame, factor: Column | str, measure: str, name: str = "factor") -> DataFrame:
    """Mean and spread of a measure per level of a factor (school size, ratio band, income band)."""
    level = F.col(factor) if isinstance(factor, str) else factor
    return df.groupBy(level.alias(name)).agg(
        _rows().alias("n"),
        settled_round(F.avg(measure), 3).alias("avg_measure"),
        settled_round(F.stddev(measure), 3).alias("stddev_measure"),
    )


def factor_correlations(df: DataFrame, factors: Sequence[str], measure: str) -> DataFrame:
    return df.agg(*[settled_round(safe_corr(f, measure), 4).alias(f"{f}_corr") for f in factors])
