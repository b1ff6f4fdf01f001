"""The three-source student pipeline: check, clean, join, summarise, find outliers, write."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tallyforge.operators.aggregates import enrollment_summary, insight_summary
from tallyforge.operators.quality import assert_quality
from tallyforge.operators.scoring import clean_academic, clean_usage
from tallyforge.operators.windows import typed_outliers
from tallyforge.plans.schools import rank_schools, region_summary, school_profile
from tallyforge.sources.readers import read_table
from tallyforge.sources.writers import write_parquet


def integrate(usage: DataFrame, academic: DataFrame, enrollment: DataFrame, repeats: bool = True) -> DataFrame:
    """Usage joined with academic rows, and with the enrolment summary where there is one.

    The inner join is on the student, so AQE splits a student whose rows dominate. The enrolment
    side has one row per (student, term).
    """
    joined = clean_usage(usage).join(clean_academic(academic), "student_id")
    return joined.join(enrollment_summary(enrollment, repeats=repeats), ["student_id", "semester"], "left")


@dataclass(frozen=True)
class Sources:
    """Tables read and folders written by ``run``."""

    usage: str = "ai_tool_usage"
    academic: str = "academic_performance"
    enrollment: str = "course_enrollment"
    integrated: str = "integrated-student-analysis"
    insights: str = "insights"
    outliers: str = "outliers"
    repeats: bool = True
    limits: dict[str, Any] = field(default_factory=lambda: {"max_duplicate_pct": 10.0})


def run(spark: SparkSession, root: str, sources: Sources = Sources()) -> dict[str, str]:
    """Run the pipeline and return the folders written.

    The integrated table is written once, and the summaries read it back: the joins are not
    computed three times and a lost executor costs no more than its own tasks.
    """
    inputs = {n: read_table(spark, getattr(sources, n)) for n in ("usage", "academic", "enrollment")}
    for name, df in inputs.items():
        assert_quality(df, name, **sources.limits)
    paths = {n: f"{root.rstrip('/')}/{getattr(sources, n)}" for n in ("integrated", "insights", "outliers")}
    write_parquet(integrate(**inputs, repeats=sources.repeats), paths["integrated"], ["field_of_study", "semester"])
    integrated = spark.read.parquet(paths["integrated"])
    write_parquet(insight_summary(integrated), paths["insights"])
    write_parquet(typed_outliers(integrated), paths["outliers"])
    return paths


def run_schools(scores: DataFrame, schools: DataFrame, economics: DataFrame, root: str) -> dict[str, str]:
    """School pipeline: the ranked school table by (region, type), and its summary."""
    spark = scores.sparkSession
    paths = {n: f"{root.rstrip('/')}/{n}" for n in ("detailed-school-analysis", "summary-statistics")}
    detailed, summary = paths.values()
    write_parquet(rank_schools(school_profile(scores, schools, economics)), detailed, ["region", "school_type"])
    write_parquet(region_summary(spark.read.parquet(detailed)), summary)
    return paths
