"""Derived scores and classifications of one row, and their summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import presets as P
from tallyforge.functions.expr import (
    band,
    classify,
    clip,
    hash_normal,
    list_count,
    member_label,
    score_map,
    share_where,
    weighted_score,
)
from tallyforge.operators import cleaning
from tallyforge.operators.ranking import rank_rows


def clean_usage(df: DataFrame) -> DataFrame:
    """Usage survey rows to counted tools, scored frequency and usage intensity."""
    return df.filter(F.col("student_id").isNotNull()).select(
        "student_id",
        "field_of_study",
        "year_of_study",
        list_count("ai_tools_used").alias("num_ai_tools"),
        score_map("frequency_of_use", P.FREQUENCY_SCORES, P.FREQUENCY_DEFAULT).alias("usage_frequency_score"),
        "satisfaction_level",
        "primary_use_case",
        member_label("frequency_of_use", P.USAGE_INTENSITY, P.USAGE_INTENSITY_DEFAULT).alias("usage_intensity"),
    )


def engagement(filled: bool = False, digits: int | None = None) -> Column:
    return weighted_score(P.ENGAGEMENT_PARTS_FILLED if filled else P.ENGAGEMENT_PARTS, digits)


def clean_academic(df: DataFrame) -> DataFrame:
    """Valid academic rows with performance category and engagement score."""
    valid = cleaning.keep_in_ranges(
        df.filter(F.col("student_id").isNotNull()), {"gpa": (0.0, 4.0), "attendance_rate": (0.0, 1.0)}
    )
    return valid.select(
        "student_id",
        "semester",
        "gpa",
        "major_gpa",
        "credits_completed",
        "attendance_rate",
        "assignment_submission_rate",
        band("gpa", P.PERFORMANCE_CATEGORY, P.PERFORMANCE_CATEGORY_DEFAULT).alias("performance_category"),
        engagement().alias("engagement_score"),
    )


def proficiency(df: DataFrame, plain: bool = False) -> DataFrame:
    """``plain`` keeps NULL inputs and full precision and adds no level."""
    parts = P.PROFICIENCY_PARTS
    if plain:
        return df.withColumn("ai_proficiency_score", weighted_score([(c, w, None) for c, w, _ in parts]))
    scored = df.withColumn("ai_proficiency_score", weighted_score(parts, 2))
    level = band("ai_proficiency_score", P.PROFICIENCY_LEVELS, P.PROFICIENCY_DEFAULT)
    return scored.withColumn("proficiency_level", level)


def learning_style(df: DataFrame, plain: bool = False) -> DataFrame:
    """``plain`` knows no high-frequency style and adds no preference."""
    if plain:
        return df.withColumn("learning_style", classify(_styles(P.LEARNING_STYLES), P.LEARNING_STYLE_DEFAULT))
    styled = df.withColumn("learning_style", classify(_styles([*P.LEARNING_STYLES, P.FREQUENT_STYLE]), P.LEARNING_STYLE_DEFAULT))
    return styled.withColumn("learning_preference", member_label("learning_style", P.LEARNING_PREFERENCES, P.LEARNING_PREFERENCE_DEFAULT))


def _at_least(values: Mapping[str, float]) -> Column:
    return reduce(and_, [F.col(c) >= v for c, v in values.items()])


def _styles(styles: Sequence[tuple[str, str | None, Mapping[str, float]]]) -> list[tuple[Column, str]]:
    use = F.col("primary_use_case")
    return [(_at_least(values) if case is None else (use == case) & _at_least(values), label) for label, case, values in styles]


def risk(df: DataFrame) -> DataFrame:
    """Banded risk points, weighted to a score; flag, level and intervention follow from the score."""
    points = [
        ("gpa", P.RISK_GPA),
        ("attendance_rate", P.RISK_ATTENDANCE),
        ("assignment_submission_rate", P.RISK_SUBMISSION),
    ]
    parts = [(band(c, steps, 1, below=True), w, None) for (c, steps), w in zip(points, P.RISK_WEIGHTS)]
    score = F.col("academic_risk_score")
    return (
        df.withColumn("academic_risk_score", weighted_score(parts, 2))
        .withColumns({"at_risk_flag": score >= P.RISK_FLAG_FROM, "risk_level": band(score, P.RISK_LEVELS, "None")})
        .withColumn("intervention_needed", score_map("risk_level", P.INTERVENTIONS, "None"))
    )


def risk_by_rule(df: DataFrame) -> DataFrame:
    """At risk only if all three measures are low; the level follows from the grade average."""
    low = reduce(and_, [F.col(c) < v for c, v in P.RULE_RISK.items()])
    flag = F.coalesce(low, F.lit(False))
    level = F.when(flag, band("gpa", P.RULE_RISK_LEVELS, P.RULE_RISK_DEFAULT, below=True)).otherwise("None")
    return df.withColumns({"at_risk_flag": flag, "risk_level": level})


def workload(df: DataFrame, plain: bool = False) -> DataFrame:
    if plain:
        scored = df.withColumn("workload_score", weighted_score(P.WORKLOAD_PARTS_PLAIN))
        category = band("workload_score", P.WORKLOAD_BANDS_PLAIN, P.WORKLOAD_DEFAULT_PLAIN)
        return scored.withColumn("workload_category", category)
    category = F.col("workload_category")
    balance = [((category == name) & (F.col("gpa") >= gpa), points) for name, gpa, points in P.WORKLOAD_BALANCE]
    return (
        df.withColumn("workload_score", weighted_score(P.WORKLOAD_PARTS, 2))
        .withColumn("workload_category", band("workload_score", P.WORKLOAD_BANDS, P.WORKLOAD_DEFAULT))
        .withColumn("workload_balance_score", classify([*balance, (category == P.WORKLOAD_DEFAULT, 2)], 1))
    )


def usage_patterns(df: DataFrame) -> DataFrame:
    near = F.abs(F.col("usage_frequency_score") - F.col("satisfaction_level")) <= P.CONSISTENT_APART
    steady = [(_at_least(values), label) for label, values in P.USAGE_CONSISTENCY]
    stages = [(_at_least(values), label) for label, values in P.ADOPTION_STAGES]
    return df.withColumns(
        {"usage_consistency": classify([*steady, (near, P.CONSISTENT)], P.INCONSISTENT), "adoption_stage": classify(stages, P.ADOPTION_DEFAULT)}
    )


def success_indicators(df: DataFrame, key: Sequence[str] = ("student_id",), field: str = "field_of_study") -> DataFrame:
    """Percent rank of the grade average within the field, its band, and the potential to improve."""
    percentile, skill = F.col("performance_percentile"), F.col("ai_proficiency_score")
    room = [((skill >= least) & (percentile < below), label) for least, below, label in P.IMPROVEMENT_POTENTIAL]
    ranked = rank_rows(df, [field], "gpa", key[0], percent_rank="relative_performance")
    return (
        ranked.withColumn("performance_percentile", F.round(F.col("relative_performance") * 100, 1))
        .withColumn("success_category", band(percentile, P.SUCCESS_BANDS, P.SUCCESS_DEFAULT))
        .withColumn("improvement_potential", classify(room, P.IMPROVEMENT_DEFAULT))
    )


def apply_all(df: DataFrame, quality_fixes: bool = True, key: Sequence[str] = ("student_id",)) -> DataFrame:
    """All student transforms; those whose input columns are absent are left out."""
    if quality_fixes:
        df = cleaning.remove_outliers(cleaning.standardise_student(cleaning.fill_constants(df)))
    df = risk(learning_style(proficiency(df)))
    if "course_name" in df.columns:
        df = cleaning.normalise_courses(df)
    if "total_courses" in df.columns:
        df = workload(df)
    return success_indicators(usage_patterns(df), key)


def apply_all_plain(df: DataFrame) -> DataFrame:
    """The short variant of the student transforms."""
    df = risk_by_rule(learning_style(proficiency(df, plain=True), plain=True))
    if "course_name" in df.columns and "course_code" in df.columns:
        df = cleaning.normalise_courses(df)
    return workload(df, plain=True) if "total_courses" in df.columns else df


def score_summary(df: DataFrame) -> DataFrame:
    """One row: range and mean of the proficiency score, and how many are at risk."""
    score = "ai_proficiency_score"
    return df.agg(
        F.min(score).alias("min_proficiency"),
        F.max(score).alias("max_proficiency"),
        F.avg(score).alias("avg_proficiency"),
        F.count_if("at_risk_flag").alias("at_risk_count"),
        share_where(F.col("at_risk_flag"), 1).alias("at_risk_pct"),
    )


def style_distribution(df: DataFrame, column: str = "learning_style") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def score_tiers(df: DataFrame, average: str = "average_score", subjects: Mapping[str, str] | None = None) -> DataFrame:
    """Tier of the average, and the subject that is strictly the strongest (else ``Balanced``)."""
    subjects = subjects or {"Math": "math_score", "Reading": "reading_score", "Writing": "writing_score"}

    def strongest(column: str) -> Column:
        others = [F.col(c) for c in subjects.values() if c != column]
        return F.col(column) > F.greatest(*others)

    return df.withColumns(
        {
            "performance_tier": band(average, P.SCORE_TIERS, P.SCORE_TIER_DEFAULT),
            "subject_strength": classify([(strongest(c), name) for name, c in subjects.items()], "Balanced"),
        }
    )


def school_effect(
    school_type: str = "school_type",
    ratio: str = "student_teacher_ratio",
    budget: str = "budget_per_student",
    technology: str = "technology_score",
    facility: str = "facility_score",
) -> Column:
    """Additive effect of a school's type, class size, budget and equipment on its pupils' scores."""
    return (
        score_map(school_type, P.SCHOOL_TYPE_EFFECT, 0)
        + classify([(F.col(ratio) < 15, 3), (F.col(ratio) > 20, -2)], 0)
        + classify([(F.col(budget) > 12000, 3), (F.col(budget) < 8000, -2)], 0)
        + (F.col(technology) - 5) * 0.5
        + (F.col(facility) - 5) * 0.3
    )


def adjust_for_school(df: DataFrame, key: str, scores: Sequence[str], noise_sd: float = 2.0) -> DataFrame:
    """Shift scores by the school effect and a normal noise drawn from the row key, limited to 0..100."""
    df = df.withColumn("school_effect", school_effect())

    def shifted(c: str) -> Column:
        noise = hash_normal(F.col(key), c, 0.0, noise_sd) if noise_sd else F.lit(0.0)
        return clip((F.col(c) + F.col("school_effect") + noise).cast("int"), 0, 100).cast("int")

    df = df.withColumns({c: shifted(c) for c in scores})
    total = sum((F.col(c) for c in scores), F.lit(0))
    return df.withColumns(
        {
            "total_score": total,
            "average_score": F.round(total / len(scores), 1),
            "school_effect": F.round("school_effect", 1),
        }
    )
