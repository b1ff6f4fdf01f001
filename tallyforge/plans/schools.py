"""School pipeline: clean scores, summarise per school, join school and region, rank, analyse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import presets as P
from tallyforge.functions.expr import band, classify, safe_corr, score_map, settled_round, share_where, spread, weighted_score, z_score
from tallyforge.operators.aggregates import school_summary
from tallyforge.operators.cleaning import keep_in_ranges, train_test_split
from tallyforge.operators.joins import join_small, with_total_stats
from tallyforge.operators.ranking import rank_rows
from tallyforge.operators.scoring import score_tiers


def _rows() -> Column:
    return F.count(F.lit(1))


def clean_scores(df: DataFrame) -> DataFrame:
    """Rows with all three scores in 0..100, with tier and strongest subject."""
    return score_tiers(keep_in_ranges(df, {c: (0, 100) for c in ("math_score", "reading_score", "writing_score")}))


def school_profile(scores: DataFrame, schools: DataFrame, economics: DataFrame) -> DataFrame:
    """One row per school: score summary, school attributes and the economics of its region."""
    summary = school_summary(clean_scores(scores))
    return join_small(summary.join(schools, "school_id"), economics, ["region"])


def rank_schools(profile: DataFrame) -> DataFrame:
    """Rank and percentile of schools in their region, efficiency, equity, socioeconomic impact.

    The percentile ascends: 1 is the best school of the region.
    """
    mean = F.col("avg_school_score")
    scored = profile.withColumns(
        {
            "efficiency_score": settled_round(F.try_divide(mean, "budget_per_student") * 1000, 2),
            "equity_score": settled_round(100 - F.try_divide("score_stddev", mean) * 100, 2),
            "socioeconomic_impact": settled_round(mean - F.col("median_household_income") / 1000 * 0.1, 2),
        }
    )
    ranked = rank_rows(
        scored,
        ["region"],
        "avg_school_score",
        "school_id",
        ascending=False,
        row_number="regional_rank",
        rank="__rank",
        ties="__ties",
        group_size="__size",
    )
    size = F.col("__size")
    below = size - F.col("__rank") - F.col("__ties") + 1
    percentile = F.when(size > 1, below / (size - 1)).otherwise(0.0)
    return ranked.withColumn("regional_percentile", percentile).drop("__rank", "__size", "__ties")


def region_summary(detailed: DataFrame) -> DataFrame:
    return detailed.groupBy("region", "school_type").agg(
        F.count("school_id").alias("school_count"),
        settled_round(F.avg("avg_school_score"), 6).alias("regional_avg_score"),
        settled_round(F.avg("efficiency_score"), 6).alias("avg_efficiency"),
        settled_round(F.avg("equity_score"), 6).alias("avg_equity"),
        settled_round(safe_corr("budget_per_student", "avg_school_score"), 6).alias("budget_performance_corr"),
        settled_round(safe_corr("student_teacher_ratio", "avg_school_score"), 6).alias("ratio_performance_corr"),
    )


def school_effectiveness(detailed: DataFrame) -> DataFrame:
    overall = weighted_score(
        [("avg_school_score", 0.4, None), ("efficiency_score", 0.3, None), ("equity_score", 0.3, None)]
    )
    return (
        detailed.withColumn("overall_effectiveness", settled_round(overall, 2))
        .groupBy("region", "school_type")
        .agg(
            _rows().alias("school_count"),
            settled_round(F.avg("overall_effectiveness"), 2).alias("avg_effectiveness"),
            settled_round(F.avg("avg_school_score"), 2).alias("avg_performance"),
            settled_round(F.avg("efficiency_score"), 2).alias("avg_efficiency"),
            settled_round(F.avg("equity_score"), 2).alias("avg_equity"),
            share_where(F.col("regional_percentile") >= 0.75, 1).alias("top_quartile_pct"),
            settled_round(safe_corr("budget_per_student", "avg_school_score"), 4).alias("budget_performance_corr"),
        )
        .orderBy(F.desc("avg_effectiveness"))
    )


def with_economics(detailed: DataFrame, economics: DataFrame | None) -> DataFrame:
    """Join the region's economics only if they are not there yet."""
    if economics is None or "median_household_income" in detailed.columns:
        return detailed
    return join_small(detailed, economics, ["region"])


def socioeconomic_impact(detailed: DataFrame, economics: DataFrame | None = None) -> DataFrame:
    index = weighted_score(
        [
            (F.col("median_household_income") / 1000, 0.4, None),
            (100 - F.col("unemployment_rate"), 0.2, None),
            (100 - F.col("poverty_rate"), 0.2, None),
            ("college_graduation_rate", 0.2, None),
        ]
    )
    score = F.col("avg_school_score")
    return (
        with_economics(detailed, economics)
        .withColumn("socioeconomic_index", settled_round(index, 2))
        .groupBy("region")
        .agg(
            _rows().alias("school_count"),
            settled_round(F.avg("socioeconomic_index"), 2).alias("avg_socioeconomic_index"),
            settled_round(F.avg(score), 2).alias("avg_school_performance"),
            settled_round(F.avg("median_household_income"), 0).alias("avg_household_income"),
            settled_round(F.avg("unemployment_rate"), 1).alias("avg_unemployment_rate"),
            settled_round(F.avg("poverty_rate"), 1).alias("avg_poverty_rate"),
            settled_round(safe_corr("socioeconomic_index", score), 4).alias("socioeconomic_performance_corr"),
            settled_round(safe_corr("median_household_income", score), 4).alias("income_performance_corr"),
            settled_round(safe_corr("poverty_rate", score), 4).alias("poverty_performance_corr"),
            settled_round(F.max(score) - F.min(score), 2).alias("performance_gap"),
            settled_round(F.stddev(score), 2).alias("performance_stddev"),
        )
        .orderBy(F.desc("avg_socioeconomic_index"))
    )


def resource_optimisation(detailed: DataFrame) -> DataFrame:
    ratio = band("student_teacher_ratio", P.RATIO_POINTS, P.RATIO_POINTS_DEFAULT, below=True, closed=True)
    used = weighted_score([("technology_score", 0.3, None), ("facility_score", 0.3, None), (ratio, 0.4, None)])
    rows = detailed.withColumns(
        {
            "resource_utilization_score": settled_round(used, 2),
            "efficiency_grade": band("efficiency_score", P.EFFICIENCY_GRADES, P.EFFICIENCY_GRADE_DEFAULT),
        }
    )
    efficiency, budget = F.avg("efficiency_score"), F.avg("budget_per_student")
    potential = classify(
        [
            ((efficiency < 5) & (budget > 10000), "High Improvement Potential"),
            ((efficiency < 6) & (F.avg("resource_utilization_score") < 6), "Medium Improvement Potential"),
        ],
        "Optimized",
    )
    return (
        rows.groupBy("efficiency_grade", "school_type")
        .agg(
            _rows().alias("school_count"),
            settled_round(budget, 0).alias("avg_budget_per_student"),
            settled_round(F.avg("student_teacher_ratio"), 1).alias("avg_student_teacher_ratio"),
            settled_round(F.avg("technology_score"), 1).alias("avg_technology_score"),
            settled_round(F.avg("facility_score"), 1).alias("avg_facility_score"),
            settled_round(F.avg("avg_school_score"), 2).alias("avg_performance"),
            settled_round(efficiency, 2).alias("avg_efficiency_score"),
            settled_round(F.avg("resource_utilization_score"), 2).alias("avg_resource_utilization"),
            potential.alias("improvement_potential"),
        )
        .orderBy(F.desc("avg_efficiency_score"))
    )


def model_features(detailed: DataFrame, economics: DataFrame | None = None, digits: int = 6) -> DataFrame:
    """Feature table of schools: encodings, ratios, interactions, z-scores, class label, split."""
    rows = with_economics(detailed, economics)
    scaled = {"budget": "budget_per_student", "ratio": "student_teacher_ratio", "income": "median_household_income"}
    stats = {f"__mean_{n}": F.avg(c) for n, c in scaled.items()} | {f"__sd_{n}": spread(c) for n, c in scaled.items()}
    rows = with_total_stats(rows, stats)
    budget, income = F.col("budget_per_student"), F.col("median_household_income")
    out = rows.select(
        "school_id",
        settled_round(F.col("avg_school_score"), digits).alias("target_performance"),
        score_map("school_type", P.SCHOOL_TYPE_CODES, None).alias("school_type_encoded"),
        score_map("region", P.REGION_CODES, None).alias("region_encoded"),
        "budget_per_student",
        "student_teacher_ratio",
        "technology_score",
        "facility_score",
        "total_students",
        "median_household_income",
        "unemployment_rate",
        "poverty_rate",
        "college_graduation_rate",
        "internet_access_rate",
        settled_round(F.try_divide(budget, income) * 100, digits).alias("budget_income_ratio"),
        settled_round(F.col("technology_score") * F.col("internet_access_rate") / 100, digits).alias("tech_access_score"),
        settled_round((100 - F.col("poverty_rate")) * budget / 1000, digits).alias("economic_resource_index"),
        settled_round(F.col("student_teacher_ratio") * F.col("total_students"), digits).alias("class_size_impact"),
        (F.col("technology_score") * F.col("facility_score")).alias("infrastructure_score"),
        *[settled_round(z_score(c, f"__mean_{n}", f"__sd_{n}"), digits).alias(f"{n}_zscore") for n, c in scaled.items()],
    )
    label = band("target_performance", P.TARGET_CLASSES, P.TARGET_CLASS_DEFAULT)
    return train_test_split(out.withColumn("performance_category", label), "school_id")
