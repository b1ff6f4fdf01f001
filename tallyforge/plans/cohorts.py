"""Multi-stage analyses: effectiveness, cohorts, trend stability, trajectories, segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import presets as P
from tallyforge.functions.expr import band, classify, pct, safe_corr, settled_round, share_where, spread, weighted_score
from tallyforge.operators.joins import with_group_stats
from tallyforge.operators.ranking import with_quantiles
from tallyforge.operators.scoring import engagement
from tallyforge.operators.windows import neighbours



def _rows() -> Column:
    return F.count(F.lit(1))


def effectiveness(df: DataFrame, field: str = "field_of_study", minimum: int = 3) -> DataFrame:
    """Learner types by z-scores against the field, summarised per field, type and potential."""
    known = F.col("gpa").isNotNull() & F.col("usage_frequency_score").isNotNull() & F.col("attendance_rate").isNotNull()
    base = df.filter(known).select(
        field,
        "gpa",
        settled_round(engagement(filled=True), 3).alias("engagement_score"),
        settled_round(weighted_score(P.UTILIZATION_PARTS), 2).alias("ai_utilization_score"),
    )
    measures = [("gpa", "gpa", 3), ("engagement", "engagement_score", 3), ("ai_utilization", "ai_utilization_score", 2)]
    stats: dict[str, Column] = {}
    for name, column, digits in measures:
        stats[f"__mean_{name}"] = settled_round(F.avg(column), digits)
        stats[f"__sd_{name}"] = settled_round(spread(column), 3)
    rows = with_group_stats(base, [field], stats)
    relative = {}
    for name, column, _ in measures:
        gap = F.col(column) - F.col(f"__mean_{name}")
        sd = F.col(f"__sd_{name}")
        relative[f"{name}_vs_field_avg"] = settled_round(gap, 3)
        relative[f"{name}_z_score"] = F.when(sd > 0, settled_round(F.try_divide(gap, sd), 3)).otherwise(0.0)
    rows = rows.withColumns(relative)
    gpa, engaged, ai = (F.col(f"{name}_z_score") for name, _, _ in measures)

    def points(z: Column) -> Column:
        return classify([(z > 1, 3), (z > 0, 2), (z > -1, 1)], 0)

    rows = rows.withColumns(
        {
            "effectiveness_score": settled_round(points(gpa) * 0.4 + points(engaged) * 0.3 + points(ai) * 0.3, 1),
            "learner_type": classify(
                [
                    ((gpa > 1) & (ai > 0.5), "High Achiever + AI Savvy"),
                    ((gpa > 1) & (ai <= 0), "High Achiever + Traditional"),
                    ((gpa <= 0) & (ai > 0.5), "Struggling + AI Dependent"),
                    ((gpa <= 0) & (engaged <= 0), "At Risk"),
                    ((engaged > 1) & (gpa > 0), "Engaged High Performer"),
                    ((engaged > 1) & (gpa <= 0), "Engaged Underperformer"),
                ],
                "Average Performer",
            ),
            "improvement_potential": classify(
                [
                    ((ai >= 1) & (gpa < 0), "High Potential"),
                    ((engaged >= 1) & (gpa < 0.5), "Medium Potential"),
                    ((ai < -0.5) & (gpa > 0), "AI Enhancement Opportunity"),
                ],
                "Stable",
            ),
        }
    )
    summary = (
        rows.groupBy(field, "learner_type", "improvement_potential")
        .agg(
            _rows().alias("student_count"),
            settled_round(F.avg("gpa"), 3).alias("avg_gpa"),
            settled_round(F.avg("effectiveness_score"), 2).alias("avg_effectiveness_score"),
            settled_round(F.avg("engagement_score"), 3).alias("avg_engagement"),
            settled_round(F.avg("ai_utilization_score"), 2).alias("avg_ai_utilization"),
            settled_round(F.avg("gpa_vs_field_avg"), 3).alias("avg_gpa_vs_field"),
            settled_round(F.avg("engagement_vs_field_avg"), 3).alias("avg_engagement_vs_field"),
            settled_round(F.avg("ai_utilization_vs_field_avg"), 2).alias("avg_ai_utilization_vs_field"),
            settled_round(F.stddev("effectiveness_score"), 2).alias("effectiveness_stddev"),
        )
        .filter(F.col("student_count") >= minimum)
    )
    summary = with_quantiles(summary, rows, [field, "learner_type", "improvement_potential"], "effectiveness_score", [0.5], "median_effectiveness")
    summary = summary.withColumn("median_effectiveness", F.col("median_effectiveness")[0])
    # from here on one row per (field, type, potential)
    within = Window.partitionBy(field)
    return summary.withColumns(
        {
            "pct_of_field": pct(F.col("student_count"), F.sum("student_count").over(within), 1),
            "effectiveness_rank": F.rank().over(within.orderBy(F.desc("avg_effectiveness_score"))).cast("long"),
        }
    ).orderBy(field, F.desc("avg_effectiveness_score"))


def with_cohorts(df: DataFrame, levels: bool = True) -> DataFrame:
    """Usage cohort, satisfaction segment and (with ``levels``) the academic level of every row."""
    usage, tools = F.col("usage_frequency_score"), F.col("num_ai_tools")
    out = {
        "usage_cohort": classify(
            [
                ((usage >= 4) & (tools >= 3), "Power Users"),
                ((usage >= 3) & (tools >= 2), "Regular Users"),
                (usage >= 2, "Occasional Users"),
            ],
            "Light Users",
        ),
        "satisfaction_segment": band("satisfaction_level", P.SATISFACTION_SEGMENTS, P.SATISFACTION_SEGMENT_DEFAULT),
    }
    if levels:
        out["academic_level"] = band(
            "year_of_study", P.ACADEMIC_LEVELS, P.ACADEMIC_LEVEL_DEFAULT, below=True, closed=True
        )
    return df.withColumns(out)


def _cohort_stats(df: DataFrame, keys: Sequence[str], minimum: int) -> DataFrame:
    stats = df.groupBy(*keys).agg(
        _rows().alias("cohort_size"),
        settled_round(F.avg("gpa"), 3).alias("avg_gpa"),
        settled_round(F.avg("attendance_rate"), 3).alias("avg_attendance"),
        settled_round(F.avg("usage_frequency_score"), 2).alias("avg_usage_frequency"),
        settled_round(F.avg("satisfaction_level"), 2).alias("avg_satisfaction"),
        settled_round(F.avg("num_ai_tools"), 1).alias("avg_tools_used"),
    )
    kept = with_quantiles(stats.filter(F.col("cohort_size") >= minimum), df, keys, "gpa", [0.5], "gpa_median")
    return kept.withColumn("gpa_median", F.col("gpa_median")[0])


def cohort_success(df: DataFrame, field: str = "field_of_study", minimum: int = 5) -> DataFrame:
    """Which (usage, satisfaction) cohorts succeed: share of their sub-cohorts in the field's top quarter."""
    known = df.filter(
        F.col("usage_frequency_score").isNotNull() & F.col("satisfaction_level").isNotNull() & F.col("gpa").isNotNull()
    )
    keys = ["usage_cohort", "satisfaction_segment", "academic_level", field]
    stats = _cohort_stats(with_cohorts(known), keys, minimum)
    # one row per cohort: at most 4 x 4 x 4 rows per field
    within = Window.partitionBy(field)
    compared = stats.withColumns(
        {
            "performance_rank": F.rank().over(within.orderBy(F.desc("avg_gpa"))),
            "field_cohorts": F.count(F.lit(1)).over(within),
            "balance_score": settled_round(F.col("avg_gpa") * 0.7 + F.col("avg_satisfaction") * 0.3, 3),
        }
    )
    in_top = F.col("performance_rank") <= F.ceil(F.col("field_cohorts") * 0.25)
    patterns = compared.groupBy("usage_cohort", "satisfaction_segment").agg(
        F.count_distinct(field).alias("fields_represented"),
        _rows().alias("total_cohorts"),
        settled_round(F.avg("avg_gpa"), 3).alias("overall_avg_gpa"),
        settled_round(F.avg("balance_score"), 3).alias("overall_balance_score"),
        share_where(in_top, 1).alias("success_rate"),
        settled_round(F.stddev("avg_gpa"), 3).alias("performance_consistency"),
    )
    rate, spread = F.col("success_rate"), F.col("performance_consistency")
    cohort, segment = F.col("usage_cohort"), F.col("satisfaction_segment")
    return patterns.withColumns(
        {
            "recommendation_level": classify(
                [
                    ((rate >= 75) & (spread <= 0.3), "Highly Recommended"),
                    ((rate >= 50) & (spread <= 0.5), "Recommended"),
                    (rate >= 25, "Conditionally Recommended"),
                ],
                "Not Recommended",
            ),
            "improvement_suggestion": classify(
                [
                    ((cohort == "Light Users") & segment.isin("Satisfied", "Highly Satisfied"), "Increase Usage Frequency"),
                    (cohort.isin("Power Users", "Regular Users") & (segment == "Dissatisfied"), "Improve Tool Selection"),
                    (rate < 25, "Comprehensive Support Needed"),
                ],
                "Maintain Current Approach",
            ),
        }
    ).orderBy(F.desc("overall_balance_score"))


def cohort_index(df: DataFrame, field: str = "field_of_study", minimum: int = 5) -> DataFrame:
    """Performance index and rank of (usage, satisfaction) cohorts within their field."""
    known = df.filter(F.col("usage_frequency_score").isNotNull() & F.col("satisfaction_level").isNotNull())
    keys = [field, "usage_cohort", "satisfaction_segment"]
    stats = _cohort_stats(with_cohorts(known, levels=False), keys, minimum)
    index = F.col("avg_gpa") * 0.7 + F.col("avg_attendance") * 4 * 0.3
    return stats.withColumns(
        {
            "performance_index": settled_round(index, 3),
            "performance_rank_in_field": F.rank().over(Window.partitionBy(field).orderBy(F.desc("avg_gpa"))).cast("long"),
        }
    ).orderBy(field, F.desc("performance_index"))


def period_changes(df: DataFrame, entity: str = "student_id", field: str = "field_of_study", period: str = "semester") -> DataFrame:
    """Change of measure, usage and satisfaction against the previous period, trend and trajectory."""
    known = F.col(period).isNotNull() & F.col("gpa").isNotNull() & F.col("usage_frequency_score").isNotNull()
    rows = df.filter(known).select(
        entity, field, period, "gpa", "usage_frequency_score", "satisfaction_level", "attendance_rate"
    )
    rows = neighbours(
        rows,
        entity,
        period,
        {"prev_gpa": "gpa", "prev_usage": "usage_frequency_score", "prev_satisfaction": "satisfaction_level"},
        {"next_gpa": "gpa"},
    )
    came, goes = F.col("gpa") - F.col("prev_gpa"), F.col("next_gpa") - F.col("gpa")
    trend = F.when(
        F.col("prev_gpa").isNotNull(), classify([(came > 0.2, "Improving"), (came < -0.2, "Declining")], "Stable")
    ).otherwise(P.FIRST_PERIOD)
    trajectory = classify(
        [
            ((came > 0) & (goes > 0), "Sustained Growth"),
            ((came > 0) & (goes <= 0), "Peak Performance"),
            ((came <= 0) & (goes > 0), "Recovery"),
            ((came <= 0) & (goes <= 0), "Continued Decline"),
        ]
    )
    return rows.withColumns(
        {
            "gpa_change": settled_round(came, 3),
            "usage_change": settled_round(F.col("usage_frequency_score") - F.col("prev_usage"), 2),
            "satisfaction_change": settled_round(F.col("satisfaction_level") - F.col("prev_satisfaction"), 2),
            "performance_trend": trend,
            "trajectory_pattern": trajectory,
        }
    )


def trend_stability(df: DataFrame, entity: str = "student_id", field: str = "field_of_study", period: str = "semester") -> DataFrame:
    """Per field, period and trend: mean changes, stability of the trend, and whether to intervene."""
    changes = period_changes(df, entity, field, period).filter(F.col("performance_trend") != P.FIRST_PERIOD)
    stats = changes.groupBy(field, period, "performance_trend").agg(
        _rows().alias("student_count"),
        settled_round(F.avg("gpa"), 3).alias("avg_gpa"),
        settled_round(F.avg("gpa_change"), 3).alias("avg_gpa_change"),
        settled_round(F.avg("usage_frequency_score"), 2).alias("avg_usage"),
        settled_round(F.avg("usage_change"), 2).alias("avg_usage_change"),
        settled_round(F.avg("satisfaction_level"), 2).alias("avg_satisfaction"),
        settled_round(F.stddev("gpa_change"), 3).alias("gpa_change_stddev"),
        share_where(F.abs("gpa_change") > 0.5, 1).alias("extreme_change_pct"),
    )
    spread, extreme, trend = F.col("gpa_change_stddev"), F.col("extreme_change_pct"), F.col("performance_trend")
    order = classify([(trend == "Improving", 1), (trend == "Stable", 2)], 3)
    return stats.withColumns(
        {
            "trend_stability": classify(
                [
                    ((spread <= 0.2) & (extreme <= 10), "Very Stable"),
                    ((spread <= 0.4) & (extreme <= 20), "Stable"),
                    ((spread <= 0.6) & (extreme <= 30), "Moderate Volatility"),
                ],
                "High Volatility",
            ),
            "intervention_recommendation": classify(
                [
                    ((trend == "Declining") & (extreme > 25), "Immediate Intervention"),
                    (trend == "Declining", "Monitor Closely"),
                    ((trend == "Stable") & (F.col("avg_gpa") < 2.5), "Support Needed"),
                ],
                "Continue Current Approach",
            ),
        }
    ).orderBy(field, period, order)


def trajectories(
    df: DataFrame, entity: str = "student_id", field: str = "field_of_study", period: str = "semester", minimum: int = 5
) -> DataFrame:
    """Shape of the path through three periods, and how usage and measure change together on it."""
    rows = period_changes(df, entity, field, period).filter(
        F.col("trajectory_pattern").isNotNull() & F.col("usage_change").isNotNull() & F.col("gpa_change").isNotNull()
    )
    dx, dy = F.col("usage_change"), F.col("gpa_change")
    cosine = F.try_divide(F.sum(dx * dy), F.sqrt(F.sum(dx * dx) * F.sum(dy * dy)))
    return (
        rows.groupBy(field, "trajectory_pattern")
        .agg(
            _rows().alias("pattern_count"),
            settled_round(F.avg("gpa"), 3).alias("avg_final_gpa"),
            settled_round(F.avg("usage_frequency_score"), 2).alias("avg_final_usage"),
            share_where(F.col("gpa") >= 3.5, 1).alias("high_performance_rate"),
            settled_round(cosine, 3).alias("usage_performance_cosine"),
            settled_round(safe_corr(dx, dy), 3).alias("usage_performance_correlation"),
        )
        .filter(F.col("pattern_count") >= minimum)
    )


def segments(df: DataFrame, field: str = "field_of_study") -> DataFrame:
    """Shares of measure and usage segments per field, and the effect of high usage."""
    gpa, usage = F.col("gpa"), F.col("usage_frequency_score")
    high, heavy, light = gpa >= 3.5, usage >= 4, usage < 2
    stats = (
        df.filter(gpa.isNotNull() & usage.isNotNull())
        .groupBy(field)
        .agg(
            _rows().alias("total_students"),
            share_where(high, 1).alias("high_gpa_pct"),
            share_where(gpa.between(2.5, 3.49), 1).alias("medium_gpa_pct"),
            share_where(gpa < 2.5, 1).alias("low_gpa_pct"),
            share_where(heavy, 1).alias("high_usage_pct"),
            share_where(usage.between(2, 3.99), 1).alias("medium_usage_pct"),
            share_where(light, 1).alias("low_usage_pct"),
            share_where(high & heavy, 1).alias("high_gpa_high_usage_pct"),
            share_where((gpa < 2.5) & heavy, 1).alias("low_gpa_high_usage_pct"),
            share_where((gpa < 2.5) & (F.col("attendance_rate") < 0.7), 1).alias("at_risk_pct"),
            share_where(high & heavy & (F.col("satisfaction_level") >= 4), 1).alias("star_performer_pct"),
            F.avg(F.when(heavy, gpa)).alias("__heavy"),
            F.avg(F.when(light, gpa)).alias("__light"),
        )
    )
    effect = F.when(F.col("__light") > 0, settled_round((F.col("__heavy") / F.col("__light") - 1) * 100, 1))
    return (
        stats.withColumns(
            {
                "gpa_difference_by_usage": settled_round(F.col("__heavy") - F.col("__light"), 3),
                "ai_effectiveness_index": effect,
            }
        )
        .drop("__heavy", "__light")
        .orderBy(F.col("ai_effectiveness_index").desc_nulls_last())
    )
