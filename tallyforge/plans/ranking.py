"""Rank, trend, distribution and correlation analyses over (student, term) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import presets as P
from tallyforge.functions.expr import band, classify, row_stddev, safe_corr, settled_round, slope, varies, weighted_score
from tallyforge.operators.joins import measured
from tallyforge.operators.ranking import percent_rank_of, tile_of, value_distribution
from tallyforge.operators.windows import against_own_history, by_period, cumulative_average, moving_average, neighbours


def _mean(total: str, n: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(n))


def category_order(column: str, labels: list[str]) -> Column:
    """Sort key for a fixed order of labels; unknown labels come last."""
    return classify([(F.col(column) == label, i) for i, label in enumerate(labels)], len(labels))


def rank_tiers(
    df: DataFrame,
    field: str = "field_of_study",
    measure: str = "gpa",
    usage: str = "usage_frequency_score",
    satisfaction: str = "satisfaction_level",
) -> DataFrame:
    """Students by tier of their percent rank within the field, with usage and satisfaction per tier.

    Works on distinct measure values with their counts; rows are never ranked one by one.
    """
    product = F.col(usage) * F.col(satisfaction)
    sums = {"usage": F.col(usage), "satisfaction": F.col(satisfaction), "product": product}
    aggs = {f"{n}_sum": F.sum(c) for n, c in sums.items()} | {f"{n}_n": F.count(c) for n, c in sums.items()}
    values = value_distribution(df.filter(F.col(measure).isNotNull()), [field], measure, aggs)
    tier = band(percent_rank_of(F.col("below"), F.col("total")), P.RANK_TIERS, P.RANK_TIER_DEFAULT)
    labels = [label for _, label in P.RANK_TIERS]
    return (
        values.groupBy(field, tier.alias("performance_tier"))
        .agg(
            F.sum("n").alias("student_count"),
            settled_round(F.try_divide(F.sum(F.col("n") * F.col(measure)), F.sum("n")), 3).alias("avg_gpa"),
            settled_round(_mean("usage_sum", "usage_n"), 2).alias("avg_ai_usage"),
            settled_round(_mean("satisfaction_sum", "satisfaction_n"), 2).alias("avg_satisfaction"),
            settled_round(_mean("product_sum", "product_n"), 2).alias("ai_engagement_score"),
        )
        .orderBy(field, category_order("performance_tier", labels))
    )


def with_trend(df: DataFrame, entity: str = "student_id", period: str = "semester", measure: str = "gpa") -> DataFrame:
    """Previous and next value, change, own averages and a five-step trend of every period row."""
    rows = neighbours(df, entity, period, {"previous_gpa": measure}, {"next_gpa": measure})
    rows = cumulative_average(rows, entity, period, measure, "cumulative_gpa")
    # the frame covers all periods, so it shares the sort of the windows before it
    whole = by_period(entity, period).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    change = F.col(measure) - F.col("previous_gpa")
    trend = F.when(
        F.col("previous_gpa").isNotNull(),
        classify([(change > step, label) for step, label in P.TREND_STEPS], P.TREND_DEFAULT),
    ).otherwise(P.FIRST_PERIOD)
    return rows.withColumns(
        {
            "student_avg_gpa": F.avg(measure).over(whole),
            "gpa_change": settled_round(change, 3),
            "performance_trend": trend,
        }
    )


def period_trend(df: DataFrame, entity: str = "student_id", period: str = "semester", measure: str = "gpa") -> DataFrame:
    rows = with_trend(df.filter(F.col(period).isNotNull() & F.col(measure).isNotNull()), entity, period, measure)
    labels = [label for _, label in P.TREND_STEPS] + [P.TREND_DEFAULT]
    return (
        rows.filter(F.col("performance_trend") != P.FIRST_PERIOD)
        .groupBy(period, "performance_trend")
        .agg(
            F.count(F.lit(1)).alias("student_count"),
            settled_round(F.avg(measure), 3).alias("avg_current_gpa"),
            settled_round(F.avg("previous_gpa"), 3).alias("avg_previous_gpa"),
            settled_round(F.avg("gpa_change"), 3).alias("avg_gpa_change"),
            settled_round(F.avg("attendance_rate"), 3).alias("avg_attendance"),
            settled_round(F.avg("assignment_submission_rate"), 3).alias("avg_submission_rate"),
        )
        .orderBy(period, category_order("performance_trend", labels))
    )


def moving_statistics(
    df: DataFrame, entity: str = "student_id", field: str = "field_of_study", period: str = "semester", measure: str = "gpa"
) -> DataFrame:
    """Three-period and cumulative averages, and each value against the entity's best and first one."""
    rows = df.filter(F.col(period).isNotNull() & F.col(measure).isNotNull()).select(entity, field, period, measure)
    rows = moving_average(rows, entity, period, measure, 2, "__ma")
    rows = cumulative_average(rows, entity, period, measure, "__ca")
    rows = against_own_history(rows, entity, period, measure, "__best", "__first")
    return rows.select(
        entity,
        field,
        period,
        measure,
        settled_round(F.col("__ma"), 3).alias("moving_avg_3_semesters"),
        settled_round(F.col("__ca"), 3).alias("cumulative_avg_gpa"),
        settled_round(F.try_divide(measure, "__best"), 3).alias("performance_vs_best"),
        settled_round(F.col(measure) - F.col("__first"), 3).alias("improvement_from_first_semester"),
    )


def tile_distribution(df: DataFrame, field: str = "field_of_study", measure: str = "gpa", tiles: int = 4) -> DataFrame:
    """Statistics per ntile of the measure within the field.

    A tile is an interval of positions, and a distinct value covers the positions
    ``below + 1 .. below + n``; the rows of a value are split over the tiles it touches.
    """
    d = value_distribution(df.filter(F.col(measure).isNotNull()), [field], measure, center="__center")
    first, last = F.col("below") + 1, F.col("below") + F.col("n")
    total = F.col("total")
    d = d.withColumn("tile", F.explode(F.sequence(tile_of(first, total, tiles), tile_of(last, total, tiles))))
    small, extra, tile = F.floor(total / tiles), total % tiles, F.col("tile")
    start = (tile - 1) * small + F.least(tile - 1, extra) + 1
    end = tile * small + F.least(tile, extra)
    d = d.withColumn("rows", F.least(end, last) - F.greatest(start, first) + 1)
    # deviations from the field's mean keep the squares small
    off, n = F.col(measure) - F.col("__center"), F.sum("rows")
    moved, squared = F.sum(F.col("rows") * off), F.sum(F.col("rows") * off * off)
    variance = F.greatest(F.try_divide(squared - moved * moved / n, n - 1), F.lit(0.0))
    rank = percent_rank_of(F.col("below"), total)
    output = "gpa_quartile" if tiles == 4 else "tile"
    return (
        d.groupBy(field, F.col("tile").alias(output))
        .agg(
            n.alias("student_count"),
            settled_round(F.min(measure), 3).alias("min_gpa"),
            settled_round(F.max(measure), 3).alias("max_gpa"),
            settled_round(F.sum(F.col("rows") * F.col(measure)) / n, 3).alias("avg_gpa"),
            settled_round(F.when(varies(measure), F.sqrt(variance)).when(n > 1, 0.0), 3).alias("stddev_gpa"),
            settled_round(F.min(rank), 3).alias("min_percentile"),
            settled_round(F.max(rank), 3).alias("max_percentile"),
        )
        .orderBy(field, output)
    )


def group_correlation(
    df: DataFrame,
    field: str = "field_of_study",
    measure: str = "gpa",
    usage: str = "usage_frequency_score",
    satisfaction: str = "satisfaction_level",
) -> DataFrame:
    """Per field: correlations with the measure, slope, R², strength and a rough significance."""
    known = df.filter(F.col(measure).isNotNull() & F.col(usage).isNotNull() & F.col(satisfaction).isNotNull())
    r = safe_corr(measure, usage)
    stats = known.groupBy(field).agg(
        F.count(F.lit(1)).alias("sample_size"),
        settled_round(r, 4).alias("gpa_usage_correlation"),
        settled_round(safe_corr(measure, satisfaction), 4).alias("gpa_satisfaction_correlation"),
        settled_round(slope(measure, usage), 4).alias("gpa_usage_slope"),
        settled_round(F.pow(r, F.lit(2.0)), 4).alias("r_squared_gpa_usage"),
    )
    strength = F.abs("gpa_usage_correlation")
    n = F.col("sample_size")
    likely = ((n >= 30) & (strength >= 0.3)) | ((n >= 100) & (strength >= 0.2))
    return stats.withColumns(
        {
            "correlation_strength": band(strength, P.CORRELATION_STRENGTH, P.CORRELATION_STRENGTH_DEFAULT),
            "significance_estimate": F.when(likely, "Likely Significant").otherwise("Not Significant"),
        }
    ).orderBy(strength.desc_nulls_last(), field)


def multi_criteria_rank(
    df: DataFrame, entity: str = "student_id", field: str = "field_of_study", top: int = 20, extra_keys: tuple[str, ...] = ()
) -> DataFrame:
    """The ``top`` ranks per field by a composite score, with the rank by each criterion and their spread.

    The composite is cut to its ``top`` ranks on distinct scores first. Only for those rows the
    other ranks are looked up, in the value distributions of the criteria.
    """
    criteria = {
        "gpa_rank": "gpa",
        "usage_rank": "usage_frequency_score",
        "satisfaction_rank": "satisfaction_level",
        "attendance_rank": "attendance_rate",
    }
    known = F.col("gpa").isNotNull() & F.col("usage_frequency_score").isNotNull() & F.col("attendance_rate").isNotNull()
    keys = [entity, *extra_keys]
    rows = df.filter(known).withColumn("composite_score", settled_round(weighted_score(P.COMPOSITE_PARTS), 3))
    rows = rows.select(*keys, field, "composite_score", *criteria.values())

    scores = rows.groupBy(field, "composite_score").agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(field).orderBy(F.col("composite_score").desc_nulls_first())
    scores = scores.withColumn("__pos", F.row_number().over(order)).filter(F.col("__pos") <= top)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    scores = scores.withColumn("overall_rank", F.coalesce(F.sum("__n").over(before), F.lit(0)) + 1)
    best = measured(scores.filter(F.col("overall_rank") <= top).select(field, "composite_score", "overall_rank"))
    best_rows = measured(rows.join(best, [field, "composite_score"]))

    # all criteria in long form share one value distribution; an unknown value ranks last
    pairs = [
        F.struct(F.lit(name).alias("criterion"), F.coalesce(F.col(c).cast("double"), F.lit(-1.2e308)).alias("value"))
        for name, c in criteria.items()
    ]
    long = F.explode(F.array(*pairs)).alias("p")
    ranks = value_distribution(rows.select(field, long).select(field, "p.*"), [field, "criterion"], "value")
    ranks = ranks.select(field, "criterion", "value", (F.col("total") - F.col("below") - F.col("n") + 1).alias("rank"))
    best_keys = [field, *keys, "overall_rank", "composite_score"]
    out = (
        best_rows.select(*best_keys, long)
        .select(*best_keys, "p.*")
        .join(ranks, [field, "criterion", "value"])
        .groupBy(*best_keys)
        .agg(*[F.max(F.when(F.col("criterion") == name, F.col("rank"))).alias(name) for name in criteria])
    )
    spread = F.col("rank_volatility")
    kind = classify(
        [
            ((spread <= 5) & (F.col("overall_rank") <= 10), "Consistent Top Performer"),
            (spread <= 3, "Balanced Performer"),
            (spread > 10, "Inconsistent Performer"),
        ],
        "Average Performer",
    )
    return (
        out.withColumn("rank_volatility", settled_round(row_stddev(list(criteria)), 2))
        .withColumn("performance_type", kind)
        .select(field, *keys, "overall_rank", "composite_score", *criteria, "rank_volatility", "performance_type")
    )
