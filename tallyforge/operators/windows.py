"""Windows over the periods of one entity, and outliers within groups.

The period windows partition by entity and expect one row per (entity, period), so a window holds
at most as many rows as there are periods, however busy the entity is. ``one_row_per_period``
brings raw rows to that grain with a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyforge.functions.expr import classify, outside, spread, z_score
from tallyforge.operators.joins import with_group_stats
from tallyforge.operators.moments import deviation_of, mean_of, with_grain_stats


def one_row_per_period(df: DataFrame, entity: Sequence[str], period: str, aggs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*entity, period).agg(*[c.alias(n) for n, c in aggs.items()])


def by_period(entity: str, period: str) -> WindowSpec:
    return Window.partitionBy(entity).orderBy(period)


def neighbours(
    df: DataFrame, entity: str, period: str, previous: Mapping[str, str], following: Mapping[str, str] | None = None
) -> DataFrame:
    """``previous`` and ``following`` map an output name to the column taken from the neighbour period."""
    w = by_period(entity, period)
    out = {name: F.lag(c, 1).over(w) for name, c in previous.items()}
    out |= {name: F.lead(c, 1).over(w) for name, c in (following or {}).items()}
    return df.withColumns(out)


def moving_average(df: DataFrame, entity: str, period: str, value: str, preceding: int, output: str) -> DataFrame:
    w = by_period(entity, period).rowsBetween(-preceding, 0)
    return df.withColumn(output, F.avg(value).over(w))


def cumulative_average(df: DataFrame, entity: str, period: str, value: str, output: str) -> DataFrame:
    w = by_period(entity, period).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(output, F.avg(value).over(w))


def against_own_history(
    df: DataFrame, entity: str, period: str, value: str, best: str = "best", first: str = "first"
) -> DataFrame:
    """The entity's best and first value, on every one of its rows."""
    whole = by_period(entity, period).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({best: F.max(value).over(whole), first: F.first(value).over(whole)})


def period_bundle(df: DataFrame, entity: str, period: str, value: str) -> DataFrame:
    """Row number, rank and running total of an entity's periods: three functions, one sort."""
    w = by_period(entity, period)
    return df.withColumns(
        {"row_number": F.row_number().over(w), "rank": F.rank().over(w), "running_total": F.sum(value).over(w)}
    )


def group_outliers(df: DataFrame, group: Sequence[str], value: str, limit: float, z: str, flag: str) -> DataFrame:
    """z-score of ``value`` within its group and a flag for ``|z| > limit``.

    No spread in the group, or an unknown value, gives no z-score and no flag.
    """
    stats = {"__mean": F.avg(value), "__sd": spread(value)}
    scored = with_group_stats(df, group, stats).withColumn(z, z_score(value, "__mean", "__sd"))
    return scored.withColumn(flag, outside(F.col(z), limit)).drop("__mean", "__sd")


def typed_outliers(
    df: DataFrame,
    field: str = "field_of_study",
    level: str = "year_of_study",
    measure: str = "gpa",
    usage: str = "usage_frequency_score",
    measure_limit: float = 2.5,
    usage_limit: float = 2.0,
) -> DataFrame:
    """Rows that stand out by measure within the field, by usage within (field, level), or by both."""
    grains = {
        (field, level): {"avg_usage_frequency": mean_of(usage), "__sd": deviation_of(usage)},
        (field,): {"field_avg_gpa": mean_of(measure), "field_stddev_gpa": deviation_of(measure)},
    }
    out = with_grain_stats(df, grains, [measure, usage])
    out = out.withColumns(
        {
            "gpa_z_score": z_score(measure, "field_avg_gpa", "field_stddev_gpa"),
            "usage_z_score": z_score(usage, "avg_usage_frequency", "__sd"),
        }
    ).withColumns(
        {
            "is_gpa_outlier": outside(F.col("gpa_z_score"), measure_limit),
            "is_usage_outlier": outside(F.col("usage_z_score"), usage_limit),
        }
    )
    kind = classify(
        [
            (F.col("is_gpa_outlier") & F.col("is_usage_outlier"), "Both"),
            (F.col("is_gpa_outlier"), "GPA"),
            (F.col("is_usage_outlier"), "Usage"),
        ],
        "None",
    )
    return out.withColumn("outlier_type", kind).filter(F.col("outlier_type") != "None").drop("__sd")
