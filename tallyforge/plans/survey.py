"""Survey summaries and the datasets behind dashboard charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import presets as P
from tallyforge.functions.expr import band, bin_floor, pct, safe_corr, settled_round, split_list
from tallyforge.operators.aggregates import box_plot, grid_counts, share_of_total, share_within
from tallyforge.operators.joins import with_total_stats


def _rows() -> Column:
    return F.count(F.lit(1))


def overview(df: DataFrame, columns: Sequence[str] = ("stream", "year_of_study", "preferred_ai_tool")) -> DataFrame:
    """Row count and exact distinct counts of a few columns, in one query."""
    return df.agg(_rows().alias("total_records"), *[F.count_distinct(c).alias(f"unique_{c}") for c in columns])


def mean_summary(
    df: DataFrame, group: Sequence[str], means: Sequence[str], minimum: int = 1, digits: int = 2, n: str = "n"
) -> DataFrame:
    """Rows and means per group, for groups with at least ``minimum`` rows."""
    stats = df.groupBy(*group).agg(_rows().alias(n), *[settled_round(F.avg(m), digits).alias(f"avg_{m}") for m in means])
    return stats.filter(F.col(n) >= minimum)


def stream_share(df: DataFrame) -> DataFrame:
    return share_of_total(df, ["stream"], 2, "student_count").orderBy(F.desc("student_count"))


def trust_by_stream(df: DataFrame, minimum: int = 10) -> DataFrame:
    trust = "trust_in_ai_tools"
    stats = df.groupBy("stream").agg(
        _rows().alias("student_count"),
        settled_round(F.avg(trust), 2).alias("avg_trust"),
        F.min(trust).alias("min_trust"),
        F.max(trust).alias("max_trust"),
    )
    return stats.filter(F.col("student_count") >= minimum).orderBy(F.desc("avg_trust"))


def usage_level() -> Column:
    return band("daily_usage_hours", P.USAGE_HOURS, P.USAGE_HOURS_DEFAULT, below=True)


def usage_bands(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("daily_usage_hours").isNotNull())
        .groupBy(usage_level().alias("usage_category"))
        .agg(
            _rows().alias("user_count"),
            settled_round(F.avg("trust_in_ai_tools"), 2).alias("avg_trust"),
            settled_round(F.avg("impact_on_grades"), 2).alias("avg_grade_impact"),
        )
    )


# --- dashboard datasets --------------------------------------------------------------------------


def tool_share(df: DataFrame, tools: str = "ai_tools_used", sep: str = ",") -> DataFrame:
    """Mentions of each tool in a delimited list and their share of all mentions."""
    mentions = df.select(F.explode(split_list(tools, sep)).alias("tool")).select(F.trim("tool").alias("tool"))
    return share_of_total(mentions, ["tool"], 2, "mentions").orderBy(F.desc("mentions"))


def histogram(df: DataFrame, value: str, width: float, origin: float = 0.0) -> DataFrame:
    return df.groupBy(bin_floor(value, width, origin).alias("bin_from")).agg(_rows().alias("n"))


def scatter_with_correlation(df: DataFrame, x: str, y: str, columns: Sequence[str]) -> DataFrame:
    """Every point, with the overall correlation beside it."""
    return with_total_stats(df.select(*columns), {"correlation": settled_round(safe_corr(x, y), 4)})


def heatmap(df: DataFrame, x: str, x_width: float, y: str, y_width: float) -> DataFrame:
    return grid_counts(df, bin_floor(x, x_width), bin_floor(y, y_width), f"{x}_from", f"{y}_from")


def box(df: DataFrame, group: str, value: str) -> DataFrame:
    return box_plot(df, group, value)


def group_share_grid(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of (row, column) with the percentage within the row."""
    return share_within(df, [row, column], [row], 2, "n", "pct_of_row")


def breaches(df: DataFrame, metric: str, limit: float, above: bool = True) -> DataFrame:
    """Rows of a summary whose metric crosses a limit."""
    return df.filter(F.col(metric) > limit if above else F.col(metric) < limit)


def top_correlations(insights: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Groups with the strongest correlation, by absolute value."""
    return insights.orderBy(F.abs(column).desc_nulls_last(), *insights.columns[:3]).limit(n)


def top_outliers(outliers: DataFrame, z: str, key: Sequence[str], n: int = 10) -> DataFrame:
    return outliers.orderBy(F.abs(z).desc_nulls_last(), *key).limit(n)


def outlier_share(outliers: DataFrame, total: DataFrame) -> DataFrame:
    """Outliers by type and their percentage of all rows."""
    rows = total.agg(_rows()).scalar()
    kinds = outliers.groupBy("outlier_type").agg(_rows().alias("n")).withColumn("__rows", rows)
    return kinds.select("outlier_type", "n", pct(F.col("n"), F.col("__rows"), 2).alias("pct"))
