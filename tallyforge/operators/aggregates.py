"""Group summaries used by several analyses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import presets as P
from tallyforge.functions.expr import pct, safe_corr, score_map
from tallyforge.operators.joins import with_total_stats
from tallyforge.operators.ranking import rank_rows, with_quantiles


def share_of_total(df: DataFrame, group: Sequence[str], digits: int = 2, n: str = "n", share: str = "percentage") -> DataFrame:
    """Rows per group and their percentage of all rows (of the enclosing groups: see ``share_within``)."""
    return share_within(df, group, (), digits, n, share)


def share_within(
    df: DataFrame, group: Sequence[str], outer: Sequence[str], digits: int = 2, n: str = "n", share: str = "percentage"
) -> DataFrame:
    """Rows per group and their percentage of the rows of the ``outer`` group; the window sees groups, not rows."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias(n))
    if not outer:
        # a window over everything would gather all groups in one task
        whole = with_total_stats(counts, {"__all": F.sum(n)})
        return whole.withColumn(share, pct(F.col(n), F.col("__all"), digits)).drop("__all")
    return counts.withColumn(share, pct(F.col(n), F.sum(n).over(Window.partitionBy(*outer)), digits))


def enrollment_summary(df: DataFrame, key: Sequence[str] = ("student_id", "semester"), repeats: bool = True) -> DataFrame:
    """Per student and term: courses, credits, grade points, the courses and departments, and their diversity.

    The lists are sorted. With ``repeats`` a course taken n times is listed n times; without it
    once, which bounds the list by the course catalogue, so that a key with very many rows shrinks
    in the partial aggregate.
    """
    points = score_map("grade", P.GRADE_POINTS, P.GRADE_POINTS_DEFAULT)
    if not repeats:
        return df.groupBy(*key).agg(
            F.count("course_code").alias("total_courses"),
            F.sum("credit_hours").alias("total_credits"),
            F.avg(points).alias("calculated_gpa"),
            F.sort_array(F.collect_set("course_name")).alias("courses_taken"),
            F.sort_array(F.collect_set("department")).alias("departments"),
            F.size(F.collect_set("department")).alias("academic_diversity"),
        )
    # counted per course first: a key's lists are made of its distinct courses. Rows are dealt by the key before they are counted:
    # a course seldom repeats, so counts before the shuffle would hold nearly all rows beside the sorts of the joins in front
    courses = df.repartition(*key).groupBy(*key, "course_name", "department").agg(
        F.count(F.lit(1)).alias("__rows"),
        F.count("course_code").alias("__courses"),
        F.sum("credit_hours").alias("__credits"),
        F.sum(points).alias("__points"),
    )

    def listed(column: str) -> Column:
        pairs = F.collect_list(F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("v"), F.col("__rows").alias("n"))))
        return F.flatten(F.transform(F.sort_array(pairs), lambda p: F.array_repeat(p["v"], p["n"].cast("int"))))

    return courses.groupBy(*key).agg(
        F.sum("__courses").alias("total_courses"),
        F.sum("__credits").alias("total_credits"),
        (F.sum("__points") / F.sum("__rows")).alias("calculated_gpa"),
        listed("course_name").alias("courses_taken"),
        listed("department").alias("departments"),
        F.size(F.collect_set("department")).alias("academic_diversity"),
    )


def insight_summary(df: DataFrame, group: Sequence[str] = P.INSIGHT_GROUP, minimum: int = 5, preset: P.Insight = P.STUDENT_INSIGHT) -> DataFrame:
    """Means, correlations and the range of one measure per group of at least ``minimum`` rows."""
    spread = {f"{preset.spread}_stddev": F.stddev, f"min_{preset.spread}": F.min, f"max_{preset.spread}": F.max}
    measures = [F.count(preset.entity).alias(preset.count)]
    measures += [F.avg(column).alias(name) for name, column in preset.means.items()]
    measures += [safe_corr(x, y).alias(name) for name, (x, y) in preset.correlations.items()]
    measures += [f(preset.spread).alias(name) for name, f in spread.items()]
    return df.groupBy(*group).agg(*measures).filter(F.col(preset.count) >= minimum)


def school_summary(df: DataFrame, school: str = "school_id", entity: str = "student_id") -> DataFrame:
    """Per school: size, mean scores, spread and how the score tiers are filled.

    The mean that ranks schools is that of exact decimals (ten places), so schools with the same scores tie however their rows
    were spread over tasks.
    """
    tier = F.col("performance_tier")
    return df.groupBy(school).agg(
        F.count(entity).alias("total_students"),
        F.try_divide(F.sum(F.col("average_score").cast("decimal(20,10)")).cast("double"), F.count("average_score")).alias("avg_school_score"),
        F.stddev("average_score").alias("score_stddev"),
        F.avg("math_score").alias("avg_math"),
        F.avg("reading_score").alias("avg_reading"),
        F.avg("writing_score").alias("avg_writing"),
        # a flag per known tier: no set, so the aggregate stays on plain rows
        reduce(Column.__add__, [F.max(F.when(tier == t, 1).otherwise(0)) for t in P.SCORE_TIER_NAMES]).alias("performance_diversity"),
        F.count_if(tier == "Excellent").alias("excellent_count"),
        F.count_if(tier == P.SCORE_TIER_DEFAULT).alias("poor_count"),
    )


def box_plot(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact five-number summary per group."""
    counts = df.groupBy(group).agg(F.count(value).alias("n"))
    five = with_quantiles(counts, df, [group], value, [0.0, 0.25, 0.5, 0.75, 1.0], "q")
    names = ["min_value", "q1", "median", "q3", "max_value"]
    return five.select(group, "n", *[F.col("q")[i].alias(name) for i, name in enumerate(names)])


def grid_counts(df: DataFrame, x: Column, y: Column, x_name: str, y_name: str) -> DataFrame:
    """Counts of a two-dimensional grid, in long form."""
    return df.groupBy(x.alias(x_name), y.alias(y_name)).agg(F.count(F.lit(1)).alias("n"))


def pivot_counts(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts with one output column per listed value; one aggregate, no extra pass for the values."""
    cells = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return df.groupBy(row).agg(*cells)


def activity_rollup(df: DataFrame, time: str, unit: str, group: Sequence[str], value: str) -> DataFrame:
    """Events per hour or day and group: count and mean value."""
    return df.groupBy(F.date_trunc(unit, time).alias("period"), *group).agg(
        F.count(F.lit(1)).alias("n_events"), F.avg(value).alias("avg_value")
    )


def list_segments(df: DataFrame, keys: Sequence[str], order: str, item: str, unique: str, size: int = 1000) -> DataFrame:
    """(keys, part, first, items): each key's items in order, in parts of ``size``.

    A plain list of a key that holds much of the data is one huge row in one task. Here rows get their number within the key from
    the rank engine, which spreads a hot key over tasks, and every part is a row of bounded length; ``first`` is the number of its first
    item. ``unique`` breaks ties and is unique in its key; NULL items stay in the list.
    """
    rows = df.select(*keys, order, *[c for c in dict.fromkeys((item, unique)) if c not in (*keys, order)])
    numbered = rank_rows(rows, list(keys), order, unique, row_number="__rn")
    part = F.floor((F.col("__rn") - 1) / size)
    lists = numbered.groupBy(*keys, part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("__rn", F.col(item).alias("item")))).alias("__items"))
    return lists.select(*keys, "part", (F.col("part") * size + 1).alias("first"), F.transform("__items", lambda x: x["item"]).alias("items"))


def set_segments(df: DataFrame, keys: Sequence[str], item: str, size: int = 1000) -> DataFrame:
    """(keys, part, first, items): each key's distinct items in their own order, NULL left out, in parts of ``size``.

    Repetitions collapse in a hash aggregate before anything is put into a list.
    """
    once = df.filter(F.col(item).isNotNull()).select(*keys, item).distinct()
    return list_segments(once, keys, item, item, item, size)
