"""Mergeable group statistics: aggregated once at the finest grain, rolled up to any coarser one.

A measure's moments are its count, mean, sum of squared deviations, minimum and maximum. Moments of several groups merge without
their rows and without the loss of digits that sums of squares bring. So statistics on several grains cost one scan of the rows, and
rows get all of them in one join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.session import written

_PARTS = ("n", "mean", "m2", "low", "high")


def moments(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per key with ``<measure>__n``, ``__mean``, ``__m2``, ``__low`` and ``__high``, and ``rows``; NULL and NaN do not count."""
    out = []
    for m in measures:
        number = F.col(m).cast("double")
        v = F.when(~F.isnan(number), number)
        n = F.count(v)
        out += [c.alias(f"{m}__{p}") for p, c in zip(_PARTS, (n, F.avg(v), F.var_pop(v) * n, F.min(v), F.max(v)), strict=True)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *out)


def rolled_up(summary: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The moments of coarser groups from those of finer ones; ``summary`` has one row per fine group, so it is small."""
    whole = Window.partitionBy(*keys)
    means = {f"{m}__all": F.try_divide(F.sum(F.col(f"{m}__n") * F.col(f"{m}__mean")).over(whole), F.sum(f"{m}__n").over(whole)) for m in measures}
    rows = summary.withColumns(means)
    out = []
    for m in measures:
        n, apart = F.col(f"{m}__n"), F.col(f"{m}__mean") - F.col(f"{m}__all")
        merged = (F.sum(n), F.any_value(f"{m}__all"), F.sum(F.col(f"{m}__m2") + n * apart * apart), F.min(f"{m}__low"), F.max(f"{m}__high"))
        out += [c.alias(f"{m}__{p}") for p, c in zip(_PARTS, merged, strict=True)]
    return rows.groupBy(*keys).agg(F.sum("rows").alias("rows"), *out)


def mean_of(measure: str) -> Column:
    return F.col(f"{measure}__mean")


def deviation_of(measure: str) -> Column:
    """The sample standard deviation, exactly 0 for a constant measure, NULL below two values."""
    n = F.col(f"{measure}__n")
    constant = F.col(f"{measure}__low") == F.col(f"{measure}__high")
    return F.when((n > 1) & constant, 0.0).when(n > 1, F.sqrt(F.try_divide(F.col(f"{measure}__m2"), n - 1)))


def with_grain_stats(df: DataFrame, grains: Mapping[tuple[str, ...], Mapping[str, Column]], measures: Sequence[str]) -> DataFrame:
    """Rows with statistics of several nested grains; ``grains`` maps keys to output columns made of moments, finest grain first.

    Every further grain is a part of the finest one's keys. The finest summary is aggregated from the rows and written, the others are
    rolled up from it, and the rows meet all of them in one join. Groups named NULL are groups.
    """
    finest, *coarser = [list(k) for k in grains]
    base = written(moments(df, finest, measures))
    marks = {c: f"__k{i}" for i, c in enumerate(finest)}
    joined = base.select(F.struct(*[F.col(c).alias(marks[c]) for c in finest]).alias("__key"), *[c.alias(n) for n, c in grains[tuple(finest)].items()])
    for keys in coarser:
        stats = rolled_up(base, keys, measures)
        own = F.struct(*[F.col(c).alias(marks[c]) for c in keys]).alias("__part")
        stats = stats.select(own, *[c.alias(n) for n, c in grains[tuple(keys)].items()])
        part = F.struct(*[F.col(f"__key.{marks[c]}").alias(marks[c]) for c in keys])
        joined = joined.withColumn("__part", part).join(stats, "__part").drop("__part")
    keyed = df.withColumn("__key", F.struct(*[F.col(c).alias(marks[c]) for c in finest]))
    return keyed.join(written(joined), "__key").drop("__key")
