"""Stored sketches per period and group: percentiles and distinct counts of any range of periods without reading its rows again.

Each load reduces its rows to one line per (period, group) with counts, sums, a KLL sketch of the measure and an HLL sketch of the
actors, and writes its own folder, so a repeated load replaces itself. Lines of different loads and periods merge in any order. A
sketch has a fixed size whatever it stands for; up to ``k`` values the percentiles are exact, beyond that their rank is off by
``rank_error(k)`` at most with 99 % confidence.

With ``exact`` a load also writes its counted values and its distinct actors per period and group. They grow with the distinct values,
and ``exactly`` has from them what a query over the rows would say: percentiles from summed counts, actors counted once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.ranking import quantiles
from tallyforge.streaming.ledger import replace_batch


def rank_error(k: int) -> float:
    """The published bound of a KLL sketch: how far the rank of an estimated percentile may be from the asked one, as a share."""
    return 2.296 / k**0.9021


@dataclass(frozen=True)
class Rollup:
    """What is kept: ``measure`` and ``actor`` of every (``period``, ``groups``)."""

    path: str
    groups: Sequence[str]
    measure: str
    actor: str
    k: int = 800
    lg_k: int = 14
    exact: bool = False

    def _value(self) -> Column:
        number = F.col(self.measure).cast("double")
        return F.when(~F.isnan(number), number)

    def summary(self, df: DataFrame, period: Column) -> DataFrame:
        """One line per (period, group). NULL and NaN measures count as rows without a value; a NULL group is a group."""
        value = self._value()
        return df.groupBy(period.alias("period"), *self.groups).agg(
            F.count(F.lit(1)).alias("n"),
            F.count(value).alias("n_values"),
            F.sum(value).alias("total"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.kll_sketch_agg_double(value, F.lit(self.k)).alias("values"),
            F.hll_sketch_agg(self.actor, F.lit(self.lg_k)).alias("actors"),
        )

    def load(self, df: DataFrame, period: Column, batch: int) -> None:
        """Add the rows of one load; running it again under the same number replaces it."""
        if self.exact:
            keys = [period.alias("period"), *self.groups]
            counted = df.groupBy(*keys, self._value().alias("value")).agg(F.count(F.lit(1)).alias("n")).filter("value IS NOT NULL")
            replace_batch(counted, f"{self.path}-values", batch)
            actors = df.filter(F.col(self.actor).isNotNull()).select(*keys, F.col(self.actor).alias("actor")).distinct()
            replace_batch(actors, f"{self.path}-actors", batch)
        # the lines come last: what they count is stored by then
        replace_batch(self.summary(df, period), self.path, batch)

    def stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch")

    def merged(self, lines: DataFrame, by: Sequence[str | Column], percentiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
        """Totals, percentiles (p50, p90, ...) and distinct actors of the given lines by any coarser key."""
        both = lines.groupBy(*by).agg(
            *self._totals(),
            F.kll_merge_agg_double("values").alias("values"),
            F.hll_union_agg("actors").alias("actors"),
        )
        names = dict(zip(_names(percentiles), percentiles))
        asked = {name: F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("values", F.lit(float(p)))) for name, p in names.items()}
        return both.withColumns(asked | {"distinct_actors": F.hll_sketch_estimate("actors")}).drop("values", "actors")

    def _totals(self) -> list[Column]:
        return [
            F.sum("n").alias("n"),
            F.sum("n_values").alias("n_values"),
            F.try_divide(F.sum("total"), F.sum("n_values")).alias("mean"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        ]

    def exactly(
        self, spark: SparkSession, by: Mapping[str, Column], percentiles: Sequence[float] = (0.5, 0.9), where: Column | None = None
    ) -> DataFrame:
        """The columns of ``merged`` without any error, from what ``exact`` loads stored.

        ``by`` names coarser keys, ``where`` selects periods and groups. Counts are summed over ranges of values, so a group of any
        size is in no single task.
        """
        keys = [key.alias(name) for name, key in by.items()]

        def part(suffix: str, *columns: str) -> DataFrame:
            rows = spark.read.parquet(f"{self.path}{suffix}").drop("batch")
            return (rows if where is None else rows.filter(where)).select(*keys, *columns)

        def keyed(df: DataFrame) -> DataFrame:
            # one struct column, so that groups with a NULL name join like any other
            return df.withColumn("__key", F.struct(*by)).drop(*by)

        totals = part("", "n", "n_values", "total", "low", "high").groupBy(*by).agg(*self._totals())
        actors = part("-actors", "actor").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("distinct_actors"))
        values = quantiles(part("-values", "value", "n"), list(by), "value", percentiles, weight="n")
        found = values.select(*by, *[F.col("quantiles")[i].alias(name) for i, name in enumerate(_names(percentiles))])
        out = totals.withColumn("__key", F.struct(*by))
        for side in (found, actors):
            out = out.join(keyed(side), "__key", "left")
        return out.withColumn("distinct_actors", F.coalesce("distinct_actors", F.lit(0))).drop("__key")


def _names(percentiles: Sequence[float]) -> list[str]:
    return [f"p{100 * p:g}".replace(".", "_") for p in percentiles]
