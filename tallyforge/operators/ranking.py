"""Ranks over groups of any size.

``rank() over (partition by field order by score)`` sends a whole field to one task. With a few
fields and billions of rows that task never finishes, so the operators here let Spark's range
exchange sort all rows at once:

1. Rows are exchanged by ranges of (group, value, key), sorted, numbered and written. The exchange
   compares the columns themselves, whatever their type, and a group, a value or a common beginning of
   strings that holds much of the data spreads over as many partitions as it fills.
2. Rows are counted per (partition, group); running totals over a group's partitions, one row each,
   say how many rows lie in front. A row number is that plus the row's place in its partition.
3. Rows of one value form a run in their partition. Ranks, ties and running sums are worked out once per
   run; only a partition's first and last value can go on in another one, and these few are put together.

The driver sees the exchange's sample and nothing else. Groups that are bounded by nature (the periods of one
entity) do not need this; see ``windows``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.session import written

_VALUE, _AT, _PART, _CELL, _RUN = "__value", "__at", "__part", "__cell", "__run"


def _comparable(value: Column, kind: T.DataType) -> Column:
    """Both zeros are one value, as in grouping and in comparisons."""
    return value + F.lit(0.0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def _laid_out(df: DataFrame, group: Sequence[str], order: Sequence[Column], ranges: int | None) -> DataFrame:
    """``df`` sorted over all partitions and written, with the partition and a place that grows along it.

    Without ``ranges`` there are as many partitions as Spark's shuffles have.
    """
    by = [*[F.col(g).asc_nulls_first() for g in group], *order]
    if not by:
        by = [F.lit(0)]
    spread = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    placed = spread.sortWithinPartitions(*by).withColumn(_AT, F.monotonically_increasing_id())
    return written(placed.withColumn(_PART, F.shiftright(_AT, 33)))


def _cell(group: Sequence[str]) -> Column:
    # one struct column, so that groups with a NULL name join like any other
    return F.struct(F.col(_PART), *[F.col(g).alias(f"g{i}") for i, g in enumerate(group)])


def _with_front(cells: DataFrame, group: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Cells (partition, group) with ``__before_x`` and ``__all_x`` of their group for each total x."""
    own = [F.col(f"{_CELL}.g{i}") for i in range(len(group))]
    whole = Window.partitionBy(*own)
    before = whole.orderBy(F.col(f"{_CELL}.{_PART}")).rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"__before_{x}": F.coalesce(F.sum(x).over(before), F.lit(0)) for x in totals}
    return cells.withColumns(sums | {f"__all_{x}": F.sum(x).over(whole) for x in totals})


def _runs(placed: DataFrame, group: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """One row per (partition, group, value): how many rows, their sums, and the first one's place."""
    rows = placed.select(_cell(group).alias(_CELL), F.col(_VALUE), _AT, *[F.col(c).alias(f"of_{n}") for n, c in sums.items()])
    totals = [F.coalesce(F.sum(f"of_{n}"), F.lit(0)).alias(f"sum_{n}") for n in sums]
    return rows.groupBy(_CELL, _VALUE).agg(F.count(F.lit(1)).alias("n"), F.min(_AT).alias("first"), *totals)


def _spanning(cells: DataFrame, group: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """The runs that go on over partitions, by (group, value): where they start, how many rows, sums up to their end."""
    ends = F.explode(F.array_distinct(F.array("head", "tail"))).alias("e")
    own = F.struct(*[F.col(f"{_CELL}.g{i}").alias(f"g{i}") for i in range(len(group))], F.col(f"e.{_VALUE}").alias(_VALUE))
    start = F.col("__before_n") + F.col("e.first") - F.col("__begin")
    # the sums up to the end of the part of the run that lies in this partition
    upto = [(F.col(f"__before_{x}") + F.when(F.col("e.first") == F.col("__begin"), F.col(f"e.{x}")).otherwise(F.col(x))).alias(x) for x in totals]
    parts = cells.select("*", ends).select(own.alias(_RUN), start.alias("start"), F.col("e.n").alias("own_n"), F.col(f"{_CELL}.{_PART}").alias("p"), *upto)
    sums = [F.max_by(x, "p").alias(f"span_{x}") for x in totals]
    return parts.groupBy(_RUN).agg(F.min("start").alias("span_start"), F.sum("own_n").alias("span_rows"), F.count("*").alias("c"), *sums).filter("c > 1").drop("c")


def rank_rows(
    df: DataFrame,
    group: Sequence[str],
    value: str | Column,
    key: str,
    ascending: bool = True,
    row_number: str | None = None,
    rank: str | None = None,
    percent_rank: str | None = None,
    ties: str | None = None,
    group_size: str | None = None,
    relative_position: str | None = None,
    ntile: Mapping[str, int] | None = None,
    running_sum: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add rank columns of ``value`` within ``group``; ``key`` (unique in its group) breaks ties.

    Each output is produced only if named. ``ties`` is the number of rows that share the value. ``ntile`` maps output name to number of tiles,
    ``running_sum`` maps output name to the summed column (NULL counts as 0); like Spark's default
    frame, rows with equal ``value`` share the running sum. ``df`` is written once, so give it the columns that are needed.
    """
    value = F.col(value) if isinstance(value, str) else value
    running_sum = dict(running_sum or {})
    valued = df.withColumn(_VALUE, value)
    valued = valued.withColumn(_VALUE, _comparable(F.col(_VALUE), valued.schema[_VALUE].dataType))
    order = F.col(_VALUE).asc_nulls_first() if ascending else F.col(_VALUE).desc_nulls_last()
    placed = _laid_out(valued, group, [order, F.col(key).asc_nulls_first()], ranges)

    totals = ["n", *[f"sum_{name}" for name in running_sum]]
    by_value = rank or percent_rank or ties or running_sum
    if by_value:
        runs = _runs(placed, group, running_sum)
        run = F.struct(_VALUE, "n", "first", *totals[1:])
        cells = runs.groupBy(_CELL).agg(*[F.sum(x).alias(x) for x in totals], F.min("first").alias("__begin"), F.min_by(run, "first").alias("head"), F.max_by(run, "first").alias("tail"))
    else:
        # numbers need no runs: a table of values with their places would be as large as the rows
        cells = placed.groupBy(_cell(group).alias(_CELL)).agg(F.count(F.lit(1)).alias("n"), F.min(_AT).alias("__begin"))
    cells = written(_with_front(cells, group, totals))

    rows = placed.withColumn(_CELL, _cell(group))
    front = cells.select(_CELL, "__begin", "__all_n", *[f"__before_{x}" for x in totals])
    if by_value:
        upto = Window.partitionBy(_CELL).orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
        local = runs.withColumns({f"upto_{x}": F.sum(x).over(upto) for x in totals[1:]}).join(front, _CELL)
        own = F.struct(*[F.col(f"{_CELL}.g{i}").alias(f"g{i}") for i in range(len(group))], F.col(_VALUE).alias(_VALUE))
        local = local.withColumn(_RUN, own).join(written(_spanning(cells, group, totals)), _RUN, "left")
        shared = {
            "__start": F.coalesce("span_start", F.col("__before_n") + F.col("first") - F.col("__begin")),
            "__ties": F.coalesce("span_rows", "n"),
            **{f"__{x}": F.coalesce(f"span_{x}", F.col(f"__before_{x}") + F.col(f"upto_{x}")) for x in totals[1:]},
        }
        local = local.select(F.struct(_CELL, _VALUE).alias(_RUN), "__begin", "__all_n", "__before_n", *[c.alias(n) for n, c in shared.items()])
        joined = rows.withColumn(_RUN, F.struct(_CELL, _VALUE)).join(local, _RUN)
    else:
        joined = rows.join(front, _CELL)

    number = F.col("__before_n") + F.col(_AT) - F.col("__begin") + 1
    size = F.col("__all_n")
    out: dict[str, Column] = {}
    if row_number:
        out[row_number] = number
    if rank:
        out[rank] = F.col("__start") + 1
    if percent_rank:
        out[percent_rank] = F.when(size > 1, F.col("__start") / (size - 1)).otherwise(0.0)
    if ties:
        out[ties] = F.col("__ties")
    if group_size:
        out[group_size] = size
    if relative_position:
        out[relative_position] = F.try_divide(number - 1.0, size - 1)
    for name, tiles in (ntile or {}).items():
        out[name] = tile_of(number, size, tiles)
    for name in running_sum:
        out[name] = F.col(f"__sum_{name}")
    return joined.select(*[rows[c] for c in df.columns if c not in out], *[c.alias(n) for n, c in out.items()])


def tile_of(number: Column, size: Column, tiles: int) -> Column:
    """The ntile of a 1-based position: the first ``size % tiles`` tiles hold one row more."""
    small = F.floor(size / tiles)
    extra = size % tiles
    in_large = extra * (small + 1)
    return (
        F.when(number <= in_large, F.floor((number - 1) / (small + 1)))
        .otherwise(extra + F.floor(F.try_divide(number - in_large - 1, small)))
        .cast("int")
        + 1
    )


def value_distribution(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    aggs: Mapping[str, Column] | None = None,
    ranges: int | None = None,
    center: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per distinct (group, value): ``n`` rows hold it, ``below`` rows are smaller, ``total`` in the group.

    Further per-value aggregates come from ``aggs``; ``center`` names an output for the mean of the
    group. A row stands for as many as ``weight`` says. Analyses that only need totals per rank
    band read this instead of ranking rows: repeated values collapse before the shuffle, and only distinct ones are sorted.
    """
    extra = [c.alias(n) for n, c in (aggs or {}).items()]
    counted = F.sum(weight) if weight else F.count(F.lit(1))
    held = df.groupBy(*group, value).agg(counted.alias("n"), *([F.sum(value).alias("__sum")] if center else []), *extra)
    placed = _laid_out(held, group, [F.col(value).asc_nulls_first()], ranges).withColumn(_CELL, _cell(group))
    totals = ["n", *(["__sum"] if center else [])]
    cells = placed.groupBy(_CELL).agg(*[F.sum(x).alias(x) for x in totals])
    front = _with_front(cells, group, totals).select(_CELL, "__before_n", *[f"__all_{x}" for x in totals])
    earlier = Window.partitionBy(_CELL).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("__earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(front, _CELL)
        .select(
            *group,
            value,
            "n",
            (F.col("__before_n") + F.col("__earlier")).alias("below"),
            F.col("__all_n").alias("total"),
            *([(F.col("__all___sum") / F.col("__all_n")).alias(center)] if center else []),
            *list(aggs or {}),
        )
    )


def quantiles(
    df: DataFrame,
    group: Sequence[str],
    value: str | Column,
    probabilities: Sequence[float],
    output: str = "quantiles",
    weight: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """One row per group that has values: an array of the values at the given probabilities, exact at any size.

    The value at p of n is the one at place ceil(p * n), 1 at least, as in SQL's ``percentile_disc``; NULL is no value. Values
    are counted first and their counts summed up over the ranges of ``value_distribution``, so no group is sorted in one task.
    """
    value = F.col(value) if isinstance(value, str) else value
    rows = df.select(*group, *([weight] if weight else []), value.alias(_VALUE)).filter(F.col(_VALUE).isNotNull())
    held = value_distribution(rows, group, _VALUE, ranges=ranges, weight=weight)
    places = [F.greatest(F.ceil(F.col("total") * F.lit(Decimal(str(p)))), F.lit(1)) for p in probabilities]
    asked = [F.min(F.when(F.col("below") + F.col("n") >= place, F.col(_VALUE))) for place in places]
    found = held.groupBy(*group).agg(F.array(*asked).alias(output))
    return found if group else found.filter(F.col(output)[0].isNotNull())


def with_quantiles(summary: DataFrame, df: DataFrame, group: Sequence[str], value: str, probabilities: Sequence[float], output: str) -> DataFrame:
    """``summary``, one row per group of ``df``, with the exact quantiles of the group's values; NULL where it has none."""
    # one struct column, so that groups with a NULL name join like any other
    key = F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)])
    found = quantiles(df, group, value, probabilities).select(key.alias("__group"), F.col("quantiles").alias(output))
    return summary.withColumn("__group", key).join(found, "__group", "left").drop("__group")


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """One row: per column its exact quantiles as numbers, NULL without values; all columns in one pass."""
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    found = quantiles(df.select(F.explode(cells).alias("e")).select("e.*"), ["i"], "v", probabilities)
    return found.agg(*[F.max(F.when(F.col("i") == i, F.col("quantiles"))).alias(c) for i, c in enumerate(columns)])


def percent_rank_of(below: Column, total: Column) -> Column:
    return F.when(total > 1, below / (total - 1)).otherwise(0.0)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows of each group. ``order`` must end in a unique key.

    Spark keeps at most ``n`` rows per group and task before the shuffle, so a large group is no
    larger than ``n`` rows per task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    numbered = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
    return numbered.withColumn(rank, F.col(rank).cast("long"))
