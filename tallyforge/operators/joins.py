"""Joins whose small side is checked before it is broadcast, and reconciliation of join results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyforge.operators.ranking import rank_rows
from tallyforge.session import written

BROADCAST_ROWS = 10_000


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; reads at most ``rows + 1`` of them."""
    return df.limit(rows + 1).count() <= rows


def measured(df: DataFrame) -> DataFrame:
    """Compute a summary once and write it down.

    Spark knows the size of a written table, so a join with it is broadcast if, and only if, it is below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that the join is a shuffle join whose hot keys AQE splits.
    Without this, a summary of a huge table is taken for huge and the huge table is shuffled by its group. Nothing
    is kept in memory.
    """
    return written(df)


def join_small(
    df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Broadcast ``small`` only if it has at most ``max_rows`` rows, else leave the choice to Spark."""
    side = F.broadcast(small) if at_most(small, max_rows) else small
    return df.join(side, list(keys), how)


def with_group_stats(
    df: DataFrame, group: Sequence[str], stats: Mapping[str, Column], having: Column | None = None
) -> DataFrame:
    """Rows joined with aggregates of their own group.

    Replaces ``agg() over (partition by group)``, which would sort and hold a whole group in one
    task. ``having`` keeps only rows of qualifying groups. Rows whose group is NULL keep their own
    statistics.
    """
    marks = [f"__k{i}" for i in range(len(group))]
    keyed = df.withColumn("__key", F.struct(*[F.col(g).alias(m) for g, m in zip(group, marks)]))
    summary = keyed.groupBy("__key").agg(*[c.alias(n) for n, c in stats.items()])
    if having is not None:
        summary = summary.filter(having)
    return keyed.join(measured(summary), "__key").drop("__key")


def with_total_stats(df: DataFrame, stats: Mapping[str, Column]) -> DataFrame:
    """Rows extended by aggregates of the whole table: one scalar subquery, no join and no shuffle of the rows."""
    total = df.agg(F.struct(*[c.alias(n) for n, c in stats.items()]).alias("__stats")).scalar()
    return df.withColumn("__stats", total).withColumns({n: F.col("__stats")[n] for n in stats}).drop("__stats")


def semi_join(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(wanted.select(*keys), list(keys), "left_semi")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key does not exist in the parent."""
    refs = parent.select(F.col(parent_key).alias("__ref"))
    return child.filter(F.col(child_key).isNotNull()).join(refs, F.col(child_key) == F.col("__ref"), "left_anti")


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Inner joins of a fact with its dimensions; each is broadcast only if it is small."""
    for dimension, keys in dimensions:
        fact = join_small(fact, dimension, keys)
    return fact


def alias_table(targets: DataFrame, target_key: str, weight: str) -> tuple[DataFrame, int, Decimal]:
    """(slot, own, upto, other), the number of slots, and the whole weight: a table to draw targets from by their weights.

    There are as many slots as targets of positive weight, all equally likely. Slot i belongs to one target for the part ``upto`` of the
    whole weight and to another for the rest. Light targets (below the average) and heavy ones are laid out on one axis, light ones
    by what they lack and heavy ones by what they have too much; a light slot is filled by the heavy target at whose place it begins, and
    a heavy target gives away what the last light slot it reaches takes beyond its end, to be filled by the next heavy one. Both places
    are found by running counts over the sorted axis, so the table is built in parallel, in exact decimals.
    """
    rows = targets.select(F.col(target_key).alias("own"), F.col(weight).cast("decimal(20,6)").alias("w")).filter("w > 0")
    slots, whole = rows.agg(F.count(F.lit(1)), F.sum("w")).first()
    if not slots:
        return rows.select(F.lit(0).cast("long").alias("slot"), "own", F.col("w").alias("upto"), F.col("own").alias("other")), 0, Decimal(0)
    scaled = (F.col("w") * slots).cast("decimal(38,6)")
    rows = rows.select("own", scaled.alias("p")).withColumns({"heavy": F.col("p") >= F.lit(whole), "gap": F.abs(F.col("p") - F.lit(whole))})
    rows = written(rank_rows(rows, ["heavy"], "own", "own", row_number="i", running_sum={"end": "gap"}))
    light, heavy = rows.filter("NOT heavy"), rows.filter("heavy")
    points = light.select("own", (F.col("end") - F.col("gap")).alias("at"), F.lit(1).alias("kind"))
    points = points.unionByName(heavy.select("own", F.col("end").cast(points.schema["at"].dataType).alias("at"), F.lit(0).alias("kind")))
    points = points.withColumns({"is_light": F.col("kind"), "is_heavy": 1 - F.col("kind")})
    placed = rank_rows(points, [], F.struct("at", "kind"), "own", running_sum={"lights": "is_light", "heavies": "is_heavy"})
    rows = written(rows.join(placed.select("own", "lights", "heavies"), "own"))
    light, heavy = rows.filter("NOT heavy"), rows.filter("heavy")
    by_number = heavy.select(F.col("i").alias("j"), F.col("own").alias("other"))
    n_light = rows.filter("NOT heavy").agg(F.count(F.lit(1))).first()[0]
    light = light.withColumn("j", F.col("heavies") + 1).join(by_number, "j", "left")
    light = light.select((F.col("i") - 1).alias("slot"), "own", F.col("p").alias("upto"), "other")
    reached = rows.filter("NOT heavy").select(F.col("i").alias("lights"), F.col("end").alias("reach"))
    heavy = heavy.withColumn("j", F.col("i") + 1).join(reached, "lights", "left").join(by_number, "j", "left")
    given = F.greatest(F.coalesce(F.col("reach"), F.lit(0)) - F.col("end"), F.lit(0).cast("decimal(38,6)"))
    heavy = heavy.select((F.col("i") - 1 + n_light).alias("slot"), "own", (F.lit(whole) - given).cast("decimal(38,6)").alias("upto"), "other")
    return written(light.unionByName(heavy)), slots, whole


def assign_weighted(
    rows: DataFrame, row_key: str, targets: DataFrame, target_key: str, weight: str, salt: str = "assign"
) -> DataFrame:
    """Give every row one target with probability proportional to the target's weight.

    A hash of the row key and the salt chooses a slot of the alias table and a point in it; every row reads exactly one slot. Weights
    count to six decimals; without a positive weight no row gets a target and none is returned. Target keys are unique and
    not NULL; a NULL row key is a key like any other.
    """
    table, slots, whole = alias_table(targets, target_key, weight)
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col(row_key).cast("string"), F.lit("")), F.lit(salt)))
    number = [F.conv(F.substring(digest, a, n), 16, 10).cast("long") for a, n in ((1, 12), (13, 8))]
    drawn = rows.withColumns({"__slot": F.pmod(number[0], F.lit(max(slots, 1))), "__point": number[1]})
    hit = drawn.join(table.withColumnRenamed("slot", "__slot").select("__slot", *[F.col(c).alias(f"__{c}") for c in ("own", "upto", "other")]), "__slot")
    own = F.col("__point").cast("decimal(10,0)") * F.lit(whole).cast("decimal(27,6)") < F.col("__upto").cast("decimal(27,6)") * F.lit(2**32).cast("decimal(10,0)")
    return hit.select(*rows.columns, F.when(own, F.col("__own")).otherwise(F.col("__other")).alias(target_key))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, without an extra job; read ``observation.get['rows']`` after an action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def join_reconciliation(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """Row counts before and after a join, as one row."""
    rows_after = after.agg(F.count(F.lit(1))).scalar()
    counts = before.agg(F.count(F.lit(1)).alias("rows_before"))
    return counts.select(F.lit(name).alias("join_name"), "rows_before", rows_after.alias("rows_after"))
