import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows_of, values
from tallyforge.operators.ranking import percent_rank_of, quantiles, rank_rows, tile_of, top_per_group, value_distribution
from tallyforge.plans.ranking import multi_criteria_rank, rank_tiers, tile_distribution


def skewed(spark, key_type="long", n=3000):
    """A third of all rows in one group, and a third of all rows with one value."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        group = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
        value = 2.0 if rng.random() < 0.34 else rng.choice([None, round(rng.random() * 4, 2), -0.0, 0.0, rng.random() * 4])
        key = i if key_type == "long" else f"STU_{i:06d}"
        rows.append((group, value, key, rng.randint(0, 9)))
    return spark.createDataFrame(rows, f"g string, v double, k {key_type}, w long").repartition(5)


@pytest.mark.parametrize("key_type", ["long", "string"])
@pytest.mark.parametrize("ascending", [True, False])
def test_rank_rows_equals_plain_windows(spark, key_type, ascending):
    df = skewed(spark, key_type)
    got = rank_rows(
        df,
        ["g"],
        "v",
        "k",
        ascending,
        row_number="rn",
        rank="rk",
        percent_rank="pr",
        ties="t",
        group_size="n",
        relative_position="pos",
        ntile={"q": 4, "d": 10},
        running_sum={"total": "w"},
        ranges=16,
    )
    order = F.asc("v") if ascending else F.desc("v")
    w, wk = Window.partitionBy("g").orderBy(order), Window.partitionBy("g").orderBy(order, "k")
    n = F.count(F.lit(1)).over(Window.partitionBy("g"))
    want = df.select(
        "*",
        F.row_number().over(wk).alias("rn"),
        F.rank().over(w).alias("rk"),
        F.percent_rank().over(w).alias("pr"),
        F.count(F.lit(1)).over(Window.partitionBy("g", "v")).alias("t"),
        n.alias("n"),
        ((F.row_number().over(wk) - 1.0) / F.nullif(n - 1, F.lit(0))).alias("pos"),
        F.ntile(4).over(wk).alias("q"),
        F.ntile(10).over(wk).alias("d"),
        F.sum("w").over(w).alias("total"),
    )
    assert rows_of(got) == rows_of(want)


def largest_share(df, group, order, ranges):
    """The largest partition of the sorted rows, as a share of all rows."""
    from tallyforge.operators import ranking

    placed = ranking._laid_out(df, group, order, ranges)
    return placed.groupBy("__part").count().agg(F.max("count") / F.sum("count")).first()[0]


def test_a_hot_group_and_value_spread(spark):
    """The largest partition stays near 1/ranges of the rows, however skewed group and value are."""
    value = F.when(F.col("id") % 3 == 0, 2.0).otherwise(F.rand(1) * 4)
    df = spark.range(20000).select(F.lit("only").alias("g"), value.alias("v"), F.col("id").alias("k"))
    assert largest_share(df, ["g"], [F.asc("v"), F.asc("k")], 20) < 0.15


def test_strings_with_a_common_beginning_spread(spark):
    df = spark.range(40000).select(F.lit("only").alias("g"), F.format_string("STU_%020d", F.col("id") * 7 % 40009).alias("v"), F.col("id").alias("k"))
    assert largest_share(df, ["g"], [F.asc("v"), F.asc("k")], 20) < 0.15
    got = rank_rows(df, ["g"], "v", "k", row_number="rn", rank="rk", ties="t", ranges=20)
    assert got.filter("rn <> rk OR t <> 1").count() == 0
    assert rows_of(got.select("g", "v", "k", "rn", "rk", "t")) == rows_of(plain(df))


def test_the_plan_holds_no_list_of_bounds(spark):
    sizes = []
    for n in (2000, 40000):
        df = spark.range(n).select(F.lit("g").alias("g"), (F.col("id") % 97).cast("string").alias("v"), F.col("id").alias("k"))
        plan = rank_rows(df, ["g"], "v", "k", row_number="rn", percent_rank="pr", ranges=16)._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len(plan))
    assert abs(sizes[0] - sizes[1]) < 200


def test_runs_over_several_partitions(spark):
    """One value fills many partitions, its neighbours share partitions with it; groups begin and end anywhere."""
    rows = [(g, v, i, i % 5) for g, n in (("a", 900), (None, 700), ("c", 3), ("d", 1)) for i, v in ((i, None if i < n // 9 else "m" if i < n * 8 // 9 else f"x{i % 4}") for i in range(n))]
    df = spark.createDataFrame(rows, "g string, v string, k long, w long").repartition(4)
    for ascending in (True, False):
        order = F.asc_nulls_first("v") if ascending else F.desc_nulls_last("v")
        want = plain(df, ascending).withColumn("s", F.sum("w").over(Window.partitionBy("g").orderBy(order)))
        got = rank_rows(df, ["g"], "v", "k", ascending, row_number="rn", rank="rk", ties="t", running_sum={"s": "w"}, ranges=13)
        assert rows_of(got) == rows_of(want)


def test_columns_with_inner_names(spark):
    df = spark.createDataFrame([("a", 1.0, i, 5, 6) for i in range(4)], "g string, v double, n long, begin int, first int")
    got = rank_rows(df, ["g"], "v", "n", row_number="rn", rank="rk", running_sum={"s": "begin"})
    assert rows_of(got.select("n", "rn", "rk", "s", "first")) == [(6, i, 1, i + 1, 20) for i in range(4)]


def test_global_rank(spark):
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate([5, 3, 3, 9])], "v double, k long")
    got = rank_rows(df, [], "v", "k", row_number="rn", rank="rk")
    assert sorted(values(got.select("k", "rn", "rk"))) == [(0, 3, 3), (1, 1, 1), (2, 2, 1), (3, 4, 4)]


def test_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "g string, v double, k long")
    assert rank_rows(empty, ["g"], "v", "k", row_number="rn").count() == 0
    one = spark.createDataFrame([("a", 1.0, 1)], "g string, v double, k long")
    row = rank_rows(one, ["g"], "v", "k", percent_rank="pr", relative_position="rp", ntile={"q": 4}).first()
    assert (row.pr, row.rp, row.q) == (0.0, None, 1)


def test_value_distribution_counts(spark):
    df = skewed(spark).filter(F.col("v").isNotNull()).withColumn("v", F.col("v") + 0.0)
    got = value_distribution(df, ["g"], "v", {"w": F.sum("w")}, ranges=16)
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    plain = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"))
    want = plain.select(
        "g",
        "v",
        "n",
        F.coalesce(F.sum("n").over(w), F.lit(0)).alias("below"),
        F.sum("n").over(Window.partitionBy("g")).alias("total"),
        "w",
    )
    assert rows_of(got) == rows_of(want)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(size=st.integers(1, 60), tiles=st.integers(1, 12))
def test_tiles_partition_positions_evenly(spark, size, tiles):
    df = spark.range(1, size + 1)
    out = [r[0] for r in df.orderBy("id").select(tile_of(F.col("id"), F.lit(size), tiles)).collect()]
    counts = [out.count(t) for t in range(1, min(tiles, size) + 1)]
    assert out == sorted(out) and sum(counts) == size
    assert max(counts) - min(counts) <= 1


def test_percent_rank_of_is_bounded(spark):
    out = [r[0] for r in spark.range(10).select(percent_rank_of(F.col("id"), F.lit(10))).collect()]
    assert out[0] == 0.0 and out[-1] == 1.0


def test_top_per_group_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", 1.0, k) for k in range(9)], "g string, v double, k long")
    out = top_per_group(df, ["g"], [F.desc("v"), F.asc("k")], 3, "r")
    assert sorted(values(out.select("k", "r"))) == [(0, 1), (1, 2), (2, 3)]


def students(spark, n=2000):
    rng = random.Random(3)
    rows = [
        (i, rng.choice(["x", "y"]), round(rng.random() * 4, 1), rng.randint(1, 5), rng.randint(1, 5), rng.randint(5, 10) / 10, 0.9)
        for i in range(n)
    ]
    schema = "student_id long, field_of_study string, gpa double, usage_frequency_score int, satisfaction_level int, attendance_rate double, assignment_submission_rate double"
    return spark.createDataFrame(rows, schema)


def test_tile_distribution_with_many_ties(spark):
    df = students(spark)
    w = Window.partitionBy("field_of_study").orderBy("gpa")
    plain = df.select("field_of_study", "gpa", F.ntile(4).over(w).alias("q"), F.percent_rank().over(w).alias("p"))
    want = plain.groupBy("field_of_study", F.col("q").alias("gpa_quartile")).agg(
        F.count(F.lit(1)).alias("student_count"),
        F.round(F.avg("gpa"), 3).alias("avg_gpa"),
        F.round(F.stddev("gpa"), 3).alias("stddev_gpa"),
        F.round(F.max("p"), 3).alias("max_percentile"),
    )
    assert rows_of(tile_distribution(df).select(*want.columns)) == rows_of(want)


def test_rank_tiers_count_every_row_once(spark):
    assert rank_tiers(students(spark)).agg(F.sum("student_count")).first()[0] == 2000


def test_multi_criteria_keeps_all_rows_of_the_last_rank(spark):
    df = students(spark).withColumns({"gpa": F.lit(3.0), "usage_frequency_score": F.lit(5)})
    out = multi_criteria_rank(df, top=3)
    w = Window.partitionBy("field_of_study").orderBy(F.desc("c"))
    score = F.round(
        F.col("gpa") * 0.4 + F.col("usage_frequency_score") * 0.2 + F.col("satisfaction_level") * 0.2
        + F.col("attendance_rate") * 0.4 + F.col("assignment_submission_rate") * 0.4, 3,
    )
    want = df.withColumn("c", F.round(F.round(score, 10), 3)).withColumn("r", F.rank().over(w)).filter("r <= 3")
    assert out.count() == want.count() > 6


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_time_keys_break_ties_of_a_hot_value(spark, kind):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    df = spark.range(400).select(F.lit(1.0).alias("v"), day.cast(kind).alias("k"), "id")
    out = rank_rows(df, [], "v", "k", row_number="rn", ranges=8)
    assert out.filter(F.col("rn") != F.col("id") + 1).count() == 0


def plain(df, ascending=True):
    order = F.col("v").asc_nulls_first() if ascending else F.col("v").desc_nulls_last()
    by = Window.partitionBy("g").orderBy(order)
    return df.withColumns({"rn": F.row_number().over(Window.partitionBy("g").orderBy(order, "k")), "rk": F.rank().over(by), "t": F.count(F.lit(1)).over(Window.partitionBy("g", "v"))})


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize(("kind", "make"), [("bigint", lambda i: 2**53 + i % 3), ("decimal(30,2)", lambda i: f"{10**20 + i % 2}.5{i % 7}"), ("string", lambda i: ["abcdefg", "abcdefh", "b", "", None][i % 5])])
def test_values_that_share_a_double(spark, kind, make, ascending):
    df = spark.createDataFrame([("g", str(make(i)) if make(i) is not None else None, i) for i in range(600)], "g string, v string, k int").withColumn("v", F.col("v").cast(kind))
    got = rank_rows(df, ["g"], "v", "k", ascending, row_number="rn", rank="rk", ties="t", ranges=8)
    assert rows_of(got) == rows_of(plain(df, ascending))


def test_one_odd_key_does_not_undo_the_split(spark):
    df = spark.createDataFrame([("g", 1.0, f"STU_{i:020d}") for i in range(4000)] + [("g", 1.0, "A1")], "g string, v double, k string")
    assert largest_share(df, ["g"], [F.asc("v"), F.asc("k")], 8) < 0.3
    assert rows_of(rank_rows(df, ["g"], "v", "k", row_number="rn", rank="rk", ties="t", ranges=8)) == rows_of(plain(df))


def test_quantiles_are_the_values_at_their_places(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", None]), rng.choice([round(rng.random(), 4), None, 0.5]), rng.randint(1, 3)) for _ in range(30_000)]
    df = spark.createDataFrame([*rows, ("none", None, 1)], "g string, v double, w int")
    asked = [0.0, 0.07, 0.5, 0.999, 1.0]
    for weight in (None, "w"):
        got = {r.g: r["quantiles"] for r in quantiles(df, ["g"], "v", asked, weight=weight, ranges=5).collect()}
        assert set(got) == {"a", None}
        for group, found in got.items():
            held = sorted(v for g, v, w in rows if g == group and v is not None for _ in range(w if weight else 1))
            assert found == [held[max(-(-len(held) * round(p * 1000) // 1000), 1) - 1] for p in asked]


def test_plain_numbers_count_no_runs(spark, monkeypatch):
    df = skewed(spark, n=300)
    want = sorted(map(str, rank_rows(df, ["g"], "v", "k", row_number="rn", rank="rk").drop("rk").collect()))
    monkeypatch.setattr("tallyforge.operators.ranking._runs", None)
    assert sorted(map(str, rank_rows(df, ["g"], "v", "k", row_number="rn").collect())) == want
