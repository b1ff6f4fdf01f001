import random

from pyspark.sql import functions as F

from tallyforge.operators.rollups import Rollup, rank_error


def visits(spark, n):
    pick = random.Random(5)
    rows = [(i % 30, pick.choice(["a", "b", None]), pick.choice([pick.gauss(50, 20), 7.0, None, float("nan")]), pick.randrange(4000)) for i in range(n)]
    return spark.createDataFrame(rows, "day int, g string, v double, who int")


def test_merged_ranges_keep_the_error_bound(spark, folder):
    df = visits(spark, 60_000).persist()
    rollup = Rollup(f"{folder}/r", ["g"], "v", "who", k=200, lg_k=12)
    for batch in (0, 1, 0):
        rollup.load(df.filter(F.col("day") % 2 == batch), F.col("day"), batch)
    lines = rollup.stored(spark).filter("period >= 3")
    own = df.filter("day >= 3")
    exact = {r["g"]: r for r in own.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("who").alias("d"), F.avg(F.when(~F.isnan("v"), F.col("v"))).alias("m")).collect()}
    for r in rollup.merged(lines, ["g"], (0.1, 0.5, 0.95)).collect():
        want = exact[r["g"]]
        assert r["n"] == want["n"] and abs(r["mean"] - want["m"]) < 1e-9
        assert abs(r["distinct_actors"] / want["d"] - 1) < 0.06
        values = own.filter(F.col("g").eqNullSafe(r["g"]) & ~F.isnan("v"))
        for name, p in (("p10", 0.1), ("p50", 0.5), ("p95", 0.95)):
            below, upto = values.agg(F.avg((F.col("v") < r[name]).cast("double")), F.avg((F.col("v") <= r[name]).cast("double"))).first()
            assert below - rank_error(200) <= p <= upto + rank_error(200)


def test_merged_equals_fresh(spark, folder):
    df = visits(spark, 3000)
    rollup = Rollup(f"{folder}/r", ["g"], "v", "who", k=4096, lg_k=18)
    for batch in range(3):
        rollup.load(df.filter(F.col("who") % 3 == batch), F.col("day"), batch)
    merged = rollup.merged(rollup.stored(spark), ["g"], (0.25, 0.5, 0.999))
    fresh = rollup.merged(rollup.summary(df, F.lit(0)), ["g"], (0.25, 0.5, 0.999))
    assert sorted(map(str, merged.select(fresh.columns).drop("mean").collect())) == sorted(map(str, fresh.drop("mean").collect()))


def test_groups_without_values(spark, folder):
    df = spark.createDataFrame([(1, "a", None, None), (1, "a", float("nan"), 3)], "day int, g string, v double, who int")
    rollup = Rollup(f"{folder}/r", ["g"], "v", "who")
    row = rollup.merged(rollup.summary(df, F.col("day")), ["g"]).first()
    assert (row["n"], row["n_values"], row["mean"], row["p50"], row["distinct_actors"]) == (2, 0, None, None, 1)


def test_exact_ranges_beyond_the_sketch(spark, folder):
    df = visits(spark, 30_000).persist()
    rollup = Rollup(f"{folder}/r", ["g"], "v", "who", k=64, lg_k=4, exact=True)
    for batch in (0, 1, 0):
        rollup.load(df.filter(F.col("day") % 2 == batch), F.col("day"), batch)
    rows = [r for r in df.collect() if r.day >= 3]
    got = rollup.exactly(spark, {"half": F.col("period") < 15, "g": F.col("g")}, (0.07, 0.5, 0.999), F.col("period") >= 3).collect()
    assert len(got) == 6
    for r in got:
        own = [x for x in rows if (x.day < 15) == r.half and x.g == r.g]
        held = sorted(x.v for x in own if x.v is not None and x.v == x.v)
        assert (r.n, r.n_values, r.distinct_actors) == (len(own), len(held), len({x.who for x in own}))
        assert [r.p7, r.p50, r.p99_9] == [held[-(-len(held) * p // 1000) - 1] for p in (70, 500, 999)]
