import pytest
from pyspark.sql import functions as F

from helpers import values
from tallyforge.functions import expr


def one(spark, column, **inputs):
    df = spark.range(1).select(*[(F.lit(v) if v is not None else F.lit(None).cast("double")).alias(k) for k, v in inputs.items()])
    return df.select(column).first()[0]


@pytest.mark.parametrize("value, label", [(4.0, "a"), (3.999, "b"), (3.0, "b"), (2.9, "c"), (None, "c")])
def test_band_lower_bounds_are_closed(spark, value, label):
    assert one(spark, expr.band("x", [(4.0, "a"), (3.0, "b")], "c"), x=value) == label


@pytest.mark.parametrize("value, label", [(0.99, "a"), (1.0, "b"), (3.0, "c"), (None, "c")])
def test_band_below_is_open(spark, value, label):
    assert one(spark, expr.band("x", [(1, "a"), (3, "b")], "c", below=True), x=value) == label


def test_band_below_closed(spark):
    assert one(spark, expr.band("x", [(1, "a"), (3, "b")], "c", below=True, closed=True), x=1.0) == "a"


def test_classify_takes_first_match_and_skips_null(spark):
    rules = [(F.col("x") > 5, "big"), (F.col("x") > 1, "mid")]
    assert one(spark, expr.classify(rules, "small"), x=9.0) == "big"
    assert one(spark, expr.classify(rules, "small"), x=2.0) == "mid"
    assert one(spark, expr.classify(rules, "small"), x=None) == "small"


def test_weighted_score_null_handling(spark):
    filled = expr.weighted_score([("a", 0.5, 2), ("b", 0.5, 0)])
    kept = expr.weighted_score([("a", 0.5, None), ("b", 0.5, None)])
    assert one(spark, filled, a=None, b=4.0) == 3.0
    assert one(spark, kept, a=None, b=4.0) is None


def pairs(spark, rows):
    return spark.createDataFrame(rows, "g string, x double, y double")


def test_safe_corr_degenerate_groups_are_null(spark):
    rows = [("flat", 1.0, 1.0), ("flat", 1.0, 2.0), ("one", 1.0, 1.0), ("line", 1.0, 2.0), ("line", 2.0, 4.0), ("line", 3.0, 6.0)]
    out = dict(values(pairs(spark, rows).groupBy("g").agg(expr.safe_corr("x", "y"))))
    assert out["flat"] is None and out["one"] is None
    assert out["line"] == pytest.approx(1.0)


def test_safe_corr_uses_complete_pairs_only(spark):
    rows = [("g", 1.0, 2.0), ("g", 2.0, 1.0), ("g", 3.0, 5.0), ("g", 100.0, None), ("g", None, -7.0)]
    with_gaps = pairs(spark, rows).agg(expr.safe_corr("x", "y")).first()[0]
    complete = pairs(spark, rows[:3]).agg(F.corr("x", "y")).first()[0]
    assert with_gaps == pytest.approx(complete)


def test_slope(spark):
    rows = [("g", float(x), 3.0 * x + 1) for x in range(5)] + [("g", 99.0, None)]
    assert pairs(spark, rows).agg(expr.slope("y", "x")).first()[0] == pytest.approx(3.0)


def test_z_score_without_spread_is_null_and_no_outlier(spark):
    z = expr.z_score("x", F.lit(1.0), F.lit(0.0))
    assert one(spark, z, x=1.0) is None
    assert one(spark, expr.outside(z, 2.0), x=1.0) is False


def test_settled_round_ignores_summation_noise(spark):
    assert one(spark, expr.settled_round(F.col("x"), 2), x=0.14499999999999996) == 0.15
    assert one(spark, expr.settled_round(F.col("x"), 2), x=-0.145) == -0.15


@pytest.mark.parametrize("text, n", [("a,b,c", 3), ("a", 1), ("", 1), (None, 0)])
def test_list_count(spark, text, n):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(expr.list_count("t")).first()[0] == n


def py_title(text):
    """The row-at-a-time definition, kept as the oracle of the native expression."""
    import re

    if text is None:
        return None
    return " ".join(w.capitalize() for w in re.sub(r"[^\w\s]", "", text.replace("_", " ")).split())


@pytest.mark.parametrize(
    "text",
    ["Data_Structures", "physics_I", "  a__b  ", "C++ & C#: intro!", "ÉCOLE_d'été", "한국어_과목", "", "\tx\n y", None],
)
def test_title_text_equals_python_definition(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(expr.title_text("t")).first()[0] == py_title(text)


def test_row_stddev(spark):
    import statistics

    got = one(spark, expr.row_stddev(["a", "b", "c", "d"]), a=1.0, b=5.0, c=9.0, d=2.0)
    assert got == pytest.approx(statistics.stdev([1, 5, 9, 2]))


def test_hash_functions_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumn("u", expr.hash_uniform(F.col("id"), "s")).withColumn("p", expr.hash_percent("id"))
    a = {r.id: (r.u, r.p) for r in df.repartition(3).collect()}
    b = {r.id: (r.u, r.p) for r in df.repartition(7, "id").collect()}
    assert a == b
    assert all(0 <= u < 1 and 0 <= p < 100 for u, p in a.values())
    assert abs(sum(u for u, _ in a.values()) / 5000 - 0.5) < 0.03


def test_hash_normal_moments(spark):
    row = spark.range(20000).select(expr.hash_normal(F.col("id"), "n", 3.0, 2.0).alias("x")).agg(F.avg("x"), F.stddev("x")).first()
    assert row[0] == pytest.approx(3.0, abs=0.06) and row[1] == pytest.approx(2.0, abs=0.06)


def test_clip_keeps_null(spark):
    assert one(spark, expr.clip(F.col("x"), 0.0, 4.0), x=5.0) == 4.0
    assert one(spark, expr.clip(F.col("x"), 0.0, 4.0), x=-1.0) == 0.0
    assert one(spark, expr.clip(F.col("x"), 0.0, 4.0), x=None) is None


def test_percent_of_zero_is_null(spark):
    assert one(spark, expr.pct(F.lit(1), F.lit(0), 1), x=1.0) is None


def test_constant_column_has_no_noise_after_merging(spark):
    """0.1 and 3 merged from many partitions: moments are not exactly zero, the results must be."""
    df = spark.range(0, 977, 1, 13).select(F.lit(0.1).alias("c"), (F.col("id") % 7).cast("double").alias("y"))
    row = df.agg(expr.safe_corr("c", "y").alias("r"), expr.spread("c").alias("s"), expr.slope("y", "c").alias("b")).first()
    assert (row.r, row.s, row.b) == (None, 0.0, None)
    assert spark.createDataFrame([(1.0,)], "c double").agg(expr.spread("c")).first()[0] is None


@pytest.mark.parametrize("value, digits, want", [(2.5, 0, 3.0), (-2.5, 0, -3.0), (-0.0004, 3, 0.0), (1e15, 2, 1e15), (1.005, 2, 1.01), (2.675, 2, 2.68), (0.1 + 0.2, 1, 0.3), (123456789.985, 2, 123456789.99)])
def test_settled_round_values(spark, value, digits, want):
    got = one(spark, expr.settled_round(F.col("x"), digits), x=value)
    assert got == want and str(got) == str(want)


def test_settled_round_keeps_null_and_nan(spark):
    assert one(spark, expr.settled_round(F.col("x"), 2), x=None) is None
    assert one(spark, expr.settled_round(F.col("x"), 2), x=float("nan")) != one(spark, expr.settled_round(F.col("x"), 2), x=0.0)


@pytest.mark.parametrize(("x", "digits", "want"), [(999999999999.0, 8, 999999999999.0), (123456789012.5, 9, 123456789012.5), (-0.5, 0, -1.0), (2.0**52 + 0.5, 0, 2.0**52 + 1), (1e300, 2, 1e300)])
def test_settled_round_beyond_exact_doubles(spark, x, digits, want):
    assert spark.range(1).select(expr.settled_round(F.lit(x), digits)).first()[0] == want


def test_separators_are_literal(spark):
    df = spark.createDataFrame([("a|b|c",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(expr.list_count("v", "|")).collect()] == [3, 1, 0]
    assert [r[0] for r in df.select(expr.list_count("v", ".")).collect()] == [1, 1, 0]
