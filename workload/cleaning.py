"""Cleaning, scoring, quality and modeling operators on the driver tables.

The tables have no NULLs or duplicates of their own; defects are derived from keys, so both engines
see the same ones.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tallyforge.functions.expr import list_count, settled_round, title_text
from tallyforge.operators import cleaning, modeling, quality, regression, scoring
from tallyforge.operators.joins import orphans, semi_join, star_join
from tallyforge.session import cut_lineage, ensure_checkpoint_dir
from tallyforge.sources import readers, writers
from workload import roles
from workload.analyses import INTEGRATED, integrated_frame, written_students
from workload.registry import CORR, ORACLES, PCT, R, query

S = roles.STUDENTS_SQL

# customers with gaps: a balance missing for every 7th, a segment for every 11th
GAPPY = "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS segment, CAST(NULL AS INT) AS nothing FROM customer"


def gappy(spark, sf_dir):
    return roles.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("segment"),
        F.lit(None).cast("int").alias("nothing"),
    )


@query("drop_nulls", f"SELECT c_custkey, balance, segment FROM ({GAPPY}) WHERE balance IS NOT NULL AND segment IS NOT NULL")
def drop_nulls(spark, sf_dir):
    return cleaning.drop_null_rows(cleaning.drop_empty_columns(gappy(spark, sf_dir)))


@query(
    "fill_constants",
    f"SELECT c_custkey, coalesce(balance, 2.5e0) AS balance, coalesce(segment, 'UNKNOWN') AS segment, nothing FROM ({GAPPY})",
)
def fill_constants(spark, sf_dir):
    return cleaning.fill_constants(gappy(spark, sf_dir), {"balance": 2.5, "segment": "UNKNOWN"})


@query(
    "fill_median",
    f"WITH g AS ({GAPPY}) SELECT c_custkey, coalesce(balance, (SELECT quantile_disc(balance, 0.5) FROM g)) AS balance, segment, nothing FROM g",
)
def fill_median(spark, sf_dir):
    return cleaning.fill_median(gappy(spark, sf_dir), ["balance"])


@query(
    "fill_mean_and_mode",
    f"""WITH g AS ({GAPPY}), m AS (SELECT segment FROM g WHERE segment IS NOT NULL GROUP BY segment ORDER BY COUNT(*) DESC, segment LIMIT 1)
    SELECT c_custkey, {R('coalesce(balance, (SELECT AVG(balance) FROM g))', 6)} AS balance, coalesce(segment, (SELECT segment FROM m)) AS segment, nothing FROM g""",
)
def fill_mean_and_mode(spark, sf_dir):
    filled = cleaning.fill_mode(cleaning.fill_mean(gappy(spark, sf_dir), ["balance"]), ["segment"])
    return filled.withColumn("balance", settled_round(F.col("balance"), 6))


CUBED = "SELECT c_custkey, c_acctbal * c_acctbal * c_acctbal / 1000000000 AS x, c_acctbal * c_acctbal / 1000000 AS y FROM customer"


def cubed(spark, sf_dir):
    b = F.col("c_acctbal")
    return roles.table(spark, sf_dir, "customer").select(
        "c_custkey", (b * b * b / 1000000000).alias("x"), (b * b / 1000000).alias("y")
    )


def _fence(source, column, output):
    q1, q3 = f"quantile_disc({column}, 0.25)", f"quantile_disc({column}, 0.75)"
    return f"{output} AS (SELECT t.* FROM {source} t, (SELECT {q1} AS a, {q3} AS b FROM {source}) WHERE {column} BETWEEN a - 1.5e0 * (b - a) AND b + 1.5e0 * (b - a))"


@query("outliers_removed_in_turn", f"WITH c AS ({CUBED}), {_fence('c', 'x', 'k')}, {_fence('k', 'y', 'l')} SELECT * FROM l")
def outliers_removed_in_turn(spark, sf_dir):
    return cleaning.remove_outliers(cubed(spark, sf_dir), ["x", "y"])


@query(
    "outliers_removed_together",
    f"WITH c AS ({CUBED}), {_fence('c', 'x', 'k')}, {_fence('c', 'y', 'l')} SELECT k.* FROM k JOIN l USING (c_custkey)",
)
def outliers_removed_together(spark, sf_dir):
    return cleaning.remove_outliers(cubed(spark, sf_dir), ["x", "y"], sequential=False)


@query(
    "standardised_priority",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Urgent' WHEN o_orderpriority = '5-LOW' THEN 'Low'
      ELSE o_orderpriority END AS priority_clean FROM orders""",
)
def standardised_priority(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    synonyms = {"Urgent": ["1-urgent", "2-High"], "Low": ["5-low"]}
    return cleaning.standardise(orders, "o_orderpriority", synonyms, "priority_clean", ignore_case=True).drop("o_orderpriority")


@query(
    "part_titles",
    """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
      CASE WHEN starts_with(p_type, 'STA') THEN 'Standard' WHEN starts_with(p_type, 'S') THEN 'Small' WHEN starts_with(p_type, 'L') THEN 'Large'
      ELSE 'Other' END AS category, CAST(len(string_split(p_name, ' ')) AS INT) AS words FROM part""",
)
def part_titles(spark, sf_dir):
    part = roles.table(spark, sf_dir, "part")
    prefixes = {"STA": "Standard", "S": "Small", "L": "Large"}
    name = F.concat_ws("", F.translate("p_name", " ", "_"), F.lit("!"))
    return part.select(
        "p_partkey",
        title_text(name).alias("title"),
        cleaning.prefix_category("p_type", prefixes, "Other").alias("category"),
        list_count("p_name", " ").alias("words"),
    )


@query(
    "latest_order_per_customer",
    """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders) WHERE rn = 1""",
)
def latest_order_per_customer(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    newest = -F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    return cleaning.drop_duplicates(orders, ["o_custkey"], [newest, F.col("o_orderkey")])


@query("distinct_segments", "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer")
def distinct_segments(spark, sf_dir):
    return cleaning.drop_duplicates(roles.table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey"))


@query(
    "cast_failures",
    """SELECT COUNT(*) FILTER (WHERE TRY_CAST(o_orderpriority AS INT) IS NULL) AS o_orderpriority,
      COUNT(*) FILTER (WHERE o_orderkey > 2147483647) AS o_orderkey FROM orders""",
)
def cast_failures(spark, sf_dir):
    return cleaning.cast_failures(roles.table(spark, sf_dir, "orders"), {"o_orderpriority": "int", "o_orderkey": "int"})


@query(
    "cast_columns",
    "SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE substr(o_orderpriority, 1, 1) END AS INT) AS p, CAST(o_custkey AS INT) AS o_custkey FROM orders",
)
def cast_columns(spark, sf_dir):
    digit = F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.substring("o_orderpriority", 1, 1))
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", digit.alias("p"), "o_custkey")
    return cleaning.cast_columns(orders, {"p": "int", "o_custkey": "int"})


@query(
    "parsed_dates",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders",
)
def parsed_dates(spark, sf_dir):
    text = (
        F.when(F.col("o_orderkey") % 9 == 0, "soon")
        .when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    )
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("d"))
    parsed = cleaning.parse_date(orders, "d", ["yyyy-MM-dd", "dd/MM/yyyy"])
    return parsed.withColumn("d", F.coalesce(F.col("d").cast("string"), F.lit("unknown")))


@query(
    "protected_customers",
    """SELECT c_custkey, sha256(c_name) AS c_name, regexp_replace(regexp_replace(c_mktsegment, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g') AS c_mktsegment,
      c_nationkey FROM customer""",
)
def protected_customers(spark, sf_dir):
    customer = roles.table(spark, sf_dir, "customer")
    return cleaning.protect_pii(customer, drop=["c_acctbal"], hashed=["c_name"], masked=["c_mktsegment"])


@query("range_filter", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 10 AND 40 AND l_discount BETWEEN 0.02 AND 0.08")
def range_filter(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem")
    return cleaning.keep_in_ranges(lines, {"l_quantity": (10, 40), "l_discount": (0.02, 0.08)}).select("l_orderkey", "l_linenumber")


def _md5_percent(key):
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100"


@query("hash_sample", f"SELECT o_orderkey, o_custkey FROM orders WHERE {_md5_percent('o_custkey')} < 10")
def hash_sample(spark, sf_dir):
    return cleaning.hash_sample(roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 10)


@query("train_test_split", f"SELECT c_custkey, CASE WHEN {_md5_percent('c_custkey')} % 10 < 8 THEN 'train' ELSE 'test' END AS dataset_split FROM customer")
def train_test_split(spark, sf_dir):
    return cleaning.train_test_split(roles.table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")


@query(
    "fraction_sample",
    """SELECT l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (ORDER BY substr(md5(concat_ws('|', l_orderkey, l_linenumber, '42')), 1, 15), l_orderkey, l_linenumber)
      <= (SELECT floor(COUNT(*) * 0.1 + 0.5) FROM lineitem)""",
)
def fraction_sample(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return cleaning.fraction_sample(lines, 0.1, keys=["l_orderkey", "l_linenumber"])


@query(
    "reconciled_measures",
    f"""WITH {roles.TERMS_SQL}, k AS (SELECT student_id, semester, gpa, major_gpa, student_id * 10000 + CAST(semester AS BIGINT) AS key FROM terms),
    n AS (SELECT *, gpa + (CAST('0x' || substr(md5(concat(key, '|reconcile')), 1, 12) AS BIGINT) / 281474976710656e0 * 2e0 - 1e0) * 0.3e0 AS x FROM k)
    SELECT student_id, semester, gpa, CASE WHEN abs(gpa - major_gpa) > 0.5e0 THEN {R('greatest(0, least(4, x))', 2)} ELSE major_gpa END AS major_gpa FROM n""",
)
def reconciled_measures(spark, sf_dir):
    terms = roles.terms(spark, sf_dir).select("student_id", "semester", "gpa", "major_gpa")
    keyed = terms.withColumn("key", F.col("student_id") * 10000 + F.col("semester").cast("long"))
    return cleaning.reconcile(keyed, "gpa", "major_gpa", "key", limit=0.5).drop("key")


@query(
    "orphan_labels",
    "SELECT doc_id + (doc_id % 3) * 1000000000 AS doc_id, quality FROM labels WHERE doc_id % 3 <> 0 OR doc_id NOT IN (SELECT doc_id FROM documents)",
)
def orphan_labels(spark, sf_dir):
    moved = (F.col("doc_id") + (F.col("doc_id") % 3) * 1000000000).alias("doc_id")
    labels = roles.table(spark, sf_dir, "labels").select(moved, "quality")
    return orphans(labels, "doc_id", roles.table(spark, sf_dir, "documents"), "doc_id")


@query(
    "orders_of_large_segments",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN
      (SELECT c_mktsegment FROM customer GROUP BY 1 HAVING COUNT(*) > (SELECT COUNT(*) / 5e0 FROM customer)))""",
)
def orders_of_large_segments(spark, sf_dir):
    """Two semi joins: customers of segments above the mean size, and their orders."""
    customer = roles.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    sizes = customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    limit = customer.count() / 5
    wanted = semi_join(customer, sizes.filter(F.col("n") > limit), ["c_mktsegment"])
    orders = roles.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return semi_join(orders, wanted, ["o_custkey"])


@query(
    "revenue_by_region",
    f"""SELECT r_name, l_returnflag, COUNT(*) AS n, {R('SUM(l_extendedprice * (1 - l_discount))', 2)} AS revenue FROM lineitem
      JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def revenue_by_region(spark, sf_dir):
    def dim(name, **renamed):
        return roles.table(spark, sf_dir, name).select(*[F.col(c).alias(a) for c, a in renamed.items()])

    lines = dim("lineitem", l_suppkey="supp", l_returnflag="l_returnflag", l_extendedprice="price", l_discount="discount")
    joined = star_join(
        lines,
        [
            (dim("supplier", s_suppkey="supp", s_nationkey="nation"), ["supp"]),
            (dim("nation", n_nationkey="nation", n_regionkey="region"), ["nation"]),
            (dim("region", r_regionkey="region", r_name="r_name"), ["region"]),
        ],
    )
    revenue = settled_round(F.sum(F.col("price") * (1 - F.col("discount"))), 2)
    return joined.groupBy("r_name", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), revenue.alias("revenue"))


# --- scores --------------------------------------------------------------------------------------

PROFICIENCY = R("num_ai_tools * 0.3e0 + usage_frequency_score * 0.4e0 + satisfaction_level * 0.3e0", 2)
STYLE = """CASE WHEN primary_use_case = 'Research' AND usage_frequency_score >= 4 THEN 'Research_Intensive'
  WHEN primary_use_case = 'Assignment_Help' AND satisfaction_level >= 4 THEN 'Assignment_Focused' WHEN num_ai_tools >= 3 THEN 'Multi_Tool_User'
  WHEN usage_frequency_score >= 4 THEN 'High_Frequency_User' ELSE 'Basic_User' END"""
RISK = R(
    "(CASE WHEN gpa < 2 THEN 4 WHEN gpa < 2.5e0 THEN 3 WHEN gpa < 3 THEN 2 ELSE 1 END) * 0.4e0"
    " + (CASE WHEN attendance_rate < 0.6e0 THEN 4 WHEN attendance_rate < 0.7e0 THEN 3 WHEN attendance_rate < 0.8e0 THEN 2 ELSE 1 END) * 0.3e0"
    " + (CASE WHEN assignment_submission_rate < 0.7e0 THEN 4 WHEN assignment_submission_rate < 0.8e0 THEN 3"
    " WHEN assignment_submission_rate < 0.9e0 THEN 2 ELSE 1 END) * 0.3e0",
    2,
)
SCORED = f"""s AS (SELECT *, {PROFICIENCY} AS ai_proficiency_score, {STYLE} AS learning_style, {RISK} AS academic_risk_score,
  percent_rank() OVER (PARTITION BY field_of_study ORDER BY gpa) AS relative_performance FROM students),
  t AS (SELECT *, CAST(ROUND(CAST(relative_performance * 100 AS DECIMAL(30, 15)), 1) AS DOUBLE) AS performance_percentile,
  academic_risk_score >= 3 AS at_risk_flag, CASE WHEN academic_risk_score >= 3.5 THEN 'High' WHEN academic_risk_score >= 2.5 THEN 'Medium'
  WHEN academic_risk_score >= 1.5 THEN 'Low' ELSE 'None' END AS risk_level FROM s)"""


SCORE_OUTPUTS = """student_id semester ai_proficiency_score proficiency_level learning_style learning_preference academic_risk_score at_risk_flag
  risk_level intervention_needed usage_consistency adoption_stage performance_percentile success_category improvement_potential""".split()
SCORE_INPUTS = ["student_id", "semester", "field_of_study", "gpa", "usage_frequency_score", "satisfaction_level", "num_ai_tools", "primary_use_case", "attendance_rate", "assignment_submission_rate"]


def scored(spark, sf_dir):
    return scoring.apply_all(written_students(spark, sf_dir, columns=SCORE_INPUTS), quality_fixes=False)


@query(
    "student_scores",
    f"""WITH {S}, {SCORED} SELECT student_id, semester, ai_proficiency_score, CASE WHEN ai_proficiency_score >= 4 THEN 'Expert'
      WHEN ai_proficiency_score >= 3 THEN 'Advanced' WHEN ai_proficiency_score >= 2 THEN 'Intermediate' ELSE 'Beginner' END AS proficiency_level,
      learning_style, CASE WHEN learning_style IN ('Research_Intensive', 'Multi_Tool_User') THEN 'Exploratory' WHEN learning_style = 'Assignment_Focused'
      THEN 'Task_Oriented' ELSE 'Casual' END AS learning_preference, academic_risk_score, at_risk_flag, risk_level,
      CASE risk_level WHEN 'High' THEN 'Immediate' WHEN 'Medium' THEN 'Monitor' ELSE 'None' END AS intervention_needed,
      CASE WHEN usage_frequency_score >= 4 AND satisfaction_level >= 4 THEN 'High_Consistent' WHEN usage_frequency_score >= 3 AND satisfaction_level >= 3
      THEN 'Medium_Consistent' WHEN abs(usage_frequency_score - satisfaction_level) <= 1 THEN 'Consistent' ELSE 'Inconsistent' END AS usage_consistency,
      CASE WHEN usage_frequency_score >= 4 AND num_ai_tools >= 3 THEN 'Advanced_Adopter' WHEN usage_frequency_score >= 3 AND num_ai_tools >= 2 THEN 'Regular_User'
      WHEN usage_frequency_score >= 2 THEN 'Occasional_User' ELSE 'Beginner' END AS adoption_stage, performance_percentile,
      CASE WHEN performance_percentile >= 90 THEN 'Top_Performer' WHEN performance_percentile >= 75 THEN 'High_Performer' WHEN performance_percentile >= 50
      THEN 'Average_Performer' WHEN performance_percentile >= 25 THEN 'Below_Average' ELSE 'Low_Performer' END AS success_category,
      CASE WHEN ai_proficiency_score >= 3 AND performance_percentile < 50 THEN 'High' WHEN ai_proficiency_score >= 2 AND performance_percentile < 75
      THEN 'Medium' ELSE 'Low' END AS improvement_potential FROM t""",
)
def student_scores(spark, sf_dir):
    return scored(spark, sf_dir).select(SCORE_OUTPUTS)


# students with gaps and wild values, so that the quality steps of the transforms have something to do
FLAWED_STUDENTS = """f0 AS (SELECT * REPLACE (CASE WHEN student_id % 7 = 0 THEN 2.5e0 WHEN student_id % 41 = 0 THEN gpa + 90 ELSE gpa END AS gpa,
  CASE WHEN student_id % 5 = 0 THEN 3 ELSE satisfaction_level END AS satisfaction_level,
  CASE WHEN student_id % 31 = 0 THEN usage_frequency_score + 40 ELSE usage_frequency_score END AS usage_frequency_score) FROM students)"""


def _cleaned_scores():
    fences = [_fence(f"f{i}", c, f"f{i + 1}") for i, c in enumerate(("gpa", "satisfaction_level", "usage_frequency_score"))]
    plain = ORACLES["student_scores"]
    columns = plain[plain.index("SELECT student_id, semester, ai_proficiency_score") :]
    return f"WITH {S}, {FLAWED_STUDENTS}, {', '.join(fences)}, {SCORED.replace('FROM students', 'FROM f3')} {columns}"


@query("student_scores_cleaned", _cleaned_scores())
def student_scores_cleaned(spark, sf_dir):
    """All transforms, the quality steps included."""
    key = F.col("student_id")
    rows = roles.students(spark, sf_dir).select(SCORE_INPUTS).withColumns(
        {
            "gpa": F.when(key % 7 == 0, None).when(key % 41 == 0, F.col("gpa") + 90).otherwise(F.col("gpa")),
            "satisfaction_level": F.when(key % 5 != 0, F.col("satisfaction_level")),
            "usage_frequency_score": F.when(key % 31 == 0, F.col("usage_frequency_score") + 40).otherwise(F.col("usage_frequency_score")),
        }
    )
    return scoring.apply_all(cut_lineage(rows)).select(SCORE_OUTPUTS)


@query(
    "score_summary",
    f"""WITH {S}, {SCORED} SELECT MIN(ai_proficiency_score) AS min_proficiency, MAX(ai_proficiency_score) AS max_proficiency,
      {R('AVG(ai_proficiency_score)', 6)} AS avg_proficiency, COUNT(*) FILTER (WHERE at_risk_flag) AS at_risk_count, {PCT('at_risk_flag')} AS at_risk_pct FROM t""",
)
def score_summary(spark, sf_dir):
    rows = scoring.risk(scoring.proficiency(roles.students(spark, sf_dir)))
    return scoring.score_summary(rows).withColumn("avg_proficiency", settled_round(F.col("avg_proficiency"), 6))


@query("style_distribution", f"WITH {S}, {SCORED} SELECT learning_style, COUNT(*) AS n FROM t GROUP BY learning_style")
def style_distribution(spark, sf_dir):
    return scoring.style_distribution(scoring.learning_style(roles.students(spark, sf_dir)))


@query(
    "student_scores_plain",
    f"""WITH {S} SELECT student_id, semester, {R('num_ai_tools * 0.3e0 + usage_frequency_score * 0.4e0 + satisfaction_level * 0.3e0', 6)} AS ai_proficiency_score,
      replace({STYLE}, 'High_Frequency_User', 'Basic_User') AS learning_style,
      gpa < 2.5 AND attendance_rate < 0.7e0 AND assignment_submission_rate < 0.8e0 AS at_risk_flag,
      CASE WHEN gpa < 2.5 AND attendance_rate < 0.7e0 AND assignment_submission_rate < 0.8e0 THEN CASE WHEN gpa < 2 THEN 'High' ELSE 'Medium' END
      ELSE 'None' END AS risk_level FROM students""",
)
def student_scores_plain(spark, sf_dir):
    rows = scoring.apply_all_plain(roles.students(spark, sf_dir))
    rows = rows.withColumn("ai_proficiency_score", settled_round(F.col("ai_proficiency_score"), 6))
    return rows.select("student_id", "semester", "ai_proficiency_score", "learning_style", "at_risk_flag", "risk_level")


@query(
    "workload_balance",
    f"""WITH {INTEGRATED}, w AS (SELECT student_id, semester, gpa, {R('coalesce(total_courses, 0) * 2.5e0 + coalesce(total_credits, 0) * 1.5e0 + coalesce(academic_diversity, 0) * 4e0', 2)} AS workload_score FROM i),
    c AS (SELECT *, CASE WHEN workload_score >= 60 THEN 'Heavy' WHEN workload_score >= 40 THEN 'Moderate' WHEN workload_score >= 20 THEN 'Light'
      ELSE 'Minimal' END AS workload_category FROM w)
    SELECT student_id, semester, workload_score, workload_category, CASE WHEN workload_category = 'Heavy' AND gpa >= 3.5 THEN 5
      WHEN workload_category = 'Moderate' AND gpa >= 3 THEN 4 WHEN workload_category = 'Light' AND gpa >= 2.5 THEN 3
      WHEN workload_category = 'Minimal' THEN 2 ELSE 1 END AS workload_balance_score FROM c""",
)
def workload_balance(spark, sf_dir):
    rows = scoring.workload(integrated_frame(spark, sf_dir))
    return rows.select("student_id", "semester", "workload_score", "workload_category", "workload_balance_score")


# --- data quality --------------------------------------------------------------------------------

# order lines with gaps, blanks and a repeated tenth of the rows
FLAWED = """SELECT l_orderkey, l_suppkey, CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_quantity END AS quantity, l_discount AS discount_rate,
  CASE WHEN l_orderkey % 13 = 0 THEN ' ' ELSE l_returnflag END AS flag, CASE WHEN l_orderkey % 19 = 0 THEN l_tax + 1 ELSE l_tax END AS tax_rate, l_shipdate, l_linenumber
  FROM lineitem"""
FLAWED_TWICE = f"flawed AS ({FLAWED} UNION ALL SELECT * FROM ({FLAWED}) WHERE l_orderkey % 10 = 0)"


def flawed(spark, sf_dir):
    k = F.col("l_orderkey")
    rows = roles.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        F.when(k % 17 != 0, F.col("l_quantity")).alias("quantity"),
        F.col("l_discount").alias("discount_rate"),
        F.when(k % 13 == 0, " ").otherwise(F.col("l_returnflag")).alias("flag"),
        F.when(k % 19 == 0, F.col("l_tax") + 1).otherwise(F.col("l_tax")).alias("tax_rate"),
        "l_shipdate",
        "l_linenumber",
    )
    return rows.unionByName(rows.filter(k % 10 == 0))


def _check_sql(check, column, bad, rule, judged):
    status = f"CASE WHEN COUNT(*) FILTER (WHERE {bad}) = 0 THEN 'PASS' ELSE 'FAIL' END" if judged else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT 'lines' AS table_name, '{check}' AS \"check\", '{column}' AS column_name, COUNT(*) FILTER (WHERE {bad}) AS invalid, COUNT(*) AS total,"
        f" {R(f'100.0 * CAST(COUNT(*) FILTER (WHERE {bad}) AS DOUBLE) / COUNT(*)', 2)} AS percentage, '{rule}' AS rule, {status} AS status FROM flawed"
    )


FLAWED_COLUMNS = ["l_orderkey", "l_suppkey", "quantity", "discount_rate", "flag", "tax_rate", "l_shipdate", "l_linenumber"]
PROFILE = [_check_sql("null_values", c, f"{c} IS NULL", f"{c} should be present", False) for c in FLAWED_COLUMNS] + [
    _check_sql("empty_strings", "flag", "flag IN ('''', '' '')".replace("''''", "''").replace("'' ''", "' '"), "flag should not be blank", False)
]
RULES = [
    _check_sql("quantity_range", "quantity", "quantity < 5 OR quantity > 45", "quantity should be between 5 and 45", True),
    _check_sql("tax_range", "tax_rate", "tax_rate < 0 OR tax_rate > 2", "tax_rate should be between 0 and 2", True),
    _check_sql("known_flag", "flag", "flag NOT IN ('A', 'N', 'R')", "flag should be one of [''A'', ''N'', ''R'']", True),
    _check_sql("flag_pattern", "flag", "NOT regexp_matches(flag, '^[A-Z]$')", "flag should match pattern ^[A-Z]$", True),
    _check_sql("positive_line", "l_linenumber", "l_linenumber <= 0", "l_linenumber should be positive", True),
]
CONSISTENCY = [
    _check_sql(f"{c}_range_consistency", c, f"{c} < 0 OR {c} > 1", f"{c} should be between 0 and 1", False) for c in ("discount_rate", "tax_rate")
]
DUPLICATES = f"""SELECT 'lines' AS table_name, 'duplicates' AS "check", '*' AS column_name, total - n AS invalid, total,
  {R('100.0 * CAST(total - n AS DOUBLE) / total', 2)} AS percentage, 'rows should be unique' AS rule, CAST(NULL AS VARCHAR) AS status
  FROM (SELECT (SELECT COUNT(*) FROM flawed) AS total, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM flawed)) AS n)"""


def rules():
    return quality.rules_from(
        {
            "quantity_range": {"type": "range", "column": "quantity", "min": 5, "max": 45},
            "tax_range": {"type": "range", "column": "tax_rate", "min": 0, "max": 2},
            "known_flag": {"type": "categorical", "column": "flag", "valid_values": ["A", "N", "R"]},
            "flag_pattern": {"type": "pattern", "column": "flag", "pattern": "^[A-Z]$"},
            "positive_line": {"type": "positive", "column": "l_linenumber"},
        }
    )


@query(
    "type_profile",
    "SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type FROM (DESCRIBE events)",
)
def type_profile(spark, sf_dir):
    return quality.type_profile(roles.table(spark, sf_dir, "events"))


@query("quality_profile", f"WITH {FLAWED_TWICE} " + " UNION ALL ".join([*PROFILE, DUPLICATES]))
def quality_profile(spark, sf_dir):
    df = flawed(spark, sf_dir)
    checks = [*quality.null_checks(df), *quality.blank_checks(df)]
    return quality.run_checks(df, "lines", checks).unionByName(quality.duplicate_profile(df, "lines"))


@query("quality_rules", f"WITH {FLAWED_TWICE} " + " UNION ALL ".join(RULES))
def quality_rules(spark, sf_dir):
    return quality.run_checks(flawed(spark, sf_dir), "lines", rules())


@query("quality_consistency", f"WITH {FLAWED_TWICE} " + " UNION ALL ".join(CONSISTENCY))
def quality_consistency(spark, sf_dir):
    df = flawed(spark, sf_dir)
    return quality.run_checks(df, "lines", quality.consistency_checks(df))


@query(
    "quality_date_order",
    f"""SELECT 'lines' AS table_name, 'shipped_after_order' AS "check", COUNT(*) FILTER (WHERE o_orderdate > l_shipdate) AS invalid, COUNT(*) AS total,
      {R('100.0 * CAST(COUNT(*) FILTER (WHERE o_orderdate > l_shipdate) AS DOUBLE) / COUNT(*)', 2)} AS percentage
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def quality_date_order(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate").join(orders, "l_orderkey")
    check = quality.order_rule("shipped_after_order", "o_orderdate", "l_shipdate")
    return quality.run_checks(joined, "lines", [check]).select("table_name", "check", "invalid", "total", "percentage")


@query(
    "quality_agreement",
    f"""WITH {roles.TERMS_SQL} SELECT 'gpa_consistency' AS "check", COUNT(*) FILTER (WHERE abs(gpa - major_gpa) > 1e0) AS invalid, COUNT(*) AS total FROM terms""",
)
def quality_agreement(spark, sf_dir):
    terms = roles.terms(spark, sf_dir).select("gpa", "major_gpa")
    return quality.run_checks(terms, "terms", quality.consistency_checks(terms, limit=1.0)).select("check", "invalid", "total")


REFERENCE = f"""SELECT 'labels' AS table_name, 'reference' AS "check", 'ref' AS column_name, COUNT(*) FILTER (WHERE ref NOT IN (SELECT doc_id FROM documents)) AS invalid,
  COUNT(ref) AS total, {R('100.0 * CAST(COUNT(*) FILTER (WHERE ref NOT IN (SELECT doc_id FROM documents)) AS DOUBLE) / COUNT(ref)', 2)} AS percentage,
  'ref must exist in documents.doc_id' AS rule, 'FAIL' AS status
  FROM (SELECT CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN -doc_id - 1 ELSE doc_id END AS ref FROM labels)"""


@query("quality_references", REFERENCE)
def quality_references(spark, sf_dir):
    d = F.col("doc_id")
    ref = F.when(d % 4 == 0, None).when(d % 5 == 0, -d - 1).otherwise(d)
    labels = roles.table(spark, sf_dir, "labels").select(ref.alias("ref"))
    return quality.reference_check(labels, "ref", roles.table(spark, sf_dir, "documents"), "doc_id", "labels", "documents")


def _outlier_sql(column):
    stats = f"(SELECT AVG({column}) AS m, STDDEV({column}) AS s, quantile_disc({column}, 0.25) AS a, quantile_disc({column}, 0.75) AS b FROM c)"
    return f"""SELECT '{column}' AS column_name, COUNT(*) FILTER (WHERE abs(({column} - m) / s) > 2.5) AS zscore_outliers,
      COUNT(*) FILTER (WHERE {column} < a - 1.5e0 * (b - a) OR {column} > b + 1.5e0 * (b - a)) AS iqr_outliers, {R('ANY_VALUE(m)', 4)} AS mean,
      {R('ANY_VALUE(s)', 4)} AS stddev, {R('ANY_VALUE(a)', 4)} AS q1, {R('ANY_VALUE(b)', 4)} AS q3 FROM c, {stats}"""


@query("quality_outliers", f"WITH c AS ({CUBED}) " + " UNION ALL ".join(_outlier_sql(c) for c in ("x", "y")))
def quality_outliers(spark, sf_dir):
    return quality.outlier_profile(cubed(spark, sf_dir), ["x", "y"], z_limit=2.5)


SEVERITY = """CASE WHEN "check" = 'null_values' AND percentage > 50 THEN 'critical' WHEN "check" = 'null_values' AND percentage > 5 THEN 'warning'
  WHEN "check" = 'duplicates' AND percentage > 20 THEN 'critical' WHEN "check" = 'duplicates' AND percentage > 5 THEN 'warning'
  WHEN status = 'FAIL' AND percentage > 10 THEN 'critical' WHEN status = 'FAIL' THEN 'warning' END"""
REPORT = "report AS (" + " UNION ALL ".join([*PROFILE, *RULES, *CONSISTENCY, DUPLICATES]) + ")"


def report(spark, sf_dir):
    return quality.full_report(flawed(spark, sf_dir), "lines", rules(), outliers=False)


@query("quality_report", f"WITH {FLAWED_TWICE}, {REPORT} SELECT * FROM report")
def quality_report(spark, sf_dir):
    return report(spark, sf_dir)


@query(
    "quality_verdict",
    f"""WITH {FLAWED_TWICE}, {REPORT}, s AS (SELECT *, {SEVERITY} AS severity FROM report)
    SELECT COUNT(DISTINCT table_name) AS total_tables_checked, COUNT(*) FILTER (WHERE severity = 'critical') AS critical_issues_count,
      COUNT(*) FILTER (WHERE severity = 'warning') AS warnings_count,
      CASE WHEN COUNT(*) FILTER (WHERE severity = 'critical') > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status FROM s""",
)
def quality_verdict(spark, sf_dir):
    return quality.verdict(cut_lineage(report(spark, sf_dir)), null_limits=(50.0, 5.0))


@query(
    "quality_recommendations",
    f"""WITH {FLAWED_TWICE}, {REPORT} SELECT "check", column_name, percentage, CASE WHEN "check" = 'null_values' THEN 'review data collection or set a default'
      ELSE 'remove duplicates or enforce a unique key' END AS recommendation FROM report
      WHERE ("check" = 'null_values' AND percentage > 20) OR ("check" = 'duplicates' AND percentage > 5)""",
)
def quality_recommendations(spark, sf_dir):
    return quality.recommendations(report(spark, sf_dir)).select("check", "column_name", "percentage", "recommendation")


BROKEN = "SELECT 'lines', 'no_such_column', 'warehouse', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), 'ERROR', 'ERROR'"
FAR = [
    _check_sql("zscore_outliers", c, f"abs(({c} - (SELECT AVG({c}) FROM flawed)) / (SELECT STDDEV({c}) FROM flawed)) > 3", "values should lie within three standard deviations", False)
    for c in ("l_orderkey", "l_suppkey", "quantity", "discount_rate", "tax_rate", "l_linenumber")
]
PARENTS = f"""SELECT 'lines' AS table_name, 'reference' AS "check", 'l_suppkey' AS column_name, COUNT(*) FILTER (WHERE bad) AS invalid, COUNT(*) AS total,
  {R('100.0 * CAST(COUNT(*) FILTER (WHERE bad) AS DOUBLE) / COUNT(*)', 2)} AS percentage, 'l_suppkey must exist in some.s_suppkey' AS rule,
  CASE WHEN COUNT(*) FILTER (WHERE bad) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM (SELECT l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey > 2) AS bad FROM flawed)"""
WHOLE_REPORT = "report AS (" + " UNION ALL ".join([*PROFILE, *RULES, RULES[0], *CONSISTENCY, DUPLICATES, *FAR, PARENTS, BROKEN]) + ")"


def whole_report(spark, sf_dir):
    """Every leg: outliers, references, a rule named twice and one that cannot run."""
    extra = [rules()[0], quality.range_rule("no_such_column", "warehouse", 0, 1)]
    some = roles.table(spark, sf_dir, "supplier").filter("s_nationkey > 2")
    return quality.full_report(flawed(spark, sf_dir), "lines", [*rules(), *extra], [("l_suppkey", some, "s_suppkey", "some")])


@query("quality_full_report", f"""WITH {FLAWED_TWICE}, {WHOLE_REPORT} SELECT table_name, "check", column_name, invalid, total, percentage, status FROM report""")
def quality_full_report(spark, sf_dir):
    return whole_report(spark, sf_dir).drop("rule")


@query(
    "quality_full_verdict",
    f"""WITH {FLAWED_TWICE}, {WHOLE_REPORT}, s AS (SELECT *, {SEVERITY.replace("status = 'FAIL' THEN", "status IN ('FAIL', 'ERROR') THEN")} AS severity FROM report)
    SELECT COUNT(DISTINCT table_name) AS total_tables_checked, COUNT(*) FILTER (WHERE severity = 'critical') AS critical_issues_count,
      COUNT(*) FILTER (WHERE severity = 'warning') AS warnings_count,
      CASE WHEN COUNT(*) FILTER (WHERE severity = 'critical') > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status FROM s""",
)
def quality_full_verdict(spark, sf_dir):
    return quality.verdict(whole_report(spark, sf_dir), null_limits=(50.0, 5.0))


@query(
    "quality_strict_verdict",
    f"""WITH {FLAWED_TWICE}, {WHOLE_REPORT} SELECT CASE WHEN COUNT(*) FILTER (WHERE ("check" = 'null_values' AND percentage > 20)
      OR ("check" = 'duplicates' AND percentage > 10)) > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status FROM report""",
)
def quality_strict_verdict(spark, sf_dir):
    return quality.strict_verdict(whole_report(spark, sf_dir))


@query(
    "quality_outlier_advice",
    f"""WITH {FLAWED_TWICE}, {WHOLE_REPORT} SELECT column_name, invalid, 'examine outliers and tighten validation' AS recommendation
      FROM report WHERE "check" = 'zscore_outliers' AND invalid > 0""",
)
def quality_outlier_advice(spark, sf_dir):
    advice = quality.recommendations(whole_report(spark, sf_dir)).filter(F.col("check") == "zscore_outliers")
    return advice.select("column_name", "invalid", "recommendation")


@query(
    "quality_gate",
    f"""WITH {FLAWED_TWICE}, d AS (SELECT 'flawed' AS source, (SELECT COUNT(*) FROM flawed) AS n, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM flawed)) AS u
      UNION ALL SELECT 'supplier', (SELECT COUNT(*) FROM supplier), (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM supplier)))
    SELECT source, 100.0 * CAST(n - u AS DOUBLE) / n > 5 AS refused FROM d""",
)
def quality_gate(spark, sf_dir):
    """Which of two sources the gate refuses for its duplicates."""
    sources = {"flawed": flawed(spark, sf_dir), "supplier": roles.table(spark, sf_dir, "supplier")}
    rows = []
    for name, df in sources.items():
        try:
            quality.assert_quality(df, name, max_duplicate_pct=5.0)
            rows.append((name, False))
        except quality.QualityError:
            rows.append((name, True))
    return spark.createDataFrame(rows, "source string, refused boolean")


@query(
    "quality_declared_rules",
    f"""WITH {FLAWED_TWICE} SELECT 'required_column' AS "check", 'warehouse' AS column_name, CAST(NULL AS BIGINT) AS invalid
    UNION ALL SELECT 'null_tolerance', 'quantity', COUNT(*) FILTER (WHERE quantity IS NULL) FROM flawed
    UNION ALL SELECT 'score_range', 'quantity', COUNT(*) FILTER (WHERE quantity < 0 OR quantity > 40) FROM flawed
    UNION ALL SELECT 'range_check', 'tax_rate', COUNT(*) FILTER (WHERE tax_rate < 0 OR tax_rate > 1) FROM flawed
    UNION ALL SELECT 'positive_value', 'discount_rate', COUNT(*) FILTER (WHERE discount_rate <= 0) FROM flawed
    UNION ALL SELECT 'duplicates', 'l_orderkey', COUNT(*) - COUNT(DISTINCT l_orderkey) FROM flawed""",
)
def quality_declared_rules(spark, sf_dir):
    declared = {
        "required_columns": ["l_orderkey", "warehouse"],
        "null_tolerance": {"quantity": 0.0, "flag": 0.0},
        "score_range": {"min": 0, "max": 40, "columns": ["quantity"]},
        "range_checks": {"tax_rate": {"min": 0, "max": 1}},
        "positive_values": ["discount_rate", "l_linenumber"],
        "duplicate_check": ["l_orderkey"],
    }
    return quality.declared_issues(flawed(spark, sf_dir), "lines", declared).select("check", "column_name", "invalid")


@query(
    "quality_json_report",
    f"""WITH {FLAWED_TWICE}, {REPORT}, s AS (SELECT *, {SEVERITY.replace('> 5 THEN', '> 20 THEN', 1)} AS severity FROM report)
    SELECT table_name, CASE WHEN COUNT(*) FILTER (WHERE severity = 'critical') > 0 THEN 'FAIL' ELSE 'PASS' END AS overall_status,
      COUNT(*) FILTER (WHERE severity = 'warning') AS warnings_count, CAST(SUM(invalid) AS BIGINT) AS invalid, COUNT(*) AS checks,
      (SELECT COUNT(*) FROM flawed) AS total_rows, (SELECT CAST(len(json_keys(to_json(f))) AS BIGINT) FROM flawed f LIMIT 1) AS total_columns, TRUE AS timed FROM s GROUP BY 1""",
)
def quality_json_report(spark, sf_dir):
    """The nested report is written as JSON and read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    totals = quality.table_totals({"lines": flawed(spark, sf_dir)})
    document = quality.report_document(report(spark, sf_dir), totals, datetime.now(timezone.utc))
    writers.write_json(document, path)
    return readers.read_json(spark, path, document.schema).select(
        "table_name",
        "summary.overall_status",
        "summary.warnings_count",
        F.aggregate("checks", F.lit(0).cast("long"), lambda total, c: total + c["invalid"]).alias("invalid"),
        F.size("checks").cast("long").alias("checks"),
        "summary.total_rows",
        F.col("summary.total_columns").cast("long").alias("total_columns"),
        (F.col("summary.run_seconds") >= 0).alias("timed"),
    )


@query(
    "category_advice",
    """SELECT 'c_mktsegment' AS column_name, CAST(MAX(length(c_mktsegment)) AS INT) AS max_length, COUNT(DISTINCT c_mktsegment) AS distinct_values
      FROM customer""",
)
def category_advice(spark, sf_dir):
    return quality.category_advice(roles.table(spark, sf_dir, "customer"))


# --- modeling ------------------------------------------------------------------------------------


@query(
    "ab_comparison",
    f"""WITH s AS (SELECT COUNT(*) FILTER (WHERE event_type = 'view') AS n_a, COUNT(*) FILTER (WHERE event_type = 'click') AS n_b,
      AVG(value) FILTER (WHERE event_type = 'view') AS a, AVG(value) FILTER (WHERE event_type = 'click') AS b,
      var_samp(value) FILTER (WHERE event_type = 'view') AS va, var_samp(value) FILTER (WHERE event_type = 'click') AS vb FROM events)
    SELECT n_a, n_b, {R('a', 6)} AS mean_a, {R('b', 6)} AS mean_b, {R('b - a', 6)} AS difference, {R('(b - a) / sqrt(va / n_a + vb / n_b)', 6)} AS t_statistic,
      {R('power(va / n_a + vb / n_b, 2) / (power(va / n_a, 2) / (n_a - 1) + power(vb / n_b, 2) / (n_b - 1))', 4)} AS degrees_of_freedom FROM s""",
)
def ab_comparison(spark, sf_dir):
    out = modeling.ab_test(roles.table(spark, sf_dir, "events"), "event_type", "view", "click", "value")
    names = ["mean_a", "mean_b", "difference", "t_statistic"]
    out = out.withColumns({n: settled_round(F.col(n), 6) for n in names})
    return out.withColumn("degrees_of_freedom", settled_round(F.col("degrees_of_freedom"), 4))


@query(
    "balance_drift",
    f"""WITH b AS (SELECT c_acctbal AS v FROM customer WHERE c_nationkey < 12), c AS (SELECT c_acctbal + 200 AS v FROM customer WHERE c_nationkey >= 12),
    e AS (SELECT unnest([{', '.join(f'quantile_disc(v, {i / 5})' for i in range(1, 5))}]) AS edge FROM b),
    bb AS (SELECT (SELECT COUNT(*) FROM e WHERE edge <= v) AS bin, COUNT(*) AS n, SUM(v) AS s FROM b GROUP BY 1),
    cc AS (SELECT (SELECT COUNT(*) FROM e WHERE edge <= v) AS bin, COUNT(*) AS n, SUM(v) AS s FROM c GROUP BY 1),
    j AS (SELECT bin, bb.n AS base_n, cc.n AS current_n, bb.n / CAST(SUM(bb.n) OVER () AS DOUBLE) AS p, cc.n / CAST(SUM(cc.n) OVER () AS DOUBLE) AS q,
      SUM(cc.s) OVER () / SUM(cc.n) OVER () - SUM(bb.s) OVER () / SUM(bb.n) OVER () AS shift FROM bb JOIN cc USING (bin))
    SELECT CAST(bin AS INT) AS bin, base_n, current_n, {R('p', 6)} AS base_share, {R('q', 6)} AS current_share, {R('(q - p) * ln(q / p)', 6)} AS psi,
      {R('shift', 4)} AS mean_shift FROM j""",
)
def balance_drift(spark, sf_dir):
    customer = roles.table(spark, sf_dir, "customer")
    base = customer.filter(F.col("c_nationkey") < 12)
    current = customer.filter(F.col("c_nationkey") >= 12).withColumn("c_acctbal", F.col("c_acctbal") + 200)
    out = modeling.drift(base, current, "c_acctbal", bins=5)
    out = out.withColumns({n: settled_round(F.col(n), 6) for n in ("base_share", "current_share", "psi")})
    return out.withColumn("mean_shift", settled_round(F.col("mean_shift"), 4))


FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query(
    "feature_correlations",
    " UNION ALL ".join(f"SELECT '{f}' AS feature, {R(CORR(f, 'l_extendedprice'), 6)} AS correlation FROM lineitem" for f in FEATURES),
)
def feature_correlations(spark, sf_dir):
    out = modeling.rank_features(roles.table(spark, sf_dir, "lineitem"), "l_extendedprice", FEATURES)
    return out.withColumn("correlation", settled_round(F.col("correlation"), 6))


@query("regression_grid")
def regression_grid(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem")
    model = modeling.fit_regression(lines, ["l_quantity", "l_discount"], "l_extendedprice", {"regParam": [0.0, 1.0]}, folds=2)
    return modeling.grid_scores(model, lines)


# every 13th line has no quantity; folds go by order, the ridge is that of standardised features
_MOMENTS = ", ".join(
    ["COUNT(*) AS n"] + [f"AVG({v}) AS m{v}, stddev_pop({v}) AS s{v}" for v in "xzy"] + [f"covar_pop({a}, {b}) AS c{a}{b}" for a, b in ("xz", "xy", "zy")]
)
_PARTS = "cxz / (sx * sz) AS rxz, cxy / (sx * sy) AS rxy, czy / (sz * sy) AS rzy, 1 + reg_param / sy AS d"
_BETAS = "(d * rxy - rxz * rzy) / (d * d - rxz * rxz) * sy / sx AS bx, (d * rzy - rxz * rxy) / (d * d - rxz * rxz) * sy / sz AS bz"


@query(
    "regression_folds",
    f"""WITH r AS (SELECT l_orderkey % 3 AS fold, CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_quantity END AS x, l_discount AS z, l_extendedprice AS y FROM lineitem),
    k AS (SELECT * FROM r WHERE x IS NOT NULL), g AS (SELECT unnest([0.0, 1000.0, 50000.0]) AS reg_param),
    t AS (SELECT f.fold, (SELECT COUNT(*) FROM k) AS whole, m.* FROM (SELECT DISTINCT fold FROM k) f, LATERAL (SELECT {_MOMENTS} FROM k WHERE k.fold <> f.fold) m),
    b AS (SELECT fold, reg_param, mx, mz, my, {_BETAS} FROM (SELECT *, {_PARTS} FROM t, g)),
    e AS (SELECT b.reg_param, b.fold, sqrt(AVG(power(k.y - b.my - b.bx * (k.x - b.mx) - b.bz * (k.z - b.mz), 2))) AS rmse FROM b JOIN k ON k.fold = b.fold GROUP BY 1, 2),
    a AS (SELECT reg_param, mx, mz, my, {_BETAS} FROM (SELECT *, {_PARTS} FROM (SELECT {_MOMENTS} FROM k), g))
    SELECT CAST(a.reg_param AS DOUBLE) AS reg_param, {R('AVG(e.rmse)', 4)} AS rmse, {R('ANY_VALUE(a.my - a.bx * a.mx - a.bz * a.mz)', 4)} AS intercept, {R('ANY_VALUE(a.bx)', 5)} AS quantity, {R('ANY_VALUE(a.bz)', 3)} AS discount,
      (SELECT COUNT(*) FROM k) AS rows_used, (SELECT COUNT(*) FROM r WHERE x IS NULL) AS rows_left_out
    FROM a JOIN e ON e.reg_param = a.reg_param GROUP BY a.reg_param""",
)
def regression_folds(spark, sf_dir):
    quantity = F.when(F.col("l_orderkey") % 13 != 0, F.col("l_quantity"))
    lines = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", quantity.alias("quantity"), F.col("l_discount").alias("discount"), "l_extendedprice")
    out = regression.cross_validated(lines, ["quantity", "discount"], "l_extendedprice", F.col("l_orderkey") % 3, [0.0, 1000.0, 50000.0])
    return out.select(
        "reg_param",
        settled_round(F.col("rmse"), 4).alias("rmse"),
        settled_round(F.col("intercept"), 4).alias("intercept"),
        settled_round(F.col("coefficients")["quantity"], 5).alias("quantity"),
        settled_round(F.col("coefficients")["discount"], 3).alias("discount"),
        "rows_used",
        "rows_left_out",
    )
