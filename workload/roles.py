"""Driver tables in the roles of the student tables, as DataFrames and as the same definitions in SQL.

Customers play students, order years play terms, order lines play exam results and enrolments,
suppliers play schools, events play survey answers and activity. Everything is derived from whole
tables; sums that decide a class or a rank are made of integers, so both engines agree exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: names given to driver codes ---------------------------------------------------
GRADES = {"AF": "A+", "AO": "A", "NF": "B+", "NO": "B", "RF": "C+", "RO": "D"}
EDUCATION = [
    "some high school",
    "high school",
    "some college",
    "associate degree",
    "bachelor degree",
    "master degree",
]
REGIONS = ["urban", "suburban", "rural"]
SCHOOL_TYPES = ["public", "private", "charter"]
USE_CASES = ["Research", "Assignment_Help", "Exam_Prep"]
INTERNET = ["high", "medium", "low"]
DEVICES = ["Mobile", "Laptop", "Tablet"]
FREQUENCY_FROM = [(75, "Daily"), (68, "Weekly"), (62, "Monthly"), (55, "Rarely")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(number: str, names: list[str]) -> str:
    """SQL: one of the names by a number modulo their count; the same text serves both engines."""
    whens = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE CAST(({number}) % {len(names)} AS INT) {whens} END"


_CENTS = "CAST(round({0} * 100) AS BIGINT)"

# One text per derived column; DuckDB and Spark read the same expressions.
_TERM = {
    "gpa": f"CAST(SUM({_CENTS.format('o_totalprice')}) AS DOUBLE) / (CAST(COUNT(*) AS DOUBLE) * 12500000)",
    "major_gpa": f"CAST(MAX({_CENTS.format('o_totalprice')}) AS DOUBLE) / 12500000",
    "credits_completed": "CAST(COUNT(*) AS INT)",
    "attendance_rate": "CAST(SUM(CASE o_orderstatus WHEN 'F' THEN 10 WHEN 'O' THEN 8 ELSE 5 END) AS DOUBLE)"
    " / (CAST(COUNT(*) AS DOUBLE) * 10)",
    "assignment_submission_rate": "CAST(SUM(CASE substr(o_orderpriority, 1, 1) WHEN '5' THEN 6 WHEN '4' THEN 8 ELSE 10 END)"
    " AS DOUBLE) / (CAST(COUNT(*) AS DOUBLE) * 10)",
    "usage_frequency_score": "CAST(1 + MAX(o_orderkey) % 5 AS INT)",
    "satisfaction_level": "CAST(1 + MIN(o_orderkey) % 5 AS INT)",
    "num_ai_tools": "CAST(1 + SUM(o_orderkey % 7) % 5 AS INT)",
    "primary_use_case": _pick("MAX(o_orderkey)", USE_CASES),
    "last_updated": "CAST(CAST(MAX(o_orderdate) AS DATE) AS STRING)",
}


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (student, term): the orders of a customer in a year."""
    orders = table(spark, sf_dir, "orders").withColumn("semester", F.year("o_orderdate").cast("string"))
    return orders.groupBy(F.col("o_custkey").alias("student_id"), "semester").agg(
        *[F.expr(e).alias(n) for n, e in _TERM.items()]
    )


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms with the student's field and year: the wide table most analyses read."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("student_id"),
        F.col("c_mktsegment").alias("field_of_study"),
        F.expr("CAST(c_nationkey % 4 + 1 AS INT)").alias("year_of_study"),
    )
    return customer.join(terms(spark, sf_dir), "student_id")


TERMS_SQL = (
    "terms AS (SELECT o_custkey AS student_id, CAST(year(o_orderdate) AS VARCHAR) AS semester, "
    + ", ".join(f"{e} AS {n}" for n, e in _TERM.items())
    + " FROM orders GROUP BY o_custkey, CAST(year(o_orderdate) AS VARCHAR))"
)
STUDENTS_SQL = (
    TERMS_SQL
    + ", students AS (SELECT c_mktsegment AS field_of_study, CAST(c_nationkey % 4 + 1 AS INT) AS year_of_study, t.*"
    " FROM customer JOIN terms t ON c_custkey = t.student_id)"
)

_FREQUENCY = "CASE " + " ".join(f"WHEN n >= {k} THEN '{w}'" for k, w in FREQUENCY_FROM) + " ELSE 'Never' END"
_USE_CASE = _pick("purchases", USE_CASES)


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One usage answer per active user: event types as tools, event count as frequency."""
    per_user = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("student_id"))
        .agg(
            F.concat_ws(",", F.sort_array(F.collect_set("event_type"))).alias("ai_tools_used"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("event_type") == "purchase").alias("purchases"),
            F.expr("CAST(1 + SUM(event_id) % 5 AS INT)").alias("satisfaction_level"),
        )
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("student_id"),
        F.col("c_mktsegment").alias("field_of_study"),
        F.expr("CAST(c_nationkey % 4 + 1 AS INT)").alias("year_of_study"),
    )
    return customer.join(per_user, "student_id").select(
        "student_id",
        "field_of_study",
        "year_of_study",
        "ai_tools_used",
        F.expr(_FREQUENCY).alias("frequency_of_use"),
        "satisfaction_level",
        F.expr(_USE_CASE).alias("primary_use_case"),
    )


USAGE_SQL = (
    "usage AS (SELECT c_custkey AS student_id, c_mktsegment AS field_of_study, CAST(c_nationkey % 4 + 1 AS INT) AS year_of_study,"
    f" tools AS ai_tools_used, {_FREQUENCY} AS frequency_of_use, satisfaction_level, {_USE_CASE} AS primary_use_case"
    " FROM customer JOIN (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tools, COUNT(*) AS n,"
    " COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases, CAST(1 + SUM(event_id) % 5 AS INT) AS satisfaction_level"
    " FROM events GROUP BY user_id) ON c_custkey = user_id)"
)

_GRADE = "CASE l_returnflag || l_linestatus " + " ".join(f"WHEN '{k}' THEN '{g}'" for k, g in GRADES.items()) + " END"


def enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: the part is the course, its type the department."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("o_custkey").alias("student_id"),
        F.col("y").cast("string").alias("semester"),
        F.col("p_brand").alias("course_code"),
        F.translate("p_name", " ", "_").alias("course_name"),
        F.col("p_type").alias("department"),
        F.expr(_GRADE).alias("grade"),
        F.expr("3 + CAST(l_quantity AS INT) % 2").alias("credit_hours"),
    )


ENROLLMENT_SQL = (
    "enrollment AS (SELECT o_custkey AS student_id, CAST(year(o_orderdate) AS VARCHAR) AS semester, p_brand AS course_code,"
    f" replace(p_name, ' ', '_') AS course_name, p_type AS department, {_GRADE} AS grade,"
    " 3 + CAST(l_quantity AS INT) % 2 AS credit_hours"
    " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"
)

_SCORES = {
    "student_id": "l_orderkey * 10 + l_linenumber",
    "school_id": "l_suppkey",
    "gender": "CASE l_linestatus WHEN 'F' THEN 'female' ELSE 'male' END",
    "race_ethnicity": "concat('group ', l_returnflag)",
    "parental_level_of_education": _pick("l_linenumber", EDUCATION),
    "lunch": "CASE WHEN l_quantity > 20 THEN 'standard' ELSE 'free/reduced' END",
    "test_preparation_course": "CASE WHEN month(l_shipdate) % 3 = 0 THEN 'completed' ELSE 'none' END",
    "math_score": "CAST(round(l_quantity * 2) AS INT)",
    "reading_score": "CAST(round(l_discount * 1000) AS INT)",
    "writing_score": "100 - CAST(round(l_tax * 1000) AS INT)",
}


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exam result per order line."""
    rows = table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(n) for n, e in _SCORES.items()])
    total = F.col("math_score") + F.col("reading_score") + F.col("writing_score")
    return rows.withColumns({"total_score": total, "average_score": F.round(total / 3, 1)})


SCORES_SQL = (
    "scores AS (SELECT *, math_score + reading_score + writing_score AS total_score,"
    " round(CAST(math_score + reading_score + writing_score AS DOUBLE) / 3, 1) AS average_score FROM (SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in _SCORES.items())
    + " FROM lineitem))"
)

_SCHOOL = {
    "school_id": "s_suppkey",
    "school_name": "s_name",
    "school_type": _pick("s_suppkey", SCHOOL_TYPES),
    "region": _pick("n_regionkey", REGIONS),
    "student_count": "CAST(200 + (s_suppkey * 37) % 2800 AS INT)",
    "teacher_count": "CAST(10 + (s_suppkey * 11) % 90 AS INT)",
    "student_teacher_ratio": "10.5E0 + s_suppkey % 16",
    "budget_per_student": "CAST(7000 + round(abs(s_acctbal)) AS INT)",
    "technology_score": "CAST(1 + s_suppkey % 9 AS INT)",
    "facility_score": "CAST(1 + (s_suppkey * 7) % 9 AS INT)",
}


def schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select(*[F.expr(e).alias(n) for n, e in _SCHOOL.items()])


SCHOOLS_SQL = (
    "schools AS (SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in _SCHOOL.items())
    + " FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
)


def _share(condition: str) -> str:
    """Tenths of a per cent as an integer quotient, so that both engines round alike."""
    return f"CAST(floor(CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS DOUBLE) * 1000 / COUNT(*)) AS DOUBLE) / 10"


_ECONOMICS = {
    "median_household_income": f"CAST(floor(30000 + CAST(SUM({_CENTS.format('c_acctbal')}) AS DOUBLE) / COUNT(*) / 20) AS INT)",
    "unemployment_rate": _share("c_acctbal < 0"),
    "poverty_rate": _share("c_acctbal < 1500"),
    "college_graduation_rate": _share("c_acctbal > 5000"),
    "internet_access_rate": _share("c_acctbal > 500"),
}


def economics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per region from the balances of its customers."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy(F.expr(_pick("n_regionkey", REGIONS)).alias("region")).agg(
        *[F.expr(e).alias(n) for n, e in _ECONOMICS.items()]
    )


ECONOMICS_SQL = (
    f"economics AS (SELECT {_pick('n_regionkey', REGIONS)} AS region, "
    + ", ".join(f"{e} AS {n}" for n, e in _ECONOMICS.items())
    + f" FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY {_pick('n_regionkey', REGIONS)})"
)

_SURVEY = {
    "response_id": "event_id",
    "stream": "c_mktsegment",
    "year_of_study": "CAST(c_nationkey % 4 + 1 AS INT)",
    "daily_usage_hours": "value / 60",
    "trust_in_ai_tools": "1 + event_id % 5",
    "impact_on_grades": "(user_id * 5 + event_id) % 7 - 3",
    "preferred_ai_tool": "event_type",
    "state": "n_name",
    "device_used": _pick("event_id", DEVICES),
    "internet_access": _pick("user_id", INTERNET),
    "do_professors_allow_use": "CASE WHEN (user_id + event_id) % 2 = 0 THEN 'Yes' ELSE 'No' END",
    "awareness_level": "1 + k % 10",
}


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey answer per event of a known customer; awareness comes from the JSON payload."""
    events = table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k int")["k"])
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = events.join(customer, F.col("user_id") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(*[F.expr(e).alias(n) for n, e in _SURVEY.items()])


SURVEY_SQL = (
    "survey AS (SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in _SURVEY.items())
    + " FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)"
    " JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
)
