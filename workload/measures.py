"""Exam score, school, survey and dashboard analyses."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyforge.functions.expr import band, settled_round
from tallyforge.operators import aggregates
from tallyforge.operators.joins import assign_weighted
from tallyforge.plans import integration, schools, scores, survey
from tallyforge.session import cut_lineage, ensure_checkpoint_dir
from workload import roles
from workload.registry import CORR, PCT, R, query

SC = roles.SCORES_SQL
MEANS = ", ".join(f"{R(f'AVG({c}_score)', 2)} AS avg_{c}" for c in ("math", "reading", "writing"))


@query(
    "basic_statistics",
    f"""WITH {SC} SELECT COUNT(*) AS total_students, {MEANS}, {R('AVG(average_score)', 2)} AS overall_avg,
      {R('STDDEV(average_score)', 2)} AS score_stddev FROM scores""",
)
def basic_statistics(spark, sf_dir):
    return scores.basic_statistics(roles.scores(spark, sf_dir))


@query(
    "gender_comparison",
    f"""WITH {SC} SELECT gender, COUNT(*) AS student_count, {MEANS}, {R('AVG(average_score)', 2)} AS avg_total,
      {R('AVG(reading_score) - AVG(math_score)', 2)} AS reading_math_diff FROM scores GROUP BY gender""",
)
def gender_comparison(spark, sf_dir):
    return scores.group_comparison(roles.scores(spark, sf_dir))


@query(
    "education_impact",
    f"""WITH {SC}, s AS (SELECT parental_level_of_education, COUNT(*) AS student_count, AVG(average_score) AS m,
      {R('STDDEV(average_score)', 2)} AS score_stddev, {PCT('average_score >= 80')} AS high_scorer_pct FROM scores GROUP BY 1)
    SELECT * EXCLUDE (m), {R('m', 2)} AS avg_score, rank() OVER (ORDER BY m DESC) AS education_rank FROM s""",
)
def education_impact(spark, sf_dir):
    return scores.group_impact(roles.scores(spark, sf_dir))


@query(
    "preparation_effect",
    f"""WITH {SC}, s AS (SELECT test_preparation_course, gender, COUNT(*) AS student_count, {MEANS}, AVG(average_score) AS m
      FROM scores GROUP BY 1, 2)
    SELECT * EXCLUDE (m), {R('m', 2)} AS avg_total, {R('m - AVG(m) OVER (PARTITION BY gender)', 2)} AS prep_effect FROM s""",
)
def preparation_effect(spark, sf_dir):
    return scores.treatment_effect(roles.scores(spark, sf_dir))


@query(
    "lunch_effect",
    f"""WITH {SC}, s AS (SELECT lunch, race_ethnicity, COUNT(*) AS student_count, AVG(average_score) AS m, STDDEV(average_score) AS sd
      FROM scores GROUP BY 1, 2)
    SELECT lunch, race_ethnicity, student_count, {R('m', 2)} AS avg_score, {R('sd', 2)} AS score_stddev,
      {R('m - AVG(m) OVER ()', 2)} AS vs_overall_avg, {R('m - AVG(m) OVER (PARTITION BY race_ethnicity)', 2)} AS within_race_effect FROM s""",
)
def lunch_effect(spark, sf_dir):
    return scores.two_factor_effect(roles.scores(spark, sf_dir))


@query(
    "grade_distribution",
    f"""WITH {SC}, s AS (SELECT CASE WHEN average_score >= 90 THEN 'A (90-100)' WHEN average_score >= 80 THEN 'B (80-89)'
      WHEN average_score >= 70 THEN 'C (70-79)' WHEN average_score >= 60 THEN 'D (60-69)' ELSE 'F (Below 60)' END AS grade_range,
      COUNT(*) AS student_count, {MEANS} FROM scores GROUP BY 1)
    SELECT *, {R('100.0 * CAST(student_count AS DOUBLE) / SUM(student_count) OVER ()', 1)} AS percentage FROM s""",
)
def grade_distribution(spark, sf_dir):
    return scores.grade_distribution(roles.scores(spark, sf_dir))


@query(
    "subject_correlations",
    f"""WITH {SC} SELECT COUNT(*) AS total_students, {R(CORR('math_score', 'reading_score'), 4)} AS math_reading_corr,
      {R(CORR('math_score', 'writing_score'), 4)} AS math_writing_corr, {R(CORR('reading_score', 'writing_score'), 4)} AS reading_writing_corr,
      {MEANS}, {', '.join(f"{R(f'STDDEV({c}_score)', 2)} AS stddev_{c}" for c in ('math', 'reading', 'writing'))} FROM scores""",
)
def subject_correlations(spark, sf_dir):
    return scores.subject_correlations(roles.scores(spark, sf_dir))


# --- schools -------------------------------------------------------------------------------------

TIERS = """CASE WHEN average_score >= 90 THEN 'Excellent' WHEN average_score >= 80 THEN 'Good' WHEN average_score >= 70 THEN 'Average'
  WHEN average_score >= 60 THEN 'Below Average' ELSE 'Poor' END"""
STRENGTH = """CASE WHEN math_score > reading_score AND math_score > writing_score THEN 'Math'
  WHEN reading_score > math_score AND reading_score > writing_score THEN 'Reading'
  WHEN writing_score > math_score AND writing_score > reading_score THEN 'Writing' ELSE 'Balanced' END"""
VALID = " AND ".join(f"{c}_score BETWEEN 0 AND 100" for c in ("math", "reading", "writing"))
SCHOOL_AGG = f"""sp AS (SELECT school_id, COUNT(student_id) AS total_students, AVG(average_score) AS avg_school_score, STDDEV(average_score) AS score_stddev,
  AVG(math_score) AS avg_math, AVG(reading_score) AS avg_reading, AVG(writing_score) AS avg_writing,
  CAST(COUNT(DISTINCT {TIERS}) AS INT) AS performance_diversity, COUNT(*) FILTER (WHERE average_score >= 90) AS excellent_count,
  COUNT(*) FILTER (WHERE average_score < 60) AS poor_count FROM scores WHERE {VALID} GROUP BY school_id)"""
DETAILED = f"""{SC}, {roles.SCHOOLS_SQL}, {roles.ECONOMICS_SQL}, {SCHOOL_AGG}, d AS (SELECT *,
  {R('avg_school_score / budget_per_student * 1000', 2)} AS efficiency_score,
  {R('100 - score_stddev / avg_school_score * 100', 2)} AS equity_score,
  {R('avg_school_score - median_household_income / 1000e0 * 0.1e0', 2)} AS socioeconomic_impact,
  row_number() OVER (PARTITION BY region ORDER BY avg_school_score DESC, school_id) AS regional_rank,
  percent_rank() OVER (PARTITION BY region ORDER BY avg_school_score) AS regional_percentile
  FROM sp JOIN schools USING (school_id) JOIN economics USING (region))"""


def profile(spark, sf_dir):
    return schools.school_profile(roles.scores(spark, sf_dir), roles.schools(spark, sf_dir), roles.economics(spark, sf_dir))


def detailed(spark, sf_dir):
    """Ranked school table. The profile is written once; ranking reads it several times."""
    return schools.rank_schools(cut_lineage(profile(spark, sf_dir)))


@query(
    "score_tiers",
    f"WITH {SC} SELECT student_id, school_id, average_score, {TIERS} AS performance_tier, {STRENGTH} AS subject_strength FROM scores WHERE {VALID}",
)
def score_tiers(spark, sf_dir):
    rows = schools.clean_scores(roles.scores(spark, sf_dir))
    return rows.select("student_id", "school_id", "average_score", "performance_tier", "subject_strength")


@query(
    "school_summary",
    f"""WITH {SC}, {SCHOOL_AGG} SELECT school_id, total_students, {R('avg_school_score', 6)} AS avg_school_score, {R('score_stddev', 6)} AS score_stddev,
      {R('avg_math', 6)} AS avg_math, {R('avg_reading', 6)} AS avg_reading, {R('avg_writing', 6)} AS avg_writing, performance_diversity,
      excellent_count, poor_count FROM sp""",
)
def school_summary(spark, sf_dir):
    out = aggregates.school_summary(schools.clean_scores(roles.scores(spark, sf_dir)))
    return out.withColumns({n: settled_round(F.col(n), 6) for n, t in out.dtypes if t == "double"})


@query(
    "school_ranking",
    f"""WITH {DETAILED} SELECT school_id, school_name, school_type, region, total_students, {R('avg_school_score', 6)} AS avg_school_score,
      regional_rank, {R('regional_percentile', 6)} AS regional_percentile, efficiency_score, equity_score, socioeconomic_impact FROM d""",
)
def school_ranking(spark, sf_dir):
    return detailed(spark, sf_dir).select(
        "school_id",
        "school_name",
        "school_type",
        "region",
        "total_students",
        settled_round(F.col("avg_school_score"), 6).alias("avg_school_score"),
        "regional_rank",
        settled_round(F.col("regional_percentile"), 6).alias("regional_percentile"),
        "efficiency_score",
        "equity_score",
        "socioeconomic_impact",
    )


REGION_SUMMARY = f"""WITH {DETAILED} SELECT region, school_type, COUNT(school_id) AS school_count, {R('AVG(avg_school_score)', 6)} AS regional_avg_score,
      {R('AVG(efficiency_score)', 6)} AS avg_efficiency, {R('AVG(equity_score)', 6)} AS avg_equity,
      {R(CORR('budget_per_student', 'avg_school_score'), 6)} AS budget_performance_corr,
      {R(CORR('student_teacher_ratio', 'avg_school_score'), 6)} AS ratio_performance_corr FROM d GROUP BY region, school_type"""


@query("region_summary", REGION_SUMMARY)
def region_summary(spark, sf_dir):
    return schools.region_summary(detailed(spark, sf_dir))


@query("school_run", REGION_SUMMARY)
def school_run(spark, sf_dir):
    """The whole school pipeline; its summary is read back from what it wrote."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/schools-{uuid.uuid4().hex}"
    paths = integration.run_schools(roles.scores(spark, sf_dir), roles.schools(spark, sf_dir), roles.economics(spark, sf_dir), root)
    return spark.read.parquet(paths["summary-statistics"])


@query(
    "school_effectiveness",
    f"""WITH {DETAILED}, e AS (SELECT *, {R('avg_school_score * 0.4e0 + efficiency_score * 0.3e0 + equity_score * 0.3e0', 2)} AS overall FROM d)
    SELECT region, school_type, COUNT(*) AS school_count, {R('AVG(overall)', 2)} AS avg_effectiveness, {R('AVG(avg_school_score)', 2)} AS avg_performance,
      {R('AVG(efficiency_score)', 2)} AS avg_efficiency, {R('AVG(equity_score)', 2)} AS avg_equity, {PCT('regional_percentile >= 0.75')} AS top_quartile_pct,
      {R(CORR('budget_per_student', 'avg_school_score'), 4)} AS budget_performance_corr FROM e GROUP BY region, school_type""",
)
def school_effectiveness(spark, sf_dir):
    return schools.school_effectiveness(detailed(spark, sf_dir))


@query(
    "socioeconomic_impact",
    f"""WITH {DETAILED}, x AS (SELECT *, {R('median_household_income / 1000e0 * 0.4e0 + (100 - unemployment_rate) * 0.2e0 + (100 - poverty_rate) * 0.2e0 + college_graduation_rate * 0.2e0', 2)} AS idx FROM d)
    SELECT region, COUNT(*) AS school_count, {R('AVG(idx)', 2)} AS avg_socioeconomic_index, {R('AVG(avg_school_score)', 2)} AS avg_school_performance,
      {R('AVG(median_household_income)', 0)} AS avg_household_income, {R('AVG(unemployment_rate)', 1)} AS avg_unemployment_rate,
      {R('AVG(poverty_rate)', 1)} AS avg_poverty_rate, {R(CORR('idx', 'avg_school_score'), 4)} AS socioeconomic_performance_corr,
      {R(CORR('median_household_income', 'avg_school_score'), 4)} AS income_performance_corr,
      {R(CORR('poverty_rate', 'avg_school_score'), 4)} AS poverty_performance_corr,
      {R('MAX(avg_school_score) - MIN(avg_school_score)', 2)} AS performance_gap, {R('STDDEV(avg_school_score)', 2)} AS performance_stddev
    FROM x GROUP BY region""",
)
def socioeconomic_impact(spark, sf_dir):
    # the economics are constant within a region, so the correlations have no value there
    return schools.socioeconomic_impact(detailed(spark, sf_dir))


@query(
    "resource_optimisation",
    f"""WITH {DETAILED}, u AS (SELECT *, {R('technology_score * 0.3e0 + facility_score * 0.3e0 + (CASE WHEN student_teacher_ratio <= 15 THEN 10 WHEN student_teacher_ratio <= 20 THEN 7 WHEN student_teacher_ratio <= 25 THEN 5 ELSE 3 END) * 0.4e0', 2)} AS used,
      CASE WHEN efficiency_score >= 8 THEN 'Highly Efficient' WHEN efficiency_score >= 6 THEN 'Efficient' WHEN efficiency_score >= 4
      THEN 'Moderately Efficient' ELSE 'Inefficient' END AS efficiency_grade FROM d)
    SELECT efficiency_grade, school_type, COUNT(*) AS school_count, {R('AVG(budget_per_student)', 0)} AS avg_budget_per_student,
      {R('AVG(student_teacher_ratio)', 1)} AS avg_student_teacher_ratio, {R('AVG(technology_score)', 1)} AS avg_technology_score,
      {R('AVG(facility_score)', 1)} AS avg_facility_score, {R('AVG(avg_school_score)', 2)} AS avg_performance,
      {R('AVG(efficiency_score)', 2)} AS avg_efficiency_score, {R('AVG(used)', 2)} AS avg_resource_utilization,
      CASE WHEN AVG(efficiency_score) < 5 AND AVG(budget_per_student) > 10000 THEN 'High Improvement Potential'
      WHEN AVG(efficiency_score) < 6 AND AVG(used) < 6 THEN 'Medium Improvement Potential' ELSE 'Optimized' END AS improvement_potential
    FROM u GROUP BY efficiency_grade, school_type""",
)
def resource_optimisation(spark, sf_dir):
    return schools.resource_optimisation(detailed(spark, sf_dir))


SPLIT = "CASE WHEN CAST('0x' || substr(md5(CAST(school_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 % 10 < 8 THEN 'train' ELSE 'test' END"


def _zscore(column: str, name: str) -> str:
    return f"{R(f'({column} - AVG({column}) OVER ()) / NULLIF(STDDEV({column}) OVER (), 0)', 6)} AS {name}_zscore"


@query(
    "model_features",
    f"""WITH {SC}, {roles.SCHOOLS_SQL}, {roles.ECONOMICS_SQL}, {SCHOOL_AGG} SELECT school_id, {R('avg_school_score', 6)} AS target_performance,
      CASE school_type WHEN 'public' THEN 0 WHEN 'charter' THEN 1 WHEN 'private' THEN 2 END AS school_type_encoded,
      CASE region WHEN 'rural' THEN 0 WHEN 'suburban' THEN 1 WHEN 'urban' THEN 2 END AS region_encoded, budget_per_student,
      student_teacher_ratio, technology_score, facility_score, total_students, median_household_income, unemployment_rate, poverty_rate,
      college_graduation_rate, internet_access_rate, {R('budget_per_student / CAST(median_household_income AS DOUBLE) * 100', 6)} AS budget_income_ratio,
      {R('technology_score * internet_access_rate / 100', 6)} AS tech_access_score, {R('(100 - poverty_rate) * budget_per_student / 1000', 6)} AS economic_resource_index,
      {R('student_teacher_ratio * total_students', 6)} AS class_size_impact, technology_score * facility_score AS infrastructure_score,
      {_zscore('budget_per_student', 'budget')}, {_zscore('student_teacher_ratio', 'ratio')}, {_zscore('median_household_income', 'income')},
      CASE WHEN {R('avg_school_score', 6)} >= 85 THEN 'High' WHEN {R('avg_school_score', 6)} >= 75 THEN 'Medium' ELSE 'Low' END AS performance_category,
      {SPLIT} AS dataset_split FROM sp JOIN schools USING (school_id) JOIN economics USING (region)""",
)
def model_features(spark, sf_dir):
    return schools.model_features(profile(spark, sf_dir))


@query(
    "school_size_comparison",
    f"""WITH {SC}, {roles.SCHOOLS_SQL}, {roles.ECONOMICS_SQL}, {SCHOOL_AGG} SELECT CASE WHEN student_count >= 1200 THEN 'large' WHEN student_count >= 500
      THEN 'medium' ELSE 'small' END AS factor, COUNT(*) AS n, {R('AVG(avg_school_score)', 3)} AS avg_measure, {R('STDDEV(avg_school_score)', 3)} AS stddev_measure
    FROM sp JOIN schools USING (school_id) JOIN economics USING (region) GROUP BY 1""",
)
def school_size_comparison(spark, sf_dir):
    size = band("student_count", [(1200, "large"), (500, "medium")], "small")
    return scores.factor_comparison(profile(spark, sf_dir), size, "avg_school_score")


@query(
    "school_factor_correlations",
    f"""WITH {SC}, {roles.SCHOOLS_SQL}, {roles.ECONOMICS_SQL}, {SCHOOL_AGG} SELECT {R(CORR('student_teacher_ratio', 'avg_school_score'), 4)} AS student_teacher_ratio_corr,
      {R(CORR('median_household_income', 'avg_school_score'), 4)} AS median_household_income_corr, {R(CORR('student_count', 'avg_school_score'), 4)} AS student_count_corr
    FROM sp JOIN schools USING (school_id) JOIN economics USING (region)""",
)
def school_factor_correlations(spark, sf_dir):
    factors = ["student_teacher_ratio", "median_household_income", "student_count"]
    return scores.factor_correlations(profile(spark, sf_dir), factors, "avg_school_score")


@query(
    "weighted_assignment",
    f"""WITH {roles.SCHOOLS_SQL}, t AS (SELECT school_id AS own, CAST(student_count AS DECIMAL(20, 6)) AS w FROM schools WHERE student_count > 0),
    n AS (SELECT COUNT(*) AS slots, SUM(w) AS whole FROM t),
    r AS (SELECT own, w * slots AS p, w * slots >= whole AS heavy, abs(w * slots - whole) AS gap FROM t, n),
    x AS (SELECT *, row_number() OVER (PARTITION BY heavy ORDER BY own) AS i, SUM(gap) OVER (PARTITION BY heavy ORDER BY own) AS upto FROM r),
    l AS (SELECT *, (SELECT COUNT(*) FROM x h WHERE h.heavy AND h.upto <= x.upto - x.gap) + 1 AS j FROM x WHERE NOT heavy),
    h AS (SELECT x.own, x.i, greatest(coalesce((SELECT MAX(y.upto) FROM x y WHERE NOT y.heavy AND y.upto - y.gap < x.upto), 0) - x.upto, 0) AS given FROM x WHERE heavy),
    s AS (SELECT l.i - 1 AS slot, l.own, l.p AS part, h.own AS other FROM l JOIN h ON h.i = l.j
      UNION ALL SELECT h.i - 1 + (SELECT COUNT(*) FROM l), h.own, whole - h.given, g.own FROM n, h LEFT JOIN h g ON g.i = h.i + 1),
    c AS (SELECT c_custkey, md5(c_custkey || '|assign') AS d FROM customer)
    SELECT c_custkey, CASE WHEN CAST(('0x' || substr(d, 13, 8)) AS HUGEINT) / 4294967296e0 < CAST(part AS DOUBLE) / CAST(whole AS DOUBLE) THEN own ELSE other END AS school_id
    FROM c, n JOIN s ON s.slot = CAST(('0x' || substr(d, 1, 12)) AS BIGINT) % slots""",
)
def weighted_assignment(spark, sf_dir):
    """Every customer gets exactly one supplier, by the supplier's weight."""
    supplier = roles.schools(spark, sf_dir).select("school_id", "student_count")
    customer = roles.table(spark, sf_dir, "customer").select("c_custkey")
    return assign_weighted(customer, "c_custkey", supplier, "school_id", "student_count")


@query(
    "school_adjusted_effect",
    f"""WITH {SC}, {roles.SCHOOLS_SQL}, e AS (SELECT s.*, (CASE school_type WHEN 'private' THEN 5 WHEN 'charter' THEN 2 ELSE 0 END)
      + (CASE WHEN student_teacher_ratio < 15 THEN 3 WHEN student_teacher_ratio > 20 THEN -2 ELSE 0 END)
      + (CASE WHEN budget_per_student > 12000 THEN 3 WHEN budget_per_student < 8000 THEN -2 ELSE 0 END)
      + (technology_score - 5) * 0.5e0 + (facility_score - 5) * 0.3e0 AS eff FROM scores s JOIN schools USING (school_id)),
    a AS (SELECT student_id, school_id, eff, {', '.join(f'CAST(greatest(0, least(100, trunc({c}_score + eff))) AS INT) AS {c}_score' for c in ('math', 'reading', 'writing'))} FROM e)
    SELECT student_id, school_id, math_score, reading_score, writing_score, math_score + reading_score + writing_score AS total_score,
      {R('(math_score + reading_score + writing_score) / 3e0', 1)} AS average_score, {R('eff', 1)} AS school_effect FROM a""",
)
def school_adjusted_effect(spark, sf_dir):
    from tallyforge.operators.scoring import adjust_for_school

    joined = roles.scores(spark, sf_dir).join(roles.schools(spark, sf_dir), "school_id")
    out = adjust_for_school(joined, "student_id", ["math_score", "reading_score", "writing_score"], noise_sd=0.0)
    names = ["student_id", "school_id", "math_score", "reading_score", "writing_score", "total_score", "average_score", "school_effect"]
    return out.select(*names)


def _noise_sql(subject, sd=2):
    """The normal variate that a row key and a salt give: two md5 numbers, Box-Muller."""
    u, v = (f"(CAST('0x' || substr(md5(concat_ws('|', CAST(student_id AS VARCHAR), '{subject}_score/{x}')), 1, 12) AS BIGINT) / 281474976710656e0)" for x in "uv")
    return f"(0e0 + {sd}e0 * sqrt(-2e0 * ln(1e0 - {u})) * cos(2e0 * pi() * {v}))"


@query(
    "school_noisy_effect",
    f"""WITH {SC}, {roles.SCHOOLS_SQL}, e AS (SELECT s.*, (CASE school_type WHEN 'private' THEN 5 WHEN 'charter' THEN 2 ELSE 0 END)
      + (CASE WHEN student_teacher_ratio < 15 THEN 3 WHEN student_teacher_ratio > 20 THEN -2 ELSE 0 END)
      + (CASE WHEN budget_per_student > 12000 THEN 3 WHEN budget_per_student < 8000 THEN -2 ELSE 0 END)
      + (technology_score - 5) * 0.5e0 + (facility_score - 5) * 0.3e0 AS eff FROM scores s JOIN schools USING (school_id))
    SELECT student_id, school_id, {', '.join(f'CAST(greatest(0, least(100, trunc({c}_score + eff + {_noise_sql(c)}))) AS INT) AS {c}_score' for c in ('math', 'reading', 'writing'))} FROM e""",
)
def school_noisy_effect(spark, sf_dir):
    from tallyforge.operators.scoring import adjust_for_school

    joined = roles.scores(spark, sf_dir).join(roles.schools(spark, sf_dir), "school_id")
    out = adjust_for_school(joined, "student_id", ["math_score", "reading_score", "writing_score"])
    return out.select("student_id", "school_id", "math_score", "reading_score", "writing_score")


# --- survey --------------------------------------------------------------------------------------

SV = roles.SURVEY_SQL


@query(
    "survey_overview",
    f"""WITH {SV} SELECT COUNT(*) AS total_records, COUNT(DISTINCT stream) AS unique_stream, COUNT(DISTINCT year_of_study) AS unique_year_of_study,
      COUNT(DISTINCT preferred_ai_tool) AS unique_preferred_ai_tool FROM survey""",
)
def survey_overview(spark, sf_dir):
    return survey.overview(roles.survey(spark, sf_dir))


@query(
    "survey_stream_share",
    f"WITH {SV} SELECT stream, COUNT(*) AS student_count, {R('100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER ()', 2)} AS percentage FROM survey GROUP BY stream",
)
def survey_stream_share(spark, sf_dir):
    return survey.stream_share(roles.survey(spark, sf_dir))


@query(
    "survey_trust_by_stream",
    f"""WITH {SV} SELECT stream, COUNT(*) AS student_count, {R('AVG(trust_in_ai_tools)', 2)} AS avg_trust, MIN(trust_in_ai_tools) AS min_trust,
      MAX(trust_in_ai_tools) AS max_trust FROM survey GROUP BY stream HAVING COUNT(*) >= 10""",
)
def survey_trust_by_stream(spark, sf_dir):
    return survey.trust_by_stream(roles.survey(spark, sf_dir))


def _survey_means(key, group, minimum):
    means = ["daily_usage_hours", "trust_in_ai_tools", "impact_on_grades"]
    columns = ", ".join(f"{R(f'AVG({m})', 2)} AS avg_{m}" for m in means)
    keys = ", ".join(group)
    sql = f"WITH {SV} SELECT {keys}, COUNT(*) AS n, {columns} FROM survey GROUP BY {keys} HAVING COUNT(*) >= {minimum}"

    @query(key, sql)
    def run(spark, sf_dir):
        return survey.mean_summary(roles.survey(spark, sf_dir), group, means, minimum)


_survey_means("survey_by_year", ["year_of_study"], 1)
_survey_means("survey_by_tool", ["preferred_ai_tool"], 5)
_survey_means("survey_stream_by_year", ["stream", "year_of_study"], 3)

LEVEL = """CASE WHEN daily_usage_hours < 1 THEN 'Light User (< 1h)' WHEN daily_usage_hours < 3 THEN 'Moderate User (1-3h)'
  WHEN daily_usage_hours < 5 THEN 'Heavy User (3-5h)' ELSE 'Very Heavy User (5h+)' END"""


@query(
    "survey_usage_bands",
    f"""WITH {SV} SELECT {LEVEL} AS usage_category, COUNT(*) AS user_count, {R('AVG(trust_in_ai_tools)', 2)} AS avg_trust,
      {R('AVG(impact_on_grades)', 2)} AS avg_grade_impact FROM survey GROUP BY 1""",
)
def survey_usage_bands(spark, sf_dir):
    return survey.usage_bands(roles.survey(spark, sf_dir))


# --- dashboards ----------------------------------------------------------------------------------


@query(
    "dash_tool_share",
    f"""WITH {roles.USAGE_SQL}, m AS (SELECT unnest(string_split(ai_tools_used, ',')) AS tool FROM usage) SELECT tool, COUNT(*) AS mentions,
      {R('100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER ()', 2)} AS percentage FROM m GROUP BY tool""",
)
def dash_tool_share(spark, sf_dir):
    return survey.tool_share(roles.usage(spark, sf_dir))


def _dash_mean(key, group, measure):
    sql = f"WITH {SV} SELECT {group}, COUNT(*) AS n, {R(f'AVG({measure})', 2)} AS avg_{measure} FROM survey GROUP BY {group}"

    @query(key, sql)
    def run(spark, sf_dir):
        return survey.mean_summary(roles.survey(spark, sf_dir), [group], [measure])


_dash_mean("dash_hours_by_stream", "stream", "daily_usage_hours")
_dash_mean("dash_hours_by_year", "year_of_study", "daily_usage_hours")
_dash_mean("dash_impact_by_permission", "do_professors_allow_use", "impact_on_grades")
_dash_mean("dash_hours_by_state", "state", "daily_usage_hours")
_dash_mean("dash_hours_by_internet", "internet_access", "daily_usage_hours")


@query("dash_trust_histogram", f"WITH {SV} SELECT CAST(trust_in_ai_tools AS DOUBLE) AS bin_from, COUNT(*) AS n FROM survey GROUP BY 1")
def dash_trust_histogram(spark, sf_dir):
    return survey.histogram(roles.survey(spark, sf_dir), "trust_in_ai_tools", 1.0)


@query(
    "dash_hours_vs_impact",
    f"""WITH {SV} SELECT response_id, daily_usage_hours, impact_on_grades, (SELECT {R(CORR('daily_usage_hours', 'impact_on_grades'), 4)} FROM survey) AS correlation
      FROM survey""",
)
def dash_hours_vs_impact(spark, sf_dir):
    columns = ["response_id", "daily_usage_hours", "impact_on_grades"]
    return survey.scatter_with_correlation(roles.survey(spark, sf_dir), "daily_usage_hours", "impact_on_grades", columns)


def _dash_box(key, group, value):
    q = ", ".join(f"quantile_disc({value}, {p}) AS {n}" for p, n in ((0, "min_value"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1, "max_value")))
    sql = f"WITH {SV} SELECT {group}, COUNT({value}) AS n, {q} FROM survey GROUP BY {group}"

    @query(key, sql)
    def run(spark, sf_dir):
        return survey.box(roles.survey(spark, sf_dir), group, value)


_dash_box("dash_impact_box_by_tool", "preferred_ai_tool", "impact_on_grades")
_dash_box("dash_trust_box_by_internet", "internet_access", "trust_in_ai_tools")


@query(
    "dash_awareness_impact_heatmap",
    f"""WITH {SV} SELECT floor(awareness_level / 2e0) * 2 AS awareness_level_from, floor(impact_on_grades / 1e0) AS impact_on_grades_from, COUNT(*) AS n
      FROM survey GROUP BY 1, 2""",
)
def dash_awareness_impact_heatmap(spark, sf_dir):
    return survey.heatmap(roles.survey(spark, sf_dir), "awareness_level", 2.0, "impact_on_grades", 1.0)


@query(
    "dash_device_by_tool",
    f"""WITH {SV} SELECT device_used, preferred_ai_tool, COUNT(*) AS n,
      {R('100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY device_used)', 2)} AS pct_of_row FROM survey GROUP BY 1, 2""",
)
def dash_device_by_tool(spark, sf_dir):
    return survey.group_share_grid(roles.survey(spark, sf_dir), "device_used", "preferred_ai_tool")


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "dash_device_tool_pivot",
    f"WITH {SV} SELECT device_used, " + ", ".join(f"COUNT(*) FILTER (WHERE preferred_ai_tool = '{e}') AS {e}" for e in EVENT_TYPES) + " FROM survey GROUP BY 1",
)
def dash_device_tool_pivot(spark, sf_dir):
    return aggregates.pivot_counts(roles.survey(spark, sf_dir), "device_used", "preferred_ai_tool", EVENT_TYPES)


@query(
    "dash_threshold_breaches",
    f"""WITH {SV}, s AS (SELECT state, COUNT(*) AS n, {R('AVG(daily_usage_hours)', 2)} AS avg_daily_usage_hours FROM survey GROUP BY state)
    SELECT * FROM s WHERE avg_daily_usage_hours > 0.83""",
)
def dash_threshold_breaches(spark, sf_dir):
    means = survey.mean_summary(roles.survey(spark, sf_dir), ["state"], ["daily_usage_hours"])
    return survey.breaches(means, "avg_daily_usage_hours", 0.83)


@query(
    "activity_rollup",
    f"""SELECT date_trunc('hour', ts) AS period, event_type, COUNT(*) AS n_events, {R('AVG(value)', 4)} AS avg_value FROM events GROUP BY 1, 2""",
)
def activity_rollup(spark, sf_dir):
    out = aggregates.activity_rollup(roles.table(spark, sf_dir, "events"), "ts", "hour", ["event_type"], "value")
    return out.withColumn("avg_value", settled_round(F.col("avg_value"), 4)).withColumn("period", F.col("period").cast("timestamp_ntz"))


@query(
    "daily_activity",
    f"""SELECT date_trunc('day', ts)::TIMESTAMP AS period, user_id, COUNT(*) AS n_events, {R('AVG(value)', 4)} AS avg_value FROM events GROUP BY 1, 2""",
)
def daily_activity(spark, sf_dir):
    out = aggregates.activity_rollup(roles.table(spark, sf_dir, "events"), "ts", "day", ["user_id"], "value")
    return out.withColumn("avg_value", settled_round(F.col("avg_value"), 4)).withColumn("period", F.col("period").cast("timestamp_ntz"))
