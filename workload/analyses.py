"""Rank, trend, cohort, scaling and integration analyses on the student tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.expr import settled_round
from tallyforge.operators import aggregates, moments, scoring, windows
from tallyforge.operators.joins import join_reconciliation
from tallyforge.plans import cohorts, integration, ranking, scaling, survey
from tallyforge.session import cut_lineage
from workload import roles
from workload.registry import CORR, PCT, R, query

S = roles.STUDENTS_SQL
TOP_TERMS = {"semester": ["1999", "2000"]}
IN_TERMS = "semester IN ('1999', '2000')"
SOME_FIELDS = ["BUILDING", "MACHINERY", "FURNITURE"]
IN_FIELDS = "field_of_study IN ('BUILDING', 'MACHINERY', 'FURNITURE')"
TIER = (
    "CASE WHEN pr >= 0.9 THEN 'Top 10%' WHEN pr >= 0.75 THEN 'Top 25%' WHEN pr >= 0.5 THEN 'Top 50%' ELSE 'Bottom 50%' END"
)


def written_students(spark, sf_dir, keep="true", columns=("*",)):
    """What an analysis needs of the wide table, written once, for analyses that read it several times."""
    return cut_lineage(roles.students(spark, sf_dir).filter(keep).select(*columns))


GRADED = ("student_id", "semester", "field_of_study", "gpa", "usage_frequency_score", "satisfaction_level", "attendance_rate")


@query(
    "rank_tiers",
    f"""WITH {S}, r AS (SELECT *, percent_rank() OVER (PARTITION BY field_of_study ORDER BY gpa) AS pr FROM students),
    t AS (SELECT *, {TIER} AS performance_tier FROM r)
    SELECT field_of_study, performance_tier, COUNT(*) AS student_count, {R('AVG(gpa)', 3)} AS avg_gpa,
    {R('AVG(usage_frequency_score)', 2)} AS avg_ai_usage, {R('AVG(satisfaction_level)', 2)} AS avg_satisfaction,
    {R('AVG(usage_frequency_score * satisfaction_level)', 2)} AS ai_engagement_score
    FROM t GROUP BY field_of_study, performance_tier""",
)
def rank_tiers(spark, sf_dir):
    return ranking.rank_tiers(written_students(spark, sf_dir, columns=GRADED))


@query(
    "period_trend",
    f"""WITH {S}, p AS (SELECT *, lag(gpa) OVER (PARTITION BY student_id ORDER BY semester) AS prev FROM students),
    t AS (SELECT *, {R('gpa - prev', 3)} AS change, CASE WHEN gpa - prev > 0.3e0 THEN 'Significant Improvement'
      WHEN gpa - prev > 0.1e0 THEN 'Moderate Improvement' WHEN gpa - prev > -0.1e0 THEN 'Stable'
      WHEN gpa - prev > -0.3e0 THEN 'Moderate Decline' ELSE 'Significant Decline' END AS performance_trend
      FROM p WHERE prev IS NOT NULL)
    SELECT semester, performance_trend, COUNT(*) AS student_count, {R('AVG(gpa)', 3)} AS avg_current_gpa,
    {R('AVG(prev)', 3)} AS avg_previous_gpa, {R('AVG(change)', 3)} AS avg_gpa_change,
    {R('AVG(attendance_rate)', 3)} AS avg_attendance, {R('AVG(assignment_submission_rate)', 3)} AS avg_submission_rate
    FROM t GROUP BY semester, performance_trend""",
)
def period_trend(spark, sf_dir):
    return ranking.period_trend(roles.students(spark, sf_dir))


@query(
    "moving_average",
    f"""WITH {S} SELECT student_id, field_of_study, semester, gpa,
    {R('AVG(gpa) OVER (PARTITION BY student_id ORDER BY semester ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 3)} AS moving_avg_3_semesters,
    {R('AVG(gpa) OVER (PARTITION BY student_id ORDER BY semester ROWS UNBOUNDED PRECEDING)', 3)} AS cumulative_avg_gpa,
    {R('gpa / MAX(gpa) OVER (PARTITION BY student_id)', 3)} AS performance_vs_best,
    {R('gpa - FIRST_VALUE(gpa) OVER (PARTITION BY student_id ORDER BY semester)', 3)} AS improvement_from_first_semester
    FROM students""",
)
def moving_average(spark, sf_dir):
    return ranking.moving_statistics(roles.students(spark, sf_dir))


@query(
    "quartile_distribution",
    f"""WITH {S}, d AS (SELECT field_of_study, gpa, ntile(4) OVER (PARTITION BY field_of_study ORDER BY gpa, student_id, semester) AS q,
      percent_rank() OVER (PARTITION BY field_of_study ORDER BY gpa) AS pr FROM students)
    SELECT field_of_study, CAST(q AS INT) AS gpa_quartile, COUNT(*) AS student_count, {R('MIN(gpa)', 3)} AS min_gpa,
    {R('MAX(gpa)', 3)} AS max_gpa, {R('AVG(gpa)', 3)} AS avg_gpa, {R('STDDEV(gpa)', 3)} AS stddev_gpa,
    {R('MIN(pr)', 3)} AS min_percentile, {R('MAX(pr)', 3)} AS max_percentile FROM d GROUP BY field_of_study, q""",
)
def quartile_distribution(spark, sf_dir):
    return ranking.tile_distribution(written_students(spark, sf_dir, columns=("field_of_study", "gpa")))


@query(
    "decile_of_balance",
    """SELECT c_custkey, c_mktsegment, c_acctbal, CAST(ntile(10) OVER w AS INT) AS decile, row_number() OVER w AS position,
    rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS standing,
    CAST(ROUND(percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC), 9) AS DOUBLE) AS percentile,
    COUNT(*) OVER (PARTITION BY c_mktsegment) AS group_size,
    CAST(ROUND(SUM(CAST(round(c_acctbal * 100) AS BIGINT)) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC), 0) AS BIGINT) AS running_cents
    FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey)""",
)
def decile_of_balance(spark, sf_dir):
    from tallyforge.operators.ranking import rank_rows

    rows = roles.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_acctbal", F.expr("CAST(round(c_acctbal * 100) AS BIGINT)").alias("cents")
    )
    ranked = rank_rows(
        rows,
        ["c_mktsegment"],
        "c_acctbal",
        "c_custkey",
        ascending=False,
        row_number="position",
        rank="standing",
        percent_rank="percentile",
        group_size="group_size",
        ntile={"decile": 10},
        running_sum={"running_cents": "cents"},
    )
    return ranked.withColumn("percentile", F.round("percentile", 9)).drop("cents")


def _correlation_sql(source: str, field: str, x: str, usage: str, happy: str) -> str:
    r = CORR(x, usage)
    return f"""SELECT *, CASE WHEN abs(gpa_usage_correlation) >= 0.7 THEN 'Strong' WHEN abs(gpa_usage_correlation) >= 0.5 THEN 'Moderate'
      WHEN abs(gpa_usage_correlation) >= 0.3 THEN 'Weak' ELSE 'Very Weak' END AS correlation_strength,
      CASE WHEN (sample_size >= 30 AND abs(gpa_usage_correlation) >= 0.3) OR (sample_size >= 100 AND abs(gpa_usage_correlation) >= 0.2)
      THEN 'Likely Significant' ELSE 'Not Significant' END AS significance_estimate
    FROM (SELECT {field}, COUNT(*) AS sample_size, {R(r, 4)} AS gpa_usage_correlation,
      {R(CORR(x, happy), 4)} AS gpa_satisfaction_correlation,
      {R(f'covar_pop({x}, {usage}) / NULLIF(var_pop({usage}), 0)', 4)} AS gpa_usage_slope,
      {R(f'power({r}, 2)', 4)} AS r_squared_gpa_usage FROM {source} GROUP BY {field})"""


@query("group_correlation", f"WITH {S} " + _correlation_sql("students", "field_of_study", "gpa", "usage_frequency_score", "satisfaction_level"))
def group_correlation(spark, sf_dir):
    return ranking.group_correlation(roles.students(spark, sf_dir))


@query(
    "line_correlation",
    _correlation_sql("lineitem", "l_returnflag", "l_extendedprice", "l_quantity", "l_discount"),
)
def line_correlation(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem")
    return ranking.group_correlation(lines, "l_returnflag", "l_extendedprice", "l_quantity", "l_discount")


@query(
    "multi_criteria_rank",
    f"""WITH {S}, m AS (SELECT *, rank() OVER (PARTITION BY field_of_study ORDER BY gpa DESC) AS gpa_rank,
      rank() OVER (PARTITION BY field_of_study ORDER BY usage_frequency_score DESC) AS usage_rank,
      rank() OVER (PARTITION BY field_of_study ORDER BY satisfaction_level DESC) AS satisfaction_rank,
      rank() OVER (PARTITION BY field_of_study ORDER BY attendance_rate DESC) AS attendance_rank,
      {R('gpa * 0.4e0 + usage_frequency_score * 0.2e0 + satisfaction_level * 0.2e0 + attendance_rate * 0.4e0 + assignment_submission_rate * 0.4e0', 3)} AS composite_score
      FROM students),
    v AS (SELECT *, rank() OVER (PARTITION BY field_of_study ORDER BY composite_score DESC) AS overall_rank,
      (gpa_rank + usage_rank + satisfaction_rank + attendance_rank) / 4e0 AS mean_rank FROM m),
    f AS (SELECT *, {R('sqrt((power(gpa_rank - mean_rank, 2) + power(usage_rank - mean_rank, 2) + power(satisfaction_rank - mean_rank, 2) + power(attendance_rank - mean_rank, 2)) / 3)', 2)} AS rank_volatility FROM v)
    SELECT field_of_study, student_id, semester, overall_rank, composite_score, gpa_rank, usage_rank, satisfaction_rank, attendance_rank,
      rank_volatility, CASE WHEN rank_volatility <= 5 AND overall_rank <= 10 THEN 'Consistent Top Performer'
      WHEN rank_volatility <= 3 THEN 'Balanced Performer' WHEN rank_volatility > 10 THEN 'Inconsistent Performer'
      ELSE 'Average Performer' END AS performance_type FROM f WHERE overall_rank <= 20""",
)
def multi_criteria_rank(spark, sf_dir):
    return ranking.multi_criteria_rank(written_students(spark, sf_dir), extra_keys=("semester",))


def _z(name: str, digits: int) -> str:
    return f"CASE WHEN sd_{name} > 0 THEN {R(f'({name} - mean_{name}) / sd_{name}', 3)} ELSE 0 END AS z_{name}"


def _points(z: str) -> str:
    return f"(CASE WHEN {z} > 1 THEN 3 WHEN {z} > 0 THEN 2 WHEN {z} > -1 THEN 1 ELSE 0 END)"


@query(
    "effectiveness",
    f"""WITH {S}, b AS (SELECT field_of_study, gpa AS g,
      {R('attendance_rate * 0.4e0 + assignment_submission_rate * 0.6e0', 3)} AS e,
      {R('usage_frequency_score * 0.5e0 + satisfaction_level * 0.3e0 + num_ai_tools * 0.2e0', 2)} AS a FROM students),
    s AS (SELECT field_of_study, {R('AVG(g)', 3)} AS mean_g, {R('AVG(e)', 3)} AS mean_e, {R('AVG(a)', 2)} AS mean_a,
      {R('STDDEV(g)', 3)} AS sd_g, {R('STDDEV(e)', 3)} AS sd_e, {R('STDDEV(a)', 3)} AS sd_a FROM b GROUP BY field_of_study),
    z AS (SELECT b.*, {R('g - mean_g', 3)} AS d_g, {R('e - mean_e', 3)} AS d_e, {R('a - mean_a', 3)} AS d_a,
      {_z('g', 3)}, {_z('e', 3)}, {_z('a', 3)} FROM b JOIN s USING (field_of_study)),
    l AS (SELECT *, {R(f"{_points('z_g')} * 0.4e0 + {_points('z_e')} * 0.3e0 + {_points('z_a')} * 0.3e0", 1)} AS score,
      CASE WHEN z_g > 1 AND z_a > 0.5 THEN 'High Achiever + AI Savvy' WHEN z_g > 1 AND z_a <= 0 THEN 'High Achiever + Traditional'
      WHEN z_g <= 0 AND z_a > 0.5 THEN 'Struggling + AI Dependent' WHEN z_g <= 0 AND z_e <= 0 THEN 'At Risk'
      WHEN z_e > 1 AND z_g > 0 THEN 'Engaged High Performer' WHEN z_e > 1 AND z_g <= 0 THEN 'Engaged Underperformer'
      ELSE 'Average Performer' END AS learner_type,
      CASE WHEN z_a >= 1 AND z_g < 0 THEN 'High Potential' WHEN z_e >= 1 AND z_g < 0.5 THEN 'Medium Potential'
      WHEN z_a < -0.5 AND z_g > 0 THEN 'AI Enhancement Opportunity' ELSE 'Stable' END AS improvement_potential FROM z),
    f AS (SELECT field_of_study, learner_type, improvement_potential, COUNT(*) AS student_count, {R('AVG(g)', 3)} AS avg_gpa,
      {R('AVG(score)', 2)} AS avg_effectiveness_score, {R('AVG(e)', 3)} AS avg_engagement, {R('AVG(a)', 2)} AS avg_ai_utilization,
      {R('AVG(d_g)', 3)} AS avg_gpa_vs_field, {R('AVG(d_e)', 3)} AS avg_engagement_vs_field, {R('AVG(d_a)', 2)} AS avg_ai_utilization_vs_field,
      quantile_disc(score, 0.5) AS median_effectiveness, {R('STDDEV(score)', 2)} AS effectiveness_stddev
      FROM l GROUP BY ALL HAVING COUNT(*) >= 3)
    SELECT *, {R('100.0 * student_count / CAST(SUM(student_count) OVER (PARTITION BY field_of_study) AS DOUBLE)', 1)} AS pct_of_field,
      rank() OVER (PARTITION BY field_of_study ORDER BY avg_effectiveness_score DESC) AS effectiveness_rank FROM f""",
)
def effectiveness(spark, sf_dir):
    return cohorts.effectiveness(written_students(spark, sf_dir))


COHORT = """CASE WHEN usage_frequency_score >= 4 AND num_ai_tools >= 3 THEN 'Power Users'
  WHEN usage_frequency_score >= 3 AND num_ai_tools >= 2 THEN 'Regular Users'
  WHEN usage_frequency_score >= 2 THEN 'Occasional Users' ELSE 'Light Users' END AS usage_cohort,
  CASE WHEN satisfaction_level >= 4 THEN 'Highly Satisfied' WHEN satisfaction_level >= 3 THEN 'Satisfied'
  WHEN satisfaction_level >= 2 THEN 'Neutral' ELSE 'Dissatisfied' END AS satisfaction_segment"""
COHORT_STATS = f"""COUNT(*) AS cohort_size, {R('AVG(gpa)', 3)} AS avg_gpa, {R('AVG(attendance_rate)', 3)} AS avg_attendance,
  {R('AVG(usage_frequency_score)', 2)} AS avg_usage_frequency, {R('AVG(satisfaction_level)', 2)} AS avg_satisfaction,
  {R('AVG(num_ai_tools)', 1)} AS avg_tools_used, quantile_disc(gpa, 0.5) AS gpa_median"""


@query(
    "cohort_success",
    f"""WITH {S}, c AS (SELECT *, {COHORT}, CASE WHEN year_of_study <= 1 THEN 'Freshman' WHEN year_of_study <= 2 THEN 'Sophomore'
      WHEN year_of_study <= 3 THEN 'Junior' ELSE 'Senior' END AS academic_level FROM students),
    s AS (SELECT usage_cohort, satisfaction_segment, academic_level, field_of_study, {COHORT_STATS} FROM c
      GROUP BY usage_cohort, satisfaction_segment, academic_level, field_of_study HAVING COUNT(*) >= 5),
    k AS (SELECT *, rank() OVER (PARTITION BY field_of_study ORDER BY avg_gpa DESC) AS pos,
      COUNT(*) OVER (PARTITION BY field_of_study) AS cohorts, {R('avg_gpa * 0.7e0 + avg_satisfaction * 0.3e0', 3)} AS balance FROM s),
    p AS (SELECT usage_cohort, satisfaction_segment, COUNT(DISTINCT field_of_study) AS fields_represented, COUNT(*) AS total_cohorts,
      {R('AVG(avg_gpa)', 3)} AS overall_avg_gpa, {R('AVG(balance)', 3)} AS overall_balance_score,
      {PCT('pos <= ceil(cohorts * 0.25)')} AS success_rate, {R('STDDEV(avg_gpa)', 3)} AS performance_consistency
      FROM k GROUP BY usage_cohort, satisfaction_segment)
    SELECT *, CASE WHEN success_rate >= 75 AND performance_consistency <= 0.3 THEN 'Highly Recommended'
      WHEN success_rate >= 50 AND performance_consistency <= 0.5 THEN 'Recommended'
      WHEN success_rate >= 25 THEN 'Conditionally Recommended' ELSE 'Not Recommended' END AS recommendation_level,
      CASE WHEN usage_cohort = 'Light Users' AND satisfaction_segment IN ('Satisfied', 'Highly Satisfied') THEN 'Increase Usage Frequency'
      WHEN usage_cohort IN ('Power Users', 'Regular Users') AND satisfaction_segment = 'Dissatisfied' THEN 'Improve Tool Selection'
      WHEN success_rate < 25 THEN 'Comprehensive Support Needed' ELSE 'Maintain Current Approach' END AS improvement_suggestion FROM p""",
)
def cohort_success(spark, sf_dir):
    return cohorts.cohort_success(roles.students(spark, sf_dir))


@query(
    "cohort_index",
    f"""WITH {S}, c AS (SELECT *, {COHORT} FROM students),
    s AS (SELECT field_of_study, usage_cohort, satisfaction_segment, {COHORT_STATS} FROM c GROUP BY field_of_study, usage_cohort,
      satisfaction_segment HAVING COUNT(*) >= 5)
    SELECT *, {R('avg_gpa * 0.7e0 + avg_attendance * 4 * 0.3e0', 3)} AS performance_index,
      rank() OVER (PARTITION BY field_of_study ORDER BY avg_gpa DESC) AS performance_rank_in_field FROM s""",
)
def cohort_index(spark, sf_dir):
    return cohorts.cohort_index(roles.students(spark, sf_dir))


CHANGES = f"""p AS (SELECT *, lag(gpa) OVER w AS pg, lead(gpa) OVER w AS ng, lag(usage_frequency_score) OVER w AS pu
    FROM students WINDOW w AS (PARTITION BY student_id ORDER BY semester)),
  c AS (SELECT *, {R('gpa - pg', 3)} AS gc, {R('usage_frequency_score - pu', 2)} AS uc,
    CASE WHEN gpa - pg > 0.2e0 THEN 'Improving' WHEN gpa - pg < -0.2e0 THEN 'Declining' ELSE 'Stable' END AS performance_trend,
    CASE WHEN gpa - pg > 0 AND ng - gpa > 0 THEN 'Sustained Growth' WHEN gpa - pg > 0 AND ng - gpa <= 0 THEN 'Peak Performance'
    WHEN gpa - pg <= 0 AND ng - gpa > 0 THEN 'Recovery' WHEN gpa - pg <= 0 AND ng - gpa <= 0 THEN 'Continued Decline' END AS trajectory_pattern
    FROM p WHERE pg IS NOT NULL)"""


@query(
    "trend_stability",
    f"""WITH {S}, {CHANGES}, f AS (SELECT field_of_study, semester, performance_trend, COUNT(*) AS student_count, {R('AVG(gpa)', 3)} AS avg_gpa,
      {R('AVG(gc)', 3)} AS avg_gpa_change, {R('AVG(usage_frequency_score)', 2)} AS avg_usage, {R('AVG(uc)', 2)} AS avg_usage_change,
      {R('AVG(satisfaction_level)', 2)} AS avg_satisfaction, {R('STDDEV(gc)', 3)} AS gpa_change_stddev,
      {PCT('abs(gc) > 0.5')} AS extreme_change_pct FROM c GROUP BY field_of_study, semester, performance_trend)
    SELECT *, CASE WHEN gpa_change_stddev <= 0.2 AND extreme_change_pct <= 10 THEN 'Very Stable'
      WHEN gpa_change_stddev <= 0.4 AND extreme_change_pct <= 20 THEN 'Stable'
      WHEN gpa_change_stddev <= 0.6 AND extreme_change_pct <= 30 THEN 'Moderate Volatility' ELSE 'High Volatility' END AS trend_stability,
      CASE WHEN performance_trend = 'Declining' AND extreme_change_pct > 25 THEN 'Immediate Intervention'
      WHEN performance_trend = 'Declining' THEN 'Monitor Closely' WHEN performance_trend = 'Stable' AND avg_gpa < 2.5 THEN 'Support Needed'
      ELSE 'Continue Current Approach' END AS intervention_recommendation FROM f""",
)
def trend_stability(spark, sf_dir):
    return cohorts.trend_stability(roles.students(spark, sf_dir))


@query(
    "trajectories",
    f"""WITH {S}, {CHANGES} SELECT field_of_study, trajectory_pattern, COUNT(*) AS pattern_count, {R('AVG(gpa)', 3)} AS avg_final_gpa,
      {R('AVG(usage_frequency_score)', 2)} AS avg_final_usage, {PCT('gpa >= 3.5')} AS high_performance_rate,
      {R('SUM(uc * gc) / NULLIF(sqrt(SUM(uc * uc) * SUM(gc * gc)), 0)', 3)} AS usage_performance_cosine,
      {R(CORR('uc', 'gc'), 3)} AS usage_performance_correlation
    FROM c WHERE trajectory_pattern IS NOT NULL GROUP BY field_of_study, trajectory_pattern HAVING COUNT(*) >= 5""",
)
def trajectories(spark, sf_dir):
    return cohorts.trajectories(roles.students(spark, sf_dir))


@query(
    "segments",
    f"""WITH {S}, s AS (SELECT field_of_study, COUNT(*) AS total_students, {PCT('gpa >= 3.5')} AS high_gpa_pct,
      {PCT('gpa BETWEEN 2.5 AND 3.49')} AS medium_gpa_pct, {PCT('gpa < 2.5')} AS low_gpa_pct,
      {PCT('usage_frequency_score >= 4')} AS high_usage_pct, {PCT('usage_frequency_score BETWEEN 2 AND 3.99')} AS medium_usage_pct,
      {PCT('usage_frequency_score < 2')} AS low_usage_pct, {PCT('gpa >= 3.5 AND usage_frequency_score >= 4')} AS high_gpa_high_usage_pct,
      {PCT('gpa < 2.5 AND usage_frequency_score >= 4')} AS low_gpa_high_usage_pct, {PCT('gpa < 2.5 AND attendance_rate < 0.7e0')} AS at_risk_pct,
      {PCT('gpa >= 3.5 AND usage_frequency_score >= 4 AND satisfaction_level >= 4')} AS star_performer_pct,
      AVG(gpa) FILTER (WHERE usage_frequency_score >= 4) AS h, AVG(gpa) FILTER (WHERE usage_frequency_score < 2) AS l
      FROM students GROUP BY field_of_study)
    SELECT * EXCLUDE (h, l), {R('h - l', 3)} AS gpa_difference_by_usage, CASE WHEN l > 0 THEN {R('(h / l - 1) * 100', 1)} END AS ai_effectiveness_index FROM s""",
)
def segments(spark, sf_dir):
    return cohorts.segments(roles.students(spark, sf_dir))


@query(
    "pruned_summary",
    f"""WITH {S} SELECT field_of_study, COUNT(*) AS student_count, {R('AVG(gpa)', 6)} AS avg_gpa, {R('AVG(usage_frequency_score)', 6)} AS avg_usage,
      {R('STDDEV(gpa)', 6)} AS gpa_stddev FROM students WHERE {IN_FIELDS} AND semester = '1999' GROUP BY field_of_study""",
)
def pruned_summary(spark, sf_dir):
    return scaling.pruned_summary(roles.students(spark, sf_dir), {"field_of_study": SOME_FIELDS, "semester": ["1999"]})


@query(
    "monthly_trend",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, COUNT(*) AS monthly_count,
      {R('AVG(o_totalprice)', 4)} AS avg_monthly_gpa, {R('AVG(o_custkey)', 4)} AS avg_monthly_usage FROM orders
      WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-12-31' GROUP BY 1, 2""",
)
def monthly_trend(spark, sf_dir):
    orders = roles.table(spark, sf_dir, "orders")
    since, before = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1998-12-31").cast("timestamp_ntz")
    out = scaling.monthly_trend(orders, "o_orderdate", since, before, "o_orderpriority", "o_totalprice", "o_custkey", 4)
    return out.withColumn("month", F.date_format("month", "yyyy-MM"))


def _per_row(column: str, digits: int, name: str) -> str:
    return f"{R(f'SUM({column}) / CAST(COUNT(*) AS DOUBLE)', digits)} AS {name}"


@query(
    "staged_statistics",
    f"""WITH {S}, s AS (SELECT field_of_study, COUNT(*) AS student_count, {_per_row('gpa', 3, 'avg_gpa')}, {R('STDDEV(gpa)', 3)} AS gpa_stddev,
      {_per_row('usage_frequency_score', 2, 'avg_usage')}, {_per_row('satisfaction_level', 2, 'avg_satisfaction')},
      {_per_row('num_ai_tools', 1, 'avg_tools')}, {_per_row('attendance_rate', 3, 'avg_attendance')},
      {PCT('gpa >= 3.5')} AS high_performer_pct, {PCT('gpa < 2.5')} AS low_performer_pct, {PCT('usage_frequency_score >= 4')} AS high_user_pct,
      {PCT('satisfaction_level >= 4')} AS highly_satisfied_pct, {R(CORR('gpa', 'usage_frequency_score'), 4)} AS gpa_usage_correlation,
      {R('MAX(gpa) - MIN(gpa)', 3)} AS gpa_range, {R('MAX(usage_frequency_score) - MIN(usage_frequency_score)', 2)} AS usage_range
      FROM students WHERE {IN_FIELDS} AND {IN_TERMS} GROUP BY field_of_study)
    SELECT *, {R('avg_gpa * 0.3e0 + avg_usage * 0.2e0 + avg_satisfaction * 0.2e0 + avg_attendance * 4 * 0.15e0 + high_performer_pct * 0.01e0 * 0.15e0', 3)} AS composite_score FROM s""",
)
def staged_statistics(spark, sf_dir):
    return scaling.staged_statistics(roles.students(spark, sf_dir), {"field_of_study": SOME_FIELDS, **TOP_TERMS})


@query(
    "top_students",
    f"""WITH {S}, r AS (SELECT student_id, field_of_study, gpa, usage_frequency_score, satisfaction_level, row_number() OVER
      (PARTITION BY field_of_study ORDER BY gpa DESC, usage_frequency_score DESC, student_id) AS rank_in_field FROM students
      WHERE semester = '1999') SELECT * FROM r WHERE rank_in_field <= 10""",
)
def top_students(spark, sf_dir):
    return scaling.top_students(roles.students(spark, sf_dir), {"semester": ["1999"]})


HASH = "CAST('0x' || substr(md5(CAST(student_id AS VARCHAR)), 1, 8) AS BIGINT) % 100"


@query(
    "sampled_estimates",
    f"""WITH {S}, s AS (SELECT field_of_study, COUNT(*) AS n, AVG(gpa) AS m, STDDEV(gpa) AS sd, AVG(usage_frequency_score) AS um,
      STDDEV(usage_frequency_score) AS usd, quantile_disc(gpa, 0.5) AS med, {CORR('gpa', 'usage_frequency_score')} AS r
      FROM students WHERE {HASH} < 10 GROUP BY field_of_study HAVING COUNT(*) >= 20)
    SELECT field_of_study, n AS sample_size, n * 10 AS estimated_total, {R('m', 3)} AS estimated_avg_gpa, {R('sd', 3)} AS estimated_gpa_stddev,
      {R('um', 2)} AS estimated_avg_usage, {R('usd', 2)} AS estimated_usage_stddev, {R('med', 3)} AS estimated_median_gpa,
      {R('r', 4)} AS estimated_correlation, {R('m - 1.96e0 * sd / sqrt(n)', 3)} AS gpa_ci_lower, {R('m + 1.96e0 * sd / sqrt(n)', 3)} AS gpa_ci_upper,
      {R('1.96e0 * sd / sqrt(n)', 3)} AS margin_of_error, CASE WHEN n >= 100 THEN 'High Quality' WHEN n >= 50 THEN 'Good Quality'
      WHEN n >= 20 THEN 'Acceptable Quality' ELSE 'Low Quality' END AS sample_quality FROM s""",
)
def sampled_estimates(spark, sf_dir):
    return scaling.sampled_estimates(roles.students(spark, sf_dir))


@query(
    "window_bundle",
    f"""WITH {S}, f AS (SELECT * FROM students WHERE {IN_FIELDS} AND {IN_TERMS}),
    w AS (SELECT *, row_number() OVER (PARTITION BY field_of_study, semester ORDER BY gpa DESC, student_id) AS gpa_rank,
      dense_rank() OVER (PARTITION BY field_of_study, semester ORDER BY gpa DESC) AS gpa_dense_rank,
      percent_rank() OVER (PARTITION BY field_of_study, semester ORDER BY gpa) AS pr,
      AVG(gpa) OVER (PARTITION BY student_id ORDER BY semester ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS ma,
      COUNT(*) OVER (PARTITION BY field_of_study, semester) AS n FROM f)
    SELECT field_of_study, semester, student_id, gpa, usage_frequency_score, gpa_rank, gpa_dense_rank, {R('pr', 3)} AS gpa_percentile,
      {R('ma', 3)} AS moving_avg_gpa, n AS total_students_in_group, {R('(gpa_rank - 1e0) / NULLIF(n - 1, 0)', 3)} AS relative_position,
      {TIER} AS performance_tier FROM w WHERE gpa_rank <= 20""",
)
def window_bundle(spark, sf_dir):
    return scaling.window_bundle(written_students(spark, sf_dir, f"{IN_FIELDS} AND {IN_TERMS}", GRADED), {"field_of_study": SOME_FIELDS, **TOP_TERMS})


@query(
    "benchmark_grades",
    f"""WITH {S}, f AS (SELECT * FROM students WHERE semester = '1999'), s AS (SELECT field_of_study, COUNT(*) AS n, AVG(gpa) AS m,
      STDDEV(gpa) AS sd FROM f GROUP BY field_of_study HAVING COUNT(*) >= 10)
    SELECT field_of_study, student_id, gpa, usage_frequency_score, satisfaction_level, attendance_rate, n AS total_students,
      {R('m', 6)} AS field_avg_gpa, {R('sd', 6)} AS field_stddev_gpa, {R('gpa - m', 3)} AS gpa_vs_field_avg,
      CASE WHEN sd > 0 THEN {R('(gpa - m) / sd', 3)} ELSE 0 END AS gpa_z_score,
      CASE WHEN gpa >= m + sd THEN 'Above Average' WHEN gpa >= m THEN 'Average' WHEN gpa >= m - sd THEN 'Below Average'
      ELSE 'Well Below Average' END AS performance_grade FROM f JOIN s USING (field_of_study)""",
)
def benchmark_grades(spark, sf_dir):
    return scaling.benchmark_grades(written_students(spark, sf_dir, "semester = '1999'", GRADED), {"semester": ["1999"]})


@query(
    "approximate_summary",
    f"""WITH {S} SELECT field_of_study, COUNT(*) AS total_students, COUNT(gpa) AS valid_gpa_count, {R('AVG(gpa)', 3)} AS approx_avg_gpa,
      {R('STDDEV(gpa)', 3)} AS approx_stddev_gpa, quantile_disc(gpa, 0.25) AS approx_gpa_q1, quantile_disc(gpa, 0.5) AS approx_gpa_median,
      quantile_disc(gpa, 0.75) AS approx_gpa_q3, {PCT('gpa >= 3.5')} AS high_performer_pct, {PCT('usage_frequency_score >= 4')} AS high_usage_pct,
      {R(CORR('gpa', 'usage_frequency_score'), 4)} AS gpa_usage_correlation, TRUE AS distinct_within_bound
      FROM students GROUP BY field_of_study HAVING COUNT(*) >= 20""",
)
def approximate_summary(spark, sf_dir):
    students = roles.students(spark, sf_dir)
    rough = scaling.approximate_summary(students)
    exact = students.groupBy("field_of_study").agg(F.count_distinct("student_id").alias("exact"))
    error = F.abs(F.col("approx_unique_students") / F.col("exact") - 1)
    checked = rough.join(exact, "field_of_study").withColumn("distinct_within_bound", error <= 3 * 0.02)
    return checked.drop("exact", "approx_unique_students", "approx_unique_usage_scores")


# --- three-source integration --------------------------------------------------------------------

USAGE_CLEAN = """u AS (SELECT student_id, field_of_study, year_of_study, len(string_split(ai_tools_used, ',')) AS num_ai_tools,
  CASE frequency_of_use WHEN 'Daily' THEN 5 WHEN 'Weekly' THEN 4 WHEN 'Monthly' THEN 3 WHEN 'Rarely' THEN 2 ELSE 1 END AS usage_frequency_score,
  satisfaction_level, primary_use_case, CASE WHEN frequency_of_use IN ('Daily', 'Weekly') THEN 'High' WHEN frequency_of_use = 'Monthly'
  THEN 'Medium' ELSE 'Low' END AS usage_intensity FROM usage)"""
ACADEMIC_CLEAN = """a AS (SELECT student_id, semester, gpa, major_gpa, credits_completed, attendance_rate, assignment_submission_rate,
  CASE WHEN gpa >= 3.5 THEN 'High' WHEN gpa >= 2.5 THEN 'Medium' ELSE 'Low' END AS performance_category,
  attendance_rate * 0.4e0 + assignment_submission_rate * 0.6e0 AS engagement_score FROM terms
  WHERE gpa BETWEEN 0 AND 4 AND attendance_rate BETWEEN 0 AND 1)"""
POINTS = "CASE grade WHEN 'A+' THEN 43 WHEN 'A' THEN 40 WHEN 'B+' THEN 33 WHEN 'B' THEN 30 WHEN 'C+' THEN 23 WHEN 'C' THEN 20 WHEN 'D' THEN 10 ELSE 0 END"
ENROLL_AGG = f"""e AS (SELECT student_id, semester, COUNT(course_code) AS total_courses, CAST(SUM(credit_hours) AS BIGINT) AS total_credits,
  SUM({POINTS}) / 10e0 / COUNT(*) AS calculated_gpa, list_sort(list(DISTINCT course_name)) AS courses_taken,
  list_sort(list(DISTINCT department)) AS departments, CAST(COUNT(DISTINCT department) AS INT) AS academic_diversity
  FROM enrollment GROUP BY student_id, semester)"""
INTEGRATED = f"{roles.USAGE_SQL}, {roles.TERMS_SQL}, {roles.ENROLLMENT_SQL}, {USAGE_CLEAN}, {ACADEMIC_CLEAN}, {ENROLL_AGG}, i AS (SELECT * FROM u JOIN a USING (student_id) LEFT JOIN e USING (student_id, semester))"


def integrated_frame(spark, sf_dir):
    return integration.integrate(
        roles.usage(spark, sf_dir), roles.terms(spark, sf_dir), roles.enrollment(spark, sf_dir), repeats=False
    )


@query(
    "clean_usage",
    f"WITH {roles.USAGE_SQL}, {USAGE_CLEAN} SELECT * REPLACE (CAST(num_ai_tools AS INT) AS num_ai_tools) FROM u",
)
def clean_usage(spark, sf_dir):
    return scoring.clean_usage(roles.usage(spark, sf_dir))


@query(
    "clean_academic",
    f"WITH {roles.TERMS_SQL}, {ACADEMIC_CLEAN} SELECT * REPLACE ({R('engagement_score', 6)} AS engagement_score) FROM a",
)
def clean_academic(spark, sf_dir):
    rows = scoring.clean_academic(roles.terms(spark, sf_dir))
    return rows.withColumn("engagement_score", settled_round(F.col("engagement_score"), 6))


@query(
    "enrollment_summary",
    f"""WITH {roles.ENROLLMENT_SQL}, {ENROLL_AGG} SELECT * REPLACE ({R('calculated_gpa', 6)} AS calculated_gpa,
      array_to_string(courses_taken, '|') AS courses_taken, array_to_string(departments, '|') AS departments) FROM e""",
)
def enrollment_summary(spark, sf_dir):
    out = aggregates.enrollment_summary(roles.enrollment(spark, sf_dir), repeats=False)
    return out.withColumns(
        {
            "calculated_gpa": settled_round(F.col("calculated_gpa"), 6),
            "courses_taken": F.array_join("courses_taken", "|"),
            "departments": F.array_join("departments", "|"),
        }
    )


@query(
    "enrollment_with_repeats",
    f"""WITH {roles.ENROLLMENT_SQL} SELECT student_id, semester, COUNT(course_code) AS total_courses, CAST(SUM(credit_hours) AS BIGINT) AS total_credits,
      {R(f'SUM({POINTS}) / 10e0 / COUNT(*)', 6)} AS calculated_gpa, array_to_string(list_sort(list(course_name)), '|') AS courses_taken,
      array_to_string(list_sort(list(department)), '|') AS departments, CAST(COUNT(DISTINCT department) AS INT) AS academic_diversity
      FROM enrollment GROUP BY student_id, semester""",
)
def enrollment_with_repeats(spark, sf_dir):
    out = aggregates.enrollment_summary(roles.enrollment(spark, sf_dir))
    joined = {c: F.array_join(c, "|") for c in ("courses_taken", "departments")}
    return out.withColumns({"calculated_gpa": settled_round(F.col("calculated_gpa"), 6), **joined})


@query(
    "integrated_analysis",
    f"""WITH {INTEGRATED} SELECT student_id, semester, field_of_study, year_of_study, CAST(num_ai_tools AS INT) AS num_ai_tools,
      usage_frequency_score, satisfaction_level, primary_use_case, usage_intensity, gpa, major_gpa, credits_completed, attendance_rate,
      assignment_submission_rate, performance_category, {R('engagement_score', 6)} AS engagement_score, total_courses, total_credits,
      {R('calculated_gpa', 6)} AS calculated_gpa, array_to_string(courses_taken, '|') AS courses_taken, academic_diversity FROM i""",
)
def integrated_analysis(spark, sf_dir):
    return integrated_frame(spark, sf_dir).withColumns(
        {
            "engagement_score": settled_round(F.col("engagement_score"), 6),
            "calculated_gpa": settled_round(F.col("calculated_gpa"), 6),
            "courses_taken": F.array_join("courses_taken", "|"),
        }
    ).drop("departments")


INSIGHT = f"""SELECT {{keys}}, COUNT(*) AS student_count, {R('AVG(num_ai_tools)', 6)} AS avg_ai_tools_used,
  {R('AVG(usage_frequency_score)', 6)} AS avg_usage_frequency, {R('AVG(satisfaction_level)', 6)} AS avg_satisfaction,
  {R('AVG(gpa)', 6)} AS avg_gpa, {R('AVG(major_gpa)', 6)} AS avg_major_gpa, {R('AVG(engagement_score)', 6)} AS avg_engagement,
  {R('AVG(academic_diversity)', 6)} AS avg_academic_diversity, {R(CORR('usage_frequency_score', 'gpa'), 6)} AS usage_gpa_correlation,
  {R(CORR('satisfaction_level', 'engagement_score'), 6)} AS satisfaction_engagement_correlation,
  {R('STDDEV(gpa)', 6)} AS gpa_stddev, MIN(gpa) AS min_gpa, MAX(gpa) AS max_gpa
  FROM i GROUP BY {{keys}} HAVING COUNT(*) >= 5"""


def _rounded(df, digits=6):
    skip = {"min_gpa", "max_gpa"}
    return df.withColumns({n: settled_round(F.col(n), digits) for n, t in df.dtypes if t == "double" and n not in skip})


@query("insights", f"WITH {INTEGRATED} " + INSIGHT.format(keys="field_of_study, performance_category, usage_intensity"))
def insights(spark, sf_dir):
    return _rounded(aggregates.insight_summary(integrated_frame(spark, sf_dir)))


@query("insights_by_use_case", f"WITH {INTEGRATED} " + INSIGHT.format(keys="primary_use_case"))
def insights_by_use_case(spark, sf_dir):
    return _rounded(aggregates.insight_summary(integrated_frame(spark, sf_dir), ["primary_use_case"]))


OUTLIERS = """z AS (SELECT *, (gpa - m) / NULLIF(sd, 0) AS zg, (usage_frequency_score - um) / NULLIF(usd, 0) AS zu FROM
  (SELECT *, AVG(gpa) OVER f AS m, STDDEV(gpa) OVER f AS sd, AVG(usage_frequency_score) OVER g AS um, STDDEV(usage_frequency_score) OVER g AS usd
   FROM students WINDOW f AS (PARTITION BY field_of_study), g AS (PARTITION BY field_of_study, year_of_study))),
  o AS (SELECT *, coalesce(abs(zg) > 1.8, FALSE) AS is_gpa_outlier, coalesce(abs(zu) > 1.45, FALSE) AS is_usage_outlier FROM z)"""
OUTLIER_TYPE = "CASE WHEN is_gpa_outlier AND is_usage_outlier THEN 'Both' WHEN is_gpa_outlier THEN 'GPA' ELSE 'Usage' END"


def typed_outliers(spark, sf_dir):
    # the driver measures are uniform, so the default limits of 2.5 and 2.0 would find nothing
    rows = roles.students(spark, sf_dir).select("student_id", "semester", "field_of_study", "year_of_study", "gpa", "usage_frequency_score")
    return windows.typed_outliers(rows, measure_limit=1.8, usage_limit=1.45)


@query(
    "outliers",
    f"""WITH {S}, {OUTLIERS} SELECT student_id, semester, field_of_study, year_of_study, gpa, usage_frequency_score, {R('zg', 5)} AS gpa_z_score,
      {R('zu', 5)} AS usage_z_score, is_gpa_outlier, is_usage_outlier, {OUTLIER_TYPE} AS outlier_type FROM o WHERE is_gpa_outlier OR is_usage_outlier""",
)
def outliers(spark, sf_dir):
    return typed_outliers(spark, sf_dir).select(
        "student_id",
        "semester",
        "field_of_study",
        "year_of_study",
        "gpa",
        "usage_frequency_score",
        settled_round(F.col("gpa_z_score"), 5).alias("gpa_z_score"),
        settled_round(F.col("usage_z_score"), 5).alias("usage_z_score"),
        "is_gpa_outlier",
        "is_usage_outlier",
        "outlier_type",
    )


@query(
    "part_lists",
    """WITH n AS (SELECT l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey * 10 + l_linenumber) - 1 AS i FROM lineitem)
    SELECT l_suppkey, CAST(i // 50 AS BIGINT) AS part, CAST(MIN(i) + 1 AS BIGINT) AS first, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY i) AS items FROM n GROUP BY 1, 2""",
)
def part_lists(spark, sf_dir):
    """Parts that a supplier delivered, in order, repeats included, in lists of fifty."""
    lines = roles.table(spark, sf_dir, "lineitem").withColumn("line", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    out = aggregates.list_segments(lines, ["l_suppkey"], "l_shipdate", "l_partkey", "line", 50)
    return out.withColumn("items", F.array_join(F.transform("items", lambda x: x.cast("string")), ","))


@query(
    "part_sets",
    """WITH d AS (SELECT DISTINCT l_linestatus, l_returnflag, l_partkey FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY l_linestatus, l_returnflag ORDER BY l_partkey) - 1 AS i FROM d)
    SELECT l_linestatus, l_returnflag, CAST(i // 300 AS BIGINT) AS part, CAST(MIN(i) + 1 AS BIGINT) AS first, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY i) AS items FROM n GROUP BY 1, 2, 3""",
)
def part_sets(spark, sf_dir):
    """Distinct parts of a few hot keys, in lists of three hundred."""
    out = aggregates.set_segments(roles.table(spark, sf_dir, "lineitem"), ["l_linestatus", "l_returnflag"], "l_partkey", 300)
    return out.withColumn("items", F.array_join(F.transform("items", lambda x: x.cast("string")), ","))


@query(
    "group_outliers",
    f"""WITH g AS (SELECT *, AVG(l_quantity) OVER w AS m, STDDEV(l_quantity) OVER w AS sd FROM lineitem WINDOW w AS (PARTITION BY l_linestatus, l_returnflag)),
      z AS (SELECT *, (l_quantity - m) / NULLIF(sd, 0) AS z FROM g)
    SELECT l_orderkey, l_linenumber, {R('z', 6)} AS z, coalesce(abs(z) > 1.6, FALSE) AS far FROM z""",
)
def group_outliers(spark, sf_dir):
    lines = roles.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity")
    out = windows.group_outliers(lines, ["l_linestatus", "l_returnflag"], "l_quantity", 1.6, "z", "far")
    return out.select("l_orderkey", "l_linenumber", settled_round(F.col("z"), 6).alias("z"), "far")


@query(
    "grain_statistics",
    " UNION ALL ".join(
        f"""SELECT {flag} AS l_returnflag, {mode} AS l_linestatus, COUNT(*) AS n, {R('AVG(l_extendedprice)', 4)} AS mean, {R('STDDEV(l_extendedprice)', 4)} AS sd,
          MIN(l_extendedprice) AS low, MAX(l_extendedprice) AS high FROM lineitem GROUP BY ALL"""
        for flag, mode in (("l_returnflag", "l_linestatus"), ("l_returnflag", "NULL"), ("NULL", "NULL"))
    ),
)
def grain_statistics(spark, sf_dir):
    """Flag and mode, flag alone, and everything: one scan, two roll-ups."""
    names = ["l_extendedprice"]
    fine = moments.moments(roles.table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], names)
    flags = moments.rolled_up(fine, ["l_returnflag"], names)
    none = F.lit(None).cast("string")
    both = fine.unionByName(flags.withColumn("l_linestatus", none)).unionByName(moments.rolled_up(flags, [], names).withColumns({"l_returnflag": none, "l_linestatus": none}))
    return both.select(
        "l_returnflag",
        "l_linestatus",
        F.col("rows").alias("n"),
        settled_round(moments.mean_of("l_extendedprice"), 4).alias("mean"),
        settled_round(moments.deviation_of("l_extendedprice"), 4).alias("sd"),
        F.col("l_extendedprice__low").alias("low"),
        F.col("l_extendedprice__high").alias("high"),
    )


@query(
    "outlier_share",
    f"""WITH {S}, {OUTLIERS} SELECT {OUTLIER_TYPE} AS outlier_type, COUNT(*) AS n, {R('100.0 * CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM students)', 2)} AS pct
      FROM o WHERE is_gpa_outlier OR is_usage_outlier GROUP BY 1""",
)
def outlier_share(spark, sf_dir):
    return survey.outlier_share(typed_outliers(spark, sf_dir), roles.students(spark, sf_dir))


@query(
    "period_bundle",
    f"""WITH {roles.TERMS_SQL} SELECT student_id, semester, CAST(row_number() OVER w AS INT) AS row_number, CAST(rank() OVER w AS INT) AS rank,
      CAST(SUM(credits_completed) OVER w AS BIGINT) AS running_total FROM terms WINDOW w AS (PARTITION BY student_id ORDER BY semester)""",
)
def period_bundle(spark, sf_dir):
    terms = roles.terms(spark, sf_dir).select("student_id", "semester", "credits_completed")
    return windows.period_bundle(terms, "student_id", "semester", "credits_completed").drop("credits_completed")


@query(
    "top_outliers",
    f"""WITH {S}, {OUTLIERS} SELECT student_id, semester, {R('zg', 5)} AS gpa_z_score FROM o WHERE is_gpa_outlier OR is_usage_outlier
      ORDER BY abs({R('zg', 5)}) DESC, student_id, semester LIMIT 10""",
)
def top_outliers(spark, sf_dir):
    rows = typed_outliers(spark, sf_dir).withColumn("gpa_z_score", settled_round(F.col("gpa_z_score"), 5))
    return survey.top_outliers(rows.select("student_id", "semester", "gpa_z_score"), "gpa_z_score", ["student_id", "semester"])


@query(
    "top_correlations",
    f"WITH {INTEGRATED} SELECT field_of_study, performance_category, usage_intensity, student_count, usage_gpa_correlation FROM ("
    + INSIGHT.format(keys="field_of_study, performance_category, usage_intensity")
    + ") ORDER BY abs(usage_gpa_correlation) DESC NULLS LAST, 1, 2, 3 LIMIT 10",
)
def top_correlations(spark, sf_dir):
    rows = _rounded(aggregates.insight_summary(integrated_frame(spark, sf_dir)))
    kept = rows.select("field_of_study", "performance_category", "usage_intensity", "student_count", "usage_gpa_correlation")
    return survey.top_correlations(kept, "usage_gpa_correlation")


@query(
    "join_reconciliation",
    f"""WITH {INTEGRATED} SELECT 'integrated' AS join_name, (SELECT COUNT(*) FROM u) AS rows_before, (SELECT COUNT(*) FROM i) AS rows_after""",
)
def join_reconciled(spark, sf_dir):
    return join_reconciliation(roles.usage(spark, sf_dir), integrated_frame(spark, sf_dir), "integrated")
