"""Data quality: profile, rules, consistency, outliers, references, verdict and gate.

All counts of a table that need no shuffle come from one aggregate over the table: rules are
turned into ``count_if`` expressions first and unpivoted into report rows afterwards. The report is
a DataFrame with one row per check and column:
``table_name, check, column_name, invalid, total, percentage, rule, status``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.expr import outside, pct, spread, z_score
from tallyforge.operators.cleaning import numeric_columns
from tallyforge.operators.joins import with_total_stats
from tallyforge.operators.ranking import column_quantiles

REPORT = "table_name string, check string, column_name string, invalid long, total long, percentage double, rule string, status string"


@dataclass(frozen=True)
class Check:
    """One counted condition. ``bad`` marks an invalid row; a NULL condition does not count."""

    check: str
    column: str
    bad: Column
    rule: str
    judged: bool = True
    total: Column | None = None


def null_checks(df: DataFrame) -> list[Check]:
    return [Check("null_values", c, F.col(c).isNull(), f"{c} should be present", judged=False) for c in df.columns]


def blank_checks(df: DataFrame, trim: bool = False) -> list[Check]:
    """Empty or single-space strings; with ``trim`` any string of spaces."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]

    def blank(c: str) -> Column:
        return F.trim(c) == "" if trim else F.col(c).isin("", " ")

    return [Check("empty_strings", c, blank(c), f"{c} should not be blank", judged=False) for c in texts]


def range_rule(name: str, column: str, low: float, high: float) -> Check:
    bad = (F.col(column) < low) | (F.col(column) > high)
    return Check(name, column, bad, f"{column} should be between {low} and {high}")


def category_rule(name: str, column: str, values: Sequence[Any]) -> Check:
    return Check(name, column, ~F.col(column).isin(list(values)), f"{column} should be one of {list(values)}")


def pattern_rule(name: str, column: str, pattern: str) -> Check:
    return Check(name, column, ~F.col(column).rlike(pattern), f"{column} should match pattern {pattern}")


def positive_rule(name: str, column: str) -> Check:
    return Check(name, column, F.col(column) <= 0, f"{column} should be positive")


def order_rule(name: str, first: str, second: str) -> Check:
    return Check(name, first, F.col(first) > F.col(second), f"{first} should be <= {second}", judged=False)


def agreement_rule(name: str, one: str, other: str, limit: float = 1.5) -> Check:
    bad = F.abs(F.col(one) - F.col(other)) > limit
    return Check(name, one, bad, f"{one} and {other} should not differ by more than {limit}", judged=False)


def rules_from(config: Mapping[str, Mapping[str, Any]]) -> list[Check]:
    """Checks from a rule dictionary: ``{name: {type, column, ...}}``."""
    makers = {
        "range": lambda n, r: range_rule(n, r["column"], r["min"], r["max"]),
        "categorical": lambda n, r: category_rule(n, r["column"], r["valid_values"]),
        "pattern": lambda n, r: pattern_rule(n, r["column"], r["pattern"]),
        "positive": lambda n, r: positive_rule(n, r["column"]),
    }
    return [makers[rule["type"]](name, rule) for name, rule in config.items()]


def consistency_checks(df: DataFrame, limit: float = 1.5, dates: tuple[str, str] | None = None) -> list[Check]:
    """Checks that follow from column names and types.

    The first two date or timestamp columns must be in order (or the named ones), ``gpa`` and
    ``major_gpa`` must agree, and every fractional column with ``rate`` in its name lies in [0, 1].
    """
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    in_time = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
    pair = dates or (tuple(in_time[:2]) if len(in_time) >= 2 else None)
    checks = [order_rule("date_consistency", *pair)] if pair else []
    if {"gpa", "major_gpa"} <= set(df.columns):
        checks.append(agreement_rule("gpa_consistency", "gpa", "major_gpa", limit))
    for f in df.schema.fields:
        if "rate" in f.name.lower() and isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            bad = (F.col(f.name) < 0) | (F.col(f.name) > 1)
            checks.append(Check(f"{f.name}_range_consistency", f.name, bad, f"{f.name} should be between 0 and 1", judged=False))
    return checks


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Count all checks in one pass. A check that the schema cannot resolve is reported as ERROR."""
    good, broken = [], []
    for check in checks:
        try:
            df.select(check.bad)
            good.append(check)
        except AnalysisException as e:
            broken.append((check, e.getCondition() or "unresolvable"))
    spark = df.sparkSession
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(c.bad).alias(f"__bad_{i}") for i, c in enumerate(good)],
    )

    def line(i: int, c: Check) -> Column:
        bad, rows = F.col(f"__bad_{i}"), F.col("__rows")
        status = F.when(bad == 0, "PASS").otherwise("FAIL") if c.judged else F.lit(None).cast("string")
        return F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c.check).alias("check"),
            F.lit(c.column).alias("column_name"),
            bad.alias("invalid"),
            rows.alias("total"),
            F.coalesce(pct(bad, rows, 2), F.lit(0.0)).alias("percentage"),
            F.lit(c.rule).alias("rule"),
            status.alias("status"),
        )

    report = None
    if good:
        report = counts.select(F.explode(F.array(*[line(i, c) for i, c in enumerate(good)])).alias("r")).select("r.*")
    errors = [(table, c.check, c.column, None, None, None, f"{c.rule} ({why})", "ERROR") for c, why in broken]
    if errors or report is None:
        failed = spark.createDataFrame(errors, REPORT)
        report = failed if report is None else report.unionByName(failed)
    return report


def type_profile(df: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")


def duplicate_profile(df: DataFrame, table: str = "table", keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each whole-row (or key) group.

    Identical rows collapse in a partial count before the shuffle; NULLs are equal. What is shuffled is a pair of
    64-bit hashes, not the row: among 10^12 distinct rows, two share both with a chance of about 10^-15.
    """
    columns = [x for c in (keys or df.columns) for x in (F.col(c), F.col(c).isNull())]
    groups = df.groupBy(F.xxhash64(*columns).alias("__h1"), F.xxhash64(F.lit(1), *reversed(columns)).alias("__h2")).agg(F.count(F.lit(1)).alias("__n"))
    extra, rows = F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)), F.coalesce(F.sum("__n"), F.lit(0))
    return groups.agg(
        F.lit(table).alias("table_name"),
        F.lit("duplicates").alias("check"),
        F.lit(",".join(keys) if keys else "*").alias("column_name"),
        extra.alias("invalid"),
        rows.alias("total"),
        F.coalesce(pct(extra, rows, 2), F.lit(0.0)).alias("percentage"),
        F.lit("rows should be unique").alias("rule"),
        F.lit(None).cast("string").alias("status"),
    )


def outlier_profile(
    df: DataFrame, columns: Sequence[str] | None = None, z_limit: float = 3.0, total: str | None = None
) -> DataFrame:
    """Per numeric column: mean, deviation, quartiles, and how many values are far out by z-score and by IQR.

    One pass for the moments, one for exact quartiles, one for all counts. Columns without spread are left out. ``total`` names a column
    for the number of rows.
    """
    columns = list(columns or numeric_columns(df))
    stats: dict[str, Column] = {}
    for i, c in enumerate(columns):
        stats[f"__mean_{i}"] = F.avg(c)
        stats[f"__sd_{i}"] = spread(c)
    rows = with_total_stats(df.select(*columns), stats)
    quartiles = column_quantiles(df, columns, [0.25, 0.75]).select(F.array(*[F.col(c) for c in columns])).scalar()
    rows = rows.withColumn("__quartiles", quartiles).withColumns({f"__q_{i}": F.col("__quartiles")[i] for i in range(len(columns))})
    counts = []
    for i, c in enumerate(columns):
        q1, q3 = F.col(f"__q_{i}")[0], F.col(f"__q_{i}")[1]
        fence = 1.5 * (q3 - q1)
        counts += [
            F.count_if(outside(z_score(c, f"__mean_{i}", f"__sd_{i}"), z_limit)).alias(f"__z_{i}"),
            F.count_if((F.col(c) < q1 - fence) | (F.col(c) > q3 + fence)).alias(f"__iqr_{i}"),
            *[F.first(s).alias(s) for s in (f"__mean_{i}", f"__sd_{i}", f"__q_{i}")],
        ]
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"__z_{i}").alias("zscore_outliers"),
            F.col(f"__iqr_{i}").alias("iqr_outliers"),
            F.round(f"__mean_{i}", 4).alias("mean"),
            F.round(f"__sd_{i}", 4).alias("stddev"),
            F.round(F.col(f"__q_{i}")[0], 4).alias("q1"),
            F.round(F.col(f"__q_{i}")[1], 4).alias("q3"),
            (F.col(f"__sd_{i}") > 0).alias("__varies"),
        )
        for i, c in enumerate(columns)
    ]
    wide = rows.agg(*counts, F.count(F.lit(1)).alias("__total"))
    long = wide.select(F.explode(F.array(*lines)).alias("r"), *([F.col("__total").alias(total)] if total else []))
    return long.select("r.*", *([total] if total else [])).filter("__varies").drop("__varies")


def reference_check(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, table: str = "child", parent_name: str = "parent"
) -> DataFrame:
    """References that point to no parent row.

    The child is reduced to distinct keys with counts before the join, so a key that fills a third
    of the child is one row, and the parent keys never reach the driver.
    """
    refs = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("__n"))
    known = parent.select(F.col(parent_key).alias("__known")).filter(F.col("__known").isNotNull()).distinct()
    joined = refs.join(known, F.col(child_key) == F.col("__known"), "left")
    bad = F.coalesce(F.sum(F.when(F.col("__known").isNull(), F.col("__n")).otherwise(0)), F.lit(0))
    rows = F.coalesce(F.sum("__n"), F.lit(0))
    return joined.agg(
        F.lit(table).alias("table_name"),
        F.lit("reference").alias("check"),
        F.lit(child_key).alias("column_name"),
        bad.alias("invalid"),
        rows.alias("total"),
        F.coalesce(pct(bad, rows, 2), F.lit(0.0)).alias("percentage"),
        F.lit(f"{child_key} must exist in {parent_name}.{parent_key}").alias("rule"),
        F.when(bad == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def full_report(
    df: DataFrame,
    table: str,
    rules: Sequence[Check] = (),
    references: Sequence[tuple[str, DataFrame, str, str]] = (),
    outliers: bool = True,
) -> DataFrame:
    """All checks of one table as one report.

    ``references`` are ``(child_key, parent, parent_key, parent_name)``.
    """
    checks = [*null_checks(df), *blank_checks(df), *rules, *consistency_checks(df)]
    report = run_checks(df, table, checks).unionByName(duplicate_profile(df, table))
    if outliers and numeric_columns(df):
        report = report.unionByName(
            outlier_profile(df, total="total").select(
                F.lit(table).alias("table_name"),
                F.lit("zscore_outliers").alias("check"),
                "column_name",
                F.col("zscore_outliers").alias("invalid"),
                "total",
                pct(F.col("zscore_outliers"), F.col("total"), 2).alias("percentage"),
                F.lit("values should lie within three standard deviations").alias("rule"),
                F.lit(None).cast("string").alias("status"),
            )
        )
    for key, parent, parent_key, parent_name in references:
        report = report.unionByName(reference_check(df, key, parent, parent_key, table, parent_name))
    return report


# --- fixed values: limits of the verdict ---------------------------------------------------------
NULL_CRITICAL, NULL_WARNING = 50.0, 20.0
DUPLICATE_CRITICAL, DUPLICATE_WARNING = 20.0, 5.0
RULE_CRITICAL = 10.0


def severity_of(
    null_limits: tuple[float, float] = (NULL_CRITICAL, NULL_WARNING),
    duplicate_limits: tuple[float, float] = (DUPLICATE_CRITICAL, DUPLICATE_WARNING),
    rule_critical: float = RULE_CRITICAL,
) -> Column:
    """Severity of a report row: critical, warning or NULL."""
    check, share = F.col("check"), F.col("percentage")
    return (
        F.when((check == "null_values") & (share > null_limits[0]), "critical")
        .when((check == "null_values") & (share > null_limits[1]), "warning")
        .when((check == "duplicates") & (share > duplicate_limits[0]), "critical")
        .when((check == "duplicates") & (share > duplicate_limits[1]), "warning")
        .when((F.col("status") == "FAIL") & (share > rule_critical), "critical")
        .when(F.col("status").isin("FAIL", "ERROR"), "warning")
    )


def issues(report: DataFrame, **limits: Any) -> DataFrame:
    """Report rows that matter, with a ``severity`` of critical or warning."""
    return report.withColumn("severity", severity_of(**limits)).filter(F.col("severity").isNotNull())


def verdict(report: DataFrame, **limits: Any) -> DataFrame:
    """One row: tables checked, critical and warning counts, overall status."""
    marked = report.withColumn("severity", severity_of(**limits))
    critical = F.count_if(F.col("severity") == "critical")
    return marked.agg(
        F.count_distinct("table_name").alias("total_tables_checked"),
        critical.alias("critical_issues_count"),
        F.count_if(F.col("severity") == "warning").alias("warnings_count"),
        F.when(critical > 0, "FAIL").otherwise("PASS").alias("overall_status"),
    )


def strict_verdict(report: DataFrame) -> DataFrame:
    """The short variant: more than 20 per cent NULL or 10 per cent duplicates fails, nothing else does."""
    bad = ((F.col("check") == "null_values") & (F.col("percentage") > 20)) | (
        (F.col("check") == "duplicates") & (F.col("percentage") > 10)
    )
    return report.agg(F.when(F.count_if(bad) > 0, "FAIL").otherwise("PASS").alias("overall_status"))


def recommendations(report: DataFrame) -> DataFrame:
    check, share = F.col("check"), F.col("percentage")
    advice = (
        F.when((check == "null_values") & (share > 20), "review data collection or set a default")
        .when((check == "duplicates") & (share > 5), "remove duplicates or enforce a unique key")
        .when((check == "zscore_outliers") & (F.col("invalid") > 0), "examine outliers and tighten validation")
    )
    return report.withColumn("recommendation", advice).filter(F.col("recommendation").isNotNull())


def table_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, total_rows, total_columns) of the tables that a report is about."""
    parts = [df.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(name).alias("table_name"), "total_rows", F.lit(len(df.columns)).alias("total_columns")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def report_document(report: DataFrame, totals: DataFrame | None = None, started: datetime | None = None, **limits: Any) -> DataFrame:
    """One nested row per table, ready for JSON: counts by severity, status, and all its checks.

    With ``totals`` the summary has the tables' rows and columns (tables without a check included), with ``started`` also the time of
    the run and its seconds. A report has a row per check and column, so a table's checks are few.
    """
    marked = report.withColumn("severity", severity_of(**limits))
    detail = F.struct("check", "column_name", "invalid", "total", "percentage", "rule", "status", "severity")
    critical = F.count_if(F.col("severity") == "critical")
    checks = marked.groupBy("table_name").agg(critical.alias("__critical"), F.count_if(F.col("severity") == "warning").alias("__warnings"), F.sort_array(F.collect_list(detail)).alias("checks"))
    summary = [
        F.when(F.coalesce("__critical", F.lit(0)) > 0, "FAIL").otherwise("PASS").alias("overall_status"),
        F.coalesce("__critical", F.lit(0)).alias("critical_issues_count"),
        F.coalesce("__warnings", F.lit(0)).alias("warnings_count"),
    ]
    if totals is not None:
        checks = totals.join(checks, "table_name", "full")
        summary += [F.col("total_rows"), F.col("total_columns")]
    if started is not None:
        begun = F.lit(started).cast("timestamp")
        summary += [begun.alias("started"), (F.current_timestamp().cast("double") - begun.cast("double")).alias("run_seconds")]
    return checks.select("table_name", F.struct(*summary).alias("summary"), F.coalesce("checks", F.array().cast(checks.schema["checks"].dataType)).alias("checks"))


class QualityError(ValueError):
    """Raised by the gate."""


def assert_quality(df: DataFrame, table: str, max_duplicate_pct: float = 10.0, max_null_pct: float | None = None) -> DataFrame:
    """Return ``df`` unchanged, or raise if it has too many duplicates or NULLs."""
    share = duplicate_profile(df, table).first()["percentage"]
    if share > max_duplicate_pct:
        raise QualityError(f"{table}: {share}% duplicate rows, at most {max_duplicate_pct}% allowed")
    if max_null_pct is not None:
        over = run_checks(df, table, null_checks(df)).filter(F.col("percentage") > max_null_pct).select("column_name")
        columns = sorted(r[0] for r in over.limit(len(df.columns)).collect())
        if columns:
            raise QualityError(f"{table}: more than {max_null_pct}% NULL in {', '.join(columns)}")
    return df


def declared_issues(df: DataFrame, table: str, rules: Mapping[str, Any]) -> DataFrame:
    """Evaluate a declarative rule set and return the violated rules.

    Keys: ``required_columns``, ``null_tolerance`` {column: share}, ``score_range`` {min, max,
    columns}, ``range_checks`` {column: {min, max}}, ``positive_values``, ``duplicate_check``.
    """
    have = set(df.columns)
    missing = [
        (table, "required_column", c, None, None, None, f"{c} is required", "FAIL")
        for c in rules.get("required_columns", [])
        if c not in have
    ]
    checks = []
    tolerance = {c: t for c, t in rules.get("null_tolerance", {}).items() if c in have}
    for c in tolerance:
        checks.append(Check("null_tolerance", c, F.col(c).isNull(), f"{c} NULL share at most {tolerance[c]}"))
    scores = rules.get("score_range", {})
    for c in scores.get("columns", []):
        if c in have:
            checks.append(range_rule("score_range", c, scores["min"], scores["max"]))
    for c, r in rules.get("range_checks", {}).items():
        if c in have:
            checks.append(range_rule("range_check", c, r["min"], r["max"]))
    checks += [positive_rule("positive_value", c) for c in rules.get("positive_values", []) if c in have]

    spark = df.sparkSession
    found = spark.createDataFrame(missing, REPORT)
    if checks:
        report = run_checks(df, table, checks)
        allowed = F.lit(0.0)
        for c, t in tolerance.items():
            allowed = F.when((F.col("check") == "null_tolerance") & (F.col("column_name") == c), float(t)).otherwise(allowed)
        found = found.unionByName(report.filter(F.col("invalid") > allowed * F.col("total")))
    for c in rules.get("duplicate_check", []):
        if c in have:
            found = found.unionByName(
                duplicate_profile(df, table, [c]).filter(F.col("invalid") > 0).withColumn("status", F.lit("FAIL"))
            )
    return found


def category_advice(df: DataFrame, max_length: int = 50, max_distinct: int = 100) -> DataFrame:
    """String columns short and repetitive enough to be treated as categories; one aggregate for all."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    wide = df.agg(
        *[F.max(F.length(c)).alias(f"__len_{i}") for i, c in enumerate(texts)],
        *[F.approx_count_distinct(c, 0.01).alias(f"__n_{i}") for i, c in enumerate(texts)],
    )
    lines = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"__len_{i}").alias("max_length"), F.col(f"__n_{i}").alias("distinct_values"))
        for i, c in enumerate(texts)
    ]
    return (
        wide.select(F.explode(F.array(*lines)).alias("r"))
        .select("r.*")
        .filter((F.col("max_length") < max_length) & (F.col("distinct_values") < max_distinct))
    )
