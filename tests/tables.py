"""Small tables for tests, by arithmetic on row numbers: every count that a test names can be worked out."""

from pyspark.sql import functions as F


def _i():
    return F.col("id")


def _student():
    return F.format_string("STU_%04d", _i())


def _cycle(values, step=1):
    """The values in turn, each ``step`` rows long."""
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(_i() / step) % len(values) + 1).cast("int"))


def marks(spark, n=500):
    """One row per student and term; gpa runs through 0.00 to 4.00 in steps that never repeat early."""
    gpa = (_i() * 37 % 401) / 100.0
    return spark.range(n).select(
        _student().alias("student_id"), _cycle(["T1", "T2"]).alias("semester"), gpa.alias("gpa"), (_i() % 40).cast("int").alias("credits_completed"),
        F.greatest(gpa - 0.5, F.lit(0.0)).alias("major_gpa"), (0.5 + (_i() % 51) / 100.0).alias("attendance_rate"), (0.4 + (_i() % 61) / 100.0).alias("assignment_submission_rate"), F.lit("2031-05-01").alias("last_updated"),
    )


def tool_survey(spark, n=500):
    return spark.range(n).select(
        _student().alias("student_id"), _cycle(["Botany", "Law", "Music"]).alias("field_of_study"), (_i() % 4 + 1).cast("int").alias("year_of_study"),
        _cycle(["pen", "pen,ruler", "", "pen,ruler,lens"]).alias("ai_tools_used"), _cycle(["Daily", "Weekly", "Never"], 2).alias("frequency_of_use"), (_i() % 5 + 1).cast("int").alias("satisfaction_level"), _cycle(["notes", "review"], 3).alias("primary_use_case"),
    )


def enrolments(spark, n=800):
    """Two rows for each of the first 400 students; the others have none."""
    return spark.range(n).select(
        F.format_string("STU_%04d", F.floor(_i() / 2)).alias("student_id"), F.format_string("C%d", _i() % 7).alias("course_code"), F.format_string("Course %d", _i() % 7).alias("course_name"), _cycle(["North", "South"]).alias("department"),
        F.lit("T1").alias("semester"), _cycle(["A", "B", "C+", "F"]).alias("grade"), (_i() % 3 + 2).cast("int").alias("credit_hours"), F.lit("Prof").alias("instructor"), F.lit("2031-03-01").alias("enrollment_date"),
    )


def exams(spark, n=1000):
    math, reading, writing = ((_i() * k % 101).cast("int") for k in (7, 11, 13))
    return spark.range(n).select(
        _student().alias("student_id"), _cycle(["female", "male"]).alias("gender"), _cycle(["group A", "group B"], 2).alias("race_ethnicity"), F.lit("high school").alias("parental_level_of_education"), F.lit("standard").alias("lunch"),
        F.lit("none").alias("test_preparation_course"), math.alias("math_score"), reading.alias("reading_score"), writing.alias("writing_score"), (math + reading + writing).alias("total_score"), ((math + reading + writing) / 3.0).alias("average_score"),
    )


def school_list(spark, n=12):
    return spark.range(n).select(
        F.format_string("S%02d", _i()).alias("school_id"), F.format_string("School %d", _i()).alias("school_name"), _cycle(["public", "private"]).alias("school_type"), _cycle(["small", "large"], 3).alias("school_size"), _cycle(["rural", "suburban", "urban"], 4).alias("region"),
        (300 + 10 * _i()).cast("int").alias("student_count"), (20 + _i()).cast("int").alias("teacher_count"), (10.0 + _i()).alias("student_teacher_ratio"), (3_000_000 + _i() * 1000).alias("annual_budget"), (9000 + 100 * _i()).cast("int").alias("budget_per_student"),
        (1950 + _i()).cast("int").alias("established_year"), (_i() % 2 == 0).alias("has_advanced_programs"), (_i() % 10 + 1).cast("int").alias("technology_score"), (10 - _i() % 10).cast("int").alias("facility_score"),
    )


def regions(spark):
    rows = [("rural", 41000, 5.0, 12.0, 20.0, 88.0, 30, 70.0), ("suburban", 72000, 3.5, 7.0, 41.0, 101.0, 900, 93.0), ("urban", 60000, 6.0, 15.0, 38.0, 110.0, 4000, 90.0)]
    return spark.createDataFrame(rows, "region string, median_household_income int, unemployment_rate double, poverty_rate double, college_graduation_rate double, cost_of_living_index double, population_density int, internet_access_rate double")


def visits(spark, n):
    """Events 37 seconds apart."""
    at = F.date_format(F.timestamp_seconds(F.lit(1_900_000_000) + _i() * 37), "yyyy-MM-dd'T'HH:mm:ss")
    return spark.range(n).select(
        F.format_string("STU_%04d", _i() * 13 % 90).alias("student_id"), _cycle(["read", "quiz"]).alias("activity_type"), at.alias("timestamp"), (_i() * 17 % 60).cast("int").alias("session_duration"), _cycle(["pen", "ruler", "lens"], 2).alias("ai_tool_used"),
        F.lit("C1").alias("course_id"), F.lit("H1").alias("assignment_id"), (_i() % 5).cast("int").alias("difficulty_level"), (_i() % 100 / 100.0).alias("success_rate"), F.lit('{"device":"tablet"}').alias("metadata"), F.lit("2031-01-01T00:00:00").alias("created_at"),
    )


def defects(spark):
    """90 distinct rows and copies of the last 6: 12 null mails, 7 ages and 9 grades out of range, 4 unknown fields."""
    rows = spark.range(90).select(
        F.format_string("STU_%04d", _i()).alias("student_id"), F.format_string("n%d", _i()).alias("name"), F.when(_i() >= 12, F.format_string("m%d@x", _i())).alias("email"), F.when(_i().between(20, 26), 9).otherwise(20).cast("int").alias("age"),
        F.when(_i().between(30, 38), 5.5).otherwise(_i() % 5 / 1.25).alias("gpa"), F.when(_i().between(40, 43), "?").otherwise(_cycle(["Law", "Music"])).alias("major"), F.lit("2031-03-01").alias("enrollment_date"),
    )
    return rows.union(rows.where("student_id >= 'STU_0084'"))
