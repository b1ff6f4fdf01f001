"""Fixed values of the student presets.

These labels, thresholds, weights and word lists define the published results of the student
analyses, so they are stated here as they must be; every operator takes them as arguments.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: cleaning ------------------------------------------------------------------
FREQUENCY_SCORES = {"Daily": 5, "Weekly": 4, "Monthly": 3, "Rarely": 2}
FREQUENCY_DEFAULT = 1
USAGE_INTENSITY = {"High": ["Daily", "Weekly"], "Medium": ["Monthly"]}
USAGE_INTENSITY_DEFAULT = "Low"
GRADE_POINTS = {"A+": 4.3, "A": 4.0, "B+": 3.3, "B": 3.0, "C+": 2.3, "C": 2.0, "D": 1.0}
GRADE_POINTS_DEFAULT = 0.0
PERFORMANCE_CATEGORY = [(3.5, "High"), (2.5, "Medium")]
PERFORMANCE_CATEGORY_DEFAULT = "Low"
FILL_DEFAULTS = {
    "gpa": 2.5,
    "satisfaction_level": 3,
    "usage_frequency_score": 2,
    "attendance_rate": 0.8,
    "assignment_submission_rate": 0.85,
    "num_ai_tools": 1,
}
CLEANED_NUMERIC = ["gpa", "satisfaction_level", "usage_frequency_score"]
FIELD_SYNONYMS = {
    "Computer Science": ["CS", "Computer Science", "CompSci"],
    "Mathematics": ["Math", "Mathematics", "MATH"],
    "English": ["Eng", "English", "ENG"],
}
FREQUENCY_SYNONYMS = {
    "Daily": ["daily", "Daily", "DAILY"],
    "Weekly": ["weekly", "Weekly", "WEEKLY"],
    "Monthly": ["monthly", "Monthly", "MONTHLY"],
    "Rarely": ["rarely", "Rarely", "RARELY"],
}
COURSE_PREFIXES = {
    "CS": "Computer Science",
    "MATH": "Mathematics",
    "ENG": "English",
    "BUS": "Business",
    "PHYS": "Physics",
    "CHEM": "Chemistry",
}
COURSE_PREFIX_DEFAULT = "Other"

# --- fixed values: scores --------------------------------------------------------------------
PROFICIENCY_PARTS = [
    ("num_ai_tools", 0.3, 0),
    ("usage_frequency_score", 0.4, 1),
    ("satisfaction_level", 0.3, 1),
]
PROFICIENCY_LEVELS = [(4.0, "Expert"), (3.0, "Advanced"), (2.0, "Intermediate")]
PROFICIENCY_DEFAULT = "Beginner"
RISK_GPA = [(2.0, 4), (2.5, 3), (3.0, 2)]
RISK_ATTENDANCE = [(0.6, 4), (0.7, 3), (0.8, 2)]
RISK_SUBMISSION = [(0.7, 4), (0.8, 3), (0.9, 2)]
RISK_WEIGHTS = (0.4, 0.3, 0.3)
RISK_FLAG_FROM = 3.0
RISK_LEVELS = [(3.5, "High"), (2.5, "Medium"), (1.5, "Low")]
INTERVENTIONS = {"High": "Immediate", "Medium": "Monitor"}
WORKLOAD_PARTS = [("total_courses", 2.5, 0), ("total_credits", 1.5, 0), ("academic_diversity", 4.0, 0)]
WORKLOAD_BANDS = [(60, "Heavy"), (40, "Moderate"), (20, "Light")]
WORKLOAD_DEFAULT = "Minimal"
WORKLOAD_PARTS_PLAIN = [("total_courses", 2.0, None), ("total_credits", 1.5, None), ("academic_diversity", 3.0, None)]
WORKLOAD_BANDS_PLAIN = [(50, "Heavy"), (35, "Moderate")]
WORKLOAD_DEFAULT_PLAIN = "Light"
WORKLOAD_BALANCE = [("Heavy", 3.5, 5), ("Moderate", 3.0, 4), ("Light", 2.5, 3)]
SUCCESS_BANDS = [(90, "Top_Performer"), (75, "High_Performer"), (50, "Average_Performer"), (25, "Below_Average")]
SUCCESS_DEFAULT = "Low_Performer"
ENGAGEMENT_PARTS = [("attendance_rate", 0.4, None), ("assignment_submission_rate", 0.6, None)]
ENGAGEMENT_PARTS_FILLED = [("attendance_rate", 0.4, 0.8), ("assignment_submission_rate", 0.6, 0.85)]
UTILIZATION_PARTS = [
    ("usage_frequency_score", 0.5, 2),
    ("satisfaction_level", 0.3, 3),
    ("num_ai_tools", 0.2, 1),
]
COMPOSITE_PARTS = [
    ("gpa", 0.4, None),
    ("usage_frequency_score", 0.2, None),
    ("satisfaction_level", 0.2, None),
    ("attendance_rate", 0.4, None),
    ("assignment_submission_rate", 0.4, None),
]
SCORE_TIERS = [(90, "Excellent"), (80, "Good"), (70, "Average"), (60, "Below Average")]
SCORE_TIER_DEFAULT = "Poor"
SCORE_TIER_NAMES = [*(name for _, name in SCORE_TIERS), SCORE_TIER_DEFAULT]
GRADE_RANGES = [(90, "A (90-100)"), (80, "B (80-89)"), (70, "C (70-79)"), (60, "D (60-69)")]
GRADE_RANGE_DEFAULT = "F (Below 60)"

# label, use case (None: any), and the least value of each measure
LEARNING_STYLES = [
    ("Research_Intensive", "Research", {"usage_frequency_score": 4}),
    ("Assignment_Focused", "Assignment_Help", {"satisfaction_level": 4}),
    ("Multi_Tool_User", None, {"num_ai_tools": 3}),
]
FREQUENT_STYLE = ("High_Frequency_User", None, {"usage_frequency_score": 4})
LEARNING_STYLE_DEFAULT = "Basic_User"
LEARNING_PREFERENCES = {"Exploratory": ["Research_Intensive", "Multi_Tool_User"], "Task_Oriented": ["Assignment_Focused"]}
LEARNING_PREFERENCE_DEFAULT = "Casual"
# at risk only where all three are below
RULE_RISK = {"gpa": 2.5, "attendance_rate": 0.7, "assignment_submission_rate": 0.8}
RULE_RISK_LEVELS = [(2.0, "High"), (2.5, "Medium")]
RULE_RISK_DEFAULT = "Low"
USAGE_CONSISTENCY = [
    ("High_Consistent", {"usage_frequency_score": 4, "satisfaction_level": 4}),
    ("Medium_Consistent", {"usage_frequency_score": 3, "satisfaction_level": 3}),
]
CONSISTENT, CONSISTENT_APART, INCONSISTENT = "Consistent", 1, "Inconsistent"
ADOPTION_STAGES = [
    ("Advanced_Adopter", {"usage_frequency_score": 4, "num_ai_tools": 3}),
    ("Regular_User", {"usage_frequency_score": 3, "num_ai_tools": 2}),
    ("Occasional_User", {"usage_frequency_score": 2}),
]
ADOPTION_DEFAULT = "Beginner"
# proficiency at least, percentile below
IMPROVEMENT_POTENTIAL = [(3.0, 50, "High"), (2.0, 75, "Medium")]
IMPROVEMENT_DEFAULT = "Low"

# --- fixed values: analyses ------------------------------------------------------------------
RANK_TIERS = [(0.9, "Top 10%"), (0.75, "Top 25%"), (0.5, "Top 50%")]
RANK_TIER_DEFAULT = "Bottom 50%"
TREND_STEPS = [
    (0.3, "Significant Improvement"),
    (0.1, "Moderate Improvement"),
    (-0.1, "Stable"),
    (-0.3, "Moderate Decline"),
]
TREND_DEFAULT = "Significant Decline"
FIRST_PERIOD = "First Semester"
CORRELATION_STRENGTH = [(0.7, "Strong"), (0.5, "Moderate"), (0.3, "Weak")]
CORRELATION_STRENGTH_DEFAULT = "Very Weak"
SATISFACTION_SEGMENTS = [(4, "Highly Satisfied"), (3, "Satisfied"), (2, "Neutral")]
SATISFACTION_SEGMENT_DEFAULT = "Dissatisfied"
ACADEMIC_LEVELS = [(1, "Freshman"), (2, "Sophomore"), (3, "Junior")]
ACADEMIC_LEVEL_DEFAULT = "Senior"
SAMPLE_QUALITY = [(100, "High Quality"), (50, "Good Quality"), (20, "Acceptable Quality")]
SAMPLE_QUALITY_DEFAULT = "Low Quality"
USAGE_HOURS = [
    (1, "Light User (< 1h)"),
    (3, "Moderate User (1-3h)"),
    (5, "Heavy User (3-5h)"),
]
USAGE_HOURS_DEFAULT = "Very Heavy User (5h+)"

# --- fixed values: schools -------------------------------------------------------------------
SCHOOL_TYPE_EFFECT = {"private": 5, "charter": 2}
RATIO_POINTS = [(15, 10), (20, 7), (25, 5)]
RATIO_POINTS_DEFAULT = 3
EFFICIENCY_GRADES = [(8, "Highly Efficient"), (6, "Efficient"), (4, "Moderately Efficient")]
EFFICIENCY_GRADE_DEFAULT = "Inefficient"
SCHOOL_TYPE_CODES = {"public": 0, "charter": 1, "private": 2}
REGION_CODES = {"rural": 0, "suburban": 1, "urban": 2}
TARGET_CLASSES = [(85, "High"), (75, "Medium")]
TARGET_CLASS_DEFAULT = "Low"

# --- fixed values: data quality --------------------------------------------------------------
STUDENT_ID_PATTERN = "^STU_[0-9]{4}$"
FREQUENCY_WORDS = ["Daily", "Weekly", "Monthly", "Rarely", "Never"]

PARENT_EDUCATION_POINTS = {
    "some high school": 0,
    "high school": 5,
    "some college": 10,
    "associate's degree": 15,
    "bachelor's degree": 20,
    "master's degree": 25,
}


# --- fixed values: insights of the student tables ----------------------------------------------
@dataclass(frozen=True)
class Insight:
    """Which columns a group summary counts, averages, correlates, and gives the range of."""

    entity: str
    count: str
    means: dict[str, str]
    correlations: dict[str, tuple[str, str]]
    spread: str


INSIGHT_GROUP = ("field_of_study", "performance_category", "usage_intensity")
STUDENT_INSIGHT = Insight(
    entity="student_id",
    count="student_count",
    means={
        "avg_ai_tools_used": "num_ai_tools",
        "avg_usage_frequency": "usage_frequency_score",
        "avg_satisfaction": "satisfaction_level",
        "avg_gpa": "gpa",
        "avg_major_gpa": "major_gpa",
        "avg_engagement": "engagement_score",
        "avg_academic_diversity": "academic_diversity",
    },
    correlations={
        "usage_gpa_correlation": ("usage_frequency_score", "gpa"),
        "satisfaction_engagement_correlation": ("satisfaction_level", "engagement_score"),
    },
    spread="gpa",
)
