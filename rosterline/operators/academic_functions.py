"""Parameterised academic functions, each over a set of students, courses or requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.dates import day
from rosterline.functions.grades import GRADES, gpa, grade_hundredths
from rosterline.operators.academic import department_totals, pending_enrollments

PAIR = ["student_id", "course_id"]


def _average_points(enrollment: DataFrame, keys: DataFrame, key: str, ids: Sequence | None, name: str) -> DataFrame:
    wanted = keys.select(key) if ids is None else keys.select(key).filter(F.col(key).isin(*ids))
    graded = enrollment.filter(F.col("grade").isNotNull())
    if ids is not None:
        graded = graded.filter(F.col(key).isin(*ids))
    points = grade_hundredths(F.col("grade"))
    averages = graded.groupBy(key).agg(gpa(F.sum(points), F.count(points)).alias(name))
    return wanted.join(averages, key, "left")


def student_gpa(enrollment: DataFrame, student: DataFrame, ids: Sequence | None = None) -> DataFrame:
    """Average of graded enrollments per student; NULL where none is graded."""
    return _average_points(enrollment, student, "student_id", ids, "gpa")


def course_average(enrollment: DataFrame, course: DataFrame, ids: Sequence | None = None) -> DataFrame:
    return _average_points(enrollment, course, "course_id", ids, "average_gpa")


def department_stats(
    department: DataFrame,
    student: DataFrame,
    course: DataFrame,
    enrollment: DataFrame,
    ids: Sequence | None = None,
    dedupe_fanout: bool = False,
) -> DataFrame:
    """One JSON document per department, with a map of students per year.

    Students are counted per (department, year) before anything is collected, so a list holds one entry
    per study year, of which the schema allows four.
    """
    if ids is not None:
        department = department.filter(F.col("department_id").isin(*ids))
    entry = F.struct(F.col("student_year").cast("string").alias("key"), F.col("students").alias("value"))
    years = (
        student.groupBy("department_id", "student_year")
        .agg(F.count("*").alias("students"))
        .groupBy("department_id")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("students_per_year"))
    )
    totals = department_totals(department, student, course, enrollment, dedupe_fanout)
    document = F.struct(
        "department_id",
        "department_name",
        "total_students",
        "total_courses",
        "total_enrollments",
        gpa(F.col("points"), F.col("pointed")).alias("average_gpa"),
        "students_per_year",
    )
    return totals.join(years, "department_id", "left").select(
        "department_id", F.to_json(document, {"ignoreNullFields": "false"}).alias("stats")
    )


def pending_grades(enrollment: DataFrame, student: DataFrame, course: DataFrame, as_of=None) -> DataFrame:
    """Ungraded enrollments, oldest first, with the days they have waited."""
    return (
        pending_enrollments(enrollment, student, course)
        .orderBy(F.asc_nulls_last("enrollment_date"), "enrollment_id")
        .select(
            "enrollment_id",
            "student_name",
            "student_email",
            "course_id",
            "course_name",
            "enrollment_date",
            F.datediff(day(as_of), "enrollment_date").alias("days_since_enrollment"),
        )
    )


def check_enrollments(
    requests: DataFrame, student: DataFrame, course: DataFrame, enrollment: DataFrame, seq: str = "seq"
) -> DataFrame:
    """Outcome of each enrollment request: missing student, then missing course, then already enrolled.

    The first request for a pair wins and later ones count as already enrolled. All lookups are made
    once per distinct pair; the verdict then returns to the single requests.
    """
    pairs = requests.groupBy(*PAIR).agg(F.min(seq).alias("first_seq"))
    verdicts = (
        pairs.join(student.select("student_id", F.lit(True).alias("has_student")), "student_id", "left")
        .join(course.select("course_id", F.lit(True).alias("has_course")), "course_id", "left")
        .join(enrollment.select(*PAIR).distinct().withColumn("enrolled", F.lit(True)), PAIR, "left")
    )
    student_id, course_id = F.col("student_id").cast("string"), F.col("course_id")
    repeated = F.col("enrolled") | (F.col(seq) > F.col("first_seq"))
    judged = requests.join(verdicts, PAIR, "left").withColumn(
        "outcome",
        F.when(F.col("has_student").isNull(), F.lit("student_missing"))
        .when(F.col("has_course").isNull(), F.lit("course_missing"))
        .when(repeated, F.lit("already_enrolled"))
        .otherwise(F.lit("enrolled")),
    )
    # The messages of the three refusals.
    message = (
        F.when(F.col("outcome") == "student_missing", F.format_string("Student ID %s does not exist", student_id))
        .when(F.col("outcome") == "course_missing", F.format_string("Course ID %s does not exist", course_id))
        .when(
            F.col("outcome") == "already_enrolled",
            F.format_string("Student %s is already enrolled in course %s", student_id, course_id),
        )
    )
    return judged.select(*requests.columns, "outcome", message.alias("message"))


def check_grade_updates(updates: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Outcome of each grade update. A NULL grade passes and clears the grade."""
    known = enrollment.select(*PAIR).distinct().withColumn("known", F.lit(True))
    invalid = F.col("grade").isNotNull() & ~F.col("grade").isin(*GRADES)
    outcome = (
        F.when(invalid, F.lit("invalid_grade"))
        .when(F.col("known").isNull(), F.lit("enrollment_missing"))
        .otherwise(F.lit("updated"))
    )
    return updates.join(known, PAIR, "left").select(*updates.columns, outcome.alias("outcome"))


def update_grades(enrollment: DataFrame, updates: DataFrame, seq: str = "seq") -> DataFrame:
    """The enrollments with the last valid update of each pair applied."""
    valid = updates.filter(F.col("grade").isNull() | F.col("grade").isin(*GRADES))
    last = valid.groupBy(*PAIR).agg(F.max_by(F.struct("grade"), seq).alias("update"))
    grade = F.when(F.col("update").isNotNull(), F.col("update.grade")).otherwise(F.col("grade"))
    return enrollment.join(last, PAIR, "left").withColumn("grade", grade).select(*enrollment.columns)
