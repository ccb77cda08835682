"""Standing academic views; ``register_views`` publishes them as temporary views for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.dates import age_in_years
from rosterline.functions.grades import average, gpa, grade_hundredths, grade_to_points, performance_level
from rosterline.operators.academic import (
    department_totals,
    enrollment_details,
    full_name,
    or_zero,
    student_totals,
    with_departments,
)

# The letter groups of the course statistics.
GRADE_BUCKETS = {
    "a_grades": ("A", "A-"),
    "b_grades": ("B", "B-"),
    "c_grades": ("C", "C-"),
    "d_grades": ("D",),
    "f_grades": ("F",),
}


def student_details(student: DataFrame, department: DataFrame, as_of=None) -> DataFrame:
    return with_departments(student, department, "department_head").select(
        "student_id",
        "student_first_name",
        "student_last_name",
        full_name().alias("full_name"),
        "student_email",
        "student_date_of_birth",
        age_in_years(F.col("student_date_of_birth"), as_of).alias("age"),
        "student_year",
        "student_phone_number",
        "department_id",
        "department_name",
        "department_head",
    )


def enrollment_view(
    enrollment: DataFrame, student: DataFrame, course: DataFrame, department: DataFrame
) -> DataFrame:
    return enrollment_details(enrollment, student, course, department).select(
        "enrollment_id",
        "enrollment_date",
        "student_id",
        "student_name",
        "student_email",
        "student_year",
        "student_department",
        "course_id",
        "course_name",
        "course_credits",
        "course_department",
        "grade",
        grade_to_points(F.col("grade")).alias("grade_points"),
    )


def student_gpa_view(student: DataFrame, department: DataFrame, enrollment: DataFrame) -> DataFrame:
    points, pointed = F.col("points"), F.col("pointed")
    return student_totals(student, department, enrollment).select(
        "student_id",
        "full_name",
        "student_email",
        "department_name",
        "student_year",
        F.col("total").alias("total_courses"),
        F.col("graded").alias("graded_courses"),
        (F.col("total") - F.col("graded")).alias("pending_grades"),
        gpa(points, pointed).alias("gpa"),
        performance_level(points, pointed).alias("performance_level"),
    )


def course_statistics(course: DataFrame, department: DataFrame, enrollment: DataFrame) -> DataFrame:
    buckets = enrollment.groupBy("course_id").agg(
        F.count("enrollment_id").alias("total"),
        F.count("grade").alias("graded"),
        F.sum(grade_hundredths(F.col("grade"))).alias("points"),
        F.count(grade_to_points(F.col("grade"))).alias("pointed"),
        *[F.count_if(F.col("grade").isin(*letters)).alias(name) for name, letters in GRADE_BUCKETS.items()],
    )
    return (
        with_departments(course, department)
        .join(buckets, "course_id", "left")
        .select(
            "course_id",
            "course_name",
            "course_credits",
            "department_name",
            or_zero("total").alias("total_enrollments"),
            or_zero("graded").alias("graded_enrollments"),
            F.coalesce(F.col("total") - F.col("graded"), F.lit(0)).alias("pending_grades"),
            gpa(F.col("points"), F.col("pointed")).alias("average_gpa"),
            *[or_zero(name) for name in GRADE_BUCKETS],
        )
    )


def department_summary(
    department: DataFrame,
    student: DataFrame,
    course: DataFrame,
    enrollment: DataFrame,
    dedupe_fanout: bool = False,
) -> DataFrame:
    students = F.col("total_students").cast("decimal(20,0)")
    return department_totals(department, student, course, enrollment, dedupe_fanout).select(
        "department_id",
        "department_name",
        "department_head",
        "total_students",
        "total_courses",
        "total_enrollments",
        gpa(F.col("points"), F.col("pointed")).alias("department_gpa"),
        average(students, F.col("total_courses"), 1).alias("students_per_course"),
    )


def register_views(
    department: DataFrame, student: DataFrame, course: DataFrame, enrollment: DataFrame, as_of=None
) -> list[str]:
    views = {
        "vw_student_details": student_details(student, department, as_of),
        "vw_enrollment_report": enrollment_view(enrollment, student, course, department),
        "vw_student_gpa": student_gpa_view(student, department, enrollment),
        "vw_course_statistics": course_statistics(course, department, enrollment),
        "vw_department_summary": department_summary(department, student, course, enrollment),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
