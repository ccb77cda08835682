"""Academic queries: enrollment counts, grade-point averages and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.dates import age_in_years, latest_birth_date
from rosterline.functions.grades import GRADES, gpa, grade_hundredths, reaches


def full_name() -> Column:
    return F.concat("student_first_name", F.lit(" "), "student_last_name")


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def enrollment_totals(enrollment: DataFrame, *keys: str) -> DataFrame:
    """Per key: enrollments, graded ones, and the sum (in hundredths) and count of grade points.

    Everything here merges map-side, so this is the only form in which facts are joined below.
    """
    points = grade_hundredths(F.col("grade"))
    return enrollment.groupBy(*keys).agg(
        F.count("enrollment_id").alias("total"),
        F.count("grade").alias("graded"),
        F.sum(points).alias("points"),
        F.count(points).alias("pointed"),
    )


def with_departments(df: DataFrame, department: DataFrame, *extra: str) -> DataFrame:
    return df.join(department.select("department_id", "department_name", *extra), "department_id")


def students_per_department(student: DataFrame, department: DataFrame) -> DataFrame:
    counts = student.groupBy("department_id").agg(F.count("student_id").alias("student_count"))
    return (
        department.join(counts, "department_id", "left")
        .orderBy(F.desc(F.coalesce("student_count", F.lit(0))), "department_id")
        .select("department_name", or_zero("student_count"))
    )


def course_gpa(course: DataFrame, enrollment: DataFrame) -> DataFrame:
    return (
        course.select("course_id", "course_name")
        .join(enrollment_totals(enrollment, "course_id"), "course_id", "left")
        .select(
            "course_id",
            "course_name",
            or_zero("total").alias("total_enrollments"),
            or_zero("graded").alias("graded_enrollments"),
            gpa(F.col("points"), F.col("pointed")).alias("average_gpa"),
        )
        .orderBy(F.desc_nulls_last("average_gpa"), "course_id")
    )


def enrollments_per_student(student: DataFrame, enrollment: DataFrame) -> DataFrame:
    counts = enrollment.groupBy("student_id").agg(F.count("enrollment_id").alias("total_courses"))
    return (
        student.join(counts, "student_id", "left")
        .select("student_id", full_name().alias("full_name"), "student_email", or_zero("total_courses"))
        .orderBy(F.desc("total_courses"), "student_id")
    )


def students_per_year(student: DataFrame) -> DataFrame:
    return student.groupBy("student_year").agg(F.count("*").alias("student_count")).orderBy("student_year")


def course_popularity(department: DataFrame, course: DataFrame, enrollment: DataFrame) -> DataFrame:
    counts = enrollment.groupBy("course_id").agg(F.count("enrollment_id").alias("enrollment_count"))
    return (
        with_departments(course, department)
        .join(counts, "course_id", "left")
        .select("department_name", "course_id", "course_name", or_zero("enrollment_count"))
        .orderBy("department_name", F.desc("enrollment_count"), "course_id")
    )


def student_directory(student: DataFrame, department: DataFrame) -> DataFrame:
    return (
        with_departments(student, department)
        .orderBy("student_last_name", "student_first_name", "student_id")
        .select(
            "student_id",
            "student_first_name",
            "student_last_name",
            "student_email",
            "student_year",
            "student_phone_number",
            "department_name",
        )
    )


def enrollment_details(
    enrollment: DataFrame, student: DataFrame, course: DataFrame, department: DataFrame
) -> DataFrame:
    """Every enrollment with its student, its course and the department of each.

    Departments are attached to the two dimensions first, so the fact is shuffled once per dimension.
    """
    students = with_departments(student, department).withColumnRenamed("department_name", "student_department")
    courses = with_departments(course, department).withColumnRenamed("department_name", "course_department")
    return (
        enrollment.join(students.withColumnRenamed("department_id", "student_department_id"), "student_id")
        .join(courses.withColumnRenamed("department_id", "course_department_id"), "course_id")
        .withColumn("student_name", full_name())
    )


def enrollment_report(
    enrollment: DataFrame, student: DataFrame, course: DataFrame, department: DataFrame
) -> DataFrame:
    return (
        enrollment_details(enrollment, student, course, department)
        .orderBy("student_last_name", "course_id", "enrollment_id")
        .select(
            "student_name",
            "student_email",
            "student_year",
            "student_department",
            "course_id",
            "course_name",
            "course_department",
            "grade",
            "enrollment_date",
        )
    )


def student_totals(student: DataFrame, department: DataFrame, enrollment: DataFrame) -> DataFrame:
    """One row per student of a known department with the enrollment totals, zero where there are none."""
    return (
        with_departments(student, department)
        .join(enrollment_totals(enrollment, "student_id"), "student_id", "left")
        .withColumn("full_name", full_name())
        .withColumn("total", or_zero("total"))
        .withColumn("graded", or_zero("graded"))
    )


def student_course_load(student: DataFrame, department: DataFrame, enrollment: DataFrame) -> DataFrame:
    return (
        student_totals(student, department, enrollment)
        .select(
            "student_id",
            "full_name",
            "department_name",
            "student_year",
            F.col("total").alias("courses_taken"),
            F.col("graded").alias("courses_graded"),
            gpa(F.col("points"), F.col("pointed")).alias("gpa"),
        )
        .orderBy(F.desc_nulls_last("gpa"), "student_id")
    )


def cross_department_enrollments(
    enrollment: DataFrame, student: DataFrame, course: DataFrame, department: DataFrame
) -> DataFrame:
    return (
        enrollment_details(enrollment, student, course, department)
        .filter(F.col("student_department_id") != F.col("course_department_id"))
        .orderBy("student_last_name", "course_id", "enrollment_id")
        .select("student_name", "student_department", "course_id", "course_name", "course_department")
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("duplicate_count")).filter(F.col("duplicate_count") > 1)


def duplicate_emails(student: DataFrame) -> DataFrame:
    return duplicate_keys(student, "student_email")


def students_without_enrollment(student: DataFrame, department: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Anti join against the distinct enrolled ids: the hot side is folded before the shuffle."""
    enrolled = enrollment.filter(F.col("enrollment_id").isNotNull()).select("student_id").distinct()
    return (
        with_departments(student.join(enrolled, "student_id", "left_anti"), department)
        .orderBy("student_last_name", "student_id")
        .select("student_id", full_name().alias("full_name"), "student_email", "department_name")
    )


def pending_enrollments(enrollment: DataFrame, student: DataFrame, course: DataFrame) -> DataFrame:
    return (
        enrollment.filter(F.col("grade").isNull())
        .join(student, "student_id")
        .join(course.select("course_id", "course_name"), "course_id")
        .withColumn("student_name", full_name())
    )


def ungraded_enrollments(enrollment: DataFrame, student: DataFrame, course: DataFrame) -> DataFrame:
    return (
        pending_enrollments(enrollment, student, course)
        .orderBy(F.desc_nulls_first("enrollment_date"), "enrollment_id")
        .select("student_name", "course_id", "course_name", "enrollment_date")
    )


def underage_students(student: DataFrame, as_of=None) -> DataFrame:
    born = F.col("student_date_of_birth")
    return student.filter(born > latest_birth_date(as_of)).select(
        "student_id",
        "student_first_name",
        "student_last_name",
        "student_date_of_birth",
        age_in_years(born, as_of).alias("age"),
    )


def invalid_grades(enrollment: DataFrame, student: DataFrame, course: DataFrame) -> DataFrame:
    wrong = enrollment.filter(F.col("grade").isNotNull() & ~F.col("grade").isin(*GRADES))
    return (
        wrong.join(student.select("student_id", "student_email"), "student_id")
        .join(course.select("course_id"), "course_id")
        .select("enrollment_id", "student_email", "course_id", "grade")
    )


def department_totals(
    department: DataFrame,
    student: DataFrame,
    course: DataFrame,
    enrollment: DataFrame,
    dedupe_fanout: bool = False,
) -> DataFrame:
    """Per department: students, courses, enrollments and grade points.

    The report this follows joins students and courses of a department to each other, which counts each
    enrollment once per course of the department. That count is the product taken here, without
    building the pairs; ``dedupe_fanout`` gives the plain count. The average is the same either way.
    """
    per_student = enrollment_totals(enrollment, "student_id")
    students = (
        student.select("student_id", "department_id")
        .join(per_student, "student_id", "left")
        .groupBy("department_id")
        .agg(
            F.count("student_id").alias("total_students"),
            F.sum("total").alias("enrollments"),
            F.sum("points").alias("points"),
            F.sum("pointed").alias("pointed"),
        )
    )
    courses = course.groupBy("department_id").agg(F.count("course_id").alias("total_courses"))
    enrollments = F.coalesce("enrollments", F.lit(0))
    if not dedupe_fanout:
        enrollments = enrollments * F.greatest(F.coalesce("total_courses", F.lit(0)), F.lit(1))
    return (
        department.join(students, "department_id", "left")
        .join(courses, "department_id", "left")
        .withColumn("total_enrollments", enrollments)
        .withColumn("total_students", or_zero("total_students"))
        .withColumn("total_courses", or_zero("total_courses"))
    )


def department_card(
    department: DataFrame,
    student: DataFrame,
    course: DataFrame,
    enrollment: DataFrame,
    dedupe_fanout: bool = False,
) -> DataFrame:
    return (
        department_totals(department, student, course, enrollment, dedupe_fanout)
        .withColumn("department_avg_gpa", gpa(F.col("points"), F.col("pointed")))
        .orderBy(F.desc_nulls_last("department_avg_gpa"), "department_id")
        .select("department_name", "total_students", "total_courses", "total_enrollments", "department_avg_gpa")
    )


def top_students(
    student: DataFrame, department: DataFrame, enrollment: DataFrame, min_gpa: str = "3.5"
) -> DataFrame:
    """Students whose unrounded average reaches the bound; the filter runs before any student is joined."""
    totals = enrollment_totals(enrollment, "student_id").filter(reaches(F.col("points"), F.col("pointed"), min_gpa))
    return (
        with_departments(student.join(totals.filter(F.col("pointed") > 0), "student_id"), department)
        .select(
            "student_id",
            full_name().alias("full_name"),
            "student_email",
            "department_name",
            "student_year",
            F.col("graded").alias("courses_completed"),
            gpa(F.col("points"), F.col("pointed")).alias("gpa"),
        )
        .orderBy(F.desc("gpa"), "student_id")
    )


def _distribution_column(letter: str) -> str:
    return "grade_" + letter.replace("-", "_minus")


def grade_distribution(course: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Letter counts per course. A course without enrollments shows one ungraded entry, the empty
    row its outer join leaves."""
    counts = enrollment.groupBy("course_id").agg(
        *[F.count_if(F.col("grade") == letter).alias(_distribution_column(letter)) for letter in GRADES],
        F.count_if(F.col("grade").isNull()).alias("not_graded"),
    )
    return (
        course.select("course_id", "course_name")
        .join(counts, "course_id", "left")
        .select(
            "course_id",
            "course_name",
            *[or_zero(_distribution_column(letter)) for letter in GRADES],
            F.coalesce("not_graded", F.lit(1)).alias("not_graded"),
        )
        .orderBy("course_id")
    )
