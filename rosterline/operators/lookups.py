"""Access patterns: point lookups, pages, existence, projection and absent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.operators.academic import full_name, with_departments


def find_student(student: DataFrame, email: str) -> DataFrame:
    """Equality on one column. It reaches a Parquet scan where the column is stored; see ``layouts.store_sorted``."""
    return student.filter(F.col("student_email") == email)


def find_student_department(student: DataFrame, department: DataFrame, email: str) -> DataFrame:
    return with_departments(find_student(student, email), department).select(
        "student_first_name", "student_last_name", "department_name"
    )


def enrollments_of_year(
    enrollment: DataFrame, student: DataFrame, course: DataFrame, year: int
) -> DataFrame:
    return (
        enrollment.join(student.filter(F.col("student_year") == year), "student_id")
        .join(course.select("course_id", "course_name"), "course_id")
        .select(full_name().alias("student_name"), "course_name", "grade")
    )


def enrollments_of_student(enrollment: DataFrame, course: DataFrame, student_id: int) -> DataFrame:
    return (
        enrollment.filter(F.col("student_id") == student_id)
        .join(course.select("course_id", "course_name"), "course_id")
        .select("course_name", "grade", "enrollment_date")
    )


def students_by_phone_prefix(student: DataFrame, prefix: str = "+91") -> DataFrame:
    return student.filter(F.col("student_phone_number").startswith(prefix))


def page(df: DataFrame, key: str, size: int = 20, offset: int = 0) -> DataFrame:
    """One page by position. Deep pages cost more: prefer ``page_after``, or ``layouts.store_pages`` where pages are numbered."""
    ordered = df.orderBy(key)
    return (ordered.offset(offset) if offset else ordered).limit(size)


def page_after(df: DataFrame, key: str, last, size: int = 20) -> DataFrame:
    """The page after a key: the bound is pushed to the scan, so any depth costs the same."""
    return df.filter(F.col(key) > last).orderBy(key).limit(size)


def enrollment_count(enrollment: DataFrame, student_id: int) -> DataFrame:
    return enrollment.filter(F.col("student_id") == student_id).agg(F.count("*").alias("enrollment_count"))


def has_enrollment(enrollment: DataFrame, student_id: int) -> DataFrame:
    """EXISTS for one student: stops at the first match instead of counting them all."""
    hit = enrollment.filter(F.col("student_id") == student_id).select(F.lit(1).alias("hit")).limit(1)
    return hit.agg((F.count("hit") > 0).alias("has_enrollment"))


def enrolled_students(student: DataFrame, enrollment: DataFrame) -> DataFrame:
    """EXISTS for all students at once, against the distinct enrolled ids."""
    return student.join(enrollment.select("student_id").distinct(), "student_id", "left_semi")


def student_contacts(student: DataFrame) -> DataFrame:
    return student.select("student_id", "student_email")


def enrollment_counts(student: DataFrame, enrollment: DataFrame, keep_unmatched: bool = True) -> DataFrame:
    """Enrollments per student; without ``keep_unmatched`` students that have none are lost."""
    counts = enrollment.groupBy("student_id").agg(F.count("enrollment_id").alias("enrollment_count"))
    joined = student.select("student_id").join(counts, "student_id", "left" if keep_unmatched else "inner")
    return joined.select("student_id", F.coalesce("enrollment_count", F.lit(0)).alias("enrollment_count"))


def keys_not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """``key NOT IN (SELECT other_key …)`` with its NULL rules, at any size of the other table.

    A direct NOT IN makes the optimizer ship the whole other table to every task. Here the keys meet in
    a shuffled anti join, and the two NULL rules come from one aggregated row: a NULL among the other
    keys empties the result, and a NULL key qualifies only against an empty table.
    """
    keys = other.select(F.col(other_key).alias(key))
    all_keys, real_keys = F.count("*"), F.count(key)
    state = F.when(all_keys == 0, F.lit("empty")).when(all_keys == real_keys, F.lit("complete")).otherwise(F.lit("null"))
    found = keys.agg(state.alias("state")).scalar()
    absent = df.join(keys.filter(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return absent.filter((found == "empty") | ((found == "complete") & F.col(key).isNotNull()))
