"""Academic operators on a small school with every corner: no students, no courses, no grades."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from rosterline.operators import academic, lookups, views
from rosterline.operators import academic_functions as functions
from rosterline.schemas import COURSE, DEPARTMENT, ENROLLMENT, STUDENT

DAY = dt.date(2024, 1, 15)


@pytest.fixture(scope="module")
def school(spark):
    department = [(1, "Alpha", "H1"), (2, "Beta", "H2"), (3, "Gamma", None)]
    student = [
        (1, "Ana", "Gil", "ana@x.org", dt.date(2004, 2, 29), 1, "+91-1", 1),
        (2, "Bo", "Li", "bo@x.org", dt.date(2009, 1, 1), 2, "+44 2", 1),
        (3, "Cy", "Oh", "cy@x.org", dt.date(2003, 1, 1), 2, "+91-3", 2),
    ]
    course = [("C1", "Logic", 1, 4), ("C2", "Sets", 1, 3), ("C3", "Graphs", 3, 2)]
    enrollment = [
        (1, DAY, 1, "C1", "A"),
        (2, DAY, 1, "C2", None),
        (3, dt.date(2024, 2, 1), 2, "C1", "B-"),
        (4, DAY, 3, "C1", "B+"),
    ]
    return tuple(
        spark.createDataFrame(rows, schema)
        for rows, schema in ((department, DEPARTMENT), (student, STUDENT), (course, COURSE), (enrollment, ENROLLMENT))
    )


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_counts_keep_the_empty(school):
    department, student, course, enrollment = school
    assert tuples(academic.students_per_department(student, department)) == [("Alpha", 2), ("Beta", 1), ("Gamma", 0)]
    gpa = tuples(academic.course_gpa(course, enrollment))
    assert gpa == [("C1", "Logic", 3, 3, Decimal("3.35")), ("C2", "Sets", 1, 0, None), ("C3", "Graphs", 0, 0, None)]


def test_plus_grade_counts_as_graded_without_points(school):
    department, student, _, enrollment = school
    row = {r["student_id"]: r for r in views.student_gpa_view(student, department, enrollment).collect()}
    assert (row[3]["graded_courses"], row[3]["gpa"], row[3]["performance_level"]) == (1, None, "No Grades")
    assert (row[1]["pending_grades"], row[1]["performance_level"]) == (1, "Excellent")


def test_department_card_fan_out(school):
    department, student, course, enrollment = school
    card = {r["department_name"]: tuple(r)[1:] for r in academic.department_card(department, student, course, enrollment).collect()}
    assert card["Alpha"] == (2, 2, 6, Decimal("3.35"))  # three enrollments, once per course
    assert card["Beta"] == (1, 0, 1, None)  # no course: the outer join keeps each once
    assert card["Gamma"] == (0, 1, 0, None)
    plain = academic.department_card(department, student, course, enrollment, dedupe_fanout=True)
    assert {r["department_name"]: r["total_enrollments"] for r in plain.collect()} == {"Alpha": 3, "Beta": 1, "Gamma": 0}


def test_students_per_course_without_courses(school):
    department, student, course, enrollment = school
    summary = views.department_summary(department, student, course, enrollment)
    ratios = {r["department_name"]: r["students_per_course"] for r in summary.collect()}
    assert ratios["Alpha"] == Decimal("1.0") and ratios["Beta"] is None and ratios["Gamma"] == Decimal("0.0")


def test_empty_course_shows_one_ungraded(school):
    _, _, course, enrollment = school
    rows = {r["course_id"]: r for r in academic.grade_distribution(course, enrollment).collect()}
    assert (rows["C3"]["not_graded"], rows["C2"]["not_graded"], rows["C1"]["not_graded"]) == (1, 1, 0)
    assert (rows["C1"]["grade_A"], rows["C1"]["grade_B_minus"]) == (1, 1)


def test_top_students_use_the_unrounded_average(spark, school):
    department, student, _, _ = school
    # 3.4995… rounds to 3.50 but does not reach 3.5.
    grades = ["A"] * 1665 + ["B"] * 1668
    rows = [(i, DAY, 1, f"C{i}", g) for i, g in enumerate(grades)] + [(9000, DAY, 3, "C1", "A"), (9001, DAY, 3, "C2", "B")]
    top = academic.top_students(student, department, spark.createDataFrame(rows, ENROLLMENT))
    assert [(r["student_id"], r["gpa"]) for r in top.collect()] == [(3, Decimal("3.50"))]


def test_quality_checks(school):
    _, student, course, enrollment = school
    assert tuples(academic.duplicate_emails(student)) == []
    assert tuples(academic.duplicate_emails(student.union(student.limit(1))))[0][1] == 2
    assert [r["student_id"] for r in academic.underage_students(student, "2024-06-30").collect()] == [2]
    assert tuples(academic.invalid_grades(enrollment, student, course)) == [(4, "cy@x.org", "C1", "B+")]


def test_cross_department(school):
    department, student, course, enrollment = school
    assert tuples(academic.cross_department_enrollments(enrollment, student, course, department)) == [
        ("Cy Oh", "Beta", "C1", "Logic", "Alpha")
    ]


def test_views_answer_sql(spark, school):
    department, student, course, enrollment = school
    views.register_views(department, student, course, enrollment, "2024-06-30")
    assert spark.sql("SELECT count(*) FROM vw_enrollment_report WHERE grade_points IS NULL").first()[0] == 2
    assert spark.sql("SELECT age FROM vw_student_details WHERE student_id = 1").first()[0] == 20


def test_functions(school):
    department, student, course, enrollment = school
    assert dict(tuples(functions.student_gpa(enrollment, student))) == {1: Decimal("4.00"), 2: Decimal("2.70"), 3: None}
    assert tuples(functions.course_average(enrollment, course, ["C1"])) == [("C1", Decimal("3.35"))]
    stats = {i: json.loads(s) for i, s in tuples(functions.department_stats(department, student, course, enrollment))}
    assert stats[1]["students_per_year"] == {"1": 1, "2": 1} and stats[1]["total_enrollments"] == 6
    assert stats[3]["students_per_year"] is None and stats[3]["average_gpa"] is None
    pending = tuples(functions.pending_grades(enrollment, student, course, "2024-01-25"))
    assert pending == [(2, "Ana Gil", "ana@x.org", "C2", "Sets", DAY, 10)]


def test_enroll_outcomes(spark, school):
    _, student, course, enrollment = school
    requests = spark.createDataFrame(
        [(1, 9, "C9"), (2, 1, "C9"), (3, 1, "C1"), (4, 2, "C2"), (5, 2, "C2")], "seq long, student_id long, course_id string"
    )
    out = {r["seq"]: (r["outcome"], r["message"]) for r in functions.check_enrollments(requests, student, course, enrollment).collect()}
    assert out == {
        1: ("student_missing", "Student ID 9 does not exist"),
        2: ("course_missing", "Course ID C9 does not exist"),
        3: ("already_enrolled", "Student 1 is already enrolled in course C1"),
        4: ("enrolled", None),
        5: ("already_enrolled", "Student 2 is already enrolled in course C2"),
    }


def test_grade_updates(spark, school):
    enrollment = school[3]
    updates = spark.createDataFrame(
        [(1, 1, "C2", "C"), (2, 1, "C2", "D"), (3, 1, "C1", "B+"), (4, 2, "C1", None), (5, 9, "C1", "A")],
        "seq long, student_id long, course_id string, grade string",
    )
    outcomes = {r["seq"]: r["outcome"] for r in functions.check_grade_updates(updates, enrollment).collect()}
    assert outcomes == {1: "updated", 2: "updated", 3: "invalid_grade", 4: "updated", 5: "enrollment_missing"}
    new = {r["enrollment_id"]: r["grade"] for r in functions.update_grades(enrollment, updates).collect()}
    assert new == {1: "A", 2: "D", 3: None, 4: "B+"}


@pytest.mark.parametrize("others", [[], [1, 2], [1, None], [None]])
def test_not_in_follows_sql(spark, others):
    left = spark.createDataFrame([(1,), (3,), (None,)], "k long")
    right = spark.createDataFrame([(o,) for o in others], "o long")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    expected = spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT o FROM r)").collect()
    assert sorted(map(str, lookups.keys_not_in(left, "k", right, "o").collect())) == sorted(map(str, expected))


def test_pages_agree(school):
    student = school[1]
    assert tuples(lookups.page(student, "student_id", 2, 1)) == tuples(lookups.page_after(student, "student_id", 1, 2))


def test_existence(school):
    _, student, _, enrollment = school
    assert lookups.has_enrollment(enrollment, 1).first()[0] is True
    assert lookups.has_enrollment(enrollment, 99).first()[0] is False
    assert lookups.enrolled_students(student, enrollment.filter("student_id > 1")).count() == 2
