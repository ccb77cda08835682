"""Cleaning expressions on invented values, one per defect."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterline.functions import cleaning as clean
from rosterline.functions import dates, grades


def apply(spark, expression, values, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    rows = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


CASES = [
    (clean.normalize_email, [" A@B.Org ", "\tx@y.z\n", " q@w.e﻿", "", "  ", None],
     ["a@b.org", "x@y.z", "q@w.e", None, None, None]),
    (clean.is_email, ["a@b.c", " a@b.c ", "a@b", "a b@c.d", "a@@b.c", "", None],
     [True, True, False, False, False, False, False]),
    (clean.parse_year, ["3", " 2", "2nd", "third", " FOUR ", "+1", "2.7", "0", "", "x", "99999999999", None],
     [3, 2, 2, 3, 4, 1, 2, 0, None, None, None, None]),
    (clean.standard_department, ["CS", " comp. sci. ", "ELECTRICAL", "mech", "Astrology", "", None],
     ["Computer Science", "Computer Science", "Electrical Engineering", "Mechanical", None, None, None]),
    (clean.is_grade, ["A", " a- ", "B+", "", None, "G"], [True, True, False, True, True, False]),
    (clean.normalize_phone, ["9876543210", "(987) 654-3210", "+91 9876543210", "+44 20-7946", "abc", "", None],
     ["+91-9876543210", "+91-9876543210", "+91 9876543210", "+44 20-7946", "", "", None]),
    (clean.is_phone, ["1234567", "123456", "+91-9876543210", "12345678901234567890", "123456789012345678901", "12a4567", None],
     [True, False, True, True, False, False, False]),
    (clean.clean_text, [" a b ", "", " \t", None], ["a b", None, None, None]),
    (clean.first_name_of, ["Cher", " Ana  Maria Lopez ", "", " ", None], ["Cher", "Ana", None, None, None]),
    (clean.last_name_of, ["Cher", " Ana  Maria Lopez ", "", None], ["", "Maria Lopez", "", None]),
    (clean.number, ["2", " 2.5 ", "2d", "2nd", "-1e2", "", None], [2.0, 2.5, None, None, -100.0, None, None]),
    (dates.parse_date,
     ["2024-01-15", " 2024-01-15T10:00:00Z", "2024-01-15 08:00", "15/01/2024", "5/1/2024", "Jan 15, 2024",
      "JANUARY 5 2024", "15 march 2024", "2024/1/5", "2024-02-30", "31/02/2024", "99/99/2024", "2024-01-15x", "soon", "", None],
     [dt.date(2024, 1, 15)] * 4 + [dt.date(2024, 1, 5), dt.date(2024, 1, 15), dt.date(2024, 1, 5),
      dt.date(2024, 3, 15), dt.date(2024, 1, 5)] + [None] * 7),
    (grades.grade_to_points, ["A", "A-", "B", "B-", "C", "C-", "D", "F", "B+", "a", None],
     [Decimal(p) for p in ("4.00", "3.70", "3.00", "2.70", "2.00", "1.70", "1.00", "0.00")] + [None] * 3),
]


@pytest.mark.parametrize("expression, values, expected", CASES, ids=lambda c: getattr(c, "__name__", ""))
def test_expression(spark, expression, values, expected):
    assert apply(spark, expression, values) == expected


def test_year_range(spark):
    assert apply(spark, clean.is_year, [0, 1, 4, 5, None], "int") == [False, True, True, False, False]


def test_age_counts_completed_years(spark):
    born = [dt.date(2004, 2, 29), dt.date(2008, 6, 30), dt.date(2008, 7, 1), dt.date(2024, 12, 31), None]
    assert apply(spark, lambda c: dates.age_in_years(c, "2024-06-30"), born, "date") == [20, 16, 15, 0, None]
    assert apply(spark, lambda c: dates.age_in_years(c, "2023-02-28"), [dt.date(2004, 2, 29)], "date") == [18]


def test_old_enough_on_the_birthday(spark):
    born = [dt.date(2008, 6, 30), dt.date(2008, 7, 1)]
    assert apply(spark, lambda c: dates.old_enough(c, "2024-06-30"), born, "date") == [True, False]


def test_age_by_days_differs_from_calendar_age(spark):
    assert apply(spark, lambda c: dates.age_by_days(c, "2024-06-30"), [dt.date(2007, 7, 1)], "date") == [16]
    assert apply(spark, lambda c: dates.age_by_days(c, "2023-03-01"), [dt.date(2007, 3, 1)], "date") == [16]
    assert apply(spark, lambda c: dates.age_by_days(c, "2022-03-01"), [dt.date(2005, 3, 1)], "date") == [16]


def test_field_takes_first_filled_spelling(spark):
    df = spark.createDataFrame(
        [("", "b@x.y"), ("a@x.y", "b@x.y"), (None, ""), (" ", "b@x.y")], "email string, student_email string"
    )
    assert [r[0] for r in df.select(clean.field(df, "email")).collect()] == ["b@x.y", "a@x.y", None, " "]


def test_free_form_dates(spark):
    known = {
        "2024-1-5": (2024, 1, 5), "1-5-2024": (2024, 1, 5), "12-31-2024": (2024, 12, 31), "2024/1/5 10:00": (2024, 1, 5),
        "Jan 15, 2024 10:30": (2024, 1, 15), "15 January 2024, 23:59:59.5 GMT+0200": (2024, 1, 15), "Monday, January 15, 2024": (2024, 1, 15),
        "Mon Jan 15 2024 00:00:00 GMT+0530 (India Standard Time)": (2024, 1, 15), "tue., 2 feb 2021": (2021, 2, 2), "January 2024": (2024, 1, 1),
        "feb 2023": (2023, 2, 1), "1/15/2024 10:30 PM": (2024, 1, 15), "15/01/2024": (2024, 1, 15), "2024-01-15T10:00:00Z": (2024, 1, 15),
    }
    refused = ["13-31-2024", "31-12-2024", "2024-13-5", "2024-2-30", "15/01/2024 10:30", "Janember 2024x", "Mon", "10:30", "Feb 30, 2024", "2024", "Monday 2024-1-"]
    found = apply(spark, dates.parse_date, [*known, *refused], "string")
    assert found == [dt.date(*d) for d in known.values()] + [None] * len(refused)


def test_average_rounds_once_half_up(spark):
    # 3.004999… must not become 3.005 and then 3.01; an exact tie goes up.
    df = spark.createDataFrame([(3004999900, 10**7), (60100, 200)], "s long, n long")
    assert [r[0] for r in df.select(grades.gpa(F.col("s"), F.col("n"))).collect()] == [Decimal("3.00"), Decimal("3.01")]


def test_performance_level_uses_unrounded_average(spark):
    rows = [(69999, 200), (70000, 200), (300, 1), (200, 1), (199, 1), (None, 0)]
    df = spark.createDataFrame(rows, "s long, n long")
    levels = [r[0] for r in df.select(grades.performance_level(F.col("s"), F.col("n"))).collect()]
    assert levels == ["Good", "Excellent", "Good", "Average", "Below Average", "No Grades"]
