"""Validation jobs: one invented record per defect, order rules, and properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterline.operators import validation as v

AS_OF = "2024-06-30"
FIELDS = "seq long, first_name string, last_name string, name string, email string, date_of_birth string, year string, phone_number string, department string"


def student(seq, email="s{}@x.org", dob="2004-05-15", year="2", phone="9876543210", dept="CS", first="Ann", last="Lee", name=""):
    return (seq, first, last, name, email.format(seq), dob, year, phone, dept)


def reasons(spark, rows, department):
    tagged = v.tag_students(spark.createDataFrame(rows, FIELDS), department, AS_OF)
    return {r["seq"]: r["reject_reason"] for r in tagged.collect()}


def test_students_one_defect_each(spark, department):
    rows = [
        student(1),
        student(2, email=""),
        student(3, email="no-dot@host"),
        student(4, email=" S1@X.ORG "),
        student(5, year="5"),
        student(6, dob="2010-01-01"),
        student(7, dob="30/02/2004"),
        student(8, phone="12345"),
        student(9, dept="Astrology"),
        student(10, first="", last="", name=""),
        student(11, first=" ", last="Lee"),
        student(12, first="", last="", name="Cher"),
        student(13, dob="15/01/2004", year="third", dept="mechanical", phone="+91 98765 43210"),
    ]
    assert reasons(spark, rows, department) == {
        1: None,
        2: "invalid_email",
        3: "invalid_email",
        4: "duplicate_email",
        5: "invalid_year",
        6: "invalid_date_of_birth",
        7: "invalid_date_of_birth",
        8: "invalid_phone",
        9: "unknown_department",
        10: "missing_name",
        11: "missing_first_name",
        12: None,
        13: None,
    }


def test_unlisted_department_is_told_apart(spark, department):
    few = department.filter("department_id < 3")
    assert reasons(spark, [student(1, dept="mech")], few) == {1: "department_not_found"}


def test_first_record_that_fails_late_blocks_its_copy(spark, department):
    rows = [student(1, email="same@x.org", year="9"), student(2, email="same@x.org")]
    assert reasons(spark, rows, department) == {1: "invalid_year", 2: "duplicate_email"}


def test_invalid_email_does_not_block(spark, department):
    rows = [student(1, email="bad"), student(2, email="bad")]
    assert reasons(spark, rows, department) == {1: "invalid_email", 2: "invalid_email"}


def test_hot_email_keeps_all_records(spark, department):
    """A third of all records share one address: one is accepted, every other is accounted for."""
    rows = [student(i, email="hot@x.org" if i % 3 == 0 else "s{}@x.org") for i in range(600)]
    df = spark.createDataFrame(rows, FIELDS).repartition(7)
    accepted, rejected = v.transform_students(df, department, AS_OF)
    assert accepted.filter("student_email = 'hot@x.org'").collect()[0]["seq"] == 0
    assert (accepted.count(), rejected.count()) == (401, 199)


def test_camel_case_and_full_names(spark, department):
    rows = [(1, " Ana ", "Gil ", "", "a@x.org"), (2, "", "", " Ana Maria  Gil", "b@x.org"), (3, "", "", "Cher", "c@x.org")]
    df = spark.createDataFrame(rows, "seq long, firstName string, lastName string, name string, email string").selectExpr(
        "*", "'2004-01-01' dateOfBirth", "'1' year", "'9876543210' phoneNumber", "'cs' department"
    )
    accepted, _ = v.transform_students(df, department, AS_OF)
    names = {r["seq"]: (r["student_first_name"], r["student_last_name"]) for r in accepted.collect()}
    assert names == {1: ("Ana", "Gil"), 2: ("Ana", "Maria Gil"), 3: ("Cher", "")}


def test_enrollments_one_defect_each(spark):
    student_ = spark.createDataFrame([(7, "a@x.org"), (8, "b@x.org")], "student_id long, student_email string")
    course = spark.createDataFrame([("C1",), ("C2",)], "course_id string")
    rows = [
        (1, " A@x.org", " C1 ", " a- ", "15/01/2024"),
        (2, "a@x.org", "C1", "B", "2024-01-15"),
        (3, "nobody@x.org", "C1", "A", "2024-01-15"),
        (4, "", "C1", "A", "2024-01-15"),
        (5, "a@x.org", "C9", "A", "2024-01-15"),
        (6, "a@x.org", None, "A", "2024-01-15"),
        (7, "b@x.org", "C1", "B+", "2024-01-15"),
        (8, "b@x.org", "C1", "B", "2024-01-15"),
        (9, "b@x.org", "C2", "", "99/99/2024"),
        (10, "a@x.org", "C2", "", "Jan 15, 2024"),
    ]
    raw = spark.createDataFrame(rows, "seq long, student_email string, course_code string, grade string, enrollment_date string")
    tagged = {r["seq"]: r for r in v.tag_enrollments(raw, student_, course).collect()}
    assert {k: r["reject_reason"] for k, r in tagged.items()} == {
        1: None, 2: "duplicate_enrollment", 3: "student_not_found", 4: "student_not_found", 5: "course_not_found",
        6: "course_not_found", 7: "invalid_grade", 8: "duplicate_enrollment", 9: "invalid_date", 10: None,
    }
    assert (tagged[1]["grade"], tagged[1]["enrollment_date"]) == ("A-", dt.date(2024, 1, 15))
    assert tagged[10]["grade"] is None


REQUEST = "seq long, firstName string, lastName string, email string, dateOfBirth string, year string, phoneNumber string, department string"


def request(seq, first="Ann", last="Lee", email="r{}@x.org", dob="2004-05-15", year="2", phone="9876543210", dept="CS"):
    return (seq, first, last, email.format(seq), dob, year, phone, dept)


def test_pending_collects_all_errors(spark):
    rows = [request(1), request(2, first="", email="", year="", dept=None), request(3, email="x", year="7"),
            request(4, year="0"), request(5, year="2nd")]
    judged = v.pending_errors(spark.createDataFrame(rows, REQUEST))
    errors = {r["seq"]: r["errors"] for r in judged.collect()}
    assert errors == {
        1: [],
        2: ["Missing firstName", "Missing email", "Missing year", "Missing department"],
        3: ["Invalid email format", "Year must be between 1 and 4"],
        4: ["Missing year"],
        5: [],
    }


def test_register_statuses(spark, department):
    existing = spark.createDataFrame([("old@x.org",), ("old@x.org",)], "student_email string")
    rows = [
        request(1),
        request(2, email="R1@x.org "),
        request(3, email="old@x.org"),
        request(4, first=" ", year="9", dept="Magic"),
        request(5, dept="mech"),
    ]
    out = {
        r["seq"]: (r["status_code"], r["errors"])
        for r in v.register(spark.createDataFrame(rows, REQUEST), department.filter("department_id < 3"), existing, AS_OF).collect()
    }
    taken = ["Student with this email already exists"]
    assert out == {
        1: (201, []),
        2: (409, taken),
        3: (409, taken),
        4: (400, ["First name is required", "Year must be between 1 and 4", "Unknown department: Magic"]),
        5: (400, ['Department "Mechanical" not found in database']),
    }


def test_invalid_request_does_not_take_the_address(spark, department):
    none = spark.createDataFrame([], "student_email string")
    rows = [request(1, email="same@x.org", year="9"), request(2, email="same@x.org")]
    out = v.register(spark.createDataFrame(rows, REQUEST), department, none, AS_OF)
    assert {r["seq"]: r["status_code"] for r in out.collect()} == {1: 400, 2: 201}


def test_sheet_rules(spark):
    rows = [
        request(1),
        request(2, dob="2010-01-01", phone="12-34", year="2nd"),
        request(3, email=" r@x.org", dob="", phone=" ", dept=" "),
        request(4, phone="+91 98765-43210", year="2.5"),
    ]
    errors = {r["seq"]: r["errors"] for r in v.sheet_errors(spark.createDataFrame(rows, REQUEST), AS_OF).collect()}
    assert errors == {
        1: [],
        2: ["Student must be at least 16 years old (currently 14)", "year must be 1-4", "phoneNumber must have 10-15 digits (got 4)"],
        3: ["Valid email required", "dateOfBirth is required", "phoneNumber is required", "department is required"],
        4: [],
    }


def test_incomplete_requests_wait(spark):
    rows = [request(1), request(2, dept=" "), request(3, phone=None)]
    complete, waiting = v.split_complete(spark.createDataFrame(rows, REQUEST))
    assert [r["seq"] for r in complete.collect()] == [1]
    assert sorted(r["seq"] for r in waiting.collect()) == [2, 3]


def test_submit_statuses(spark, department):
    existing = spark.createDataFrame([("old@x.org",)], "student_email string")
    rows = [request(1), request(2, email="old@x.org"), request(3, year="5"), request(4, dept="Magic"), request(5, email="r1@x.org")]
    out = {r["seq"]: (r["status"], r["message"]) for r in v.submit(spark.createDataFrame(rows, REQUEST), department, existing, AS_OF).collect()}
    assert out == {
        1: ("Registered", "Registered"),
        2: ("Registered", "Already in database"),
        3: ("Invalid", "year must be 1-4"),
        4: ("Error", "Unknown department: Magic"),
        5: ("Registered", "Already in database"),
    }


@pytest.mark.parametrize("partitions", [1, 5])
def test_accepted_and_rejected_make_the_input(spark, department, partitions):
    rows = [student(i, email="s{}@x.org" if i % 4 else "dup@x.org", year=str(i % 6)) for i in range(120)]
    df = spark.createDataFrame(rows, FIELDS).repartition(partitions)
    accepted, rejected = v.transform_students(df, department, AS_OF)
    assert accepted.select("seq").union(rejected.select("seq")).distinct().count() == 120
    totals = v.run_totals(v.tag_students(df, department, AS_OF)).first()
    assert (totals["extracted"], totals["transformed"]) == (120, accepted.count())
    assert totals["skipped"] == v.run_statistics(v.tag_students(df, department, AS_OF)).filter(
        F.col("outcome") != "accepted"
    ).agg(F.sum("records")).first()[0]
