"""Readers on small invented files."""

import datetime as dt
import json

import pytest

from rosterline.schemas import RAW_ENROLLMENT
from rosterline.sources import readers

PEOPLE = [{"name": "Ana Gil", "email": "a@x.org", "year": 2}, {"name": "Bo Li", "email": "b@x.org", "year": "3rd"}]


def write(tmp_path, name, text):
    target = tmp_path / name
    target.write_text(text, encoding="utf-8")
    return str(target)


def test_csv_trims_skips_empty_lines_and_keeps_text(spark, tmp_path):
    text = (
        "enrollment_id,student_email,course_code,grade,enrollment_date\n"
        '1, a@x.org ,C1,"A","Jan 15, 2024"\n\n007,b@x.org,C2,,"say ""hi"""\n'
    )
    df = readers.read_csv(spark, write(tmp_path, "e.csv", text), RAW_ENROLLMENT)
    assert [tuple(r) for r in df.collect()] == [
        ("1", "a@x.org", "C1", "A", "Jan 15, 2024"),
        ("007", "b@x.org", "C2", None, 'say "hi"'),
    ]


def test_csv_with_other_columns_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, write(tmp_path, "w.csv", "a,b,c,d,e\n1,2,3,4,5\n"), RAW_ENROLLMENT).collect()


@pytest.mark.parametrize(
    "document",
    [PEOPLE, {"data": PEOPLE}, {"records": PEOPLE}, {"description": "x", "students": PEOPLE}],
    ids=["array", "data", "records", "students"],
)
def test_json_shapes(spark, tmp_path, document):
    df = readers.read_json(spark, write(tmp_path, "p.json", json.dumps(document, indent=2)))
    assert [(r["name"], r["year"]) for r in df.collect()] == [("Ana Gil", "2"), ("Bo Li", "3rd")]


def test_json_single_object_and_empty_array(spark, tmp_path):
    assert readers.read_json(spark, write(tmp_path, "one.json", json.dumps(PEOPLE[0]))).count() == 1
    assert readers.read_json(spark, write(tmp_path, "none.json", json.dumps({"data": []}))).count() == 0


def test_reader_by_extension(spark, tmp_path):
    assert readers.read_file(spark, write(tmp_path, "P.JSON", json.dumps(PEOPLE)), readers.JSON_STUDENT).count() == 2
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_file(spark, str(tmp_path / "p.xml"), readers.JSON_STUDENT)


def test_four_named_inputs(spark, tmp_path):
    for file, schema in readers.INPUTS.values():
        names = schema.fieldNames()
        write(tmp_path, file, ",".join(names) + "\n" + ",".join("v" for _ in names) + "\n")
    inputs = readers.read_inputs(spark, str(tmp_path))
    assert {name: df.count() for name, df in inputs.items()} == dict.fromkeys(readers.INPUTS, 1)


def test_pending_envelope(spark, tmp_path):
    students = [{"firstName": "A", "year": 2}, {"firstName": "B", "year": 3}]
    envelope = {"exportedAt": "2024-01-01T00:00:00Z", "count": 2, "students": students}
    df = readers.read_pending(spark, write(tmp_path, "ok.json", json.dumps(envelope, indent=1)))
    assert [(r["position"], r["firstName"], r["year"]) for r in df.collect()] == [(1, "A", "2"), (2, "B", "3")]


@pytest.mark.parametrize("bad", [{"exportedAt": "x"}, {"students": "none"}])
def test_pending_without_students_is_an_error(spark, tmp_path, bad):
    with pytest.raises(Exception, match="students|MALFORMED"):
        readers.read_pending(spark, write(tmp_path, "bad.json", json.dumps(bad))).collect()


def test_copy_text(spark, tmp_path):
    text = '1\t"quoted"\t\\N\t2009-01-01 00:00:00\n2\ta\\\\b, c\t0.99\t\\N\n3\t\t1.99\t2009-01-02 00:00:00\n'
    source = write(tmp_path, "rows.txt", text)
    schema = "id int, name string, price decimal(10,2), stamp timestamp_ntz"
    plain = [tuple(r) for r in readers.read_copy_text(spark, source, schema).collect()]
    assert plain[0][1:] == ('"quoted"', None, dt.datetime(2009, 1, 1))
    assert plain[1][1] == "a\\\\b, c" and plain[1][3] is None
    assert plain[2][1] == ""
    assert readers.read_copy_text(spark, source, schema, unescape=True).collect()[1]["name"] == "a\\b, c"


RAGGED = "enrollment_id,student_email,course_code,grade,enrollment_date\n1,a,C1,A,2024-01-01\n2,b,C1\n3,c,C1,A,2024-01-01,more\n"


def test_ragged_csv_is_an_error_or_a_reject(spark, tmp_path):
    source = write(tmp_path, "r.csv", RAGGED)
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, source, RAW_ENROLLMENT).select("enrollment_id").collect()
    df = readers.read_csv(spark, source, RAW_ENROLLMENT, rejects="reject")
    assert [(r["enrollment_id"], r["reject"]) for r in df.collect()] == [("1", None), ("2", "2,b,C1"), ("3", "3,c,C1,A,2024-01-01,more")]


def test_quoted_line_break(spark, tmp_path):
    source = write(tmp_path, "q.csv", 'enrollment_id,student_email,course_code,grade,enrollment_date\n1,a,"C\n1",A,2024-01-01\n')
    assert readers.read_csv(spark, source, RAW_ENROLLMENT, multi_line=True).first()["course_code"] == "C\n1"
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_csv(spark, source, RAW_ENROLLMENT).collect()


def test_broken_json_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        readers.read_json(spark, write(tmp_path, "b.json", '{"data": [{"name": "x"')).collect()


def test_copy_rows_that_do_not_fit(spark, tmp_path):
    source = write(tmp_path, "c.txt", "1\ta\nx\tb\n3\tc\td\n4\n\\N\te\n")
    with pytest.raises(Exception, match="does not fit"):
        readers.read_copy_text(spark, source, "id int, name string").collect()
    found = readers.read_copy_text(spark, source, "id int, name string", rejects="reject").collect()
    assert [tuple(r) for r in found] == [(1, "a", None), (None, None, "x\tb"), (None, None, "3\tc\td"), (None, None, "4"), (None, "e", None)]
