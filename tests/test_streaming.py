"""Streams over small drops of files: several micro-batches, repeats, replays and late rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rosterline.operators import validation
from rosterline.sources import sinks
from rosterline.streaming import digest, registration

AS_OF = "2024-06-30"
EVENT = (
    "event_seq long, row_id long, firstName string, lastName string, email string, dateOfBirth string, "
    "year string, phoneNumber string, department string"
)


def edit(seq, row_id, email="r{}@x.org", year="2", dept="CS"):
    return (seq, row_id, "Ann", "Lee", email.format(row_id), "2004-05-15", year, "9876543210", dept)


def drop(spark, folder, number, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{number:03d}")


@pytest.fixture
def job(spark, department, path):
    outcomes = registration.OutcomeLog(spark, path("outcomes"))
    students = sinks.student_table(spark, path("students"), partitions=4)
    return registration.RegistrationStream(outcomes, students, department, AS_OF)


def statuses(job):
    return {r["row_id"]: (r["status"], r["message"]) for r in job.outcomes.latest().collect()}


def test_registration_over_several_batches(spark, job, path):
    folder = path("in")
    drop(spark, folder, 1, [edit(1, 1), edit(2, 2, dept=""), edit(3, 3, year="9"), edit(4, 4, email="r1@x.org")], EVENT)
    events = spark.readStream.schema(EVENT).parquet(f"{folder}/*")
    job.start(events, path("check")).awaitTermination()
    assert statuses(job) == {
        1: ("Registered", "Registered"),
        3: ("Invalid", "year must be 1-4"),
        4: ("Registered", "Already in database"),
    }
    # The waiting record is completed, the invalid one corrected, a registered one edited again.
    drop(spark, folder, 2, [edit(5, 2), edit(6, 3, year="8"), edit(7, 3), edit(8, 1, year="9")], EVENT)
    job.start(events, path("check")).awaitTermination()
    assert {k: s for k, (s, _) in statuses(job).items()} == dict.fromkeys([1, 2, 3, 4], "Registered")
    rows = {r["student_email"]: (r["student_id"], r["student_year"]) for r in job.students.current().collect()}
    assert rows == {"r1@x.org": (1, 2), "r2@x.org": (2, 2), "r3@x.org": (3, 2)}


def test_replayed_batch_changes_nothing(spark, job):
    batch = spark.createDataFrame([edit(1, 1), edit(2, 2, year="9")], EVENT)
    job.process(batch, 0)
    before, students = statuses(job), sorted(job.students.current().collect())
    job.process(batch, 0)
    assert statuses(job) == before and sorted(job.students.current().collect()) == students


def test_no_batch_writes_an_earlier_file_again(spark, job):
    seen = {}
    for number in range(20):
        job.process(spark.createDataFrame([edit(number, 1, year="9"), edit(number, 100 + number)], EVENT), number)
        now = {}
        for folder, _, names in os.walk(job.outcomes.path):
            now |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
        assert seen.items() <= now.items() and len(now) > len(seen)
        seen = now
    assert len(statuses(job)) == 21 and job.outcomes.read().count() == 40 and job.students.current().count() == 20


def test_batch_that_stopped_halfway_is_completed(spark, job, monkeypatch):
    batch = spark.createDataFrame([edit(1, 1), edit(2, 2)], EVENT)

    def lost(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(job.students, "insert_ignore", lost)
    with pytest.raises(RuntimeError):
        job.process(batch, 0)
    monkeypatch.undo()
    job.process(batch, 0)
    assert {s for s, _ in statuses(job).values()} == {"Registered"}
    assert job.students.current().count() == 2


def test_stream_result_is_the_batch_result(spark, department, job, path):
    rows = [edit(i, i, email="hot@x.org" if i % 3 == 0 else "r{}@x.org", year=str(i % 6)) for i in range(60)]
    folder = path("in")
    drop(spark, folder, 1, rows, EVENT)
    job.start(spark.readStream.schema(EVENT).parquet(f"{folder}/*"), path("check")).awaitTermination()
    requests = spark.createDataFrame(rows, EVENT).withColumnRenamed("row_id", "seq")
    none = spark.createDataFrame([], "student_email string")
    complete, _ = validation.split_complete(requests)
    batch = validation.submit(complete, department, none, AS_OF)
    assert statuses(job) == {r["seq"]: (r["status"], r["message"]) for r in batch.collect()}


def test_keep_first_across_batches(spark, path):
    schema = "k string, n long"
    table = sinks.empty_table(spark, path("t"), ["k"], schema, partitions=4)
    folder = path("in")
    drop(spark, folder, 1, [("a", 5), ("a", 3), ("b", 4)], schema)
    events = spark.readStream.schema(schema).parquet(f"{folder}/*")
    registration.keep_first(events, table, "n", path("check")).awaitTermination()
    drop(spark, folder, 2, [("a", 1), ("c", 9)], schema)
    registration.keep_first(events, table, "n", path("check")).awaitTermination()
    assert sorted(tuple(r) for r in table.current().collect()) == [("a", 3), ("b", 4), ("c", 9)]


def test_repeats_over_several_files_and_a_restart(spark, path):
    schema = "k string, ts timestamp, n long"
    at = dt.datetime(2024, 1, 1)
    hour = dt.timedelta(hours=1)
    folder = path("in")

    def run():
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
        registration.start_repeats(events, ["k"], "ts", path("out"), path("check")).awaitTermination()
        return sorted((r["k"], r["ts"]) for r in spark.read.schema(schema).parquet(path("out")).collect())

    drop(spark, folder, 1, [("a", at, n) for n in range(200)] + [("b", at, 1)], schema)
    assert run() == [("a", at), ("b", at)]
    drop(spark, folder, 2, [("a", at + hour, 1), ("c", at + 2 * hour, 2)], schema)
    drop(spark, folder, 3, [("c", at + 3 * hour, 3), ("b", at, 9)], schema)
    assert run() == [("a", at), ("b", at), ("c", at + 2 * hour)]
    drop(spark, folder, 4, [("d", at + 80 * hour, 1)], schema)
    run()  # the watermark passes what is stored
    drop(spark, folder, 5, [("e", at, 1), ("a", at + 81 * hour, 5)], schema)  # e is late, a is no repeat any more
    assert run() == [("a", at), ("a", at + 81 * hour), ("b", at), ("c", at + 2 * hour), ("d", at + 80 * hour)]


RECORD = "ts timestamp, row_id long, status string, message string"


def records(day, first, count, status="Error"):
    at = dt.datetime(2024, 1, day, 12)
    return [(at, first + i, status, "m") for i in range(count)]


def test_closed_days_are_written_once_and_match_the_batch(spark, path):
    folder = path("in")

    def run():
        stream = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
        digest.start_closed_days(stream, path("days"), path("check")).awaitTermination()
        return sorted(tuple(r) for r in digest.closed_days(spark, path("days")).collect())

    first = records(1, 1, 3) + records(1, 10, 2, "Invalid") + records(1, 20, 5, "Registered")
    second = records(1, 30, 2) + records(2, 40, 1)
    drop(spark, folder, 1, first, RECORD)
    assert run() == []
    drop(spark, folder, 2, second, RECORD)
    assert run() == []  # a day may still come in until one day after its end
    third = records(3, 50, 4) + records(5, 60, 1, "Invalid")
    drop(spark, folder, 3, third, RECORD)
    day = dt.date(2024, 1, 1)
    closed = [(day, "Error", "m", 5), (day, "Invalid", "m", 2), (dt.date(2024, 1, 2), "Error", "m", 1), (dt.date(2024, 1, 3), "Error", "m", 4)]
    assert run() == closed
    drop(spark, folder, 4, records(1, 70, 9), RECORD)  # late: its day is closed
    assert run() == closed
    every = spark.createDataFrame(first + second + third, RECORD)
    so_far = digest.digest_so_far(digest.closed_days(spark, path("days")), every)
    columns = ["day", "status", "message", "records"]
    assert sorted(tuple(r) for r in so_far.select(*columns).collect()) == sorted(tuple(r) for r in digest.digest_counts(every).select(*columns).collect())

def test_digest_is_empty_without_failures(spark):
    df = spark.createDataFrame(records(1, 1, 4, "Registered"), RECORD)
    assert digest.digest_counts(df).isEmpty() and digest.digest_lines(df).isEmpty()


def test_digest_lines(spark):
    df = spark.createDataFrame(records(1, 7, 1), RECORD).withColumn("message", F.lit("bad year"))
    assert [tuple(r) for r in digest.digest_lines(df).collect()] == [(dt.date(2024, 1, 1), 7, "Row 7: bad year")]
