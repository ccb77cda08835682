"""Stored layouts read only what a lookup needs; summaries follow changes without old facts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rosterline.operators import layouts, lookups, maintained, sales, validation
from rosterline.plans.jobs import plan_text


def scanned(df):
    """Rows that came out of the scan of a plan without shuffles."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture
def students(spark):
    phone = F.when(F.col("id") % 10 == 0, F.concat(F.lit("+91"), F.col("id"))).otherwise(F.concat(F.lit("+44"), F.col("id")))
    return spark.range(40_000).select(
        F.col("id").alias("student_id"), F.md5(F.col("id").cast("string")).alias("student_email"), phone.alias("student_phone_number"))


def test_a_lookup_reads_few_row_groups(spark, students, path):
    stored = layouts.store_sorted(students, path("by_email"), "student_email", row_group_bytes=1 << 16)
    email = students.where("student_id = 777").first()["student_email"]
    found = lookups.find_student(stored, email)
    assert "EqualTo(student_email" in plan_text(found) and [r["student_id"] for r in found.collect()] == [777]
    assert 0 < scanned(found) < 8_000
    # An absent value between stored ones: the Bloom filters rule all row groups out.
    assert scanned(lookups.find_student(stored, email[:-1] + "g")) == 0


def test_a_prefix_reads_few_row_groups(spark, students, path):
    stored = layouts.store_sorted(students, path("by_phone"), "student_phone_number", row_group_bytes=1 << 16)
    found = lookups.students_by_phone_prefix(stored)
    assert "StringStartsWith(student_phone_number" in plan_text(found) and found.count() == 4_000
    assert scanned(lookups.students_by_phone_prefix(stored)) < 16_000


@pytest.mark.parametrize("size, offset", [(20, 0), (20, 39_990), (7, 12_345), (30_000, 5_000), (5, 50_000)])
def test_pages_by_position(spark, students, path, size, offset):
    pages = layouts.store_pages(students, path("pages"), "student_id")
    found = pages.page(size, offset)
    assert [r["student_id"] for r in found.collect()] == list(range(offset, min(offset + size, 40_000)))
    if size <= 20 and offset < 40_000:
        assert found.inputFiles() and len(pages.sizes) > 1
        assert found.select(F.input_file_name().alias("f")).distinct().count() == 1


def test_pages_of_an_empty_table_and_reopened_ones(spark, students, path):
    empty = layouts.store_pages(students.limit(0), path("none"), "student_id")
    assert empty.page().count() == 0
    layouts.store_pages(students, path("pages"), "student_id")
    again = layouts.open_pages(spark, path("pages"), "student_id", students.schema)
    assert [r["student_id"] for r in again.page(3, 20_000).collect()] == [20_000, 20_001, 20_002]


def test_index_search_equals_the_scan(spark, path):
    names = ["Blue Ring", "ring of BLUE", "bluering", "blue", "Rin blue g", None, "", "ab", "Äther blau", "ring blue ring blue"]
    track = spark.createDataFrame([(k, n) for k, n in enumerate(names)] + [(0, "Blue Ring")], "TrackId long, Name string")
    index = layouts.index_tracks(track, path("index"))
    for query in ("RING blue", "blue", "äther", "ring nowhere", "ri blue", "bluering"):
        found = index.search(query)
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in sales.search_tracks(track.distinct(), query).collect()]
    assert index.search("a b") is None
    text = plan_text(index.search("ring"))
    assert "PartitionFilters: [gram_bucket" in text and "In(gram" in text


# -- maintained summaries ----------------------------------------------------------------------

FACT = "CustomerId long, InvoiceDate date, Total decimal(10,2)"


def fact(customer, day, total):
    return customer, dt.date(2024, 1, day), None if total is None else Decimal(total)


def by_customer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_totals_follow_inserts_updates_and_deletes(spark, path):
    def frame(rows):
        return spark.createDataFrame(rows, FACT)

    state = maintained.MaintainedTotals(spark, path("s"), {"CustomerId": "bigint", "InvoiceDate": "date"}, {"Total": "decimal(28,2)"}, partitions=4)
    now = []

    def change(batch, gone, new):
        for row in gone:
            now.remove(row)
        now.extend(new)
        images = maintained.change_images(frame(gone), frame(new))
        state.apply(images, batch)
        once = sorted(map(str, state.read().collect()))
        state.apply(images, batch)  # repeated
        assert sorted(map(str, state.read().collect())) == once
        columns = ["CustomerId", "orders", "spent", "priced", "first_purchase", "last_purchase"]
        full = sales.orders_per_customer(frame(now).withColumn("InvoiceId", F.lit(1)))
        assert by_customer(maintained.orders_per_customer(state.read()).select(*columns)) == by_customer(full.select(*columns))

    a, b, c, d = fact(1, 5, "10.00"), fact(1, 2, "7.50"), fact(2, 9, None), fact(1, 5, "10.00")
    change(1, [], [a, b, c, d])
    change(2, [b], [fact(1, 2, "8.50")])
    change(3, [fact(1, 2, "8.50")], [])  # the least day goes
    change(4, [a], [fact(3, 1, "1.00"), fact(2, 30, "4.00")])
    change(5, [c, fact(3, 1, "1.00")], [])
    change(6, [], [])
    assert state.read().count() == 2


def test_a_change_reads_no_old_fact(spark, path):
    spark.createDataFrame([fact(1, 1, "1.00")], FACT).write.parquet(path("facts"))
    facts = spark.read.parquet(path("facts"))
    state = maintained.MaintainedTotals(spark, path("s"), {"CustomerId": "bigint", "InvoiceDate": "date"}, {"Total": "decimal(28,2)"})
    state.apply(maintained.change_images(facts.limit(0), facts), 1)
    spark.createDataFrame([fact(1, 1, "99.00")], FACT).write.mode("overwrite").parquet(path("facts"))
    state.apply(maintained.change_images(spark.createDataFrame([], FACT), spark.createDataFrame([fact(1, 1, "2.00")], FACT)), 2)
    assert [(r["rows"], r["Total"]) for r in state.read().collect()] == [(2, Decimal("3.00"))]


def test_requests_are_judged_once(spark, department, path):
    rows = [(k, "Ann", "Lee", f"r{k % 7}@x.org", "2004-05-15", "2", "9876543210", "Computer Science") for k in range(20)]
    schema = "seq long, firstName string, lastName string, email string, dateOfBirth string, year string, phoneNumber string, department string"
    spark.createDataFrame(rows, schema).write.parquet(path("requests"))
    requests = spark.read.parquet(path("requests"))
    none = spark.createDataFrame([], "student_email string")
    answers = validation.register(requests, department, none, "2024-06-30")
    assert path("requests") not in plan_text(answers)  # the stored judgements are read instead
    assert sorted(r["seq"] for r in answers.where("status_code = 201").collect()) == list(range(7))
