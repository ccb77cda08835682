"""Physical plans: what must be in them at scale, and what must never be."""

import os
import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rosterline.operators import academic
from rosterline.plans import catalog
from rosterline.schemas import COURSE, DEPARTMENT, STUDENT
from rosterline.sources.store import latest_per_key

needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")
WRITES = ("src_", "snk_", "inc_1", "inc_2", "inc_3", "inc_6", "str_1", "str_2", "str_3_error", "str_4", "mv_4", "mv_5",
          "b_5_stored", "b_8", "o_1_stored", "o_4_stored", "o_5_position", "doc_3_indexed", "val_4", "val_6", "f_3_enroll_students", "f_6_stored", "val_9_cleaning")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small enough to be shipped."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@needs_tables
@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if not n.startswith(WRITES)])
def test_no_plan_that_cannot_grow(name, spark, no_broadcast):
    text = plan(catalog.run(name, spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin", "Python", "Window ", "Expand"):
        assert bad not in text, bad


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalog.run("p_4_monthly_revenue", spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert re.search(r"ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>", text)
    text = plan(catalog.run("o_5_page_after", spark, SMALL))
    assert "GreaterThan(c_custkey,39)" in text and "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan(catalog.run("o_7_projection", spark, SMALL))


@needs_tables
def test_facts_are_folded_before_they_are_shuffled(spark, no_broadcast):
    text = plan(catalog.run("mv_1_artist_sales", spark, SMALL))
    for key in ("TrackId", "AlbumId", "ArtistId"):
        folded = rf"Exchange hashpartitioning\({key}#\d+L?, \d+\)[^\n]*\n[^\n]*HashAggregate\(keys=\[{key}#\d+L?\], functions=\[partial_"
        assert re.search(folded, text), key
    assert text.count("Exchange hashpartitioning") == 6  # one per fold and one per dimension


@needs_tables
def test_top_k_never_sorts_everything(spark):
    for name in ("p_1_top_artists", "b_1_artist_revenue", "o_5_page", "inc_5_sync_history"):
        assert "TakeOrderedAndProject" in plan(catalog.run(name, spark, SMALL)), name


def test_hot_key_is_split_in_row_level_joins(spark):
    """Two thirds of all enrollments belong to one student: adaptive execution cuts that partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        enrollment = spark.range(0, 200000, 1, 16).selectExpr(
            "id AS enrollment_id", "DATE'2024-01-01' AS enrollment_date",
            "CASE WHEN id % 3 < 2 THEN 1 ELSE id % 500 END AS student_id", "'C' || id % 300 AS course_id", "CAST(NULL AS STRING) AS grade",
        )
        student = spark.range(500).selectExpr(
            "id AS student_id", "'F' AS student_first_name", "CAST(id AS STRING) AS student_last_name", "'e' || id AS student_email",
            "DATE'2000-01-01' AS student_date_of_birth", "1 AS student_year", "'1' AS student_phone_number", "1 AS department_id",
        )
        course = spark.range(300).selectExpr("'C' || id AS course_id", "'N' AS course_name", "1 AS department_id", "1 AS course_credits")
        assert [c.split()[0] for c in STUDENT.split(", ")] == student.columns
        assert [c.split()[0] for c in COURSE.split(", ")] == course.columns and DEPARTMENT
        df = academic.pending_enrollments(enrollment, student, course)
        assert df.count() == 200000
        df.collect()
        assert "skew=true" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_latest_per_key_folds_in_a_hash_aggregate(spark, no_broadcast):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"), F.lit("x").alias("v"))
    text = plan(latest_per_key(df, ["k"], "seq"))
    assert "SortAggregate" not in text and "partial_max(row_rank" in text
    assert re.search(r"Exchange hashpartitioning\(k#[^\n]*\n[^\n]*HashAggregate\(keys=\[k#[^\n]*partial_max\(row_rank", text)
