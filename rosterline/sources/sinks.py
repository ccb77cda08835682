"""Sinks: load cleaned records into the stored academic tables, and count rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.operators.academic_functions import PAIR, check_enrollments, check_grade_updates
from rosterline.schemas import ENROLLMENT, STUDENT
from rosterline.sources.store import Change, KeyedTable, latest_per_key


def empty_table(spark: SparkSession, path: str, keys: list[str], schema: str, **options) -> KeyedTable:
    """A keyed table with a first, empty version, unless it already has one."""
    table = KeyedTable(spark, path, keys, schema=schema, **options)
    if not table.exists():
        table.replace(spark.createDataFrame([], schema))
    return table


def student_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    return empty_table(spark, path, ["student_email"], STUDENT, id_column="student_id", **options)


def enrollment_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    return empty_table(spark, path, PAIR, ENROLLMENT, id_column="enrollment_id", **options)


def load_students(table: KeyedTable, students: DataFrame, seq: str = "seq") -> Change:
    """Upsert on the e-mail: known students keep their id and get all other columns replaced."""
    return table.upsert(students, seq)


def load_enrollments(table: KeyedTable, enrollments: DataFrame, seq: str = "seq") -> Change:
    """Upsert on (student, course): grade and date are replaced."""
    return table.upsert(enrollments, seq)


def enroll_students(
    table: KeyedTable, requests: DataFrame, student: DataFrame, course: DataFrame, seq: str = "seq"
) -> Change:
    """Add the accepted enrollment requests, ungraded, with new ids."""
    judged = check_enrollments(requests, student, course, table.current_near(requests), seq)
    accepted = judged.filter(F.col("outcome") == "enrolled")
    return table.insert_ignore(accepted.withColumn("grade", F.lit(None).cast("string")), seq)


def store_grades(table: KeyedTable, updates: DataFrame, seq: str = "seq") -> Change:
    """Apply the last valid grade update of each stored (student, course); others change nothing."""
    near = table.current_near(updates)
    applied = check_grade_updates(updates, near).filter(F.col("outcome") == "updated")
    last = latest_per_key(applied.select(seq, *PAIR, "grade"), PAIR, seq)
    return table.upsert(near.drop("grade").join(last, PAIR), seq)


def insert_new(table: KeyedTable, rows: DataFrame, order_by: str) -> int:
    """Insert rows with new keys and return how many there were."""
    return table.insert_ignore(rows, order_by).inserted


def row_counts(spark: SparkSession, tables: dict[str, Callable[[], DataFrame] | DataFrame]) -> DataFrame:
    """Rows per table, ordered by name; a table that cannot be read shows NULL and ``N/A``."""
    parts = []
    for name, source in tables.items():
        try:
            df = source() if callable(source) else source
            part = df.agg(F.count("*").alias("row_count"))
        except (AnalysisException, ValueError):
            part = spark.range(1).select(F.lit(None).cast("long").alias("row_count"))
        parts.append(part.select(F.lit(name).alias("table_name"), "row_count"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    shown = F.coalesce(F.col("row_count").cast("string"), F.lit("N/A"))
    return result.withColumn("shown", shown).orderBy("table_name")
