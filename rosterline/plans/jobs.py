"""Whole flows: cleaning run, pending-registration run and the timed benchmark suite."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rosterline.operators.sync import Refresh, SummaryTable, SyncLog, last_read, refresh_all
from rosterline.operators.validation import (
    ENROLLMENT_COLUMNS,
    STUDENT_COLUMNS,
    run_statistics,
    split,
    tag_enrollments,
    tag_students,
    validate_pending,
)
from rosterline.session import fresh_path
from rosterline.sources.sinks import load_enrollments, load_students
from rosterline.sources.store import Change, KeyedTable


@dataclass
class CleaningRun:
    """What a cleaning run did: both loads, the rejected records, and the records per job and outcome."""

    students: Change
    enrollments: Change
    rejects: DataFrame
    statistics: DataFrame


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_cleaning(
    raw_students: DataFrame,
    raw_enrollments: DataFrame,
    department: DataFrame,
    course: DataFrame,
    student_table: KeyedTable,
    enrollment_table: KeyedTable,
    as_of=None,
    seq: str = "seq",
) -> CleaningRun:
    """Clean and load students, then enrollments against the students just loaded.

    Judged records are written once; loads, rejects and statistics read them. The rejects are a stored table.
    """
    students = _stored(tag_students(raw_students, department, as_of, seq), "judged-students")
    accepted, rejected = split(students, STUDENT_COLUMNS, seq)
    student_change = load_students(student_table, accepted, seq)
    enrollments = _stored(tag_enrollments(raw_enrollments, student_table.current(), course, seq), "judged-enrollments")
    enrolled, refused = split(enrollments, ENROLLMENT_COLUMNS, seq)
    enrollment_change = load_enrollments(enrollment_table, enrolled, seq)
    rejects = _stored(
        rejected.withColumn("job", F.lit("students")).unionByName(refused.withColumn("job", F.lit("enrollments"))), "rejects"
    )
    statistics = run_statistics(students, "students").unionByName(run_statistics(enrollments, "enrollments"))
    return CleaningRun(student_change, enrollment_change, rejects, statistics)


def run_pending(
    pending: DataFrame, department: DataFrame, student_table: KeyedTable, as_of=None, seq: str = "seq"
) -> Change:
    """Exported registrations: collect-all check, then the fail-fast cleaning, then the upsert."""
    valid, _ = validate_pending(pending)
    tagged = tag_students(valid, department, as_of, seq)
    return load_students(student_table, split(tagged, STUDENT_COLUMNS, seq)[0], seq)


def run_incremental(
    log: SyncLog,
    table_name: str,
    table: KeyedTable,
    changes: DataFrame,
    order_by: str,
    summaries: Mapping[str, SummaryTable],
) -> tuple[int, dict[str, Refresh]]:
    """Upsert a change under the sync log, then refresh the summaries: (records processed, rows per summary)."""

    def upsert() -> int:
        change = table.upsert(changes, order_by)
        return change.inserted + change.updated

    return log.run(table_name, "incremental", upsert), refresh_all(summaries)


def run_delta(
    log: SyncLog,
    table_name: str,
    table: KeyedTable,
    source: DataFrame,
    ts: str,
    order_by: str,
    summaries: Mapping[str, SummaryTable],
) -> tuple[int, dict[str, Refresh]]:
    """Upsert what the source has from the newest time of the last run on, then refresh the summaries.

    The bound is the source's own time and is read again: a row stamped while a run is under way, or with the time of
    the last row of a run, is met by the next one. Rows without a time cannot be bounded and are read by every run;
    ``order_by`` has to grow with ``ts`` and decides between them and dated ones.
    """

    def upsert() -> tuple[int, dt.datetime | None]:
        since = last_read(log.read(), table_name)
        undated = F.col(ts).isNull()
        changes = source if since is None else source.filter((F.col(ts) >= F.lit(str(since)).cast("timestamp_ntz")) | undated)
        until = changes.agg(F.max(ts)).first()[0]
        read = undated if until is None else (F.col(ts) <= F.lit(str(until)).cast("timestamp_ntz")) | undated
        change = table.upsert(changes.filter(read), order_by)
        return change.inserted + change.updated, since if until is None else until

    return log.run(table_name, "incremental", upsert), refresh_all(summaries)


def plan_text(df: DataFrame) -> str:
    """The formatted physical plan."""
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("formatted")
    return shown.getvalue()


def run_benchmark(spark: SparkSession, suite: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Run each query to the ``noop`` sink: name, status, rows, seconds and plan; a failing one is skipped.

    ``suite`` maps a name to a function that builds its frame.
    """
    results = []
    for name, build in suite.items():
        started = time.perf_counter()
        try:
            seen = Observation()
            df = build()
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - started
            results.append((name, "ok", seen.get["rows"], seconds, plan_text(df)))
        except Exception:  # a failing query must not stop the suite
            results.append((name, "SKIPPED", None, time.perf_counter() - started, None))
    return spark.createDataFrame(
        results, "name string, status string, result_rows long, seconds double, plan string"
    )
