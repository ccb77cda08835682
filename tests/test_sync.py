"""Sync log, delta reads, summaries and the benchmark runner."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterline.operators import sync
from rosterline.plans.jobs import run_benchmark, run_delta, run_incremental
from rosterline.schemas import SYNC_LOG
from rosterline.sources.store import KeyedTable


def test_log_keeps_successes_and_failures(spark, path):
    log = sync.SyncLog(spark, path("log"))
    assert log.read().isEmpty()
    assert log.run("orders", "incremental", lambda: 7) == 7

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        log.run("orders", "batch", fail)
    rows = log.read().orderBy("sync_id").collect()
    assert [(r["sync_id"], r["status"], r["records_processed"], r["error_message"]) for r in rows] == [
        (1, "success", 7, None),
        (2, "failed", 0, "lost"),
    ]
    last = sync.last_sync(log.read(), "orders").first()["last_sync"]
    assert last == rows[0]["completed_at"]
    assert sync.last_sync(log.read(), "other").isEmpty()
    history = sync.sync_history(log.read(), 1).collect()
    assert len(history) == 1 and history[0]["status"] == "failed" and history[0]["duration_seconds"] >= 0


def test_delta(spark):
    at = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    log = spark.createDataFrame(
        [(1, "t", "batch", 1, at[0], at[1], "success", None, None), (2, "t", "batch", 1, at[1], at[2], "failed", "x", None)], SYNC_LOG
    )
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(at)], "i int, ts timestamp_ntz")
    assert [r["i"] for r in sync.delta(rows, "ts", log, "t").collect()] == [2]
    assert sync.delta(rows, "ts", log, "never synced").count() == 3
    assert [r["i"] for r in sync.changed_since(rows, "ts", at[0]).collect()] == [1, 2]
    assert sync.changed_since(rows, "ts", None).count() == 3


def test_refresh_shows_new_data_and_survives_one_failure(spark, path):
    source = {"n": 3}

    def broken():
        return spark.range(1).select(F.raise_error(F.lit("no")).cast("long").alias("id"))

    summaries = {
        "good": sync.SummaryTable(spark, path("good"), lambda: spark.range(source["n"]), ["id"]),
        "bad": sync.SummaryTable(spark, path("bad"), broken, ["id"]),
        "late": sync.SummaryTable(spark, path("late"), lambda: spark.range(2), ["id"]),
    }
    done = sync.refresh_all(summaries)
    assert {name: r.rows for name, r in done.items()} == {"good": 3, "bad": None, "late": 2}
    assert "no" in done["bad"].error and done["good"].error is None
    before = summaries["good"].read()
    source["n"] = 5
    summaries["good"].refresh()
    assert before.count() == 3 and summaries["good"].read().count() == 5


def test_incremental_run_logs_then_refreshes(spark, path):
    table = KeyedTable(spark, path("t"), ["k"], partitions=2)
    table.replace(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"))
    log = sync.SyncLog(spark, path("log"))
    total = sync.SummaryTable(spark, path("sum"), lambda: table.current().groupBy("v").count(), ["v"])
    changes = spark.createDataFrame([(2, "a"), (3, "a")], "k long, v string")
    assert run_incremental(log, "t", table, changes, "k", {"sum": total}) == (2, {"sum": sync.Refresh(1)})
    assert [tuple(r) for r in total.read().collect()] == [("a", 3)]
    assert log.read().first()["records_processed"] == 2


def test_a_run_meets_what_was_stamped_during_the_last_one(spark, path):
    table = KeyedTable(spark, path("t"), ["k"], partitions=2)
    table.replace(spark.createDataFrame([], "k long, ts timestamp_ntz, n long"))
    log = sync.SyncLog(spark, path("log"))
    at = [dt.datetime(2024, 1, 1, 0, 0, s) for s in range(4)]

    def run(rows):
        source = spark.createDataFrame([(k, at[s], 10 * s + k) for k, s in rows], "k long, ts timestamp_ntz, n long")
        return run_delta(log, "t", table, source, "ts", "n", {})[0]

    assert run([]) == 0
    assert run([(1, 0), (2, 1)]) == 2
    assert run([(1, 0), (2, 1), (3, 1), (4, 2)]) == 3  # 3 has the time of the last row that was read
    assert sorted(r["k"] for r in table.current().collect()) == [1, 2, 3, 4]
    assert sync.last_read(log.read(), "t") == at[2]


def test_rows_without_a_time_are_read_by_every_run(spark, path):
    table = KeyedTable(spark, path("t"), ["k"], partitions=2)
    table.replace(spark.createDataFrame([], "k long, ts timestamp_ntz, n long"))
    log = sync.SyncLog(spark, path("log"))
    at = [dt.datetime(2024, 1, 1, 0, 0, s) for s in range(3)]

    def run(rows):
        source = spark.createDataFrame([(k, None if s is None else at[s], n) for k, s, n in rows], "k long, ts timestamp_ntz, n long")
        return run_delta(log, "t", table, source, "ts", "n", {})[0]

    assert run([(1, None, 1)]) == 1 and sync.last_read(log.read(), "t") is None
    assert run([(1, None, 1), (2, 1, 2), (3, 0, 3)]) == 3 and sync.last_read(log.read(), "t") == at[1]
    assert run([(1, None, 4), (2, 1, 2), (3, 0, 5), (4, None, 6)]) == 3
    assert sorted((r["k"], r["n"]) for r in table.current().collect()) == [(1, 4), (2, 2), (3, 3), (4, 6)]


def test_the_bound_of_a_delta_reaches_the_scan(spark, path):
    log = spark.createDataFrame([(1, "t", "batch", 1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), "success", None, None)], SYNC_LOG)
    spark.createDataFrame([(1, dt.datetime(2024, 1, 3))], "i int, ts timestamp_ntz").write.parquet(path("events"))
    text = sync.delta(spark.read.parquet(path("events")), "ts", log, "t")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts," in text


def test_benchmark_marks_failures(spark):
    suite = {"ok": lambda: spark.range(4), "bad": lambda: spark.read.parquet("/nowhere/at/all")}
    results = run_benchmark(spark, suite).collect()
    rows = {r["name"]: (r["status"], r["result_rows"]) for r in results}
    assert "Range" in results[0]["plan"] and results[0]["seconds"] > 0
    assert rows == {"ok": ("ok", 4), "bad": ("SKIPPED", None)}
