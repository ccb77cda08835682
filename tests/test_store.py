"""Keyed tables: order, uniqueness, ids, visibility and repetition."""

import os

import pytest
from pyspark.sql import functions as F

from rosterline.sources import sinks, store
from rosterline.sources.store import KeyedTable, first_per_key, latest_per_key

SCHEMA = "k long, v string, seq long"


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "v").collect())


@pytest.fixture
def table(spark, path):
    t = KeyedTable(spark, path("t"), ["k"], partitions=4)
    t.replace(spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], SCHEMA))
    return t


def test_upsert_last_row_wins(spark, table):
    change = table.upsert(spark.createDataFrame([(2, "x", 5), (2, "y", 9), (2, "z", 7), (4, "d", 1)], SCHEMA), "seq")
    assert (change.inserted, change.updated) == (1, 1)
    assert rows(table.current()) == [(1, "a"), (2, "y"), (3, "c"), (4, "d")]


def test_upsert_twice_is_upsert_once(spark, table):
    batch = spark.createDataFrame([(2, "y", 9), (4, "d", 1)], SCHEMA)
    table.upsert(batch, "seq")
    once = rows(table.current())
    again = table.upsert(batch, "seq")
    assert rows(table.current()) == once and (again.inserted, again.updated) == (0, 2)


def test_insert_ignore_first_row_wins(spark, table):
    change = table.insert_ignore(spark.createDataFrame([(2, "x", 1), (5, "f", 2), (5, "e", 1)], SCHEMA), "seq")
    assert change.inserted == 1
    assert rows(table.current()) == [(1, "a"), (2, "b"), (3, "c"), (5, "e")]
    assert table.upsert(spark.createDataFrame([(5, "g", 1)], SCHEMA), "seq").updated == 1
    assert rows(table.current()) == [(1, "a"), (2, "b"), (3, "c"), (5, "g")]


def test_delete_keeps_rows_where_the_condition_is_unknown(spark, path):
    t = KeyedTable(spark, path("d"), ["k"], partitions=4)
    t.replace(spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k long, v string"))
    assert t.delete_where(F.col("v") == "a").deleted == 1
    assert sorted(r["k"] for r in t.current().collect()) == [2, 3]
    assert t.delete_where(F.col("v") == "nothing").deleted == 0
    t.delete_where(F.lit(True))
    assert t.current().isEmpty()
    t.insert_ignore(spark.createDataFrame([(9, "z")], "k long, v string"), "k")
    assert rows(t.current()) == [(9, "z")]


def files(table):
    """Path and time of the table's data files."""
    found = {}
    for folder, _, names in os.walk(table.path):
        found |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def test_reader_keeps_its_version(spark, table):
    old = table.current()
    table.replace(spark.createDataFrame([(1, "new", 1)], SCHEMA))
    assert rows(old) == [(1, "a"), (2, "b"), (3, "c")] and rows(table.current()) == [(1, "new")]
    assert table.delete_where(F.col("v") == "new").deleted == 1 and table.current().isEmpty()


def test_failed_change_leaves_the_table_alone(spark, table):
    before, version = files(table), table.version()
    broken = spark.createDataFrame([(1, "q", 1)], SCHEMA).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    for change in (lambda: table.upsert(broken, "seq"), lambda: table.insert_ignore(broken, "seq"), lambda: table.replace(broken)):
        with pytest.raises(Exception, match="boom"):
            change()
        assert rows(table.current()) == [(1, "a"), (2, "b"), (3, "c")] and table.version() == version
    assert before.items() <= files(table).items()
    table.replace(spark.createDataFrame([(9, "z", 1)], SCHEMA))
    assert rows(table.current()) == [(9, "z")]


def test_only_touched_partitions_are_rewritten(spark, path):
    t = KeyedTable(spark, path("b"), ["k"])
    t.replace(spark.range(1000).select(F.col("id").alias("k"), F.lit("v").alias("v"), F.lit(0).alias("seq")))
    before = files(t)
    t.upsert(spark.createDataFrame([(7, "new", 1)], "k long, v string, seq int"), "seq")
    after = files(t)
    gone, added = before.keys() - after.keys(), after.keys() - before.keys()
    assert {os.path.dirname(f) for f in gone} == {os.path.dirname(f) for f in added} and len({os.path.dirname(f) for f in gone}) == 1
    assert t.current().count() == 1000 and t.current_near(spark.createDataFrame([(7,)], "k long")).count() < 200
    t.insert_ignore(spark.createDataFrame([(5000, "new", 1)], "k long, v string, seq int"), "seq")
    assert after.items() <= files(t).items() and t.current().count() == 1001


def test_replayed_load_gives_the_same_rows(spark, path):
    t = sinks.empty_table(spark, path("p"), ["k"], "id long, k string, v string", id_column="id")
    batch = spark.createDataFrame([("b", "1", 1), ("a", "1", 2), ("c", "2", 3)], "k string, v string, seq long")
    t.upsert(batch, "seq")
    once = sorted(tuple(r) for r in t.current().collect())
    for again in (t.upsert, t.insert_ignore):
        assert again(batch, "seq").inserted == 0
        assert sorted(tuple(r) for r in t.current().collect()) == once


def test_ids_follow_input_order_and_stay(spark, path):
    t = sinks.empty_table(spark, path("s"), ["k"], "id long, k string, v string", id_column="id")
    t.insert_ignore(spark.createDataFrame([("b", "1", 1), ("a", "1", 2), ("b", "2", 3)], "k string, v string, seq long"), "seq")
    assert sorted(tuple(r) for r in t.current().collect()) == [(1, "b", "1"), (2, "a", "1")]
    t.upsert(spark.createDataFrame([("c", "9", 1), ("a", "9", 2)], "k string, v string, seq long"), "seq")
    assert sorted(tuple(r) for r in t.current().collect()) == [(1, "b", "1"), (2, "a", "9"), (3, "c", "9")]


def test_empty_change_changes_nothing(spark, table):
    before = files(table)
    assert table.insert_ignore(spark.createDataFrame([], SCHEMA), "seq") == table.upsert(spark.createDataFrame([], SCHEMA), "seq") == store.Change()
    assert files(table) == before


def test_missing_table_is_an_error(spark, path):
    with pytest.raises(ValueError):
        KeyedTable(spark, path("nowhere"), ["k"]).current()


def test_one_per_key_with_a_hot_key(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS seq", "CAST(id AS STRING) AS v")
    assert latest_per_key(df, ["k"], "seq").filter("k = -1").first()["v"] == "2997"
    assert first_per_key(df, ["k"], "seq").filter("k = -1").first()["v"] == "0"
    assert latest_per_key(df, ["k"], "seq").count() == 2001


def test_tied_and_missing_order_values_keep_every_key_once(spark, path):
    t = sinks.empty_table(spark, path("o"), ["k"], "id long, k string, v string", id_column="id")
    change = t.upsert(spark.createDataFrame([("a", "1", 7), ("b", "2", 7), ("c", "3", None), ("d", "4", 8)], "k string, v string, seq long"), "seq")
    assert (change.inserted, change.updated) == (4, 0)
    found = {r["k"]: (r["id"], r["v"]) for r in t.current().collect()}
    assert {k: v for k, (_, v) in found.items()} == {"a": "1", "b": "2", "c": "3", "d": "4"}
    assert sorted(i for i, _ in found.values()) == [1, 2, 3, 4] and found["c"][0] == 1 and found["d"][0] == 4
    again = t.upsert(spark.createDataFrame([("a", "x", None), ("a", "x", None), ("e", "5", None)], "k string, v string, seq long"), "seq")
    assert (again.inserted, again.updated) == (1, 1)
    assert {r["k"]: r["id"] for r in t.current().collect()} == {k: i for k, (i, _) in found.items()} | {"e": 5}


def test_missing_keys_equal_themselves(spark, path):
    t = KeyedTable(spark, path("n"), ["k", "m"], partitions=4)
    t.replace(spark.createDataFrame([], "k string, m string, v string"))
    for value in ("1", "2", "3"):
        t.upsert(spark.createDataFrame([("d", None, value, 1)], "k string, m string, v string, seq long"), "seq")
    assert [tuple(r) for r in t.current().collect()] == [("d", None, "3")]
    assert t.insert_ignore(spark.createDataFrame([("d", None, "9", 1), (None, None, "0", 1)], "k string, m string, v string, seq long"), "seq").inserted == 1


def test_a_table_opened_with_other_partitions_or_keys_is_an_error(spark, path):
    rows_ = spark.createDataFrame([(i, "a", 0) for i in range(6)], SCHEMA)
    KeyedTable(spark, path("r"), ["k"]).replace(rows_)
    for wrong in (KeyedTable(spark, path("r"), ["k"], partitions=7), KeyedTable(spark, path("r"), ["v"])):
        with pytest.raises(Exception, match="another number of partitions"):
            wrong.upsert(spark.range(50).selectExpr("id AS k", "CAST(id AS STRING) AS v", "id AS seq"), "seq")
    again = KeyedTable(spark, path("r"), ["k"])
    assert again.upsert(rows_, "seq").updated == 6 and again.current().count() == 6


def test_latest_of_equal_order_values_is_one_row(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (1, "b", 5), (2, "c", None), (2, "d", 1)], SCHEMA)
    chosen = rows(latest_per_key(df, ["k"], "seq"))
    assert len(chosen) == 2 and chosen[1] == (2, "d") and chosen == rows(latest_per_key(df.orderBy(F.desc("v")), ["k"], "seq"))
    assert rows(first_per_key(df, ["k"], "seq"))[1] == (2, "c")


def test_row_counts_show_missing_tables(spark):
    counts = sinks.row_counts(spark, {"b": spark.range(3), "a": lambda: spark.read.parquet("/nowhere/x.parquet")})
    assert [tuple(r) for r in counts.collect()] == [("a", None, "N/A"), ("b", 3, "3")]


def test_grade_updates_reach_stored_rows(spark, path):
    t = sinks.enrollment_table(spark, path("e"))
    t.upsert(
        spark.sql("SELECT 1L seq, 1L student_id, 'C' course_id, 'B' grade, DATE'2024-01-01' enrollment_date "
                  "UNION ALL SELECT 2, 2, 'C', 'A', DATE'2024-01-01'"), "seq")
    updates = spark.createDataFrame(
        [(1, 1, "C", "A"), (2, 1, "C", "B+"), (3, 2, "C", None), (4, 9, "C", "A")], "seq long, student_id long, course_id string, grade string")
    change = sinks.store_grades(t, updates)
    assert (change.inserted, change.updated) == (0, 2)
    assert sorted((r["student_id"], r["grade"]) for r in t.current().collect()) == [(1, "A"), (2, None)]
