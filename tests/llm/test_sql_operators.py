"""Operators that SQL can express, against DuckDB, and their edge cases."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F
from rosterline.llm import chat_preferences, line_dedup, mixing, registry

SMALL = "/root/testdata/sf0.001"


def same(spark_df, sql, tables):
    with duckdb.connect() as duck:
        for name, df in tables.items():
            duck.register(name, df)
        relation = duck.sql(sql)
        names, expected = relation.columns, relation.fetchall()
    order = sorted(names)
    assert sorted(spark_df.columns) == order
    got = sorted((tuple(r[c] for c in order) for r in spark_df.collect()), key=str)
    assert got == sorted((tuple(r[names.index(c)] for c in order) for r in expected), key=str)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")
@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_registered_query(spark, name):
    import pyarrow.parquet as pq

    tables = {t: pq.read_table(f"{SMALL}/{t}.parquet") for t in ("documents", "conversations")}
    same(registry.QUERIES[name](spark, SMALL), registry.ORACLE[name], tables)


DOCS = [
    (1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "b\nc\nd"), (4, "a\nb"), (5, None), (6, ""), (7, "a\nb\nc\nd"), (8, "r\nr\nr\nr\nr"),
    (9, "long\n" + "\n".join(f"line {k}" for k in range(3000))), (10, "line 7\nline 8\nline 9\nend"), (11, "\n\n\n\n"),
]


def test_the_first_window_stays_whole(docs):
    rows = [(1, "a\na\na\na"), (2, "x\ny\nx\ny\nx\nz"), (3, "0\nx\ny\nx\n1"), (4, "p\nq\nr\ns"), (5, "o\np\nq\nr\ns")]
    found = {r["doc_id"]: (r["text"].split("\n"), r["n_removed"]) for r in line_dedup.dedup_lines(docs(rows)).collect()}
    assert found == {1: (["a"] * 3, 1), 2: (list("xyxz"), 2), 3: (list("01"), 3), 4: (list("pqrs"), 0), 5: (["o"], 4)}


def test_line_windows(docs):
    table = docs(DOCS)
    same(line_dedup.dedup_lines(table).select("doc_id", "n_lines", "n_removed", "text"), line_dedup.ORACLE_SQL, {"documents": table.toArrow()})
    assert line_dedup.dedup_lines(docs([])).count() == 0
    clash = docs([*DOCS, (1, "a\nb\nc\nd"), (None, "a\nb\nc")]).selectExpr("*", "1 AS pos", "2 AS a", "3 AS n_lines", "4 AS first")
    found = {}
    for r in line_dedup.dedup_lines(clash).collect():
        found.setdefault(r["doc_id"], set()).add(r["text"])
    assert found[None] == {"a\nb\nc"} and found[1] == {"b\nc\nd"} and found[2] == {"x\ny"} and found[5] == {None}
    assert line_dedup.dedup_lines(clash).count() == len(DOCS) + 2


def test_rows_without_or_with_shared_ids_are_documents_of_their_own(docs):
    rows = [(None, "p\nq\nr\nmine"), (None, "p\nq\nr\nyours"), (None, "k\nl\nm\nn"), (None, "x\ny\nz"), (None, "x\ny\nz"), (3, "u\nv\nw"), (3, "p\nq\nr\ns")]
    found = sorted((r["doc_id"] or 0, r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(docs(rows).coalesce(1)).collect())
    assert found == [(0, "", 3), (0, "k\nl\nm\nn", 0), (0, "p\nq\nr\nmine", 0), (0, "x\ny\nz", 0), (0, "yours", 3), (3, "s", 3), (3, "u\nv\nw", 0)]


TURNS = [
    (1, True, 0, "user", "hi"), (1, True, 1, "assistant", "good"), (1, True, 2, "user", "ok"),
    (1, False, 0, "user", "hi"), (1, False, 1, "assistant", "bad"), (1, False, 2, "user", "ok"), (1, False, 2, "user", "ok"),
    (2, True, 0, "user", "same"), (2, False, 0, "user", "same"), (3, True, 0, None, None), (3, True, 1, "assistant", None),
    (None, True, 0, "user", "x"), (4, True, None, "user", "x"), (5, True, 0, "user", "a"), (5, False, 0, "user", "a"), (5, True, 1, "assistant", "more"),
]


def test_preferences(spark):
    schema = "pair_id long, chosen boolean, turn long, role string, text string"
    turns = spark.createDataFrame(TURNS, schema).withColumn("part", F.lit("x")).withColumn("place", F.lit(1))
    found = {r["pair_id"]: r for r in chat_preferences.preferences(turns).collect()}
    assert set(found) == {1, 2, 3, 5}
    one = found[1]
    assert one["prompt"] == "<|im_start|>user\nhi<|im_end|>\n" and one["n_prompt_turns"] == 1
    assert one["chosen"] == "<|im_start|>assistant\ngood<|im_end|>\n<|im_start|>user\nok<|im_end|>\n"
    start, end = map(int, one["rejected_spans"].split("-"))
    assert one["rejected"][start:end] == "bad<|im_end|>"
    assert (found[2]["chosen"], found[2]["rejected"], found[2]["n_prompt_turns"]) == ("", "", 1)
    assert found[3]["prompt"] == "" and found[3]["rejected"] == "" and found[3]["chosen"].startswith("<|im_start|>\n<|im_end|>")
    assert found[5]["rejected"] == "" and "more" in found[5]["chosen"]
    assert chat_preferences.preferences(turns.limit(0)).count() == 0


def mixed(docs, **options):
    return mixing.mixed(docs, **options).collect()


def test_mixing_shortage_goes_to_siblings_first(docs):
    levels = (mixing.Level("domain", "lang", "1"), mixing.Level("origin", "source", "1"))
    rows = [(k, "one two", "a", "big") for k in range(100)] + [(200 + k, "one two", "a", "small") for k in range(5)] + [(300 + k, "one two", "b", "only") for k in range(100)]
    chosen = mixed(docs(rows), levels=levels, share=100 / 205, epochs=1)
    count = {s: sum(r["source"] == s for r in chosen) for s in ("big", "small", "only")}
    assert count == {"big": 45, "small": 5, "only": 50}  # 25 a leaf of a; what small lacks goes to big, not to b


def test_mixing_edges(docs):
    rows = [(1, None, "en", "src0"), (2, "", "en", "src0"), (3, " \n", None, None), (4, "a b c", None, None), (None, "d e", "en", "src1"), (5, "w " * 50000, "en", "src2"), (6, "x y", "en", "src1"), (6, "x y", "en", "src1")]
    table = docs(rows).selectExpr("*", "7 AS quota", "8 AS tokens", "9 AS whole")
    everything = mixed(table, share=2.0, epochs=2)
    assert sorted((str(r["doc_id"]), r["epoch"]) for r in everything) == sorted([(d, e) for d in ("4", "5", "6", "6", "None") for e in (0, 1)])
    assert mixing.mix_documents(table).columns == table.columns
    assert mixed(docs([])) == []
    again = sorted((str(r["doc_id"]), r["epoch"]) for r in mixed(table, share=0.5))
    assert again == sorted((str(r["doc_id"]), r["epoch"]) for r in mixed(table.repartition(7), share=0.5))
    none = (mixing.Level("domain", "lang", "CASE WHEN domain = 'en' THEN 0 ELSE 1 END"),)
    assert {r["doc_id"] for r in mixed(table, levels=none, share=1.0, epochs=1)} == {4}


def test_mixing_sums_hold(docs):
    rows = [(k, "t " * (1 + k % 7), "en" if k % 3 else "de", f"src{k % 5}") for k in range(400)]
    total = sum(1 + k % 7 for k in range(400))
    chosen = mixed(docs(rows), share=0.5, epochs=1)
    taken = sum(len(r["text"].split()) for r in chosen)
    assert total * 0.5 - 10 * 7 <= taken <= total * 0.5 and len({r["doc_id"] for r in chosen}) == len(chosen)


def test_nothing_native_runs_python(spark, docs):
    for df in (mixing.mixed(docs([(1, "a b", "en", "src1")])), chat_preferences.preferences(chat_preferences.alternatives(spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")))):
        assert not any(word in df._jdf.queryExecution().executedPlan().toString() for word in ("Python", "Arrow", "Pandas"))
