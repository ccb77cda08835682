"""Removal of repeated runs of lines.

Every three consecutive lines of a text form a window. Of the windows with equal lines, in all documents, the first
by (doc_id, row key, position) stays whole; the lines that later ones cover are removed, but for those that a first one
covers as well (``a a a a`` becomes ``a a a``, ``x y x y x z`` becomes ``x y x z``, line by line). Windows meet by a 128-bit
hash: their first places are folded before the shuffle, so a passage that a third of the documents share costs no more
than another, and only windows that repeat come back to the documents.

Rows: a NULL text stays NULL; texts of fewer than three lines have no window and stay as they are, empty ones too;
lines are compared as they are, blanks included; a text without any line left is empty; rows without doc_id come
first in the order, each a document of its own by a row key that is written before any hashing; rows that share a doc_id
are told apart by the hash of their text, and only repeated rows, equal in both, are one document and keep the same
lines; other columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import prepare, staged

WINDOW = 3


def _lines() -> Column:
    return F.split(F.col("text"), "\n", -1)


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with ``__key``, which tells rows of one doc_id apart; rows without doc_id are written with theirs."""
    without = staged(docs.where("doc_id IS NULL").withColumn("__key", F.monotonically_increasing_id()), "line-rows")
    return docs.where("doc_id IS NOT NULL").withColumn("__key", F.xxhash64("text")).union(without)


def windows(keyed: DataFrame) -> DataFrame:
    """(doc_id, __key, pos, a, b): the 128-bit hash of the window at each line position."""
    def hashes(i: Column) -> Column:
        run = F.slice(F.col("l"), i + 1, WINDOW)
        return F.struct(i.alias("pos"), F.xxhash64(run).alias("a"), F.xxhash64(F.lit(1), run).alias("b"))

    lines = keyed.where("text IS NOT NULL").select("doc_id", "__key", _lines().alias("l")).where(F.size("l") >= WINDOW)
    every = lines.select("doc_id", "__key", F.explode(F.transform(F.sequence(F.lit(0), F.size("l") - WINDOW), hashes)).alias("w"))
    return every.select("doc_id", "__key", "w.pos", "w.a", "w.b")


def repeated_windows(keyed: DataFrame) -> DataFrame:
    """(doc_id, __key, pos, later) of every window that repeats: ``later`` is false for the first of equal ones."""
    placed = staged(windows(keyed), "line-windows").select("a", "b", F.struct("doc_id", "__key", "pos").alias("place"))
    first = placed.groupBy("a", "b").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
    return placed.join(first.drop("last"), ["a", "b"]).select("place.*", (F.col("place") > F.col("first")).alias("later")).distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents with their texts less repeated runs, and ``n_lines`` (before) and ``n_removed``."""
    prepare(docs.sparkSession)
    keyed = _keyed(docs.drop("n_lines", "n_removed"))
    starts = F.collect_set(F.when(F.col("later"), F.col("pos"))), F.collect_set(F.when(~F.col("later"), F.col("pos")))
    covered = repeated_windows(keyed).groupBy("doc_id", "__key").agg(starts[0].alias("__starts"), starts[1].alias("__first")).where(F.size("__starts") > 0)
    covered = staged(covered.withColumnsRenamed({"doc_id": "__of", "__key": "__of_key"}), "line-repeats")
    same = F.col("doc_id").eqNullSafe(F.col("__of")) & (F.col("__key") == F.col("__of_key"))
    # One plan for every size: the removed lines grow with the texts, so they are too many to broadcast in the end.
    joined = keyed.join(covered.hint("merge"), same, "left").drop("__of", "__of_key", "__key")
    def lines_of(starts: str) -> Column:
        return F.flatten(F.transform(starts, lambda p: F.array(*[p + k for k in range(WINDOW)])))

    gone = F.array_except(lines_of("__starts"), lines_of("__first"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines()))
    kept = F.array_except(F.sequence(F.lit(0), F.size(_lines()) - 1), gone)
    text = F.array_join(F.transform("__kept", lambda i: F.get(F.col("__lines"), i)), "\n")
    hit = F.col("__starts").isNotNull() & F.col("text").isNotNull()
    found = joined.withColumn("__lines", F.when(hit, _lines())).withColumn("__kept", F.when(hit, kept))
    found = found.withColumn("n_lines", count.cast("long")).withColumn("n_removed", F.when(hit, F.size("__lines") - F.size("__kept")).otherwise(0).cast("long"))
    return found.withColumn("text", F.when(hit, text).otherwise(F.col("text"))).drop("__starts", "__first", "__lines", "__kept")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_lines", "n_removed", "text")


ORACLE_SQL = """WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (SELECT doc_id, unnest(range(0, len(l) - 2)) AS pos, l FROM split WHERE len(l) >= 3),
ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY l[pos + 1], l[pos + 2], l[pos + 3] ORDER BY doc_id, pos) AS place,
  count(*) OVER (PARTITION BY l[pos + 1], l[pos + 2], l[pos + 3]) AS equal FROM windows),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM ranked, (SELECT unnest(range(0, 3)) AS k) WHERE place > 1
  EXCEPT SELECT doc_id, pos + k FROM ranked, (SELECT unnest(range(0, 3)) AS k) WHERE place = 1 AND equal > 1),
every AS (SELECT doc_id, unnest(range(0, len(l))) AS pos, unnest(l) AS line FROM split),
kept AS (SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS text FROM every ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(l) - coalesce(n, 0), 0) AS BIGINT) AS n_removed,
  CASE WHEN split.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM split LEFT JOIN kept USING (doc_id)"""
