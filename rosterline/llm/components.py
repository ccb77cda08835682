"""Connected components of a link table, by alternating large and small stars.

Links stay in Spark throughout. Each round is written to the shared folder, so lineage stays short, and the
number of rounds follows the logarithm of the largest component, not its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rosterline.llm.common import discard, staged
from rosterline.session import observed


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    hung = down.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.union(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to (node, component): every linked node with the smallest node it reaches.

    Rows with NULL, repeated links, both directions and loops are allowed; nodes without another are not returned.
    """
    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        """The links, and their number and hash, which the write itself observes."""
        seen = Observation()
        mark = F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash")
        table = staged(df.observe(seen, *mark), "links")
        return table, observed(seen, "rows", "hash")

    current, mark = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while mark[0] and mark != before:
        before = mark
        following, mark = written(_small_star(_large_star(current)))
        discard(current)
        current = following
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(current.select("b", "b").distinct())
