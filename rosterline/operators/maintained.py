"""Summaries kept up to date from changes, without reading the facts again.

The state holds, for every key and every value that the summary takes a least, a greatest or a distinct count of, how many
facts there are and the sums of their measures. A change brings facts with a sign: the row as it is now with 1, the row as it
was with -1. Signed sums are added to the state, so a fact that goes takes its value with it, and least and greatest
follow from the values whose count is not zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.sources.store import KeyedTable, joined_by

SIGN, ROWS, BATCH = "sign", "rows", "last_batch"


def change_images(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed facts of a change: rows as they were, and as they are. An insert has only the second, a delete the first."""
    return before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)))


class MaintainedTotals:
    """Counts and sums by ``keys``, in a keyed table. ``sums`` maps a measure to its type; a NULL measure is not counted."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, str], sums: dict[str, str], partitions: int = 16):
        self.keys = list(keys)
        self.sums = dict(sums)
        measures = [f"{m} {kind}, {m}_known bigint" for m, kind in sums.items()]
        schema = ", ".join([*(f"`{k}` {kind}" for k, kind in keys.items()), f"{ROWS} bigint", *measures, f"{BATCH} bigint"])
        self.table = KeyedTable(spark, path, self.keys, partitions, schema=schema)
        if not self.table.exists():
            self.table.replace(spark.createDataFrame([], schema))

    def _folded(self, images: DataFrame) -> DataFrame:
        """One row per key of the change: facts are folded before they are shuffled."""
        sign = F.col(SIGN).cast("long")
        parts = [F.sum(sign).alias(ROWS)]
        for name, kind in self.sums.items():
            parts.append(F.coalesce(F.sum(F.col(name) * F.col(SIGN)), F.lit(0)).cast(kind).alias(name))
            parts.append(F.sum(F.when(F.col(name).isNotNull(), sign).otherwise(F.lit(0))).alias(f"{name}_known"))
        return images.groupBy(*self.keys).agg(*parts)

    def apply(self, images: DataFrame, batch: int) -> None:
        """Add the signed facts of a batch. Batches have ascending numbers; one that is repeated changes nothing."""
        change = self._folded(images)
        near = self.table.current_near(change)
        # A state row that has this batch already is left alone: the write of a batch is one commit.
        done = near.where(F.col(BATCH) >= batch).select(*self.keys)
        open_ = joined_by(change, done, self.keys, "left_anti")
        measures = [ROWS, *(n for m in self.sums for n in (m, f"{m}_known"))]
        kinds = {ROWS: "bigint"} | {n: kind for m, kind in self.sums.items() for n, kind in ((m, kind), (f"{m}_known", "bigint"))}
        known = joined_by(near, open_, self.keys, "left_semi").select(*self.keys, *measures)
        added = open_.select(*self.keys, *measures).unionByName(known).groupBy(*self.keys)
        merged = added.agg(*[F.sum(n).cast(kinds[n]).alias(n) for n in measures])
        self.table.upsert(merged.withColumn(BATCH, F.lit(batch).cast("bigint")), BATCH)

    def read(self) -> DataFrame:
        """Keys that have facts, with their counts and sums."""
        return self.table.current().where(F.col(ROWS) > 0).drop(BATCH)


def orders_per_customer(totals: DataFrame) -> DataFrame:
    """The measures of ``sales.customer_lifetime_value`` from totals by (CustomerId, InvoiceDate) of ``Total``."""

    def money(c: Column) -> Column:
        return c.cast("decimal(28,2)")

    spent = F.sum(F.when(F.col("Total_known") > 0, F.col("Total")))
    return totals.groupBy("CustomerId").agg(
        F.sum(ROWS).alias("orders"),
        money(spent).alias("spent"),
        F.sum("Total_known").alias("priced"),
        F.min("InvoiceDate").alias("first_purchase"),
        F.max("InvoiceDate").alias("last_purchase"),
    )
