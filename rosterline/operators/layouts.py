"""Stored layouts that a lookup reads a small part of: sorted copies with Bloom filters, numbered pages, a search index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.operators.sales import search_tracks

ROW_GROUP_BYTES = 16 << 20


def store_sorted(df: DataFrame, path: str, column: str, row_group_bytes: int = ROW_GROUP_BYTES) -> DataFrame:
    """A copy in the order of a column, with a Bloom filter on it.

    A filter on the column then reaches the scan, which passes over files and row groups by their least and greatest
    value and, for an equality, by their Bloom filter. Row groups are small, as a lookup reads at least one.
    """
    writer = df.repartitionByRange(column).sortWithinPartitions(column).write
    writer = writer.option("parquet.block.size", row_group_bytes).option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- pages by position -------------------------------------------------------------------------

PART, PLACE = "page_part", "page_place"


@dataclass
class Pages:
    """Rows in the order of a key, cut into range partitions whose sizes are known: page n opens the partitions it lies in."""

    rows: DataFrame
    key: str
    sizes: list[tuple[int, int]]  # partition and rows, in the order of the key

    def page(self, size: int = 20, offset: int = 0) -> DataFrame:
        """The rows from ``offset`` on, in order. Depth does not matter: only partitions that hold some of them are read."""
        wanted, before = F.lit(False), 0
        for part, rows in self.sizes:
            first, last = max(offset - before, 0), min(offset + size - before, rows)
            if first < last:
                wanted |= (F.col(PART) == part) & (F.col(PLACE) >= first) & (F.col(PLACE) < last)
            before += rows
        return self.rows.where(wanted).orderBy(PART, PLACE).drop(PART, PLACE)


def store_pages(df: DataFrame, path: str, key: str, parts: int | None = None) -> Pages:
    """Write the rows in the order of ``key`` with their place in their partition; ``key`` should be unique.

    ``parts`` defaults to the number of shuffle partitions; a page reads one of them, or two.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mark = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(parts, key).sortWithinPartitions(key).withColumn("page_mark", mark)
    placed = ordered.withColumn(PART, F.shiftright("page_mark", 33).cast("int")).withColumn(PLACE, F.col("page_mark").bitwiseAND((1 << 33) - 1))
    placed.drop("page_mark").write.partitionBy(PART).parquet(path)
    return open_pages(df.sparkSession, path, key, df.schema)


def open_pages(spark: SparkSession, path: str, key: str, row_schema: T.StructType) -> Pages:
    """The sizes, one row per partition, are counted without reading a column."""
    added = [T.StructField(PLACE, T.LongType()), T.StructField(PART, T.IntegerType())]
    rows = spark.read.schema(T.StructType([*row_schema.fields, *added])).parquet(path)
    sizes = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("rows")).orderBy(PART).collect()
    return Pages(rows, key, [(r[PART], r["rows"]) for r in sizes])


# -- search index ------------------------------------------------------------------------------

GRAM = 3
BUCKET = "gram_bucket"


def _grams(text: Column) -> Column:
    """The distinct runs of ``GRAM`` characters of a text, in lower case."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.length(low) - (GRAM - 1))
    found = F.transform(starts, lambda i: F.substring(low, i, F.lit(GRAM)))
    return F.array_distinct(F.when(F.length(low) >= GRAM, found).otherwise(F.array().cast("array<string>")))


@dataclass
class SearchIndex:
    """Postings (gram, TrackId, Name), partitioned by a hash of the gram and sorted by it."""

    postings: DataFrame
    buckets: int

    def search(self, query: str) -> DataFrame | None:
        """As ``search_tracks``, reading only the postings of the query's grams; None if no word has ``GRAM`` letters.

        A name has every word only if it has all grams of all words: those lists are intersected by counting, and what is
        left is compared with the whole words.
        """
        words = query.lower().split()
        grams = sorted({w[i : i + GRAM] for w in words for i in range(len(w) - GRAM + 1)})
        if not grams:
            return None
        spark = self.postings.sparkSession
        hashed = spark.createDataFrame([(g,) for g in grams], "gram string").select(_bucket(self.buckets).alias("b")).distinct()
        buckets = sorted(r["b"] for r in hashed.collect())  # no more than the query has grams
        lists = self.postings.where(F.col(BUCKET).isin(buckets) & F.col("gram").isin(grams))
        both = lists.groupBy("TrackId", "Name").agg(F.count(F.lit(1)).alias("found")).where(F.col("found") == len(grams))
        return search_tracks(both, query)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("gram"), F.lit(buckets)).cast("int")


def index_tracks(track: DataFrame, path: str, buckets: int = 16) -> SearchIndex:
    """Write the index; names that repeat for a track count once. Choose ``buckets`` so that one is a few gigabytes."""
    rows = track.select("TrackId", "Name").where("Name IS NOT NULL").distinct()
    postings = rows.select(F.explode(_grams(F.col("Name"))).alias("gram"), "TrackId", "Name").withColumn(BUCKET, _bucket(buckets))
    postings.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "gram", "TrackId").write.partitionBy(BUCKET).parquet(path)
    schema = f"gram string, TrackId {track.schema['TrackId'].dataType.simpleString()}, Name string, {BUCKET} int"
    return SearchIndex(track.sparkSession.read.schema(schema).parquet(path), buckets)
