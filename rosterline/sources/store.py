"""Keyed Parquet tables by Spark's own writer: replace, upsert, insert-ignore and delete.

A table is a folder of version folders, each partitioned by a hash of the key. Replacing and deleting write a new version
folder; readers of the old one are not disturbed, and the newest folder with Spark's success mark counts. An upsert overwrites
the partitions that its keys fall into (dynamic partition overwrite), from rows that were read from them in the same job and
put into place when the job commits; an insert appends files. Both can be repeated: known keys keep their id, so the same load gives
the same rows. A frame opened before a change of the same version has to be opened again. One writer per table is assumed.

Keys may be NULL and equal themselves. The number of partitions belongs to the table: rows found in a partition other than
that of their key are an error. Choose it so that a partition is a few gigabytes; a large one is written as several files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.session import fresh_path, newest_version, observed

PARTITION = "key_partition"
PARTITIONS = 16


def latest_per_key(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """Last row per key: the greatest ``order_by``, of equal ones the row with the greatest hash; NULL is lowest.

    The rank is one decimal, so keys fold in a hash aggregate before the shuffle and a hot key never gathers in
    one task; the winners' rows are joined by it, equal rows are one. ``order_by`` is a whole number, a date or a timestamp.
    """
    return _one_per_key(df, keys, F.max, order_by)


def first_per_key(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """First row per key, by the same order."""
    return _one_per_key(df, keys, F.min, order_by)


def _rank(df: DataFrame, order_by: str) -> Column:
    """Order value and row hash in one decimal(38,0); a NULL order value is below all others."""
    kind = df.schema[order_by].dataType
    value = F.col(order_by)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        value = F.unix_micros(value.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif not isinstance(kind, T.IntegralType):
        raise TypeError(f"cannot order rows by {order_by}: {kind.simpleString()}")
    whole = F.coalesce(value.cast("decimal(20,0)"), F.expr("CAST(-9223372036854775809 AS DECIMAL(20,0))"))
    # Hashing passes over NULLs, so where they are is hashed as well.
    tie = F.shiftrightunsigned(F.xxhash64(*df.columns, *[F.col(c).isNull() for c in df.columns]), 4)
    return (whole.cast("decimal(38,0)") * F.lit(1 << 60).cast("decimal(19,0)") + tie).cast("decimal(38,0)")


def _one_per_key(df: DataFrame, keys: list[str], pick, order_by: str) -> DataFrame:
    ranked = df.withColumn("row_rank", _rank(df, order_by))
    best = ranked.groupBy(*keys).agg(pick("row_rank").alias("row_rank"))
    return joined_by(ranked, best, [*keys, "row_rank"], "left_semi").drop("row_rank").distinct()


def joined_by(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join in which NULL keys equal each other."""
    other = right.withColumnsRenamed({k: f"{k}__right" for k in keys})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"{k}__right")) for k in keys])
    return left.join(other, same, how)


@dataclass
class Change:
    inserted: int = 0
    updated: int = 0
    deleted: int = 0


class KeyedTable:
    """``keys`` make rows unique; ``id_column`` is numbered by the table. ``schema`` is needed to open a table without rows."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        partitions: int = PARTITIONS,
        id_column: str | None = None,
        schema: str | T.StructType | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.partitions = partitions
        self.id_column = id_column
        self._schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version:06d}"

    def version(self) -> int:
        """The number of the newest whole version, 0 if there is none."""
        return newest_version(self.path)

    def exists(self) -> bool:
        return self.version() > 0

    # -- reading -------------------------------------------------------------------------------

    def _open(self) -> str:
        version = self.version()
        if not version:
            raise ValueError(f"no table at {self.path}")
        if self._schema is None:
            found = self.spark.read.parquet(self._folder(version)).schema
            self._schema = T.StructType([f for f in found.fields if f.name != PARTITION])
        return self._folder(version)

    def _rows(self) -> DataFrame:
        folder = self._open()
        full = T.StructType([*self._schema.fields, T.StructField(PARTITION, T.IntegerType())])
        return self.spark.read.schema(full).parquet(folder)

    def current(self) -> DataFrame:
        return self._rows().select(*[F.col(f.name) for f in self._schema.fields])

    def _partition(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.partitions)).cast("int")

    def _near(self, touched: list[int]) -> DataFrame:
        """The rows of some partitions, each checked to be in its own one."""
        rows = self._rows().where(F.col(PARTITION).isin(touched))
        own = F.col(PARTITION) == self._partition()
        wrong = F.lit(f"{self.path} was made with another number of partitions than {self.partitions} or other keys")
        return rows.where(F.when(own, True).otherwise(F.raise_error(wrong).cast("boolean")))

    def _touched(self, df: DataFrame) -> list[int]:
        found = df.select(self._partition().alias("p")).distinct().collect()  # no more than all partitions
        return sorted(r["p"] for r in found)

    def current_near(self, df: DataFrame) -> DataFrame:
        """The rows in the partitions that the keys of ``df`` fall into: all a lookup of those keys needs."""
        return self._near(self._touched(df.select(*self.keys))).drop(PARTITION)

    # -- writing -------------------------------------------------------------------------------

    def _write(self, df: DataFrame, folder: str, mode: str, sort: list[str], partitions: str = "dynamic") -> None:
        """Adaptive execution splits a large partition over several files and merges small ones."""
        laid_out = df.withColumn(PARTITION, self._partition()).hint("rebalance", PARTITION) if self.keys else df.withColumn(PARTITION, F.lit(0)).hint("rebalance")
        laid_out = laid_out.sortWithinPartitions(PARTITION, *sort) if sort else laid_out
        laid_out.write.mode(mode).option("partitionOverwriteMode", partitions).partitionBy(PARTITION).parquet(folder)

    def replace(self, df: DataFrame, sort: list[str] | None = None) -> Change:
        """A new version that holds these rows and no others; ``sort`` orders the rows of a file."""
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        # Whatever a failed write has left in the new folder goes.
        self._write(counted, self._folder(self.version() + 1), "overwrite", sort or self.keys, "static")
        self._schema = df.schema
        return Change(inserted=observed(seen, "rows")[0])

    def _staged(self, df: DataFrame) -> DataFrame:
        path = fresh_path(self.spark, "change")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _change(self, df: DataFrame, order_by: str) -> DataFrame:
        """The incoming rows with the columns of the table, written once, so that every later step reads the same."""
        self._open()
        columns = [f.name for f in self._schema.fields if f.name != self.id_column]
        return self._staged(df.select(*columns, *([] if order_by in columns else [order_by])))

    def _numbered(self, fresh: DataFrame, order_by: str) -> DataFrame:
        """New rows with unused ids that follow ``order_by``. Equal or NULL order values do not matter for them."""
        if not self.id_column:
            return fresh
        first = self._rows().agg(F.coalesce(F.max(self.id_column), F.lit(0)).cast("long")).first()[0] + 1
        marked = fresh.orderBy(F.col(order_by).asc_nulls_first(), *self.keys).withColumn("row_mark", F.monotonically_increasing_id())
        marked = self._staged(marked)
        part, place = F.shiftright("row_mark", 33), F.col("row_mark").bitwiseAND((1 << 33) - 1)
        sizes = marked.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).orderBy("part").collect()  # one per partition
        bases = []
        for row in sizes:
            bases.append((row["part"], first))
            first += row["rows"]
        base = F.broadcast(self.spark.createDataFrame(bases, "row_part long, row_base long"))
        kind = self._schema[self.id_column].dataType
        numbered = marked.withColumn("row_part", part).join(base, "row_part").withColumn(self.id_column, (F.col("row_base") + place).cast(kind))
        return numbered.drop("row_part", "row_base", "row_mark")

    def upsert(self, df: DataFrame, order_by: str) -> Change:
        """Insert new keys and replace all columns of known ones, except the id; the last row per key wins.

        ``order_by`` gives the order of the input rows; it is dropped when the table has no such column. One outer join
        of the touched partitions with the change says what is kept, replaced and new.
        """
        change = self._change(latest_per_key(df, self.keys, order_by), order_by)
        touched = self._touched(change)
        if not touched:
            return Change()
        before = self._near(touched)
        names = [f.name for f in self._schema.fields]
        if self.id_column:
            fresh = self._numbered(joined_by(change, before.select(*self.keys), self.keys, "left_anti"), order_by)
            known = joined_by(change, fresh.select(*self.keys), self.keys, "left_anti")
            change = known.withColumn(self.id_column, F.lit(None).cast(self._schema[self.id_column].dataType)).unionByName(fresh.select(*known.columns, self.id_column))
        old = before.select(*[F.col(k).alias(f"{k}__old") for k in self.keys], F.struct(*names).alias("old"))
        new = change.select(*[F.col(k).alias(f"{k}__new") for k in self.keys], F.struct(*names).alias("new"))
        same = reduce(lambda x, y: x & y, [F.col(f"{k}__old").eqNullSafe(F.col(f"{k}__new")) for k in self.keys])
        joined = old.join(new, same, "full_outer")

        def value(name: str) -> Column:
            if name == self.id_column:
                return F.coalesce(F.col(f"old.{name}"), F.col(f"new.{name}")).alias(name)
            return F.when(F.col("new").isNotNull(), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

        seen = Observation()
        inserted, updated = F.col("old").isNull(), F.col("old").isNotNull() & F.col("new").isNotNull()
        counted = joined.observe(seen, F.count_if(inserted).alias("inserted"), F.count_if(updated).alias("updated"))
        self._write(counted.select(*[value(n) for n in names]), self._open(), "overwrite", self.keys)
        return Change(*observed(seen, "inserted", "updated"))

    def insert_ignore(self, df: DataFrame, order_by: str) -> Change:
        """Add rows with new keys, the first row per key; files already there are left alone."""
        change = self._change(first_per_key(df, self.keys, order_by), order_by)
        touched = self._touched(change)
        if not touched:
            return Change()
        fresh = self._numbered(joined_by(change, self._near(touched).select(*self.keys), self.keys, "left_anti"), order_by)
        seen = Observation()
        counted = fresh.select(*[f.name for f in self._schema.fields]).observe(seen, F.count(F.lit(1)).alias("rows"))
        self._write(counted, self._open(), "append", self.keys)
        return Change(inserted=observed(seen, "rows")[0])

    def delete_where(self, condition: Column) -> Change:
        """A new version without the rows for which the condition holds; rows where it is NULL stay."""
        gone = F.coalesce(condition, F.lit(False))
        deleted = self.current().where(condition).count()
        if deleted:
            self.replace(self.current().where(~gone))
        return Change(deleted=deleted)
