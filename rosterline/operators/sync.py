"""Incremental sync: logged runs, last successful sync, history, delta reads and stored summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.schemas import SYNC_LOG
from rosterline.sources.store import KeyedTable


class SyncLog:
    """One row per finished run, appended when the run ends, whether it succeeded or failed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(SYNC_LOG).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SYNC_LOG)

    def _append(self, row: tuple) -> None:
        self.spark.createDataFrame([row], SYNC_LOG).coalesce(1).write.mode("append").parquet(self.path)

    def run(self, table_name: str, sync_type: str, action: Callable[[], int | tuple[int, dt.datetime | None]]) -> int:
        """Run ``action``, log its record count, or log its failure and raise it again.

        An action that reads a source returns the newest source time it read as well.
        """
        sync_id = self.read().agg(F.coalesce(F.max("sync_id"), F.lit(0)) + 1).first()[0]
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        records, status, message, until = 0, "failed", None, None
        try:
            done = action()
            records, until = done if isinstance(done, tuple) else (done, None)
            status = "success"
            return records
        except Exception as error:
            message = str(error)
            raise
        finally:
            ended = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            self._append((sync_id, table_name, sync_type, records, started, ended, status, message, until))


def last_sync(log: DataFrame, table_name: str | None = None) -> DataFrame:
    """End of the last successful run per table, or of one table."""
    done = log.filter(F.col("status") == "success")
    if table_name is not None:
        done = done.filter(F.col("table_name") == table_name)
    return done.groupBy("table_name").agg(F.max("completed_at").alias("last_sync"))


def last_read(log: DataFrame, table_name: str) -> dt.datetime | None:
    """The newest source time that a successful run of the table has read."""
    done = log.filter((F.col("status") == "success") & (F.col("table_name") == table_name))
    return done.agg(F.max("source_until")).first()[0]


def changed_since(df: DataFrame, ts: str, since) -> DataFrame:
    """Rows newer than a sync point; all rows when there is none. The bound is pushed to the scan."""
    if since is None:
        return df
    bound: Column = since if isinstance(since, Column) else F.lit(str(since)).cast("timestamp_ntz")
    return df.filter(F.col(ts) > bound)


def delta(df: DataFrame, ts: str, log: DataFrame, table_name: str) -> DataFrame:
    """Rows newer than the table's last successful sync, whose one value is fetched so that the scan can use it."""
    done = log.filter((F.col("status") == "success") & (F.col("table_name") == table_name))
    return changed_since(df, ts, done.agg(F.max("completed_at")).first()[0])


def sync_history(log: DataFrame, limit: int = 10) -> DataFrame:
    """Newest runs first, with their duration in seconds."""
    micros = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at"))
    seconds = (micros.cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(10,2)")
    return (
        log.orderBy(F.desc("started_at"), F.desc("sync_id"))
        .limit(limit)
        .select(
            "table_name",
            "sync_type",
            "records_processed",
            "started_at",
            "completed_at",
            "status",
            seconds.alias("duration_seconds"),
        )
    )


class SummaryTable:
    """A stored summary: its query, recomputed into a new version on refresh."""

    def __init__(self, spark: SparkSession, path: str, query: Callable[[], DataFrame], sort: list[str]):
        self.table = KeyedTable(spark, path, [])
        self.query = query
        self.sort = sort

    def refresh(self) -> int:
        return self.table.replace(self.query(), self.sort).inserted

    def read(self) -> DataFrame:
        return self.table.current()


@dataclass
class Refresh:
    """Rows written, or why the refresh failed."""

    rows: int | None = None
    error: str | None = None


def refresh_all(summaries: Mapping[str, SummaryTable]) -> dict[str, Refresh]:
    """Refresh each summary on its own."""
    outcome: dict[str, Refresh] = {}
    for name, summary in summaries.items():
        try:
            outcome[name] = Refresh(rows=summary.refresh())
        except Exception as error:  # one broken summary must not stop the others
            outcome[name] = Refresh(error=str(error))
    return outcome
