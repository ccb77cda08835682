"""Daily digest of records that ended in Error or Invalid."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The statuses that are reported.
FAILED_STATUSES = ("Error", "Invalid")


def _message() -> Column:
    """A missing message counts as an empty one."""
    return F.coalesce("message", F.lit("")).alias("message")


def failed(records: DataFrame) -> DataFrame:
    return records.filter(F.col("status").isin(*FAILED_STATUSES))


def digest_lines(records: DataFrame) -> DataFrame:
    """The digest's lines, one row each: nothing is gathered into a message body here."""
    line = F.concat(F.lit("Row "), F.col("row_id").cast("string"), F.lit(": "), F.coalesce("message", F.lit("")))
    return failed(records).select(F.to_date("ts").alias("day"), "row_id", line.alias("line")).orderBy("day", "row_id")


def digest_counts(records: DataFrame) -> DataFrame:
    """Failures per day, status and message; empty when there is nothing to report."""
    return failed(records).groupBy(F.to_date("ts").alias("day"), "status", _message()).agg(F.count("*").alias("records"))


COUNTS_SCHEMA = "day date, status string, message string, records long"


def start_closed_days(records: DataFrame, path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Append the counts of each day once, when the watermark has passed its end, through Spark's file sink.

    A record that comes after its day was closed is late: it is not counted, and no file is written again.
    """
    counts = (
        failed(records)
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day").alias("span"), "status", _message())
        .agg(F.count("*").alias("records"))
        .select(F.to_date("span.start").alias("day"), "status", "message", "records")
    )
    return (
        counts.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def closed_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COUNTS_SCHEMA).parquet(path)


def digest_so_far(closed: DataFrame, records: DataFrame) -> DataFrame:
    """Closed days as stored, and the days after the last closed one counted from their records, which the scan is bounded to."""
    last = closed.agg(F.max("day")).first()[0]
    still_open = records if last is None else records.where(F.col("ts") >= F.lit(last + dt.timedelta(days=1)))
    return closed.unionByName(digest_counts(still_open))
