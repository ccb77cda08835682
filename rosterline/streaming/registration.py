"""Registration events as a stream: gate, check, register, remember the status."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rosterline.functions.cleaning import normalize_email
from rosterline.operators.validation import STUDENT_COLUMNS, not_yet_registered, split_complete, submit
from rosterline.sources.store import KeyedTable, joined_by, latest_per_key

OUTCOME_SCHEMA = (
    "row_id long, status string, message string, status_code int, student_first_name string, "
    "student_last_name string, student_email string, student_date_of_birth date, student_year int, "
    "student_phone_number string, department_id int, batch_id long"
)


class OutcomeLog:
    """Outcomes of all batches, one folder per batch: a batch only ever writes its own, and writes it whole or not at all."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(OUTCOME_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], OUTCOME_SCHEMA)

    def of_batch(self, batch_id: int) -> DataFrame:
        return self.read().where(F.col("batch_id") == batch_id)

    def append(self, outcomes: DataFrame, batch_id: int) -> None:
        """Write a batch; a repeated write takes the place of the first."""
        rows = outcomes.withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.path)

    def latest(self) -> DataFrame:
        """The last outcome of every record."""
        log = self.read()
        last = log.groupBy("row_id").agg(F.max("batch_id").alias("batch_id"))
        return joined_by(log, last, ["row_id", "batch_id"], "left_semi")


class RegistrationStream:
    """Turns record edits into statuses and students.

    Each micro-batch first appends its outcomes to the log, then enters the students taken from these. A batch that is
    replayed after a failure finds its outcomes and only enters the students that are missing, so no record is judged
    twice and no student is entered twice. Earlier files are never written again.
    """

    def __init__(self, outcomes: OutcomeLog, students: KeyedTable, department: DataFrame, as_of=None):
        self.outcomes = outcomes
        self.students = students
        self.department = department
        self.as_of = as_of

    def _judge(self, latest: DataFrame) -> DataFrame:
        """Statuses of the complete, still open records, against the stored rows their keys fall near."""
        complete, _ = split_complete(latest)
        open_rows = not_yet_registered(complete, self.outcomes.read(), "row_id")
        emails = latest.select(normalize_email(F.col("email")).alias("student_email"))
        return submit(open_rows, self.department, self.students.current_near(emails), self.as_of, seq="row_id")

    def process(self, events: DataFrame, batch_id: int) -> None:
        if self.outcomes.of_batch(batch_id).isEmpty():
            latest = latest_per_key(events, ["row_id"], "event_seq").persist()
            try:
                self.outcomes.append(self._judge(latest), batch_id)
            finally:
                latest.unpersist()
        created = self.outcomes.of_batch(batch_id).where("status_code = 201")
        self.students.insert_ignore(created.select("row_id", *STUDENT_COLUMNS), "row_id")

    def start(self, events: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        writer = events.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        if available_now:
            writer = writer.trigger(availableNow=True)
        return writer.start()


SALTS = 16


def drop_repeats(events: DataFrame, keys: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Suppress events whose key was seen within the watermark: state holds one entry per key until it passes.

    A first round by key and a hash of the whole event spreads a key that floods the stream over ``SALTS`` tasks; the
    second then meets at most that many events of it in a batch. An event older than the watermark is dropped as late.
    """
    salt = F.pmod(F.xxhash64(*events.columns), F.lit(SALTS))
    salted = events.withColumn("salt", salt).withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, "salt"])
    return salted.dropDuplicatesWithinWatermark(keys).drop("salt")


def start_repeats(events: DataFrame, keys: list[str], ts: str, path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Append the first event of each key to a Parquet folder, through Spark's file sink."""
    return (
        drop_repeats(events, keys, ts, delay)
        .writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keep_first(events: DataFrame, table: KeyedTable, order_by: str, checkpoint: str) -> StreamingQuery:
    """Keep the first event per key for good, against the table of keys already seen.

    Copies within a micro-batch are folded by a map-side aggregate before any shuffle, so one key that
    floods the stream does not end in one task. A replayed batch finds its keys and adds nothing.
    """
    return (
        events.writeStream.foreachBatch(lambda batch, _: table.insert_ignore(batch, order_by) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
