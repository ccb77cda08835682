"""Readers for messy input files. Schemas are declared, never inferred: input is text until cleaned."""

from __future__ import annotations

import os.path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.schemas import (
    JSON_STUDENT,
    PENDING_ENVELOPE,
    RAW_COURSE,
    RAW_DEPARTMENT,
    RAW_ENROLLMENT,
    RAW_STUDENT,
)

# The fields a JSON document may wrap its records in, in order of preference.
WRAPPERS = ("data", "records", "students")

INPUTS = {
    "students": ("students.csv", RAW_STUDENT),
    "enrollments": ("enrollments.csv", RAW_ENROLLMENT),
    "departments": ("departments.csv", RAW_DEPARTMENT),
    "courses": ("courses.csv", RAW_COURSE),
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, rejects: str | None = None
) -> DataFrame:
    """Header row, trimmed values, empty lines skipped, every column text; an empty value reads as NULL.

    A record with too few or too many values is an error, or, with ``rejects``, a row whose column of that name
    holds the whole record; in other rows that column is NULL. ``multi_line`` allows line breaks in quoted values; such
    files are read by one task each.
    """
    full = T.StructType([*schema.fields, T.StructField(rejects, T.StringType())]) if rejects else schema
    # A record's values are only counted when all of them are parsed, so columns are not pruned here.
    return spark.read.option("columnPruning", False).csv(
        path,
        schema=full,
        header=True,
        enforceSchema=rejects is not None,  # the header has no reject column
        escape='"',
        multiLine=multi_line,
        mode="PERMISSIVE" if rejects else "FAILFAST",
        columnNameOfCorruptRecord=rejects,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
    )


def read_json(
    spark: SparkSession, path: str, record: T.StructType = JSON_STUDENT, multi_line: bool = True
) -> DataFrame:
    """Records of JSON documents: a bare array, an object wrapping an array, or one object.

    A document that is not JSON, or whose fields have other types, is an error. A multi-line document is read by
    one task; at scale write one document per line and pass ``multi_line=False``, which makes the files splittable.
    """
    wrappers = [T.StructField(name, T.ArrayType(record)) for name in WRAPPERS]
    full = T.StructType(list(record.fields) + wrappers)
    documents = spark.read.json(path, schema=full, multiLine=multi_line, mode="FAILFAST")
    single = F.array(F.struct(*record.fieldNames()))
    return documents.select(F.inline(F.coalesce(*WRAPPERS, single)))


def read_file(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Reader chosen by the file extension."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension == ".csv":
        return read_csv(spark, path, schema)
    if extension == ".json":
        return read_json(spark, path, schema, multi_line)
    raise ValueError(f"unsupported file type: {extension or path}")


def read_inputs(spark: SparkSession, folder: str, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The four named inputs of a cleaning run; ``files`` gives other file names."""
    names = {name: file for name, (file, _) in INPUTS.items()} | (files or {})
    return {name: read_csv(spark, f"{folder}/{names[name]}", schema) for name, (_, schema) in INPUTS.items()}


def read_pending(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Students of exported envelopes with their position in it, from 1; no student array is an error."""
    envelopes = spark.read.json(path, schema=PENDING_ENVELOPE, multiLine=multi_line, mode="FAILFAST")
    missing = F.raise_error(F.lit('invalid envelope: "students" array not found'))
    students = F.when(F.col("students").isNull(), missing).otherwise(F.col("students"))
    return envelopes.select("exportedAt", F.posexplode(students).alias("position", "student")).select(
        "exportedAt", (F.col("position") + 1).alias("position"), "student.*"
    )


def read_copy_text(
    spark: SparkSession, path: str, schema: str | T.StructType, unescape: bool = False, rejects: str | None = None
) -> DataFrame:
    r"""Tab-separated rows with ``\N`` for NULL. ``unescape`` also turns ``\\`` into one backslash.

    The CSV reader would take an empty field for NULL and could not tell it from ``\N``. A row with another number
    of fields, or with a value that does not fit its column, is an error, or, with ``rejects``, has the whole row in
    the column of that name, which is NULL in other rows.
    """
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parts = F.split("value", "\t", -1)
    raw = [F.nullif(F.get(parts, F.lit(i)), F.lit("\\N")) for i in range(len(columns.fields))]
    bad = F.size(parts) != len(columns.fields)
    values = []
    for text, field in zip(raw, columns.fields):
        if isinstance(field.dataType, T.StringType):
            value = F.replace(text, F.lit("\\\\"), F.lit("\\")) if unescape else text
        else:
            value = text.try_cast(field.dataType)
            bad = bad | (text.isNotNull() & value.isNull())
        values.append((value, field.name))
    rows = spark.read.text(path).filter(F.col("value") != "\\.")  # the end mark of a block
    if rejects:
        kept = [F.when(~bad, value).alias(name) for value, name in values]
        return rows.select(*kept, F.when(bad, F.col("value")).alias(rejects))
    stop = F.raise_error(F.concat(F.lit("row does not fit its columns: "), F.col("value")))
    first, *others = values
    checked = F.when(bad, stop.cast(columns.fields[0].dataType)).otherwise(first[0]).alias(first[1])
    return rows.select(checked, *[value.alias(name) for value, name in others])
