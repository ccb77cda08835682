"""The registered queries: every operator bound to the given tables.

Each query reads its whole tables. Decimals become doubles only here, at the edge, so that results can
be compared with engines that have other decimal rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterline.functions import cleaning as clean
from rosterline.functions.dates import old_enough, parse_date
from rosterline.functions.grades import grade_to_points
from rosterline.operators import academic, academic_functions, countries, layouts, lookups, maintained, sales, sync, validation, views
from rosterline.plans import jobs
from rosterline.plans.binding import AS_OF, FLAWED_GRADE, Tables, derive
from rosterline.session import ensure_adaptive, fresh_path
from rosterline.sources import readers, sinks
from rosterline.sources.store import KeyedTable, first_per_key, latest_per_key
from rosterline.streaming import digest, registration

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}

# Orders before this day count as stored history, later ones as the incoming change.
CUTOFF = "1998-01-01"
HIGH_VALUE, MEDIUM_VALUE = "3000000", "2000000"
# The changes of the incremental summary: smaller invoices are raised by one, larger ones deleted.
SMALL_TOTAL, LARGE_TOTAL = 50_000, 400_000


def query(name: str) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return add


def doubles(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    ensure_adaptive(spark)
    return doubles(QUERIES[name](Tables(spark, folder)))


# -- sources -----------------------------------------------------------------------------------


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"')


def _raw_students(t: Tables) -> DataFrame:
    return t.raw_students.select(*readers.RAW_STUDENT.fieldNames())


def _wrapped_students(t: Tables) -> DataFrame:
    """JSON documents of at most a hundred records, cycling through the wrapper fields."""
    block = F.floor(F.col("seq") / 100)
    documents = (
        t.raw_students.drop("student_email")
        .groupBy(block.alias("block"))
        .agg(F.collect_list(F.struct("student_id", "name", "email", "year")).alias("rows"))
    )
    wrapped = [
        F.when(F.col("block") % len(readers.WRAPPERS) == i, F.col("rows")).alias(name)
        for i, name in enumerate(readers.WRAPPERS)
    ]
    return documents.select(F.to_json(F.struct(*wrapped)).alias("value"))


@query("src_1_csv")
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "students")
    _write_csv(_raw_students(t), path)
    return readers.read_csv(t.spark, path, readers.RAW_STUDENT)


@query("src_1_rejects")
def _(t: Tables) -> DataFrame:
    """Records of which one in ten lacks its last value."""
    path = fresh_path(t.spark, "ragged")
    customer = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", customer)
    t.given("orders").select(line.alias("id,status,customer")).write.csv(path, header=True, sep="\u0001", quote="")
    schema = T.StructType.fromDDL("id string, status string, customer string")
    return readers.read_csv(t.spark, path, schema, rejects="reject")


@query("src_2_array")
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "arrays")
    wrapped = F.coalesce(*[F.get_json_object("value", f"$.{name}") for name in readers.WRAPPERS])
    _wrapped_students(t).select(wrapped.alias("value")).write.text(path)
    return readers.read_json(t.spark, path, multi_line=False).select("student_id", "name", "email", "year")


@query("src_2_single")
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "objects")
    t.raw_students.select(F.to_json(F.struct("student_id", "name", "email", "year")).alias("value")).write.text(path)
    return readers.read_json(t.spark, path, multi_line=False).select("student_id", "name", "email", "year")


@query("src_2_json")
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "documents")
    _wrapped_students(t).write.text(path)
    return readers.read_json(t.spark, path, multi_line=False).select("student_id", "name", "email", "year")


@query("src_3_by_extension")
def _(t: Tables) -> DataFrame:
    folder = fresh_path(t.spark, "mixed")
    _write_csv(_raw_students(t), f"{folder}/students.csv")
    _wrapped_students(t).write.text(f"{folder}/students.json")
    parts = [
        readers.read_file(t.spark, f"{folder}/students.{kind}", schema, multi_line=False).select(
            F.lit(kind).alias("kind"), "student_id", clean.clean_text(F.col("year")).alias("year")
        )
        for kind, schema in (("csv", readers.RAW_STUDENT), ("json", readers.JSON_STUDENT))
    ]
    return parts[0].unionByName(parts[1])


@query("src_4_all_inputs")
def _(t: Tables) -> DataFrame:
    folder = fresh_path(t.spark, "inputs")
    columns = {
        "students": _raw_students(t),
        "enrollments": t.raw_enrollments.select(*readers.RAW_ENROLLMENT.fieldNames()),
        "departments": t.registry.selectExpr("department_id AS dept_id", "department_name", "department_head"),
        "courses": t.course.selectExpr("course_id", "course_name", "department_id", "course_credits"),
    }
    for name, df in columns.items():
        file, schema = readers.INPUTS[name]
        _write_csv(df.toDF(*schema.fieldNames()), f"{folder}/{file}")
    parts = [
        df.select(F.lit(name).alias("input"), F.col(df.columns[0]).alias("id"), F.col(df.columns[1]).alias("label"))
        for name, df in readers.read_inputs(t.spark, folder).items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _envelopes(t: Tables) -> str:
    """Pending registrations exported in envelopes of at most a hundred students, one per line."""
    path = fresh_path(t.spark, "pending")
    entry = F.struct("seq", *validation.REQUEST_FIELDS)
    blocks = t.requests.groupBy(F.floor(F.col("seq") / 100).alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    students = F.transform("entries", lambda e: F.struct(*[e[f].alias(f) for f in validation.REQUEST_FIELDS]))
    envelope = F.struct(
        F.date_format(F.timestamp_seconds("block"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("exportedAt"),
        F.size("entries").cast("long").alias("count"),
        students.alias("students"),
    )
    blocks.select(F.to_json(envelope).alias("value")).write.text(path)
    return path


@query("src_5_pending")
def _(t: Tables) -> DataFrame:
    return readers.read_pending(t.spark, _envelopes(t), multi_line=False)


@query("src_6_rejects")
def _(t: Tables) -> DataFrame:
    """Rows of which one in ten has text in a column of numbers."""
    path = fresh_path(t.spark, "unfit")
    customer = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey").cast("string")).otherwise("none")
    line = F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderstatus", customer)
    t.given("orders").select(line.alias("value")).write.text(path)
    return readers.read_copy_text(t.spark, path, "id long, status string, customer long", rejects="reject")


@query("src_6_copy_text")
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "copy")
    fields = [
        F.col("o_orderkey").cast("string"),
        F.concat(F.col("o_orderstatus"), F.lit('"\\\\'), F.col("o_orderpriority")),
        F.when(F.col("o_orderstatus") == "P", F.lit("\\N")).otherwise(F.col("o_custkey").cast("string")),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
    ]
    t.given("orders").select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
    schema = "id long, label string, customer long, stamp timestamp_ntz"
    return readers.read_copy_text(t.spark, path, schema, unescape=True)


# -- sinks -------------------------------------------------------------------------------------


def _history(t: Tables) -> tuple[DataFrame, DataFrame]:
    orders = t.given("orders").withColumn("day", F.to_date("o_orderdate"))
    return orders.filter(F.col("day") < CUTOFF), orders.filter(F.col("day") >= CUTOFF)


def _terms(t: Tables) -> tuple[DataFrame, DataFrame]:
    terms = t.term_enrollment.withColumn("seq", F.col("enrollment_id"))
    return terms.filter(F.col("enrollment_date") < CUTOFF), terms.filter(F.col("enrollment_date") >= CUTOFF)


PAIR = academic_functions.PAIR


def _student_table(t: Tables) -> KeyedTable:
    return sinks.student_table(t.spark, fresh_path(t.spark, "student"))


def _enrollment_table(t: Tables) -> KeyedTable:
    return sinks.enrollment_table(t.spark, fresh_path(t.spark, "enrollment"))


@query("snk_1_load_students")
def _(t: Tables) -> DataFrame:
    table = _student_table(t)
    accepted, _ = validation.transform_students(t.raw_students, t.registry, AS_OF)
    sinks.load_students(table, accepted)
    earlier, _ = validation.transform_students(t.raw_students, t.registry, "2015-01-01")
    sinks.load_students(table, earlier.withColumn("student_year", F.lit(4)))
    return table.current().drop("student_id")


@query("snk_2_load_enrollments")
def _(t: Tables) -> DataFrame:
    table = _enrollment_table(t)
    for part in _terms(t):
        sinks.load_enrollments(table, part.drop("enrollment_id"))
    return table.current().drop("enrollment_id")


@query("snk_3_batch_insert")
def _(t: Tables) -> DataFrame:
    old, new = _terms(t)
    table = KeyedTable(t.spark, fresh_path(t.spark, "batch"), PAIR)
    table.replace(first_per_key(old, PAIR, "seq").select("seq", *PAIR, "grade"))
    sinks.insert_new(table, new, "seq")
    return table.current()


@query("snk_4_copy_insert")
def _(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "events")
    row = F.concat_ws("\t", F.col("event_id").cast("string"), F.col("user_id").cast("string"), "event_type")
    t.given("events").select(row.alias("value")).write.text(path)
    schema = "event_id long, user_id long, event_type string"
    table = sinks.empty_table(t.spark, fresh_path(t.spark, "first"), ["user_id"], schema)
    sinks.insert_new(table, readers.read_copy_text(t.spark, path, schema), "event_id")
    return table.current()


GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@query("snk_5_row_counts")
def _(t: Tables) -> DataFrame:
    names = [*GIVEN, "absent"]
    return sinks.row_counts(t.spark, {name: lambda name=name: t.given(name) for name in names})


# -- cleaning expressions ----------------------------------------------------------------------


@query("cln_1_normalize_email")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select("seq", clean.normalize_email(F.col("email")).alias("email"))


@query("cln_2_is_email")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select("seq", clean.is_email(F.col("email")).alias("valid"))


@query("cln_3_parse_year")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select("seq", clean.parse_year(F.col("year")).alias("year"))


@query("cln_4_is_year")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select("seq", clean.is_year(clean.parse_year(F.col("year"))).alias("valid"))


@query("cln_5_department")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select("seq", clean.standard_department(F.col("department")).alias("department"))


@query("cln_6_is_grade")
def _(t: Tables) -> DataFrame:
    return t.raw_enrollments.select("seq", clean.is_grade(F.col("grade")).alias("valid"))


@query("cln_7_parse_date")
def _(t: Tables) -> DataFrame:
    return t.raw_enrollments.select("seq", parse_date(F.col("enrollment_date")).alias("day"))


@query("cln_8_old_enough")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select("seq", old_enough(parse_date(F.col("date_of_birth")), AS_OF).alias("valid"))


@query("cln_9_normalize_phone")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select("seq", clean.normalize_phone(F.col("phone_number")).alias("phone"))


@query("cln_10_is_phone")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select(
        "seq", clean.is_phone(clean.normalize_phone(F.col("phone_number"))).alias("valid")
    )


@query("cln_11_clean_text")
def _(t: Tables) -> DataFrame:
    return t.raw_students.select("seq", clean.clean_text(F.col("first_name")).alias("first_name"))


@query("cln_12_split_name")
def _(t: Tables) -> DataFrame:
    name = F.col("name")
    return t.raw_students.select(
        "seq", clean.first_name_of(name).alias("first_name"), clean.last_name_of(name).alias("last_name")
    )


@query("cln_13_grade_points")
def _(t: Tables) -> DataFrame:
    return t.flawed_enrollment.select("enrollment_id", grade_to_points(F.col("grade")).alias("points"))


@query("cln_14_field_spellings")
def _(t: Tables) -> DataFrame:
    raw = t.raw_students
    return raw.select("seq", clean.field(raw, "email").alias("email"), clean.field(raw, "year").alias("year"))


# -- validation jobs ---------------------------------------------------------------------------


@query("val_1_students")
def _(t: Tables) -> DataFrame:
    return validation.tag_students(t.raw_students, t.registry, AS_OF)


@query("val_2_enrollments")
def _(t: Tables) -> DataFrame:
    return validation.tag_enrollments(t.raw_enrollments, t.student, t.course)


def _joined_errors(df: DataFrame) -> DataFrame:
    return df.select("seq", F.array_join("errors", "; ").alias("errors"))


@query("val_3_pending")
def _(t: Tables) -> DataFrame:
    return _joined_errors(validation.pending_errors(t.requests))


def _known_students(t: Tables) -> DataFrame:
    """Registered e-mails: the addresses of customers that appear in the events."""
    return t.given("events").selectExpr("'user' || CAST(user_id AS STRING) || '@example.org' AS student_email")


@query("val_4_register")
def _(t: Tables) -> DataFrame:
    judged = validation.register(t.requests, t.registry, _known_students(t), AS_OF)
    return judged.withColumn("errors", F.array_join("errors", "; "))


@query("val_5_sheet_rules")
def _(t: Tables) -> DataFrame:
    return _joined_errors(validation.sheet_errors(t.requests, AS_OF))


@query("val_6_completeness")
def _(t: Tables) -> DataFrame:
    complete, incomplete = validation.split_complete(t.requests)
    return complete.select("seq", F.lit(True).alias("complete")).unionByName(
        incomplete.select("seq", F.lit(False).alias("complete"))
    )


@query("val_7_not_yet_registered")
def _(t: Tables) -> DataFrame:
    requests = t.requests.withColumnRenamed("seq", "row_id")
    return validation.not_yet_registered(requests, t.status_records, "row_id").select("row_id", "email")


@query("val_8_shape")
def _(t: Tables) -> DataFrame:
    return validation.shape_requests(t.requests)


@query("val_9_run_statistics")
def _(t: Tables) -> DataFrame:
    students = validation.tag_students(t.raw_students, t.registry, AS_OF)
    enrollments = validation.tag_enrollments(t.raw_enrollments, t.student, t.course)
    return validation.run_statistics(students, "students").unionByName(
        validation.run_statistics(enrollments, "enrollments")
    )


def _cleaning_run(t: Tables) -> tuple[jobs.CleaningRun, KeyedTable, KeyedTable]:
    address = F.regexp_replace("student_email", "CUSTOMER0*([0-9]+)", "user$1")
    students, enrollments = _student_table(t), _enrollment_table(t)
    done = jobs.run_cleaning(
        t.raw_students,
        t.raw_enrollments.withColumn("student_email", address),
        t.registry,
        t.course,
        students,
        enrollments,
        AS_OF,
    )
    return done, students, enrollments


@query("val_9_cleaning_run")
def _(t: Tables) -> DataFrame:
    """The whole cleaning run, then the enrollments it stored."""
    _, students, enrollments = _cleaning_run(t)
    return (
        enrollments.current()
        .join(students.current().select("student_id", "student_email"), "student_id")
        .select("student_email", "course_id", "grade", "enrollment_date")
    )


@query("val_9_rejects")
def _(t: Tables) -> DataFrame:
    """The stored rejects of the whole cleaning run."""
    return _cleaning_run(t)[0].rejects.select("job", "seq", "reject_reason")


# -- academic queries --------------------------------------------------------------------------


@query("q_01_students_per_department")
def _(t: Tables) -> DataFrame:
    return academic.students_per_department(t.student, t.department)


@query("q_02_course_gpa")
def _(t: Tables) -> DataFrame:
    return academic.course_gpa(t.course, t.flawed_enrollment)


@query("q_03_enrollments_per_student")
def _(t: Tables) -> DataFrame:
    return academic.enrollments_per_student(t.student, t.enrollment)


@query("q_04_students_per_year")
def _(t: Tables) -> DataFrame:
    return academic.students_per_year(t.student)


@query("q_05_course_popularity")
def _(t: Tables) -> DataFrame:
    return academic.course_popularity(t.department, t.course, t.enrollment)


@query("q_06_student_directory")
def _(t: Tables) -> DataFrame:
    return academic.student_directory(t.student, t.department)


@query("q_07_enrollment_report")
def _(t: Tables) -> DataFrame:
    return academic.enrollment_report(t.enrollment, t.student, t.course, t.department)


@query("q_08_student_course_load")
def _(t: Tables) -> DataFrame:
    return academic.student_course_load(t.student, t.department, t.enrollment)


@query("q_09_cross_department")
def _(t: Tables) -> DataFrame:
    return academic.cross_department_enrollments(t.enrollment, t.student, t.course, t.department)


@query("q_10_duplicate_keys")
def _(t: Tables) -> DataFrame:
    return academic.duplicate_keys(t.given("lineitem"), "l_orderkey", "l_linenumber")


@query("q_10_duplicate_emails")
def _(t: Tables) -> DataFrame:
    emails = t.raw_students.select(clean.normalize_email(F.col("email")).alias("student_email"))
    return academic.duplicate_emails(emails)


@query("q_11_without_enrollment")
def _(t: Tables) -> DataFrame:
    return academic.students_without_enrollment(t.student, t.department, t.activity_enrollment)


@query("q_12_ungraded")
def _(t: Tables) -> DataFrame:
    return academic.ungraded_enrollments(t.enrollment, t.student, t.course)


@query("q_13_underage")
def _(t: Tables) -> DataFrame:
    return academic.underage_students(t.student, AS_OF)


@query("q_14_invalid_grades")
def _(t: Tables) -> DataFrame:
    return academic.invalid_grades(t.flawed_enrollment, t.student, t.course)


@query("q_15_department_card")
def _(t: Tables) -> DataFrame:
    return academic.department_card(t.department, t.student, t.course, t.enrollment)


@query("q_15_department_card_deduped")
def _(t: Tables) -> DataFrame:
    return academic.department_card(t.department, t.student, t.course, t.enrollment, dedupe_fanout=True)


@query("q_16_top_students")
def _(t: Tables) -> DataFrame:
    return academic.top_students(t.student, t.department, t.term_enrollment, "2.9")


@query("q_17_grade_distribution")
def _(t: Tables) -> DataFrame:
    return academic.grade_distribution(t.course, t.activity_enrollment)


# -- views -------------------------------------------------------------------------------------


@query("v_1_student_details")
def _(t: Tables) -> DataFrame:
    return views.student_details(t.student, t.department, AS_OF)


@query("v_2_enrollment_report")
def _(t: Tables) -> DataFrame:
    return views.enrollment_view(t.enrollment, t.student, t.course, t.department)


@query("v_3_student_gpa")
def _(t: Tables) -> DataFrame:
    return views.student_gpa_view(t.student, t.department, t.term_enrollment)


@query("v_3_student_gpa_sparse")
def _(t: Tables) -> DataFrame:
    return views.student_gpa_view(t.student, t.department, t.activity_enrollment)


@query("v_4_course_statistics")
def _(t: Tables) -> DataFrame:
    return views.course_statistics(t.course, t.department, t.enrollment)


@query("v_5_department_summary")
def _(t: Tables) -> DataFrame:
    return views.department_summary(t.department, t.student, t.course, t.enrollment)


# -- academic functions ------------------------------------------------------------------------


@query("f_1_grade_to_points")
def _(t: Tables) -> DataFrame:
    return t.term_enrollment.select("enrollment_id", "grade", grade_to_points(F.col("grade")).alias("points"))


@query("f_2_student_gpa")
def _(t: Tables) -> DataFrame:
    return academic_functions.student_gpa(t.enrollment, t.student)


def _enroll_requests(t: Tables) -> DataFrame:
    return t.given("orders").selectExpr(
        "o_orderkey AS seq",
        "CASE WHEN o_orderkey % 37 = 1 THEN -1 ELSE o_custkey END AS student_id",
        "'S' || CAST(o_orderkey % 127 AS STRING) AS course_id",
        "CAST(o_orderdate AS DATE) AS enrollment_date",
    )


@query("f_3_enroll_check")
def _(t: Tables) -> DataFrame:
    return academic_functions.check_enrollments(_enroll_requests(t), t.student, t.course, t.activity_enrollment)


@query("f_3_enroll_students")
def _(t: Tables) -> DataFrame:
    """Accepted requests added to the stored enrollments."""
    table = _enrollment_table(t)
    table.replace(first_per_key(t.activity_enrollment, PAIR, "enrollment_id"))
    sinks.enroll_students(table, _enroll_requests(t), t.student, t.course)
    return table.current().drop("enrollment_id")


@query("f_4_course_average")
def _(t: Tables) -> DataFrame:
    return academic_functions.course_average(t.enrollment, t.course)


@query("f_5_department_stats")
def _(t: Tables) -> DataFrame:
    return academic_functions.department_stats(t.department, t.student, t.course, t.enrollment)


def _grade_updates(t: Tables) -> DataFrame:
    return t.given("orders").selectExpr(
        "o_orderkey AS seq",
        "o_custkey AS student_id",
        "'S' || CAST(o_orderkey % 90 AS STRING) AS course_id",
        f"{FLAWED_GRADE} AS grade",
    )


@query("f_6_grade_update_check")
def _(t: Tables) -> DataFrame:
    return academic_functions.check_grade_updates(_grade_updates(t), t.activity_enrollment)


@query("f_6_grade_updates")
def _(t: Tables) -> DataFrame:
    return academic_functions.update_grades(t.activity_enrollment, _grade_updates(t))


@query("f_6_stored_grades")
def _(t: Tables) -> DataFrame:
    """The same updates applied to stored enrollments, one per (student, course)."""
    table = _enrollment_table(t)
    table.replace(first_per_key(t.activity_enrollment, PAIR, "enrollment_id"))
    sinks.store_grades(table, _grade_updates(t))
    return table.current()


@query("f_7_pending_grades")
def _(t: Tables) -> DataFrame:
    return academic_functions.pending_grades(t.enrollment, t.student, t.course, AS_OF)


# -- access patterns ---------------------------------------------------------------------------

ONE_EMAIL = "customer000000042@example.org"


@query("o_1_find_student")
def _(t: Tables) -> DataFrame:
    return lookups.find_student(t.student, ONE_EMAIL)


@query("o_1_find_student_department")
def _(t: Tables) -> DataFrame:
    return lookups.find_student_department(t.student, t.department, ONE_EMAIL)


@query("o_2_enrollments_of_year")
def _(t: Tables) -> DataFrame:
    return lookups.enrollments_of_year(t.enrollment, t.student, t.course, 3)


@query("o_3_enrollments_of_student")
def _(t: Tables) -> DataFrame:
    return lookups.enrollments_of_student(t.enrollment, t.course, 42)


@query("o_4_phone_prefix")
def _(t: Tables) -> DataFrame:
    return lookups.students_by_phone_prefix(t.student, "+91")


@query("o_1_stored")
def _(t: Tables) -> DataFrame:
    """The same lookup on a copy sorted by the e-mail."""
    stored = layouts.store_sorted(t.student, fresh_path(t.spark, "student_by_email"), "student_email")
    return lookups.find_student(stored, ONE_EMAIL)


@query("o_4_stored")
def _(t: Tables) -> DataFrame:
    """The same prefix on a copy sorted by the phone number."""
    stored = layouts.store_sorted(t.student, fresh_path(t.spark, "student_by_phone"), "student_phone_number")
    return lookups.students_by_phone_prefix(stored, "+91")


@query("o_5_position")
def _(t: Tables) -> DataFrame:
    """The same page from stored, numbered pages."""
    return layouts.store_pages(t.student, fresh_path(t.spark, "student_pages"), "student_id").page(20, 40)


@query("o_5_page")
def _(t: Tables) -> DataFrame:
    return lookups.page(t.student, "student_id", 20, 40)


@query("o_5_page_after")
def _(t: Tables) -> DataFrame:
    return lookups.page_after(t.student, "student_id", 39, 20)


@query("o_6_exists")
def _(t: Tables) -> DataFrame:
    return lookups.has_enrollment(t.enrollment, 1)


@query("o_6_exists_for_all")
def _(t: Tables) -> DataFrame:
    return lookups.enrolled_students(t.student, t.activity_enrollment)


@query("o_6_count")
def _(t: Tables) -> DataFrame:
    return lookups.enrollment_count(t.enrollment, 1)


@query("o_7_projection")
def _(t: Tables) -> DataFrame:
    return lookups.student_contacts(t.student)


@query("o_8_inner_counts")
def _(t: Tables) -> DataFrame:
    return lookups.enrollment_counts(t.student, t.activity_enrollment, keep_unmatched=False)


@query("o_8_left_counts")
def _(t: Tables) -> DataFrame:
    return lookups.enrollment_counts(t.student, t.activity_enrollment)


@query("o_9_not_in")
def _(t: Tables) -> DataFrame:
    return lookups.keys_not_in(t.student.select("student_id", "student_email"), "student_id", t.given("events"), "user_id")


# -- sales summaries ---------------------------------------------------------------------------


def _by_artist(t: Tables) -> tuple[DataFrame, ...]:
    return t.artist, t.album, t.track, t.line


def _by_genre(t: Tables) -> tuple[DataFrame, ...]:
    return t.genre, t.part_track, t.part_album, t.part_line


def _artist_sales(t: Tables) -> DataFrame:
    return sales.artist_sales_summary(*_by_artist(t))


def _genre_popularity(t: Tables) -> DataFrame:
    return sales.genre_popularity(*_by_genre(t))


def _lifetime_value(t: Tables) -> DataFrame:
    return sales.customer_lifetime_value(t.customer_card, t.invoice, HIGH_VALUE, MEDIUM_VALUE)


SUMMARIES = {
    "artist_sales_summary": (_artist_sales, ["ArtistId"]),
    "genre_popularity": (_genre_popularity, ["GenreId"]),
    "customer_lifetime_value": (_lifetime_value, ["CustomerId"]),
}


def _summary(t: Tables, name: str) -> sync.SummaryTable:
    build, sort = SUMMARIES[name]
    return sync.SummaryTable(t.spark, fresh_path(t.spark, name), lambda: build(t), sort)


def _stored(t: Tables, name: str) -> DataFrame:
    summary = _summary(t, name)
    summary.refresh()
    return summary.read()


def _rounded_mean(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_order_value", F.round("avg_order_value", 6))


QUERIES["mv_1_artist_sales"] = _artist_sales
QUERIES["mv_2_genre_popularity"] = _genre_popularity


@query("mv_2_genre_popularity_unweighted")
def _(t: Tables) -> DataFrame:
    return sales.genre_popularity(*_by_genre(t), weighted=False)


@query("mv_3_customer_lifetime_value")
def _(t: Tables) -> DataFrame:
    return _rounded_mean(_lifetime_value(t))


@query("mv_4_refresh_all")
def _(t: Tables) -> DataFrame:
    summaries = {name: _summary(t, name) for name in SUMMARIES}
    refreshed = sync.refresh_all(summaries)
    parts = [
        summaries[name].read().agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("summary"), "row_count", F.lit(done.rows).cast("long").alias("rows_written")
        )
        for name, done in refreshed.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("mv_4_incremental")
def _(t: Tables) -> DataFrame:
    """Lifetime value from a state that was given the older invoices, then inserts, updates and deletes, the last twice."""
    invoice = t.invoice.select("CustomerId", "InvoiceDate", "Total")
    keys = {"CustomerId": invoice.schema["CustomerId"].dataType.simpleString(), "InvoiceDate": invoice.schema["InvoiceDate"].dataType.simpleString()}
    totals = maintained.MaintainedTotals(t.spark, fresh_path(t.spark, "order_totals"), keys, {"Total": "decimal(28,2)"})
    older = F.col("InvoiceDate") < F.lit(CUTOFF).cast("timestamp_ntz")
    none = invoice.limit(0)
    small, large = F.col("Total") < SMALL_TOTAL, F.coalesce(F.col("Total") > LARGE_TOTAL, F.lit(False))
    totals.apply(maintained.change_images(none, invoice.where(older)), 1)
    totals.apply(maintained.change_images(none, invoice.where(~older)), 2)
    raised = F.col("Total") + F.lit(1).cast("decimal(10,2)")
    totals.apply(maintained.change_images(invoice.where(small), invoice.where(small).withColumn("Total", raised.cast("decimal(10,2)"))), 3)
    for _ in range(2):
        totals.apply(maintained.change_images(invoice.where(large), none), 4)
    orders = maintained.orders_per_customer(totals.read())
    return _rounded_mean(sales.lifetime_value(t.customer_card, orders, HIGH_VALUE, MEDIUM_VALUE))


@query("mv_5_top_artists")
def _(t: Tables) -> DataFrame:
    return sales.top_by(_stored(t, "artist_sales_summary"), "total_revenue", "ArtistId", 10)


@query("mv_5_top_genres")
def _(t: Tables) -> DataFrame:
    return sales.top_by(_stored(t, "genre_popularity"), "total_sales", "GenreId", 5)


@query("mv_5_high_value_customers")
def _(t: Tables) -> DataFrame:
    return _rounded_mean(sales.in_segment(_stored(t, "customer_lifetime_value")))


# -- sales and country functions ---------------------------------------------------------------


@query("p_1_top_artists")
def _(t: Tables) -> DataFrame:
    return sales.top_artists(*_by_artist(t), limit=10)


@query("p_2_purchase_history")
def _(t: Tables) -> DataFrame:
    return sales.purchase_history(42, t.invoice, t.part_line, t.part_track, t.part_album, t.part_artist)


@query("p_3_genre_report")
def _(t: Tables) -> DataFrame:
    return sales.genre_report(*_by_genre(t))


@query("p_4_monthly_revenue")
def _(t: Tables) -> DataFrame:
    return sales.monthly_revenue(t.invoice, 1997)


@query("p_5_countries_at_least")
def _(t: Tables) -> DataFrame:
    return countries.countries_at_least(t.country, "4.5")


@query("p_6_compare_countries")
def _(t: Tables) -> DataFrame:
    return countries.compare_countries(t.country, "Nation_3", "NATION_17")


# -- benchmark queries -------------------------------------------------------------------------


@query("b_1_artist_revenue")
def _(t: Tables) -> DataFrame:
    return sales.artist_revenue(*_by_artist(t))


@query("b_2_monthly_sales")
def _(t: Tables) -> DataFrame:
    return sales.monthly_sales(t.invoice, "1997-01-01", "1997-12-31")


@query("b_3_sales_by_country")
def _(t: Tables) -> DataFrame:
    return _rounded_mean(sales.sales_by_country(t.customer_card, t.invoice))


@query("b_4_genre_performance")
def _(t: Tables) -> DataFrame:
    return sales.genre_performance(*_by_genre(t))


@query("b_5_direct")
def _(t: Tables) -> DataFrame:
    return sales.artist_revenue_all(*_by_artist(t))


@query("b_5_stored")
def _(t: Tables) -> DataFrame:
    top = sales.top_by(_stored(t, "artist_sales_summary"), "total_revenue", "ArtistId", 10)
    return top.select("artist_name", "total_albums", "total_revenue")


@query("b_6_genre_track_counts")
def _(t: Tables) -> DataFrame:
    return sales.genre_track_counts(t.genre, t.part_track)


@query("b_7_countries_above")
def _(t: Tables) -> DataFrame:
    return countries.countries_above(t.country, "4.5")


@query("b_8_benchmark_run")
def _(t: Tables) -> DataFrame:
    """The benchmark suite run over the whole tables: rows and status of each query."""
    names = ["b_1_artist_revenue", "b_3_sales_by_country", "b_6_genre_track_counts", "b_7_countries_above"]
    suite = {name: lambda name=name: QUERIES[name](t) for name in names}
    suite["missing_table"] = lambda: t.given("absent")
    return jobs.run_benchmark(t.spark, suite).select("name", "status", "result_rows")


# -- incremental sync --------------------------------------------------------------------------


def _customer_orders(t: Tables, first: bool) -> tuple[KeyedTable, DataFrame]:
    """A table of one stored order per customer, and the orders that come in."""
    old, new = _history(t)
    pick = first_per_key if first else latest_per_key
    columns = ["o_custkey", "o_orderkey", "o_orderstatus", "day"]
    table = KeyedTable(t.spark, fresh_path(t.spark, "orders"), ["o_custkey"])
    table.replace(pick(old.select(*columns), ["o_custkey"], "o_orderkey"))
    return table, new.select(*columns)


@query("inc_1_upsert")
def _(t: Tables) -> DataFrame:
    table, incoming = _customer_orders(t, first=False)
    table.upsert(incoming, "o_orderkey")
    return table.current()


@query("inc_2_insert_ignore")
def _(t: Tables) -> DataFrame:
    table, incoming = _customer_orders(t, first=True)
    change = table.insert_ignore(incoming, "o_orderkey")
    return table.current().withColumn("inserted", F.lit(change.inserted).cast("long"))


@query("inc_3_sync_runs")
def _(t: Tables) -> DataFrame:
    table, incoming = _customer_orders(t, first=False)
    log = sync.SyncLog(t.spark, fresh_path(t.spark, "sync_log"))

    def fail() -> int:
        raise RuntimeError("source not reachable")

    jobs.run_incremental(log, "orders", table, incoming, "o_orderkey", {})
    try:
        log.run("customer", "batch", fail)
    except RuntimeError:
        pass
    return log.read().drop("started_at", "completed_at", "source_until")


@query("inc_4_last_sync")
def _(t: Tables) -> DataFrame:
    return sync.last_sync(t.sync_log)


@query("inc_4_delta")
def _(t: Tables) -> DataFrame:
    """Events after the last successful sync of one table."""
    return sync.delta(t.given("events"), "ts", t.sync_log, "table_3").select("event_id", "ts", "event_type")


@query("inc_4_run")
def _(t: Tables) -> DataFrame:
    """Two runs that read their own delta: the source's older part first, then all of it."""
    place = F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 100 + F.col("o_orderkey") % 100
    orders = t.given("orders").select("o_custkey", "o_orderkey", "o_orderdate", place.alias("place"))
    table = sinks.empty_table(t.spark, fresh_path(t.spark, "orders"), ["o_custkey"], orders.drop("place").schema.simpleString().removeprefix("struct<").removesuffix(">"))
    log = sync.SyncLog(t.spark, fresh_path(t.spark, "sync_log"))
    jobs.run_delta(log, "orders", table, orders.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")), "o_orderdate", "place", {})
    jobs.run_delta(log, "orders", table, orders, "o_orderdate", "place", {})
    return table.current().drop("o_orderkey")


@query("inc_5_sync_history")
def _(t: Tables) -> DataFrame:
    return sync.sync_history(t.sync_log, 10)


@query("inc_6_delete")
def _(t: Tables) -> DataFrame:
    table = KeyedTable(t.spark, fresh_path(t.spark, "customer"), ["c_custkey"])
    table.replace(t.given("customer"))
    table.delete_where(F.col("c_acctbal") < 0)
    return table.current()


# -- streams -----------------------------------------------------------------------------------


TURNS, FILES_A_TURN = 4, 4


def _in_turns(t: Tables, rows: DataFrame, order: str) -> DataFrame:
    """The rows as a stream of several micro-batches in ascending order, each of several files; NULLs come first."""
    folder = fresh_path(t.spark, "stream")
    bounds = rows.approxQuantile(order, [k / TURNS for k in range(1, TURNS)], 0.001)
    for k, (low, high) in enumerate(zip([None, *bounds], [*bounds, None])):
        part = rows if low is None else rows.where(F.col(order) > low)
        part = part if high is None else part.where((F.col(order) <= high) | (F.col(order).isNull() if low is None else F.lit(False)))
        part.repartition(FILES_A_TURN).write.parquet(f"{folder}/{k:03d}")
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES_A_TURN).parquet(f"{folder}/*")


@query("str_1_registration")
def _(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "registration")
    outcomes = registration.OutcomeLog(t.spark, f"{root}/outcomes")
    stream = registration.RegistrationStream(outcomes, _student_table(t), t.registry, AS_OF)
    events = t.requests.withColumn("event_seq", F.col("seq")).withColumnRenamed("seq", "row_id")
    stream.start(_in_turns(t, events, "event_seq"), f"{root}/checkpoint").awaitTermination()
    return outcomes.latest().select("row_id", "status", "message", "student_email")


@query("str_2_first_events")
def _(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "first_events")
    schema = "user_id long, event_id long, event_type string"
    table = sinks.empty_table(t.spark, f"{root}/table", ["user_id"], schema)
    events = t.given("events").select("user_id", "event_id", "event_type")
    registration.keep_first(_in_turns(t, events, "event_id"), table, "event_id", f"{root}/checkpoint").awaitTermination()
    return table.current()


def _timed(rows: DataFrame) -> DataFrame:
    """Rows with their time in microseconds as well, by which they come in turns."""
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("at", F.unix_micros("ts"))


@query("str_2_repeats")
def _(t: Tables) -> DataFrame:
    """One event per user and day, the others suppressed by event time."""
    root = fresh_path(t.spark, "repeats")
    events = _timed(t.given("events").select("user_id", "ts").where("ts IS NOT NULL")).withColumn("day", F.to_date("ts"))
    found = registration.start_repeats(_in_turns(t, events, "at"), ["user_id", "day"], "ts", f"{root}/events", f"{root}/checkpoint")
    found.awaitTermination()
    return t.spark.read.schema("user_id long, day date").parquet(f"{root}/events")


@query("str_3_error_digest")
def _(t: Tables) -> DataFrame:
    """Days that the stream has closed, and the open ones counted from their records."""
    root = fresh_path(t.spark, "digest")
    records = _timed(t.status_records)
    digest.start_closed_days(_in_turns(t, records, "at"), f"{root}/days", f"{root}/checkpoint").awaitTermination()
    return digest.digest_so_far(digest.closed_days(t.spark, f"{root}/days"), records)


@query("str_3_closed_days")
def _(t: Tables) -> DataFrame:
    """What the stream itself has written: every day that ended a day before the newest record."""
    root = fresh_path(t.spark, "closed_days")
    digest.start_closed_days(_in_turns(t, _timed(t.status_records), "at"), f"{root}/days", f"{root}/checkpoint").awaitTermination()
    return digest.closed_days(t.spark, f"{root}/days")


@query("str_3_digest_counts")
def _(t: Tables) -> DataFrame:
    return digest.digest_counts(t.status_records)


@query("str_3_digest_lines")
def _(t: Tables) -> DataFrame:
    return digest.digest_lines(t.status_records)


@query("str_4_pending_flow")
def _(t: Tables) -> DataFrame:
    pending = readers.read_pending(t.spark, _envelopes(t), multi_line=False)
    order = F.unix_seconds(F.to_timestamp("exportedAt")) * 1000 + F.col("position")
    table = _student_table(t)
    jobs.run_pending(pending.withColumn("seq", order), t.registry, table, AS_OF)
    return table.current().drop("student_id")


# -- described by the documentation ------------------------------------------------------------


@query("doc_1_regional_averages")
def _(t: Tables) -> DataFrame:
    return countries.regional_averages(t.country, t.country_regions)


@query("doc_2_album_details")
def _(t: Tables) -> DataFrame:
    return sales.album_details(42, t.album, t.track, t.artist)


@query("doc_3_indexed")
def _(t: Tables) -> DataFrame:
    """The same search over a stored index."""
    return layouts.index_tracks(t.part_track, fresh_path(t.spark, "track_index")).search("RING blue")


@query("doc_3_search_tracks")
def _(t: Tables) -> DataFrame:
    return sales.search_tracks(t.part_track, "RING blue")
