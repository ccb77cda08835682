"""Validation jobs: tag every record with a verdict, then split.

Duplicates are found without a window. A window would sort all copies of one key in one task; here the
first sequence value per key is a map-side minimum, and it returns to its record by joining on the
sequence itself, which is unique. A key that holds a third of all records therefore costs no more than
any other. The sequence column has to be unique and to follow the input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions import cleaning as clean
from rosterline.functions.dates import MIN_AGE_YEARS, age_by_days, old_enough, parse_date
from rosterline.session import fresh_path


def first_values(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The lowest sequence value of each key."""
    return df.groupBy(*keys).agg(F.min(seq).alias(seq))


def mark(df: DataFrame, values: DataFrame, seq: str, name: str) -> DataFrame:
    """Add ``name``: true on the records whose sequence value is listed."""
    marked = df.join(values.select(seq, F.lit(True).alias(name)), seq, "left")
    return marked.withColumn(name, F.coalesce(name, F.lit(False)))


def spread(raw: DataFrame, seq: str) -> DataFrame:
    """Raw records hashed by their sequence value before they are cleaned.

    This is the shuffle that ``mark`` needs anyway, moved ahead of the costly expressions: the cores
    then share them even when the input is one large file that cannot be split.
    """
    return raw.repartition(seq)


def _tag(df: DataFrame, name: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """First failing rule as ``name``; NULL for records that pass them all."""
    verdict = F.when(rules[0][1], F.lit(rules[0][0]))
    for reason, failed in rules[1:]:
        verdict = verdict.when(failed, F.lit(reason))
    return df.withColumn(name, verdict)


STUDENT_COLUMNS = (
    "student_first_name",
    "student_last_name",
    "student_email",
    "student_date_of_birth",
    "student_year",
    "student_phone_number",
    "department_id",
)
ENROLLMENT_COLUMNS = ("student_id", "course_id", "grade", "enrollment_date")


def normalize_students(raw: DataFrame, seq: str) -> DataFrame:
    """The cleaned fields of raw student records, under whichever spelling each field arrived."""
    first, last = clean.column_or_null(raw, "first_name"), clean.column_or_null(raw, "last_name")
    first_camel, last_camel = clean.column_or_null(raw, "firstName"), clean.column_or_null(raw, "lastName")
    whole = clean.column_or_null(raw, "name")
    split_pair = clean.filled(first) & clean.filled(last)
    camel_pair = clean.filled(first_camel) & clean.filled(last_camel)

    def pick(plain: Column, camel: Column, from_whole: Column) -> Column:
        return (
            F.when(split_pair, clean.clean_text(plain))
            .when(camel_pair, clean.clean_text(camel))
            .when(clean.filled(whole), from_whole)
        )

    email = clean.field(raw, "email")
    return raw.select(
        seq,
        clean.normalize_email(email).alias("student_email"),
        clean.is_email(email).alias("email_ok"),
        clean.parse_year(clean.field(raw, "year")).alias("student_year"),
        parse_date(clean.field(raw, "date_of_birth")).alias("student_date_of_birth"),
        clean.normalize_phone(clean.field(raw, "phone_number")).alias("student_phone_number"),
        clean.standard_department(clean.field(raw, "department")).alias("department_name"),
        (split_pair | camel_pair | clean.filled(whole)).alias("has_name"),
        pick(first, first_camel, clean.first_name_of(whole)).alias("student_first_name"),
        F.coalesce(pick(last, last_camel, clean.last_name_of(whole)), F.lit("")).alias("student_last_name"),
    )


def tag_students(raw: DataFrame, department: DataFrame, as_of=None, seq: str = "seq") -> DataFrame:
    """Cleaned students plus ``reject_reason``, the first check that failed.

    The duplicate check comes right after the e-mail check, so a first record that fails later still
    blocks its copies.
    """
    mailed = normalize_students(raw, seq).filter("email_ok")
    rows = normalize_students(spread(raw, seq), seq)
    rows = mark(rows, first_values(mailed, ["student_email"], seq), seq, "is_first")
    rows = rows.join(department.select("department_name", "department_id"), "department_name", "left")
    return _tag(
        rows,
        "reject_reason",
        [
            ("invalid_email", ~F.col("email_ok")),
            ("duplicate_email", ~F.col("is_first")),
            ("invalid_year", ~clean.is_year(F.col("student_year"))),
            (
                "invalid_date_of_birth",
                ~F.coalesce(old_enough(F.col("student_date_of_birth"), as_of), F.lit(False)),
            ),
            ("invalid_phone", ~clean.is_phone(F.col("student_phone_number"))),
            ("unknown_department", F.col("department_name").isNull()),
            ("department_not_found", F.col("department_id").isNull()),
            ("missing_name", ~F.col("has_name")),
            ("missing_first_name", F.col("student_first_name").isNull()),
        ],
    ).select(seq, *STUDENT_COLUMNS, "reject_reason")


def split(tagged: DataFrame, columns: tuple[str, ...], seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a tagged frame."""
    passed = F.col("reject_reason").isNull()
    return tagged.filter(passed).select(seq, *columns), tagged.filter(~passed).select(seq, "reject_reason")


def transform_students(raw: DataFrame, department: DataFrame, as_of=None, seq: str = "seq"):
    return split(tag_students(raw, department, as_of, seq), STUDENT_COLUMNS, seq)


def normalize_enrollments(raw: DataFrame, seq: str) -> DataFrame:
    """The cleaned fields of raw enrollment records."""
    return raw.select(
        seq,
        clean.normalize_email(F.col("student_email")).alias("student_email"),
        clean.clean_text(F.col("course_code")).alias("course_id"),
        clean.clean_text(F.col("grade")).alias("grade_text"),
        parse_date(F.col("enrollment_date")).alias("enrollment_date"),
    )


def tag_enrollments(raw: DataFrame, student: DataFrame, course: DataFrame, seq: str = "seq") -> DataFrame:
    """Resolved enrollments plus ``reject_reason``; duplicates are judged before grade and date."""
    # All records of one (e-mail, course) resolve alike, so firsts need no lookup beforehand.
    pair = ["student_email", "course_id"]
    firsts = first_values(normalize_enrollments(raw, seq).dropna(subset=pair), pair, seq)
    rows = mark(normalize_enrollments(spread(raw, seq), seq), firsts, seq, "is_first")
    rows = rows.join(student.select("student_email", "student_id"), "student_email", "left").join(
        course.select("course_id", F.lit(True).alias("course_known")), "course_id", "left"
    )
    return _tag(
        rows.withColumn("grade", F.upper("grade_text")),
        "reject_reason",
        [
            ("student_not_found", F.col("student_id").isNull()),
            ("course_not_found", F.col("course_known").isNull()),
            ("duplicate_enrollment", ~F.col("is_first")),
            ("invalid_grade", ~clean.is_grade(F.col("grade_text"))),
            ("invalid_date", F.col("enrollment_date").isNull()),
        ],
    ).select(seq, *ENROLLMENT_COLUMNS, "reject_reason")


def transform_enrollments(raw: DataFrame, student: DataFrame, course: DataFrame, seq: str = "seq"):
    return split(tag_enrollments(raw, student, course, seq), ENROLLMENT_COLUMNS, seq)


def _collect_errors(df: DataFrame, rules: list[tuple[Column, Column]]) -> DataFrame:
    """Add ``errors``: the messages of all failed rules, in rule order."""
    return df.withColumn("errors", F.array_compact(F.array(*[F.when(failed, message) for failed, message in rules])))


def _message(text: str) -> Column:
    return F.lit(text)


def pending_errors(pending: DataFrame) -> DataFrame:
    """All errors of each pending registration; a row is valid when it has none."""
    year = clean.number(F.col("year").cast("string"))
    email = F.col("email")
    # The messages.
    required = [
        (~clean.filled(F.col(name)), _message(f"Missing {name}")) for name in ("firstName", "lastName", "email")
    ]
    no_year = ~clean.filled(F.col("year").cast("string")) | F.coalesce(year == 0, F.lit(False))
    return _collect_errors(
        pending,
        required
        + [
            (no_year, _message("Missing year")),
            (~clean.filled(F.col("department")), _message("Missing department")),
            (clean.filled(email) & ~F.contains(email, F.lit("@")), _message("Invalid email format")),
            (~no_year & ((year < 1) | (year > 4)), _message("Year must be between 1 and 4")),
        ],
    )


def validate_pending(pending: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) pending registrations; the invalid ones keep their errors."""
    judged = pending_errors(pending)
    valid = judged.filter(F.size("errors") == 0).drop("errors")
    return valid, judged.filter(F.size("errors") > 0)


# Registration requests carry these fields as text; VAL-6 waits until all of them are filled.
REQUEST_FIELDS = ("firstName", "lastName", "email", "dateOfBirth", "year", "phoneNumber", "department")


def is_complete() -> Column:
    """True where every field of a request is non-blank."""
    return F.forall(
        F.array(*[F.col(f).cast("string") for f in REQUEST_FIELDS]),
        lambda value: F.coalesce(clean.trim_text(value) != "", F.lit(False)),
    )


def split_complete(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(complete, incomplete): an incomplete request waits, it is neither valid nor rejected."""
    return requests.filter(is_complete()), requests.filter(~is_complete())


def service_rules(as_of=None) -> list[tuple[Column, Column]]:
    """The registration service's checks."""
    born = parse_date(F.col("dateOfBirth"))
    unknown = F.concat(F.lit("Unknown department: "), F.coalesce("department", F.lit("")))
    # The messages.
    return [
        (clean.clean_text(F.col("firstName")).isNull(), _message("First name is required")),
        (clean.clean_text(F.col("lastName")).isNull(), _message("Last name is required")),
        (~clean.is_email(F.col("email")), _message("Invalid email format")),
        (
            ~F.coalesce(old_enough(born, as_of), F.lit(False)),
            _message("Invalid date of birth or student under 16 years old"),
        ),
        (~clean.is_year(clean.parse_year(F.col("year"))), _message("Year must be between 1 and 4")),
        (~clean.is_phone(clean.normalize_phone(F.col("phoneNumber"))), _message("Invalid phone number format")),
        (clean.standard_department(F.col("department")).isNull(), unknown),
    ]


def sheet_rules(as_of=None) -> list[tuple[Column, Column]]:
    """The stricter checks made before a record is submitted: 365.25-day age, 10 to 15 phone digits."""
    year, phone = clean.number(F.col("year")), F.col("phoneNumber")
    age = age_by_days(parse_date(F.col("dateOfBirth")), as_of)
    digits = F.regexp_replace(phone, rf"[{clean.BLANKS}+\-]", "")
    has_phone = clean.clean_text(phone).isNotNull()
    # The messages.
    young = F.format_string(f"Student must be at least {MIN_AGE_YEARS} years old (currently %d)", age)
    short = F.format_string("phoneNumber must have 10-15 digits (got %d)", F.length(digits))
    return [
        (clean.clean_text(F.col("firstName")).isNull(), _message("firstName is required")),
        (clean.clean_text(F.col("lastName")).isNull(), _message("lastName is required")),
        (~F.coalesce(F.col("email").rlike(clean.EMAIL_PATTERN), F.lit(False)), _message("Valid email required")),
        (~clean.filled(F.col("dateOfBirth")), _message("dateOfBirth is required")),
        (age < MIN_AGE_YEARS, young),
        (~F.coalesce(year.between(1, 4), F.lit(False)), _message("year must be 1-4")),
        (~has_phone, _message("phoneNumber is required")),
        (has_phone & ~digits.rlike(r"^[0-9]{10,15}$"), short),
        (clean.clean_text(F.col("department")).isNull(), _message("department is required")),
    ]


def sheet_errors(requests: DataFrame, as_of=None) -> DataFrame:
    return _collect_errors(requests, sheet_rules(as_of))


def shape_requests(requests: DataFrame) -> DataFrame:
    """Fields in the form in which a checked record is submitted."""
    return requests.select(
        *[c for c in requests.columns if c not in REQUEST_FIELDS],
        clean.trim_text(F.col("firstName")).alias("firstName"),
        clean.trim_text(F.col("lastName")).alias("lastName"),
        F.lower(clean.trim_text(F.col("email"))).alias("email"),
        F.coalesce(F.date_format(parse_date(F.col("dateOfBirth")), "yyyy-MM-dd"), "dateOfBirth").alias("dateOfBirth"),
        clean.parse_year(F.col("year")).cast("string").alias("year"),
        clean.trim_text(F.col("phoneNumber")).alias("phoneNumber"),
        clean.trim_text(F.col("department")).alias("department"),
    )


def _judge(requests: DataFrame, department: DataFrame, as_of, seq: str) -> DataFrame:
    """The cleaned fields of requests with their errors and the department they name."""
    judged = _collect_errors(requests, service_rules(as_of)).select(
        seq,
        "errors",
        clean.clean_text(F.col("firstName")).alias("student_first_name"),
        clean.clean_text(F.col("lastName")).alias("student_last_name"),
        clean.normalize_email(F.col("email")).alias("student_email"),
        parse_date(F.col("dateOfBirth")).alias("student_date_of_birth"),
        clean.parse_year(F.col("year")).alias("student_year"),
        clean.normalize_phone(F.col("phoneNumber")).alias("student_phone_number"),
        clean.standard_department(F.col("department")).alias("department_name"),
    )
    return judged.join(department.select("department_name", "department_id"), "department_name", "left")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register(
    requests: DataFrame, department: DataFrame, existing: DataFrame, as_of=None, seq: str = "seq"
) -> DataFrame:
    """Judge registration requests: 400 with all errors, 409 for a known e-mail, 201 with the clean row.

    The first valid request for a new e-mail is created and its copies get 409. Only the winning sequence
    values travel back to the requests. Requests are judged once and written; what follows reads that.
    """
    judged = _written(_judge(spread(requests, seq), department, as_of, seq), "judged-requests")
    acceptable = (F.size("errors") == 0) & F.col("department_id").isNotNull()
    firsts = first_values(judged.filter(acceptable), ["student_email"], seq)
    winners = firsts.join(existing.select("student_email").distinct(), "student_email", "left_anti")
    missing = F.format_string('Department "%s" not found in database', "department_name")
    status = (
        F.when(F.size("errors") > 0, F.lit(400))
        .when(F.col("department_id").isNull(), F.lit(400))
        .when(F.col("created"), F.lit(201))
        .otherwise(F.lit(409))
    )
    # The messages.
    errors = (
        F.when(F.size("errors") > 0, F.col("errors"))
        .when(F.col("department_id").isNull(), F.array(missing))
        .when(F.col("status_code") == 409, F.array(F.lit("Student with this email already exists")))
        .otherwise(F.array().cast("array<string>"))
    )
    return (
        mark(judged, winners, seq, "created")
        .withColumn("status_code", status)
        .withColumn("errors", errors)
        .select(seq, "status_code", "errors", *STUDENT_COLUMNS)
    )


def sheet_status(status_code: Column, invalid: Column) -> Column:
    """Status shown for a record: a 409 answer counts as registered."""
    return (
        F.when(invalid, F.lit("Invalid"))
        .when(status_code.isin(201, 409), F.lit("Registered"))
        .otherwise(F.lit("Error"))
    )


def not_yet_registered(requests: DataFrame, statuses: DataFrame, key: str) -> DataFrame:
    """Drop requests whose record already has the status Registered."""
    done = statuses.filter(F.col("status") == "Registered").select(key).distinct()
    return requests.join(done, key, "left_anti")


def submit(
    requests: DataFrame, department: DataFrame, existing: DataFrame, as_of=None, seq: str = "seq"
) -> DataFrame:
    """Sheet flow for complete requests: strict checks, shaping, registration, then the shown status."""
    checked = sheet_errors(requests, as_of)
    invalid = checked.filter(F.size("errors") > 0).select(
        seq, F.lit("Invalid").alias("status"), F.array_join("errors", "; ").alias("message")
    )
    sent = shape_requests(checked.filter(F.size("errors") == 0).drop("errors"))
    answers = register(sent, department, existing, as_of, seq)
    # The messages of registered records.
    message = (
        F.when(F.col("status_code") == 201, F.lit("Registered"))
        .when(F.col("status_code") == 409, F.lit("Already in database"))
        .otherwise(F.array_join("errors", "; "))
    )
    answered = answers.select(
        seq,
        sheet_status(F.col("status_code"), F.lit(False)).alias("status"),
        message.alias("message"),
        "status_code",
        *STUDENT_COLUMNS,
    )
    return answered.unionByName(invalid, allowMissingColumns=True)


def run_statistics(tagged: DataFrame, job: str = "students") -> DataFrame:
    """Records per outcome: extracted, transformed, skipped, and skipped by reason."""
    reasons = tagged.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("records")
    )
    return reasons.select(F.lit(job).alias("job"), "outcome", "records")


def run_totals(tagged: DataFrame, job: str = "students") -> DataFrame:
    passed = F.col("reject_reason").isNull()
    return tagged.agg(
        F.count("*").alias("extracted"),
        F.count_if(passed).alias("transformed"),
        F.count_if(~passed).alias("skipped"),
    ).select(F.lit(job).alias("job"), "*")
