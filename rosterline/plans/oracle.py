"""The registered queries in plain SQL, for a check by another engine.

Each text starts from the derived input columns of the binding and states the result in its own way:
windows where the jobs aggregate, direct joins where the jobs roll up, integer arithmetic where the jobs
use decimals. Queries whose result depends on files or runs are stated as the table they must leave.
"""

from __future__ import annotations

import re

from rosterline.functions.cleaning import DEPARTMENT_SPELLINGS, YEAR_WORDS
from rosterline.functions.grades import GRADE_POINTS, GRADES
from rosterline.operators.countries import METRICS
from rosterline.plans.binding import AS_OF, EXPRESSIONS, FLAWED_GRADE, LINE_GRADE
from rosterline.plans.catalog import CUTOFF, GIVEN, HIGH_VALUE, LARGE_TOTAL, MEDIUM_VALUE, ONE_EMAIL, SMALL_TOTAL

BL = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160))"
LETTERS = ", ".join(f"'{g}'" for g in GRADES)


def half_up(num: str, den: str, digits: int) -> str:
    """num / den for non-negative integers, rounded half up without a binary fraction."""
    scale = 10**digits
    return f"(CASE WHEN ({den}) > 0 THEN ((2 * ({num}) * {scale} + ({den})) // (2 * ({den}))) / {scale}.0 END)"


def points(grade: str = "grade") -> str:
    """Grade points in hundredths."""
    arms = " ".join(f"WHEN '{g}' THEN {p.replace('.', '').lstrip('0') or 0}" for g, p in GRADE_POINTS.items())
    return f"(CASE {grade} {arms} END)"


def gpa(grade: str = "grade") -> str:
    return half_up(f"sum({points(grade)})", f"100 * count({points(grade)})", 2)


def cents(column: str) -> str:
    return f"CAST({column} * 100 AS BIGINT)"


def money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def trimmed(column: str) -> str:
    return f"trim({column}, {BL})"


def email(column: str) -> str:
    return f"nullif(lower({trimmed(column)}), '')"


def email_ok(column: str) -> str:
    shape = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"
    return f"coalesce(regexp_matches({trimmed(column)}, '{shape}'), false)"


def parsed_year(column: str) -> str:
    words = " ".join(f"WHEN '{word}' THEN {value}" for word, value in YEAR_WORDS.items())
    t = trimmed(column)
    return f"coalesce(TRY_CAST(regexp_extract({t}, '^([+-]?[0-9]+)', 1) AS INT), CASE lower({t}) {words} END)"


def parsed_date(column: str) -> str:
    t = trimmed(column)
    return (
        f"CAST(CASE WHEN regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(T.*)?$') "
        f"THEN try_strptime(substring({t}, 1, 10), '%Y-%m-%d') "
        f"WHEN regexp_matches({t}, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$') THEN try_strptime({t}, '%d/%m/%Y') "
        f"ELSE try_strptime({t}, '%b %d, %Y') END AS DATE)"
    )


def dept(column: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DEPARTMENT_SPELLINGS.items())
    return f"(CASE lower({trimmed(column)}) {arms} END)"


def phone(column: str) -> str:
    kept = f"trim(regexp_replace({column}, '[^0-9+ -]', '', 'g'))"
    digits = f"regexp_replace({column}, '[^0-9]', '', 'g')"
    return f"(CASE WHEN length({digits}) = 10 THEN '+91-' || {digits} ELSE {kept} END)"


def phone_ok(expr: str) -> str:
    return f"regexp_matches({expr}, '^[0-9+ -]{{7,20}}$')"


def old(expr: str, as_of: str = AS_OF) -> str:
    return f"(({expr}) <= DATE '{as_of}' - INTERVAL 16 YEAR)"


def grade_ok(column: str) -> str:
    return f"(coalesce({column}, '') = '' OR upper({trimmed(column)}) IN ({LETTERS}))"


def first_of(column: str) -> str:
    return f"nullif(string_split_regex({trimmed(column)}, '\\s+')[1], '')"


def last_of(column: str) -> str:
    return f"array_to_string(string_split_regex({trimmed(column)}, '\\s+')[2:], ' ')"


def _derived(name: str) -> str:
    source, columns = EXPRESSIONS[name]
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source}"


def _lines(grade: str) -> str:
    return (
        "SELECT l_orderkey * 10 + l_linenumber AS enrollment_id, CAST(o_orderdate AS DATE) AS enrollment_date, "
        f"o_custkey AS student_id, 'S' || CAST(l_suppkey AS STRING) AS course_id, {grade} AS grade "
        "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
    )


FULL_NAME = "s.student_first_name || ' ' || s.student_last_name"

CTES = {name: _derived(name) for name in EXPRESSIONS if name not in ("sync_log",)}
CTES |= {
    "sync_log": _derived("sync_log")
    .replace("SELECT ", "SELECT CASE WHEN event_type <> 'view' THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS completed_at, ", 1),
    "department": (
        "SELECT n_nationkey AS department_id, n_name AS department_name, r_name AS department_head "
        "FROM nation JOIN region ON n_regionkey = r_regionkey"
    ),
    "enrollment": _lines(LINE_GRADE),
    "flawed_enrollment": _lines(FLAWED_GRADE),
    "part_album": (
        "SELECT DISTINCT CAST(substring(p_brand, 7) AS INT) AS AlbumId, p_brand AS Title, "
        "CAST(substring(p_brand, 7) AS INT) % 5 AS ArtistId FROM part"
    ),
    "part_artist": "SELECT DISTINCT ArtistId, 'Maker ' || CAST(ArtistId AS STRING) AS Name FROM part_album",
    "genre": "SELECT DISTINCT p_type AS GenreId, p_type AS Name FROM part",
    "country": (
        "SELECT n_nationkey + 1 AS overall_rank, n_name AS country_or_region, "
        "CAST(" + half_up("c_sum", "100000 * c_count", 2) + " AS DECIMAL(5,2)) AS score, "
        "CAST(c_max AS DECIMAL(10,2)) AS gdp_per_capita, CAST(s_count AS DECIMAL(10,2)) AS social_support, "
        "CAST(s_sum AS DECIMAL(10,2)) AS healthy_life_expectancy, "
        "CAST(c_count - c_debtors AS DECIMAL(10,2)) AS freedom_to_make_life_choices, "
        "CAST(c_min AS DECIMAL(10,2)) AS generosity, CAST(c_debtors AS DECIMAL(10,2)) AS perceptions_of_corruption "
        "FROM nation LEFT JOIN (SELECT c_nationkey, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS c_sum, "
        "max(CAST(c_acctbal AS DECIMAL(18,2))) AS c_max, min(CAST(c_acctbal AS DECIMAL(18,2))) AS c_min, "
        "count(*) AS c_count, count(*) FILTER (c_acctbal < 0) AS c_debtors FROM customer GROUP BY 1) "
        "ON n_nationkey = c_nationkey LEFT JOIN (SELECT s_nationkey, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS s_sum, "
        "count(*) AS s_count FROM supplier GROUP BY 1) ON n_nationkey = s_nationkey"
    ),
    "clean_students": (
        "SELECT seq, nullif(email, '') AS e1, coalesce(nullif(email, ''), nullif(student_email, '')) AS raw_email, "
        f"{email('raw_email')} AS student_email, {email_ok('raw_email')} AS email_ok, "
        f"{parsed_year('year')} AS student_year, {parsed_date('date_of_birth')} AS student_date_of_birth, "
        f"{phone('phone_number')} AS student_phone_number, {dept('department')} AS department_name, "
        "first_name <> '' AND last_name <> '' AS pair, pair OR name <> '' AS has_name, "
        f"CASE WHEN pair THEN {trimmed('first_name')} WHEN name <> '' THEN {first_of('name')} END AS student_first_name, "
        f"coalesce(CASE WHEN pair THEN {trimmed('last_name')} WHEN name <> '' THEN {last_of('name')} END, '') "
        "AS student_last_name FROM raw_students"
    ),
}


def tagged_students(as_of: str = AS_OF, source: str = "clean_students") -> str:
    return (
        "SELECT c.seq, c.student_first_name, c.student_last_name, c.student_email, c.student_date_of_birth, "
        "c.student_year, c.student_phone_number, d.department_id, CASE "
        "WHEN NOT email_ok THEN 'invalid_email' "
        "WHEN row_number() OVER (PARTITION BY c.student_email, email_ok ORDER BY c.seq) > 1 THEN 'duplicate_email' "
        "WHEN student_year IS NULL OR student_year NOT BETWEEN 1 AND 4 THEN 'invalid_year' "
        f"WHEN NOT coalesce({old('student_date_of_birth', as_of)}, false) THEN 'invalid_date_of_birth' "
        f"WHEN NOT coalesce({phone_ok('student_phone_number')}, false) THEN 'invalid_phone' "
        "WHEN c.department_name IS NULL THEN 'unknown_department' "
        "WHEN d.department_id IS NULL THEN 'department_not_found' "
        "WHEN NOT has_name THEN 'missing_name' "
        "WHEN student_first_name IS NULL THEN 'missing_first_name' END AS reject_reason "
        f"FROM {source} c LEFT JOIN registry d ON c.department_name = d.department_name"
    )


CTES["tagged_students"] = tagged_students()


def tagged_enrollments(student: str = "student", raw: str = "raw_enrollments") -> str:
    return (
        "SELECT r.seq, s.student_id, c.course_id AS known_course, "
        f"nullif({trimmed('r.course_code')}, '') AS course_id, upper({trimmed('r.grade')}) AS grade_text, "
        f"{parsed_date('r.enrollment_date')} AS enrollment_date, CASE "
        "WHEN s.student_id IS NULL THEN 'student_not_found' WHEN c.course_id IS NULL THEN 'course_not_found' "
        "WHEN row_number() OVER (PARTITION BY s.student_id, c.course_id ORDER BY r.seq) > 1 THEN 'duplicate_enrollment' "
        f"WHEN NOT {grade_ok('r.grade')} THEN 'invalid_grade' "
        f"WHEN {parsed_date('r.enrollment_date')} IS NULL THEN 'invalid_date' END AS reject_reason "
        f"FROM {raw} r LEFT JOIN {student} s ON s.student_email = {email('r.student_email')} "
        f"LEFT JOIN course c ON c.course_id = {trimmed('r.course_code')}"
    )


CTES["tagged_enrollments"] = tagged_enrollments()
ORACLE: dict[str, str] = {}


def _needs(text: str) -> list[str]:
    """The CTEs a text uses, directly or through others, in definition order."""
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in CTES:
            if name in words and name not in found:
                found.add(name)
                todo.append(CTES[name])
    return [name for name in CTES if name in found]


def _order(names: list[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        for other in _needs(CTES[name]):
            if other != name and other not in done:
                visit(other)
        if name not in done:
            done.append(name)

    for name in names:
        visit(name)
    return done


def oracle(name: str, body: str) -> None:
    used = _order(_needs(body))
    head = "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in used) + " " if used else ""
    ORACLE[name] = head + body


def nulled(column: str) -> str:
    return f"nullif({trimmed(column)}, '') AS {column}"


RAW_COLUMNS = "student_id first_name last_name email date_of_birth year phone_number department".split()
REQUEST_COLUMNS = "firstName lastName email dateOfBirth year phoneNumber department".split()

# -- sources and sinks
oracle("src_1_csv", "SELECT " + ", ".join(nulled(c) for c in RAW_COLUMNS) + " FROM raw_students")
oracle(
    "src_1_rejects",
    "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer, "
    "CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey || ',' || o_orderstatus END AS reject FROM orders",
)
for _key in ("src_2_array", "src_2_single"):
    oracle(_key, "SELECT student_id, name, email, year FROM raw_students")
oracle("src_2_json", "SELECT student_id, name, email, year FROM raw_students")
oracle(
    "src_3_by_extension",
    f"SELECT k.kind, student_id, {nulled('year')} FROM raw_students, (VALUES ('csv'), ('json')) k(kind)",
)
oracle(
    "src_4_all_inputs",
    f"SELECT 'students' AS input, student_id AS id, nullif({trimmed('first_name')}, '') AS label FROM raw_students "
    f"UNION ALL SELECT 'enrollments', enrollment_id, nullif({trimmed('student_email')}, '') FROM raw_enrollments "
    "UNION ALL SELECT 'departments', CAST(department_id AS VARCHAR), department_name FROM registry "
    "UNION ALL SELECT 'courses', course_id, course_name FROM course",
)
oracle(
    "src_5_pending",
    "SELECT strftime(to_timestamp(seq // 100) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS \"exportedAt\", "
    "CAST(seq % 100 + 1 AS INT) AS position, " + ", ".join(f'"{c}"' for c in REQUEST_COLUMNS) + " FROM requests",
)
oracle(
    "src_6_rejects",
    "SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS id, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS status, "
    "CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS customer, "
    "CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey || chr(9) || o_orderstatus || chr(9) || 'none' END AS reject FROM orders",
)
oracle(
    "src_6_copy_text",
    "SELECT o_orderkey AS id, o_orderstatus || '\"\\' || o_orderpriority AS label, "
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS customer, o_orderdate AS stamp FROM orders",
)
STUDENT_OUT = (
    "student_first_name, student_last_name, student_email, student_date_of_birth, student_year, "
    "student_phone_number, department_id"
)
oracle(
    "snk_1_load_students",
    f"SELECT {STUDENT_OUT.replace('student_year', f'''CASE WHEN {old('student_date_of_birth', '2015-01-01')} THEN 4 ELSE student_year END AS student_year''')} "
    "FROM tagged_students WHERE reject_reason IS NULL",
)
_LATE = f"enrollment_date >= DATE '{CUTOFF}'"
oracle(
    "snk_2_load_enrollments",
    "SELECT student_id, course_id, grade, enrollment_date FROM (SELECT *, row_number() OVER (PARTITION BY student_id, "
    f"course_id ORDER BY {_LATE} DESC, enrollment_id DESC) AS rn FROM term_enrollment) WHERE rn = 1",
)
oracle(
    "snk_3_batch_insert",
    "SELECT enrollment_id AS seq, student_id, course_id, grade FROM (SELECT *, row_number() OVER (PARTITION BY "
    f"student_id, course_id ORDER BY {_LATE}, enrollment_id) AS rn FROM term_enrollment) WHERE rn = 1",
)
oracle(
    "snk_4_copy_insert",
    "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1",
)
oracle(
    "snk_5_row_counts",
    "SELECT *, coalesce(CAST(row_count AS VARCHAR), 'N/A') AS shown FROM ("
    + " UNION ALL ".join(f"SELECT '{g}' AS table_name, count(*) AS row_count FROM {g}" for g in GIVEN)
    + " UNION ALL SELECT 'absent', NULL)",
)

# -- cleaning expressions
oracle("cln_1_normalize_email", f"SELECT seq, {email('email')} AS email FROM raw_students")
oracle("cln_2_is_email", f"SELECT seq, {email_ok('email')} AS valid FROM raw_students")
oracle("cln_3_parse_year", f"SELECT seq, {parsed_year('year')} AS year FROM raw_students")
oracle(
    "cln_4_is_year", f"SELECT seq, coalesce({parsed_year('year')} BETWEEN 1 AND 4, false) AS valid FROM raw_students"
)
oracle("cln_5_department", f"SELECT seq, {dept('department')} AS department FROM raw_students")
oracle("cln_6_is_grade", f"SELECT seq, {grade_ok('grade')} AS valid FROM raw_enrollments")
oracle("cln_7_parse_date", f"SELECT seq, {parsed_date('enrollment_date')} AS day FROM raw_enrollments")
oracle("cln_8_old_enough", f"SELECT seq, {old(parsed_date('date_of_birth'))} AS valid FROM raw_students")
oracle("cln_9_normalize_phone", f"SELECT seq, {phone('phone_number')} AS phone FROM raw_students")
oracle("cln_10_is_phone", f"SELECT seq, {phone_ok(phone('phone_number'))} AS valid FROM raw_students")
oracle("cln_11_clean_text", f"SELECT seq, {nulled('first_name')} FROM raw_students")
oracle(
    "cln_12_split_name", f"SELECT seq, {first_of('name')} AS first_name, {last_of('name')} AS last_name FROM raw_students"
)
oracle(
    "cln_13_grade_points", f"SELECT enrollment_id, {points()} / 100.0 AS points FROM flawed_enrollment"
)
oracle(
    "cln_14_field_spellings",
    "SELECT seq, coalesce(nullif(email, ''), nullif(student_email, '')) AS email, nullif(year, '') AS year FROM raw_students",
)

# -- validation jobs
oracle("val_1_students", "SELECT * FROM tagged_students")
oracle(
    "val_2_enrollments",
    "SELECT seq, student_id, course_id, nullif(grade_text, '') AS grade, enrollment_date, reject_reason "
    "FROM tagged_enrollments",
)


def joined(rules: list[tuple[str, str]]) -> str:
    parts = ", ".join(f"CASE WHEN {failed} THEN {text} END" for failed, text in rules)
    return f"concat_ws('; ', {parts})"


PLAIN_NUMBER = f"TRY_CAST(CASE WHEN regexp_matches({trimmed('year')}, '^[+-]?[0-9]+([.][0-9]*)?$') THEN {trimmed('year')} END AS DOUBLE)"
NO_YEAR = f"(year = '' OR coalesce({PLAIN_NUMBER} = 0, false))"
oracle(
    "val_3_pending",
    "SELECT seq, "
    + joined(
        [
            ("firstName = ''", "'Missing firstName'"),
            ("lastName = ''", "'Missing lastName'"),
            ("email = ''", "'Missing email'"),
            (NO_YEAR, "'Missing year'"),
            ("department = ''", "'Missing department'"),
            ("email <> '' AND NOT contains(email, '@')", "'Invalid email format'"),
            (f"NOT {NO_YEAR} AND ({PLAIN_NUMBER} < 1 OR {PLAIN_NUMBER} > 4)", "'Year must be between 1 and 4'"),
        ]
    )
    + " AS errors FROM requests",
)
SERVICE = joined(
    [
        (f"{trimmed('firstName')} = ''", "'First name is required'"),
        (f"{trimmed('lastName')} = ''", "'Last name is required'"),
        (f"NOT {email_ok('email')}", "'Invalid email format'"),
        (
            f"NOT coalesce({old(parsed_date('dateOfBirth'))}, false)",
            "'Invalid date of birth or student under 16 years old'",
        ),
        (f"NOT coalesce({parsed_year('year')} BETWEEN 1 AND 4, false)", "'Year must be between 1 and 4'"),
        (f"NOT {phone_ok(phone('phoneNumber'))}", "'Invalid phone number format'"),
        (f"{dept('department')} IS NULL", "'Unknown department: ' || department"),
    ]
)
CTES["judged"] = (
    f"SELECT seq, {SERVICE} AS errors, nullif({trimmed('firstName')}, '') AS student_first_name, "
    f"nullif({trimmed('lastName')}, '') AS student_last_name, {email('email')} AS student_email, "
    f"{parsed_date('dateOfBirth')} AS student_date_of_birth, {parsed_year('year')} AS student_year, "
    f"{phone('phoneNumber')} AS student_phone_number, {dept('department')} AS wanted, d.department_id, "
    "errors = '' AND d.department_id IS NOT NULL AS acceptable "
    f"FROM requests LEFT JOIN registry d ON d.department_name = {dept('department')}"
)
CTES["known_emails"] = "SELECT DISTINCT 'user' || CAST(user_id AS STRING) || '@example.org' AS known FROM events"
CTES["answered"] = (
    "SELECT *, CASE WHEN NOT acceptable THEN 400 WHEN known IS NOT NULL OR row_number() OVER "
    "(PARTITION BY student_email, acceptable ORDER BY seq) > 1 THEN 409 ELSE 201 END AS status_code "
    "FROM judged LEFT JOIN known_emails ON known = student_email"
)
oracle(
    "val_4_register",
    "SELECT seq, status_code, CASE WHEN errors <> '' THEN errors WHEN NOT acceptable THEN "
    "'Department \"' || wanted || '\" not found in database' WHEN status_code = 409 THEN "
    f"'Student with this email already exists' ELSE '' END AS errors, {STUDENT_OUT} FROM answered",
)
BARE_PHONE = f"regexp_replace(translate(phoneNumber, {BL}, ''), '[+-]', '', 'g')"
AGE_365 = f"CAST(floor(date_diff('day', {parsed_date('dateOfBirth')}, DATE '{AS_OF}') / 365.25) AS INT)"
SHEET = joined(
    [
        (f"{trimmed('firstName')} = ''", "'firstName is required'"),
        (f"{trimmed('lastName')} = ''", "'lastName is required'"),
        (r"NOT regexp_matches(email, '^[^\s@]+@[^\s@]+\.[^\s@]+$')", "'Valid email required'"),
        ("dateOfBirth = ''", "'dateOfBirth is required'"),
        (f"{AGE_365} < 16", f"'Student must be at least 16 years old (currently ' || {AGE_365} || ')'"),
        (f"NOT coalesce({PLAIN_NUMBER} BETWEEN 1 AND 4, false)", "'year must be 1-4'"),
        (f"{trimmed('phoneNumber')} = ''", "'phoneNumber is required'"),
        (
            f"{trimmed('phoneNumber')} <> '' AND NOT regexp_matches({BARE_PHONE}, '^[0-9]{{10,15}}$')",
            f"'phoneNumber must have 10-15 digits (got ' || length({BARE_PHONE}) || ')'",
        ),
        (f"{trimmed('department')} = ''", "'department is required'"),
    ]
)
CTES["sheet"] = f"SELECT *, {SHEET} AS errors FROM requests"
oracle("val_5_sheet_rules", "SELECT seq, errors FROM sheet")
COMPLETE = " AND ".join(f"{trimmed(c)} <> ''" for c in REQUEST_COLUMNS)
oracle("val_6_completeness", f"SELECT seq, {COMPLETE} AS complete FROM requests")
oracle(
    "val_7_not_yet_registered",
    "SELECT seq AS row_id, email FROM requests WHERE NOT EXISTS "
    "(SELECT 1 FROM status_records r WHERE r.row_id = seq AND status = 'Registered')",
)
CTES["shaped"] = (
    f"SELECT seq, {trimmed('firstName')} AS \"firstName\", {trimmed('lastName')} AS \"lastName\", "
    f"lower({trimmed('email')}) AS email, "
    f"coalesce(strftime({parsed_date('dateOfBirth')}, '%Y-%m-%d'), dateOfBirth) AS \"dateOfBirth\", "
    f"CAST({parsed_year('year')} AS VARCHAR) AS year, {trimmed('phoneNumber')} AS \"phoneNumber\", "
    f"{trimmed('department')} AS department FROM requests"
)
oracle("val_8_shape", "SELECT * FROM shaped")
oracle(
    "val_9_run_statistics",
    "SELECT 'students' AS job, coalesce(reject_reason, 'accepted') AS outcome, count(*) AS records FROM tagged_students "
    "GROUP BY 2 UNION ALL SELECT 'enrollments', coalesce(reject_reason, 'accepted'), count(*) FROM tagged_enrollments GROUP BY 2",
)
CTES["loaded"] = "SELECT seq AS student_id, student_email FROM tagged_students WHERE reject_reason IS NULL"
CTES["addressed"] = (
    "SELECT * REPLACE (regexp_replace(student_email, 'CUSTOMER0*([0-9]+)', 'user\\1') AS student_email) FROM raw_enrollments"
)
CTES["loaded_enrollments"] = tagged_enrollments("loaded", "addressed")
oracle(
    "val_9_cleaning_run",
    "SELECT student_email, course_id, nullif(grade_text, '') AS grade, enrollment_date FROM loaded_enrollments e "
    "JOIN loaded l ON l.student_id = e.student_id WHERE reject_reason IS NULL",
)

oracle(
    "val_9_rejects",
    "SELECT 'students' AS job, seq, reject_reason FROM tagged_students WHERE reject_reason IS NOT NULL UNION ALL "
    "SELECT 'enrollments', seq, reject_reason FROM loaded_enrollments WHERE reject_reason IS NOT NULL",
)

# -- academic queries
oracle(
    "q_01_students_per_department",
    "SELECT department_name, count(student_id) AS student_count FROM department d LEFT JOIN student s "
    "ON d.department_id = s.department_id GROUP BY d.department_id, department_name",
)
COURSE_STATS = (
    "count(e.enrollment_id) AS total_enrollments, count(e.grade) AS graded_enrollments, "
)
oracle(
    "q_02_course_gpa",
    f"SELECT c.course_id, course_name, {COURSE_STATS} {gpa('e.grade')} AS average_gpa FROM course c "
    "LEFT JOIN flawed_enrollment e ON c.course_id = e.course_id GROUP BY c.course_id, course_name",
)
oracle(
    "q_03_enrollments_per_student",
    f"SELECT s.student_id, {FULL_NAME} AS full_name, student_email, count(enrollment_id) AS total_courses "
    "FROM student s LEFT JOIN enrollment e ON s.student_id = e.student_id GROUP BY ALL",
)
oracle("q_04_students_per_year", "SELECT student_year, count(*) AS student_count FROM student GROUP BY 1")
oracle(
    "q_05_course_popularity",
    "SELECT department_name, c.course_id, course_name, count(enrollment_id) AS enrollment_count FROM department d "
    "JOIN course c ON d.department_id = c.department_id LEFT JOIN enrollment e ON c.course_id = e.course_id GROUP BY ALL",
)
oracle(
    "q_06_student_directory",
    "SELECT student_id, student_first_name, student_last_name, student_email, student_year, student_phone_number, "
    "department_name FROM student s JOIN department d ON s.department_id = d.department_id",
)
FULL_JOIN = (
    "FROM enrollment e JOIN student s ON e.student_id = s.student_id JOIN course c ON e.course_id = c.course_id "
    "JOIN department sd ON s.department_id = sd.department_id JOIN department cd ON c.department_id = cd.department_id"
)
oracle(
    "q_07_enrollment_report",
    f"SELECT {FULL_NAME} AS student_name, student_email, student_year, sd.department_name AS student_department, "
    f"c.course_id, course_name, cd.department_name AS course_department, grade, enrollment_date {FULL_JOIN}",
)
oracle(
    "q_08_student_course_load",
    f"SELECT s.student_id, {FULL_NAME} AS full_name, department_name, student_year, count(enrollment_id) AS courses_taken, "
    f"count(grade) AS courses_graded, {gpa()} AS gpa FROM student s JOIN department d ON s.department_id = d.department_id "
    "LEFT JOIN enrollment e ON s.student_id = e.student_id GROUP BY s.student_id, full_name, department_name, student_year",
)
oracle(
    "q_09_cross_department",
    f"SELECT {FULL_NAME} AS student_name, sd.department_name AS student_department, c.course_id, course_name, "
    f"cd.department_name AS course_department {FULL_JOIN} WHERE s.department_id <> c.department_id",
)
oracle(
    "q_10_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS duplicate_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
oracle(
    "q_10_duplicate_emails",
    f"SELECT {email('email')} AS student_email, count(*) AS duplicate_count FROM raw_students GROUP BY 1 HAVING count(*) > 1",
)
oracle(
    "q_11_without_enrollment",
    f"SELECT s.student_id, {FULL_NAME} AS full_name, student_email, department_name FROM student s JOIN department d "
    "ON s.department_id = d.department_id LEFT JOIN activity_enrollment e ON s.student_id = e.student_id "
    "WHERE e.enrollment_id IS NULL",
)
PENDING_JOIN = (
    "FROM enrollment e JOIN student s ON e.student_id = s.student_id JOIN course c ON e.course_id = c.course_id "
    "WHERE grade IS NULL"
)
oracle("q_12_ungraded", f"SELECT {FULL_NAME} AS student_name, c.course_id, course_name, enrollment_date {PENDING_JOIN}")
AGE = f"CAST(date_sub('year', student_date_of_birth, DATE '{AS_OF}') AS INT) AS age"
oracle(
    "q_13_underage",
    f"SELECT student_id, student_first_name, student_last_name, student_date_of_birth, {AGE} FROM student "
    f"WHERE student_date_of_birth > DATE '{AS_OF}' - INTERVAL 16 YEAR",
)
oracle(
    "q_14_invalid_grades",
    "SELECT enrollment_id, student_email, c.course_id, grade FROM flawed_enrollment e JOIN student s "
    f"ON e.student_id = s.student_id JOIN course c ON e.course_id = c.course_id WHERE grade NOT IN ({LETTERS})",
)
CTES["fanned"] = (
    "SELECT d.department_id, d.department_name, d.department_head, s.student_id, c.course_id, e.enrollment_id, e.grade "
    "FROM department d LEFT JOIN student s ON d.department_id = s.department_id "
    "LEFT JOIN course c ON d.department_id = c.department_id LEFT JOIN enrollment e ON s.student_id = e.student_id"
)
CARD = (
    "SELECT department_name, count(DISTINCT student_id) AS total_students, count(DISTINCT course_id) AS total_courses, "
    f"{{}} AS total_enrollments, {gpa()} AS department_avg_gpa FROM fanned GROUP BY department_id, department_name"
)
oracle("q_15_department_card", CARD.format("count(enrollment_id)"))
oracle(
    "q_15_department_card_deduped",
    CARD.format("count(enrollment_id) // greatest(count(DISTINCT course_id), 1)"),
)
oracle(
    "q_16_top_students",
    f"SELECT s.student_id, {FULL_NAME} AS full_name, student_email, department_name, student_year, "
    f"count(grade) AS courses_completed, {gpa()} AS gpa FROM student s JOIN department d ON s.department_id = d.department_id "
    "LEFT JOIN term_enrollment e ON s.student_id = e.student_id GROUP BY s.student_id, full_name, student_email, "
    f"department_name, student_year HAVING sum({points()}) >= 290 * count({points()})",
)
oracle(
    "q_17_grade_distribution",
    "SELECT c.course_id, course_name, "
    + ", ".join(f"count(*) FILTER (grade = '{g}') AS grade_{g.replace('-', '_minus')}" for g in GRADES)
    + ", count(*) FILTER (grade IS NULL) AS not_graded FROM course c LEFT JOIN activity_enrollment e "
    "ON c.course_id = e.course_id GROUP BY c.course_id, course_name",
)

# -- views and academic functions
oracle(
    "v_1_student_details",
    f"SELECT student_id, student_first_name, student_last_name, {FULL_NAME} AS full_name, student_email, "
    f"student_date_of_birth, {AGE}, student_year, student_phone_number, s.department_id, department_name, department_head "
    "FROM student s JOIN department d ON s.department_id = d.department_id",
)
oracle(
    "v_2_enrollment_report",
    f"SELECT enrollment_id, enrollment_date, s.student_id, {FULL_NAME} AS student_name, student_email, student_year, "
    "sd.department_name AS student_department, c.course_id, course_name, course_credits, "
    f"cd.department_name AS course_department, grade, {points()} / 100.0 AS grade_points {FULL_JOIN}",
)
_AVG = f"sum({points()}) >= {{}} * count({points()})"
STUDENT_GPA = (
    f"SELECT s.student_id, {FULL_NAME} AS full_name, student_email, department_name, student_year, "
    "count(enrollment_id) AS total_courses, count(grade) AS graded_courses, "
    f"count(enrollment_id) - count(grade) AS pending_grades, {gpa()} AS gpa, "
    f"CASE WHEN count({points()}) = 0 THEN 'No Grades' WHEN {_AVG.format(350)} THEN 'Excellent' "
    f"WHEN {_AVG.format(300)} THEN 'Good' WHEN {_AVG.format(200)} THEN 'Average' ELSE 'Below Average' END "
    "AS performance_level FROM student s JOIN department d ON s.department_id = d.department_id LEFT JOIN {} e "
    "ON s.student_id = e.student_id GROUP BY s.student_id, full_name, student_email, department_name, student_year"
)
oracle("v_3_student_gpa", STUDENT_GPA.replace("{}", "term_enrollment"))
oracle("v_3_student_gpa_sparse", STUDENT_GPA.replace("{}", "activity_enrollment"))
oracle(
    "v_4_course_statistics",
    f"SELECT c.course_id, course_name, course_credits, department_name, {COURSE_STATS} "
    f"count(enrollment_id) - count(grade) AS pending_grades, {gpa()} AS average_gpa, "
    "count(*) FILTER (grade IN ('A', 'A-')) AS a_grades, count(*) FILTER (grade IN ('B', 'B-')) AS b_grades, "
    "count(*) FILTER (grade IN ('C', 'C-')) AS c_grades, count(*) FILTER (grade = 'D') AS d_grades, "
    "count(*) FILTER (grade = 'F') AS f_grades FROM course c JOIN department d ON c.department_id = d.department_id "
    "LEFT JOIN enrollment e ON c.course_id = e.course_id GROUP BY c.course_id, course_name, course_credits, department_name",
)
oracle(
    "v_5_department_summary",
    "SELECT department_id, department_name, department_head, count(DISTINCT student_id) AS total_students, "
    "count(DISTINCT course_id) AS total_courses, count(enrollment_id) AS total_enrollments, "
    f"{gpa()} AS department_gpa, {half_up('count(DISTINCT student_id)', 'count(DISTINCT course_id)', 1)} "
    "AS students_per_course FROM fanned GROUP BY department_id, department_name, department_head",
)
oracle(
    "f_1_grade_to_points", f"SELECT enrollment_id, grade, {points()} / 100.0 AS points FROM term_enrollment"
)
oracle(
    "f_2_student_gpa",
    f"SELECT s.student_id, {gpa()} AS gpa FROM student s LEFT JOIN enrollment e ON s.student_id = e.student_id GROUP BY 1",
)
CTES["enroll_requests"] = (
    "SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 37 = 1 THEN -1 ELSE o_custkey END AS student_id, "
    "'S' || CAST(o_orderkey % 127 AS STRING) AS course_id, CAST(o_orderdate AS DATE) AS enrollment_date FROM orders"
)
CTES["enroll_judged"] = (
    "SELECT r.*, CASE WHEN NOT EXISTS (SELECT 1 FROM student s WHERE s.student_id = r.student_id) THEN 'student_missing' "
    "WHEN NOT EXISTS (SELECT 1 FROM course c WHERE c.course_id = r.course_id) THEN 'course_missing' "
    "WHEN EXISTS (SELECT 1 FROM activity_enrollment a WHERE a.student_id = r.student_id AND a.course_id = r.course_id) "
    "OR row_number() OVER (PARTITION BY r.student_id, r.course_id ORDER BY r.seq) > 1 THEN 'already_enrolled' "
    "ELSE 'enrolled' END AS outcome FROM enroll_requests r"
)
oracle(
    "f_3_enroll_check",
    "SELECT *, CASE outcome WHEN 'student_missing' THEN 'Student ID ' || student_id || ' does not exist' "
    "WHEN 'course_missing' THEN 'Course ID ' || course_id || ' does not exist' WHEN 'already_enrolled' THEN "
    "'Student ' || student_id || ' is already enrolled in course ' || course_id END AS message FROM enroll_judged",
)
oracle(
    "f_3_enroll_students",
    "SELECT student_id, course_id, grade, enrollment_date FROM activity_enrollment QUALIFY row_number() OVER "
    "(PARTITION BY student_id, course_id ORDER BY enrollment_id) = 1 UNION ALL "
    "SELECT student_id, course_id, NULL, enrollment_date FROM enroll_judged WHERE outcome = 'enrolled'",
)
oracle(
    "f_4_course_average",
    f"SELECT c.course_id, {gpa()} AS average_gpa FROM course c LEFT JOIN enrollment e ON c.course_id = e.course_id GROUP BY 1",
)
CTES["dept_years"] = (
    "SELECT department_id, string_agg('\"' || student_year || '\":' || n, ',' ORDER BY student_year) AS years FROM "
    "(SELECT department_id, student_year, count(*) AS n FROM student GROUP BY 1, 2) GROUP BY 1"
)
oracle(
    "f_5_department_stats",
    "SELECT f.department_id, '{\"department_id\":' || f.department_id || ',\"department_name\":\"' || department_name || "
    "'\",\"total_students\":' || count(DISTINCT student_id) || ',\"total_courses\":' || count(DISTINCT course_id) || "
    "',\"total_enrollments\":' || count(enrollment_id) || ',\"average_gpa\":' || "
    f"coalesce(CAST(CAST({gpa()} AS DECIMAL(3,2)) AS VARCHAR), 'null') || ',\"students_per_year\":' || "
    "coalesce('{' || any_value(years) || '}', 'null') || '}' AS stats FROM fanned f LEFT JOIN dept_years y "
    "ON f.department_id = y.department_id GROUP BY f.department_id, department_name",
)
CTES["grade_updates"] = (
    f"SELECT o_orderkey AS seq, o_custkey AS student_id, 'S' || CAST(o_orderkey % 90 AS STRING) AS course_id, "
    f"{FLAWED_GRADE} AS grade FROM orders"
)
oracle(
    "f_6_grade_update_check",
    f"SELECT *, CASE WHEN grade NOT IN ({LETTERS}) THEN 'invalid_grade' WHEN NOT EXISTS (SELECT 1 FROM activity_enrollment a "
    "WHERE a.student_id = u.student_id AND a.course_id = u.course_id) THEN 'enrollment_missing' ELSE 'updated' END AS outcome "
    "FROM grade_updates u",
)
CTES["last_updates"] = (
    f"SELECT * FROM grade_updates WHERE grade IS NULL OR grade IN ({LETTERS}) "
    "QUALIFY row_number() OVER (PARTITION BY student_id, course_id ORDER BY seq DESC) = 1"
)
CTES["regraded"] = (
    "SELECT enrollment_id, enrollment_date, a.student_id, a.course_id, CASE WHEN u.seq IS NOT NULL THEN u.grade "
    "ELSE a.grade END AS grade FROM activity_enrollment a LEFT JOIN last_updates u "
    "ON a.student_id = u.student_id AND a.course_id = u.course_id"
)
oracle("f_6_grade_updates", "SELECT * FROM regraded")
oracle(
    "f_6_stored_grades",
    "SELECT * FROM regraded QUALIFY row_number() OVER (PARTITION BY student_id, course_id ORDER BY enrollment_id) = 1",
)
oracle(
    "f_7_pending_grades",
    f"SELECT enrollment_id, {FULL_NAME} AS student_name, student_email, c.course_id, course_name, enrollment_date, "
    f"CAST(DATE '{AS_OF}' - enrollment_date AS INT) AS days_since_enrollment {PENDING_JOIN}",
)

# -- access patterns
for _key in ("o_1_find_student", "o_1_stored"):
    oracle(_key, f"SELECT * FROM student WHERE student_email = '{ONE_EMAIL}'")
oracle(
    "o_1_find_student_department",
    "SELECT student_first_name, student_last_name, department_name FROM student s JOIN department d "
    f"ON s.department_id = d.department_id WHERE student_email = '{ONE_EMAIL}'",
)
oracle(
    "o_2_enrollments_of_year",
    f"SELECT {FULL_NAME} AS student_name, course_name, grade FROM enrollment e JOIN student s "
    "ON e.student_id = s.student_id JOIN course c ON e.course_id = c.course_id WHERE student_year = 3",
)
oracle(
    "o_3_enrollments_of_student",
    "SELECT course_name, grade, enrollment_date FROM enrollment e JOIN course c ON e.course_id = c.course_id "
    "WHERE student_id = 42",
)
for _key in ("o_4_phone_prefix", "o_4_stored"):
    oracle(_key, "SELECT * FROM student WHERE student_phone_number LIKE '+91%'")
for _key in ("o_5_page", "o_5_position"):
    oracle(_key, "SELECT * FROM student ORDER BY student_id LIMIT 20 OFFSET 40")
oracle("o_5_page_after", "SELECT * FROM student WHERE student_id > 39 ORDER BY student_id LIMIT 20")
oracle("o_6_exists", "SELECT EXISTS (SELECT 1 FROM enrollment WHERE student_id = 1) AS has_enrollment")
oracle(
    "o_6_exists_for_all",
    "SELECT * FROM student s WHERE EXISTS (SELECT 1 FROM activity_enrollment e WHERE e.student_id = s.student_id)",
)
oracle("o_6_count", "SELECT count(*) AS enrollment_count FROM enrollment WHERE student_id = 1")
oracle("o_7_projection", "SELECT student_id, student_email FROM student")
for _key, _join in (("o_8_inner_counts", "JOIN"), ("o_8_left_counts", "LEFT JOIN")):
    oracle(
        _key,
        f"SELECT s.student_id, count(enrollment_id) AS enrollment_count FROM student s {_join} activity_enrollment e "
        "ON s.student_id = e.student_id GROUP BY 1",
    )
oracle(
    "o_9_not_in",
    "SELECT student_id, student_email FROM student WHERE student_id NOT IN (SELECT user_id FROM events)",
)

# -- sales
AMOUNT = f"{cents('UnitPrice')} * Quantity"
ARTIST_JOIN = (
    "FROM artist a LEFT JOIN album al ON a.ArtistId = al.ArtistId LEFT JOIN track t ON al.AlbumId = t.AlbumId "
    "LEFT JOIN line l ON t.TrackId = l.TrackId"
)
CTES["artist_sales"] = (
    'SELECT a.ArtistId AS "ArtistId", a.Name AS artist_name, count(DISTINCT al.AlbumId) AS total_albums, '
    "count(DISTINCT t.TrackId) AS total_tracks, CAST(coalesce(sum(Quantity), 0) AS BIGINT) AS total_units_sold, "
    f"coalesce(sum({AMOUNT}), 0) / 100.0 AS total_revenue, "
    f"coalesce({half_up('sum(' + cents('UnitPrice') + ')', '100 * count(UnitPrice)', 2)}, 0) AS avg_track_price "
    f"{ARTIST_JOIN} GROUP BY a.ArtistId, a.Name"
)
oracle("mv_1_artist_sales", "SELECT * FROM artist_sales")
GENRE_AMOUNT = f"{cents('l.UnitPrice')} * Quantity"
GENRE_JOIN = (
    "FROM genre g LEFT JOIN part_track t ON g.GenreId = t.GenreId LEFT JOIN part_album al ON t.AlbumId = al.AlbumId "
    "LEFT JOIN part_line l ON t.TrackId = l.TrackId"
)
CTES["genre_sales"] = (
    'SELECT g.GenreId AS "GenreId", g.Name AS genre_name, count(DISTINCT t.TrackId) AS track_count, '
    "count(DISTINCT al.AlbumId) AS album_count, CAST(coalesce(sum(Quantity), 0) AS BIGINT) AS total_sales, "
    f"coalesce(sum({GENRE_AMOUNT}), 0) / 100.0 AS total_revenue, "
    f"coalesce({half_up('sum(Milliseconds)', '60000 * count(Milliseconds)', 2)}, 0) AS avg_track_minutes, "
    f"{half_up(f'coalesce(sum({GENRE_AMOUNT}), 0)', '100 * count(DISTINCT t.TrackId)', 2)} AS revenue_per_track "
    f"{GENRE_JOIN} GROUP BY g.GenreId, g.Name"
)
oracle("mv_2_genre_popularity", "SELECT * EXCLUDE (revenue_per_track) FROM genre_sales")
oracle(
    "mv_2_genre_popularity_unweighted",
    "SELECT s.* EXCLUDE (revenue_per_track, avg_track_minutes), m.minutes AS avg_track_minutes FROM genre_sales s "
    f"JOIN (SELECT GenreId, {half_up('sum(Milliseconds)', '60000 * count(Milliseconds)', 2)} AS minutes FROM part_track "
    "GROUP BY 1) m ON s.GenreId = m.GenreId",
)
CTES["lifetime"] = (
    "SELECT c.CustomerId AS \"CustomerId\", FirstName || ' ' || LastName AS customer_name, c.Email AS \"Email\", "
    'c.Country AS "Country", count(DISTINCT InvoiceId) AS total_orders, '
    f"coalesce(sum({cents('Total')}), 0) / 100.0 AS lifetime_value, "
    f"coalesce({half_up('sum(' + cents('Total') + ')', '100 * count(Total)', 6)}, 0) AS avg_order_value, "
    "min(InvoiceDate) AS first_purchase, max(InvoiceDate) AS last_purchase, "
    f"CASE WHEN sum(Total) > {HIGH_VALUE} THEN 'High Value' WHEN sum(Total) > {MEDIUM_VALUE} THEN 'Medium Value' "
    "ELSE 'Low Value' END AS customer_segment FROM customer_card c LEFT JOIN invoice i ON c.CustomerId = i.CustomerId "
    "GROUP BY c.CustomerId, customer_name, c.Email, c.Country"
)
oracle("mv_3_customer_lifetime_value", "SELECT * FROM lifetime")
CTES["changed_invoice"] = (
    f"SELECT InvoiceId, CustomerId, InvoiceDate, CASE WHEN Total < {SMALL_TOTAL} THEN Total + 1 ELSE Total END AS Total "
    f"FROM invoice WHERE coalesce(Total, 0) <= {LARGE_TOTAL}"
)
CTES["changed_lifetime"] = CTES["lifetime"].replace("LEFT JOIN invoice i", "LEFT JOIN changed_invoice i")
oracle("mv_4_incremental", "SELECT * FROM changed_lifetime")
oracle(
    "mv_4_refresh_all",
    "SELECT summary, row_count, row_count AS rows_written FROM (SELECT 'artist_sales_summary' AS summary, count(*) AS row_count "
    "FROM nation UNION ALL SELECT 'genre_popularity', count(DISTINCT p_type) FROM part "
    "UNION ALL SELECT 'customer_lifetime_value', count(*) FROM customer)",
)
oracle("mv_5_top_artists", "SELECT * FROM artist_sales ORDER BY total_revenue DESC, ArtistId LIMIT 10")
oracle(
    "mv_5_top_genres",
    "SELECT * EXCLUDE (revenue_per_track) FROM genre_sales ORDER BY total_sales DESC, GenreId LIMIT 5",
)
oracle("mv_5_high_value_customers", "SELECT * FROM lifetime WHERE customer_segment = 'High Value'")
oracle(
    "p_1_top_artists",
    "SELECT ArtistId AS artist_id, artist_name, total_albums, total_tracks, total_revenue, avg_track_price "
    "FROM artist_sales ORDER BY total_revenue DESC, artist_id LIMIT 10",
)
oracle(
    "p_2_purchase_history",
    "SELECT i.InvoiceId AS invoice_id, InvoiceDate AS invoice_date, t.Name AS track_name, ar.Name AS artist_name, "
    f"{money('l.UnitPrice')} AS unit_price, Quantity AS quantity, {cents('l.UnitPrice')} * Quantity / 100.0 AS line_total "
    "FROM invoice i JOIN part_line l ON i.InvoiceId = l.InvoiceId JOIN part_track t ON l.TrackId = t.TrackId "
    "JOIN part_album al ON t.AlbumId = al.AlbumId JOIN part_artist ar ON al.ArtistId = ar.ArtistId WHERE i.CustomerId = 42",
)
oracle(
    "p_3_genre_report",
    "SELECT GenreId AS genre_id, genre_name, track_count, album_count, total_sales, total_revenue, "
    "avg_track_minutes AS avg_track_length_mins, revenue_per_track FROM genre_sales",
)
oracle(
    "p_4_monthly_revenue",
    "SELECT CAST(month(InvoiceDate) AS INT) AS month_num, monthname(InvoiceDate) AS month_name, count(*) AS order_count, "
    f"sum({cents('Total')}) / 100.0 AS total_revenue, {half_up('sum(' + cents('Total') + ')', '100 * count(*)', 2)} "
    "AS avg_order_value, count(DISTINCT CustomerId) AS unique_customers FROM invoice WHERE year(InvoiceDate) = 1997 GROUP BY 1, 2",
)
oracle(
    "p_5_countries_at_least",
    f"SELECT overall_rank AS rank, country_or_region AS country, {money('score')} AS happiness_score, "
    f"{money('gdp_per_capita')} AS gdp_per_capita, {money('social_support')} AS social_support, "
    f"{money('healthy_life_expectancy')} AS life_expectancy FROM country WHERE score >= 4.5",
)
oracle(
    "p_6_compare_countries",
    " UNION ALL ".join(
        f"SELECT '{label}' AS metric, {money('a.' + c)} AS country1_value, {money('b.' + c)} AS country2_value, "
        f"{money('a.' + c + ' - b.' + c)} AS difference FROM country a, country b "
        "WHERE lower(a.country_or_region) = 'nation_3' AND lower(b.country_or_region) = 'nation_17'"
        for c, label in METRICS.items()
    ),
)
oracle(
    "b_1_artist_revenue",
    f"SELECT artist_name, albums, revenue FROM (SELECT a.ArtistId, a.Name AS artist_name, count(DISTINCT al.AlbumId) AS albums, "
    f"sum({AMOUNT}) / 100.0 AS revenue {ARTIST_JOIN.replace('LEFT JOIN', 'JOIN')} GROUP BY 1, 2 "
    "ORDER BY revenue DESC, a.ArtistId LIMIT 10)",
)
oracle(
    "b_2_monthly_sales",
    "SELECT CAST(date_trunc('month', InvoiceDate) AS TIMESTAMP) AS month, count(*) AS order_count, "
    f"sum({cents('Total')}) / 100.0 AS total_revenue FROM invoice "
    "WHERE InvoiceDate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31' GROUP BY 1",
)
oracle(
    "b_3_sales_by_country",
    'SELECT Country AS "Country", count(DISTINCT c.CustomerId) AS customer_count, '
    f"sum({cents('Total')}) / 100.0 AS total_revenue, {half_up('sum(' + cents('Total') + ')', '100 * count(Total)', 6)} "
    "AS avg_order_value FROM customer_card c JOIN invoice i ON c.CustomerId = i.CustomerId GROUP BY 1",
)
oracle(
    "b_4_genre_performance",
    "SELECT g.Name AS genre, count(t.TrackId) AS tracks, count(DISTINCT al.AlbumId) AS albums, "
    "CAST(sum(Quantity) AS BIGINT) AS units_sold FROM genre g JOIN part_track t ON g.GenreId = t.GenreId "
    "JOIN part_album al ON t.AlbumId = al.AlbumId LEFT JOIN part_line l ON t.TrackId = l.TrackId GROUP BY g.GenreId, g.Name",
)
for _key in ("b_5_direct", "b_5_stored"):
    oracle(
        _key,
        "SELECT artist_name, total_albums, total_revenue FROM (SELECT * FROM artist_sales "
        "ORDER BY total_revenue DESC, ArtistId LIMIT 10)",
    )
oracle(
    "b_6_genre_track_counts",
    'SELECT g.Name AS "Name", count(t.TrackId) AS track_count FROM genre g JOIN part_track t ON g.GenreId = t.GenreId '
    "GROUP BY g.GenreId, g.Name",
)
oracle(
    "b_7_countries_above",
    "SELECT overall_rank, country_or_region, "
    + ", ".join(f"{money(c)} AS {c}" for c in METRICS)
    + " FROM country WHERE score > 4.5",
)
oracle(
    "b_8_benchmark_run",
    "SELECT 'b_1_artist_revenue' AS name, 'ok' AS status, least(count(*), 10) AS result_rows FROM (SELECT DISTINCT c_nationkey "
    "FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey) UNION ALL "
    "SELECT 'b_3_sales_by_country', 'ok', count(DISTINCT c_nationkey) FROM customer JOIN orders ON c_custkey = o_custkey "
    "UNION ALL SELECT 'b_6_genre_track_counts', 'ok', count(DISTINCT p_type) FROM part UNION ALL "
    "SELECT 'b_7_countries_above', 'ok', count(*) FROM country WHERE score > 4.5 UNION ALL "
    "SELECT 'missing_table', 'SKIPPED', NULL",
)

# -- incremental sync
_ORDER_ROWS = (
    "SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day{} FROM orders QUALIFY row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY {}) = 1"
)
_NEW = f"o_orderdate >= DATE '{CUTOFF}'"
oracle("inc_1_upsert", _ORDER_ROWS.format("", f"{_NEW} DESC, o_orderkey DESC"))
oracle(
    "inc_2_insert_ignore",
    _ORDER_ROWS.format(
        f", (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING bool_and({_NEW}))) AS inserted",
        f"{_NEW}, o_orderkey",
    ),
)
oracle(
    "inc_3_sync_runs",
    "SELECT CAST(1 AS BIGINT) AS sync_id, 'orders' AS table_name, 'incremental' AS sync_type, "
    "count(DISTINCT o_custkey) AS records_processed, 'success' AS status, CAST(NULL AS VARCHAR) AS error_message "
    f"FROM orders WHERE {_NEW} UNION ALL SELECT 2, 'customer', 'batch', 0, 'failed', 'source not reachable'",
)
oracle(
    "inc_4_last_sync",
    "SELECT table_name, max(completed_at) AS last_sync FROM sync_log WHERE status = 'success' GROUP BY 1",
)
oracle(
    "inc_4_delta",
    "SELECT event_id, ts, event_type FROM events WHERE ts > (SELECT max(completed_at) FROM sync_log "
    "WHERE status = 'success' AND table_name = 'table_3')",
)
oracle("inc_4_run", "SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1")
oracle(
    "inc_5_sync_history",
    "SELECT table_name, sync_type, records_processed, started_at, completed_at, status, "
    "round(epoch_us(completed_at - started_at) / 1000000.0, 2) AS duration_seconds FROM sync_log "
    "ORDER BY started_at DESC, sync_id DESC LIMIT 10",
)
oracle("inc_6_delete", "SELECT * FROM customer WHERE NOT c_acctbal < 0")

# -- streams
CTES["submitted"] = (
    "SELECT s.seq, h.errors AS sheet_errors, s.* EXCLUDE (seq) FROM shaped s JOIN sheet h ON h.seq = s.seq "
    f"WHERE h.seq IN (SELECT seq FROM requests WHERE {COMPLETE})"
)
CTES["submit_judged"] = CTES["judged"].replace("FROM requests", "FROM (SELECT * FROM submitted WHERE sheet_errors = '')")
CTES["submit_answered"] = (
    "SELECT *, CASE WHEN NOT acceptable THEN 400 WHEN row_number() OVER (PARTITION BY student_email, acceptable "
    "ORDER BY seq) > 1 THEN 409 ELSE 201 END AS status_code FROM submit_judged"
)
oracle(
    "str_1_registration",
    "SELECT seq AS row_id, CASE WHEN status_code IN (201, 409) THEN 'Registered' ELSE 'Error' END AS status, "
    "CASE status_code WHEN 201 THEN 'Registered' WHEN 409 THEN 'Already in database' ELSE CASE WHEN errors <> '' THEN errors "
    "ELSE 'Department \"' || wanted || '\" not found in database' END END AS message, student_email FROM submit_answered "
    "UNION ALL SELECT seq, 'Invalid', sheet_errors, NULL FROM submitted WHERE sheet_errors <> ''",
)
oracle(
    "str_2_first_events",
    "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1",
)
oracle("str_2_repeats", "SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL")
oracle(
    "str_3_closed_days",
    "SELECT CAST(ts AS DATE) AS day, status, message, count(*) AS records FROM status_records "
    "WHERE status IN ('Error', 'Invalid') GROUP BY 1, 2, 3 HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 2 DAY "
    "<= (SELECT max(ts) FROM status_records WHERE status IN ('Error', 'Invalid'))",
)
for _key in ("str_3_error_digest", "str_3_digest_counts"):
    oracle(
        _key,
        "SELECT CAST(ts AS DATE) AS day, status, message, count(*) AS records FROM status_records "
        "WHERE status IN ('Error', 'Invalid') GROUP BY 1, 2, 3",
    )
oracle(
    "str_3_digest_lines",
    "SELECT CAST(ts AS DATE) AS day, row_id, 'Row ' || row_id || ': ' || message AS line FROM status_records "
    "WHERE status IN ('Error', 'Invalid')",
)
CTES["pending_students"] = (
    f"SELECT seq, {email('email')} AS student_email, {email_ok('email')} AS email_ok, {parsed_year('year')} AS student_year, "
    f"{parsed_date('dateOfBirth')} AS student_date_of_birth, {phone('phoneNumber')} AS student_phone_number, "
    f"{dept('department')} AS department_name, firstName <> '' AND lastName <> '' AS has_name, "
    f"nullif({trimmed('firstName')}, '') AS student_first_name, {trimmed('lastName')} AS student_last_name FROM requests "
    f"WHERE firstName <> '' AND lastName <> '' AND contains(email, '@') AND department <> '' AND NOT {NO_YEAR} "
    f"AND coalesce({PLAIN_NUMBER} BETWEEN 1 AND 4, true)"
)
CTES["pending_tagged"] = tagged_students(source="pending_students")
oracle("str_4_pending_flow", f"SELECT {STUDENT_OUT} FROM pending_tagged WHERE reject_reason IS NULL")

# -- described by the documentation
CTES["country_regions"] = "SELECT department_name AS country_or_region, department_head AS region FROM department"
_ZERO_BASE = {"generosity": 10**9}


def _mean(column: str) -> str:
    """Mean in hundredths; a column that may be negative is shifted to stay non-negative."""
    shift = _ZERO_BASE.get(column, 0)
    mean = half_up(f"sum({cents(column)} + {shift * 100})", f"100 * count({column})", 2)
    return f"round({mean} - {shift}, 2)" if shift else mean


oracle(
    "doc_1_regional_averages",
    "SELECT region, count(*) AS countries, "
    + ", ".join(f"{_mean(c)} AS avg_{c}" for c in METRICS)
    + " FROM country JOIN country_regions USING (country_or_region) GROUP BY 1",
)
oracle(
    "doc_2_album_details",
    'SELECT al.AlbumId AS "AlbumId", Title AS album_title, a.Name AS artist_name, TrackId AS "TrackId", '
    "t.Name AS track_name FROM album al JOIN track t ON al.AlbumId = t.AlbumId JOIN artist a ON al.ArtistId = a.ArtistId "
    "WHERE al.AlbumId = 42",
)
for _key in ("doc_3_search_tracks", "doc_3_indexed"):
    oracle(
        _key,
        "SELECT TrackId AS \"TrackId\", Name AS track_name FROM part_track WHERE Name ILIKE '%ring%' AND Name ILIKE '%blue%'",
    )
