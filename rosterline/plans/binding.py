"""The given tables seen through the canonical schemas.

Only this module knows the given tables. Columns are SQL expressions that mean the same in Spark and in
other SQL engines, so a check elsewhere can start from the same derived input. All rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

AS_OF = "2024-06-30"

_DIGITS = "substring(c_name, 10)"


def _padded(expr: str, width: int) -> str:
    return f"lpad(CAST({expr} AS STRING), {width}, '0')"


def _pick(key: str, values: list[str]) -> str:
    """CASE that cycles through SQL values by a key."""
    arms = " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


def _text(key: str, values: list[str]) -> str:
    return _pick(key, ["'" + value.replace("'", "''") + "'" for value in values])


_GRADE = (
    "CASE o_orderpriority "
    "WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'P' THEN 'A-' ELSE 'A' END "
    "WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'P' THEN 'B-' ELSE 'B' END "
    "WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'P' THEN 'C-' ELSE 'C' END "
    "WHEN '5-LOW' THEN CASE o_orderstatus WHEN 'P' THEN 'F' ELSE 'D' END END"
)
_EVENT_GRADE = (
    "CASE event_type WHEN 'click' THEN 'A' WHEN 'purchase' THEN 'B' WHEN 'view' THEN 'C' "
    "WHEN 'error' THEN 'F' END"
)
_EMAIL = f"'customer' || {_DIGITS} || '@example.org'"
_YEAR = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 ELSE 4 END"
_BORN = ("1990 + c_custkey % 22", "1 + c_custkey % 12", "1 + c_custkey % 28")
_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
_MONTH_WORD = _text("c_custkey", _MONTHS)


def _date_text(key: str, year: str, month: str, day_: str, month_word: str) -> str:
    """A date written in one of several styles, some impossible or not dates at all."""
    y, m, d = (f"CAST({part} AS STRING)" for part in (year, month, day_))
    iso = f"{y} || '-' || {_padded(month, 2)} || '-' || {_padded(day_, 2)}"
    styles = [
        iso,
        f"{d} || '/' || {m} || '/' || {y}",
        f"{month_word} || ' ' || {d} || ', ' || {y}",
        f"{iso} || 'T08:30:00Z'",
        iso,
        f"' ' || {iso} || ' '",
        f"{_padded(day_, 2)} || '/' || {_padded(month, 2)} || '/' || {y}",
    ]
    return (
        f"CASE WHEN {key} % 41 = 9 THEN '31/02/2004' WHEN {key} % 43 = 11 THEN 'unknown' "
        f"WHEN {key} % 47 = 13 THEN '' ELSE {_pick(key, styles)} END"
    )


_PHONES = [
    "'9' || lpad(CAST(c_custkey AS STRING), 9, '0')",
    "'+91-9' || lpad(CAST(c_custkey AS STRING), 9, '0')",
    "'(987) 654-' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')",
    "'+44 20 7946 ' || lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')",
    "'12345'",
    "'tel. 9876543210 x'",
    "'+91 98765 43210 98765 43210'",
    "'n/a'",
    "'98765-43210'",
]
_DEPARTMENTS = [
    "Computer Science",
    "CS",
    " comp sci ",
    "Comp. Sci.",
    "cse",
    "ELECTRONICS",
    "ece",
    "EC",
    "Mechanical",
    "mech",
    "ME",
    "Electrical Engineering",
    "electrical",
    "EE",
    "eee",
    "Astrology",
    "",
    "electronics",
    "mechanical",
]
_YEARS = ["1", "2", "3", "4", "2nd", "third", " FOUR ", "5", "1st", "0", "second", "", "4th", "freshman"]
_RAW_EMAIL = (
    "CASE WHEN c_custkey % 17 = 5 THEN '' "
    "WHEN c_custkey % 19 = 7 THEN 'user' || CAST(c_custkey AS STRING) || '@nodot' "
    "WHEN c_custkey % 23 = 3 THEN 'user ' || CAST(c_custkey AS STRING) || '@example.org' "
    "WHEN c_custkey % 10 = 3 THEN 'USER' || CAST(c_custkey - 1 AS STRING) || '@EXAMPLE.org' "
    "ELSE ' User' || CAST(c_custkey AS STRING) || '@Example.Org' || chr(9) END"
)

# Columns per canonical table: (given table, {column: expression}).
EXPRESSIONS: dict[str, tuple[str, dict[str, str]]] = {
    "student": (
        "customer",
        {
            "student_id": "c_custkey",
            "student_first_name": "substring(c_name, 1, 8)",
            "student_last_name": _DIGITS,
            "student_email": _EMAIL,
            "student_date_of_birth": "make_date(" + ", ".join(f"CAST({part} AS INT)" for part in _BORN) + ")",
            "student_year": _YEAR,
            "student_phone_number": (
                "CASE WHEN c_custkey % 3 = 0 THEN '+44 ' ELSE '+91-' END || " + _padded("c_custkey", 10)
            ),
            "department_id": "c_nationkey",
        },
    ),
    "course": (
        "supplier",
        {
            "course_id": "'S' || CAST(s_suppkey AS STRING)",
            "course_name": "s_name",
            "department_id": "s_nationkey",
            "course_credits": "CAST(1 + s_suppkey % 4 AS INT)",
        },
    ),
    # One enrollment per order: the student-level fact.
    "term_enrollment": (
        "orders",
        {
            "enrollment_id": "o_orderkey",
            "enrollment_date": "CAST(o_orderdate AS DATE)",
            "student_id": "o_custkey",
            "course_id": "'S' || CAST(o_orderkey % 127 AS STRING)",
            "grade": _GRADE,
        },
    ),
    # One enrollment per event: most students and some courses have none.
    "activity_enrollment": (
        "events",
        {
            "enrollment_id": "event_id",
            "enrollment_date": "CAST(ts AS DATE)",
            "student_id": "user_id",
            "course_id": "'S' || CAST(event_id % 90 AS STRING)",
            "grade": _EVENT_GRADE,
        },
    ),
    "raw_students": (
        "customer",
        {
            "seq": "c_custkey",
            "student_id": "CAST(c_custkey AS STRING)",
            "first_name": "CASE WHEN c_custkey % 29 < 3 THEN '' ELSE ' Ann' || CAST(c_custkey % 50 AS STRING) END",
            "last_name": "CASE WHEN c_custkey % 31 < 3 THEN '' ELSE 'Lee' || CAST(c_custkey % 70 AS STRING) END",
            "name": (
                "CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN 'Cher' "
                "ELSE ' Maria  del Carmen ' END"
            ),
            "email": _RAW_EMAIL,
            "student_email": (
                "CASE WHEN c_custkey % 34 = 5 THEN 'spare' || CAST(c_custkey AS STRING) || '@example.org' ELSE '' END"
            ),
            "date_of_birth": _date_text("c_custkey", *_BORN, _MONTH_WORD),
            "year": _text("c_custkey", _YEARS),
            "phone_number": _pick("c_custkey", _PHONES),
            "department": _text("c_custkey", _DEPARTMENTS),
        },
    ),
    "requests": (
        "customer",
        {
            "seq": "c_custkey",
            "firstName": "CASE WHEN c_custkey % 29 = 4 THEN '' ELSE ' Ann' || CAST(c_custkey % 50 AS STRING) END",
            "lastName": "CASE WHEN c_custkey % 31 = 6 THEN ' ' ELSE 'Lee' || CAST(c_custkey % 70 AS STRING) END",
            "email": _RAW_EMAIL,
            "dateOfBirth": _date_text("c_custkey", *_BORN, _MONTH_WORD),
            "year": _text("c_custkey", _YEARS),
            "phoneNumber": _pick("c_custkey", _PHONES),
            "department": _text("c_custkey", _DEPARTMENTS),
        },
    ),
    "raw_enrollments": (
        "orders",
        {
            "seq": "o_orderkey",
            "enrollment_id": "CAST(o_orderkey AS STRING)",
            "student_email": (
                "CASE WHEN o_orderkey % 37 = 1 THEN 'nobody@example.org' WHEN o_orderkey % 39 = 2 THEN '' "
                "ELSE ' CUSTOMER' || lpad(CAST(o_custkey AS STRING), 9, '0') || '@example.org' END"
            ),
            "course_code": (
                "CASE WHEN o_orderkey % 53 = 3 THEN '' ELSE ' S' || CAST(o_orderkey % 127 AS STRING) || ' ' END"
            ),
            "grade": (
                "CASE o_orderpriority WHEN '1-URGENT' THEN ' a ' WHEN '2-HIGH' THEN 'B-' WHEN '3-MEDIUM' THEN 'c' "
                "WHEN '5-LOW' THEN CASE o_orderstatus WHEN 'P' THEN 'B+' ELSE 'F' END ELSE '' END"
            ),
            "enrollment_date": _date_text(
                "o_orderkey",
                "1995 + o_orderkey % 7",
                "1 + o_orderkey % 12",
                "1 + o_orderkey % 28",
                _text("o_orderkey", _MONTHS),
            ),
        },
    ),
    "registry": (
        "nation",
        {
            "department_id": "n_nationkey",
            "department_name": (
                "CASE n_nationkey WHEN 0 THEN 'Computer Science' WHEN 1 THEN 'Electronics' "
                "WHEN 2 THEN 'Mechanical' ELSE n_name END"
            ),
            "department_head": "n_name",
        },
    ),
    "artist": ("nation", {"ArtistId": "n_nationkey", "Name": "n_name"}),
    "album": ("customer", {"AlbumId": "c_custkey", "Title": "c_name", "ArtistId": "c_nationkey"}),
    "track": (
        "orders",
        {
            "TrackId": "o_orderkey",
            "Name": "o_orderpriority || ' ' || o_orderstatus",
            "AlbumId": "o_custkey",
        },
    ),
    "line": (
        "lineitem",
        {
            "InvoiceLineId": "l_orderkey * 10 + l_linenumber",
            "InvoiceId": "l_orderkey",
            "TrackId": "l_orderkey",
            "UnitPrice": "CAST(l_extendedprice AS DECIMAL(10,2))",
            "Quantity": "CAST(l_quantity AS INT)",
        },
    ),
    "part_line": (
        "lineitem",
        {
            "InvoiceLineId": "l_orderkey * 10 + l_linenumber",
            "InvoiceId": "l_orderkey",
            "TrackId": "l_partkey",
            "UnitPrice": "CAST(l_extendedprice AS DECIMAL(10,2))",
            "Quantity": "CAST(l_quantity AS INT)",
        },
    ),
    "part_track": (
        "part",
        {
            "TrackId": "p_partkey",
            "Name": "p_name",
            "AlbumId": "CAST(substring(p_brand, 7) AS INT)",
            "GenreId": "p_type",
            "Milliseconds": "p_size * 10007",
            "UnitPrice": "CAST(p_retailprice AS DECIMAL(10,2))",
        },
    ),
    "customer_card": (
        "customer",
        {
            "CustomerId": "c_custkey",
            "FirstName": "substring(c_name, 1, 8)",
            "LastName": _DIGITS,
            "Email": _EMAIL,
            "Country": "'NATION_' || CAST(c_nationkey AS STRING)",
        },
    ),
    "invoice": (
        "orders",
        {
            "InvoiceId": "o_orderkey",
            "CustomerId": "o_custkey",
            "InvoiceDate": "o_orderdate",
            "Total": "CAST(o_totalprice AS DECIMAL(10,2))",
        },
    ),
    "sync_log": (
        "events",
        {
            "sync_id": "event_id",
            "table_name": "'table_' || CAST(user_id % 7 AS STRING)",
            "sync_type": "CASE WHEN event_type = 'signup' THEN 'batch' ELSE 'incremental' END",
            "records_processed": "CAST(user_id AS BIGINT)",
            "started_at": "ts",
            "status": "CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END",
        },
    ),
    "status_records": (
        "events",
        {
            "ts": "ts",
            "row_id": "event_id",
            "status": "CASE event_type WHEN 'error' THEN 'Error' WHEN 'view' THEN 'Invalid' ELSE 'Registered' END",
            "message": "event_type || ' ' || props",
        },
    ),
}


def derive(source: DataFrame, name: str) -> DataFrame:
    return source.selectExpr(*[f"{expr} AS {column}" for column, expr in EXPRESSIONS[name][1].items()])


# Schemas of given tables by path: asking a file for its schema again takes a job each time.
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """Canonical tables over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def given(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in EXPRESSIONS:
            raise AttributeError(name)
        return derive(self.given(EXPRESSIONS[name][0]), name)

    @property
    def department(self) -> DataFrame:
        return (
            self.given("nation")
            .join(self.given("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
            .selectExpr("n_nationkey AS department_id", "n_name AS department_name", "r_name AS department_head")
        )

    def _line_enrollment(self, grade: str) -> DataFrame:
        orders, lineitem = self.given("orders"), self.given("lineitem")
        return orders.join(lineitem, orders.o_orderkey == lineitem.l_orderkey).selectExpr(
            "l_orderkey * 10 + l_linenumber AS enrollment_id",
            "CAST(o_orderdate AS DATE) AS enrollment_date",
            "o_custkey AS student_id",
            "'S' || CAST(l_suppkey AS STRING) AS course_id",
            f"{grade} AS grade",
        )

    @property
    def enrollment(self) -> DataFrame:
        """One enrollment per order line."""
        return self._line_enrollment(_GRADE)

    @property
    def flawed_enrollment(self) -> DataFrame:
        """The same with some plus-grades, which are off the scale."""
        return self._line_enrollment(FLAWED_GRADE)

    @property
    def part_album(self) -> DataFrame:
        albums = self.given("part").select("p_brand").distinct()
        album_id = "CAST(substring(p_brand, 7) AS INT)"
        return albums.selectExpr(f"{album_id} AS AlbumId", "p_brand AS Title", f"{album_id} % 5 AS ArtistId")

    @property
    def part_artist(self) -> DataFrame:
        return self.part_album.select("ArtistId").distinct().selectExpr(
            "ArtistId", "'Maker ' || CAST(ArtistId AS STRING) AS Name"
        )

    @property
    def genre(self) -> DataFrame:
        return self.given("part").select("p_type").distinct().selectExpr("p_type AS GenreId", "p_type AS Name")

    @property
    def country(self) -> DataFrame:
        """Metrics per nation from the balances of its customers and suppliers."""
        money = "CAST({} AS DECIMAL(18,2))".format
        customers = self.given("customer").groupBy("c_nationkey").agg(
            *_aggregates(
                c_sum=f"sum({money('c_acctbal')})",
                c_max=f"max({money('c_acctbal')})",
                c_min=f"min({money('c_acctbal')})",
                c_count="count(*)",
                c_debtors="count_if(c_acctbal < 0)",
            )
        )
        suppliers = self.given("supplier").groupBy("s_nationkey").agg(
            *_aggregates(s_sum=f"sum({money('s_acctbal')})", s_count="count(*)")
        )
        nation = self.given("nation")
        return (
            nation.join(customers, nation.n_nationkey == customers.c_nationkey, "left")
            .join(suppliers, nation.n_nationkey == suppliers.s_nationkey, "left")
            .selectExpr(
                "n_nationkey + 1 AS overall_rank",
                "n_name AS country_or_region",
                "CAST(round(c_sum / (1000 * c_count), 2) AS DECIMAL(5,2)) AS score",
                "CAST(c_max AS DECIMAL(10,2)) AS gdp_per_capita",
                "CAST(s_count AS DECIMAL(10,2)) AS social_support",
                "CAST(s_sum AS DECIMAL(10,2)) AS healthy_life_expectancy",
                "CAST(c_count - c_debtors AS DECIMAL(10,2)) AS freedom_to_make_life_choices",
                "CAST(c_min AS DECIMAL(10,2)) AS generosity",
                "CAST(c_debtors AS DECIMAL(10,2)) AS perceptions_of_corruption",
            )
        )

    @property
    def sync_log(self) -> DataFrame:
        """Events as sync runs: a run lasts as many seconds as its event's value, unless still running."""
        source = self.given("events")
        length = F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))
        columns = EXPRESSIONS["sync_log"][1]
        return (
            source.withColumn("ended", F.col("ts") + length)
            .selectExpr(*[f"{expr} AS {column}" for column, expr in columns.items()], "ended")
            .withColumn("completed_at", F.when(F.col("status") != "running", F.col("ended")))
            .drop("ended")
        )

    @property
    def country_regions(self) -> DataFrame:
        return self.department.selectExpr("department_name AS country_or_region", "department_head AS region")


def _aggregates(**expressions: str):
    return [F.expr(expr).alias(name) for name, expr in expressions.items()]


FLAWED_GRADE = f"CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'B+' ELSE {_GRADE} END"
LINE_GRADE = _GRADE
