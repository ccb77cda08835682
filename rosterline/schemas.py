"""Canonical schemas. Money and grade points are decimals, raw input is all text."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_STUDENT = text_schema(
    "student_id", "first_name", "last_name", "email", "date_of_birth", "year", "phone_number", "department"
)
RAW_ENROLLMENT = text_schema("enrollment_id", "student_email", "course_code", "grade", "enrollment_date")
RAW_DEPARTMENT = text_schema("dept_id", "department_name", "head_name")
RAW_COURSE = text_schema("course_id", "course_name", "department", "credits")

# Every spelling under which a JSON student record may name its fields.
JSON_STUDENT = text_schema(
    "student_id",
    "name",
    "first_name",
    "last_name",
    "firstName",
    "lastName",
    "email",
    "student_email",
    "date_of_birth",
    "dateOfBirth",
    "student_date_of_birth",
    "year",
    "student_year",
    "phone_number",
    "phoneNumber",
    "student_phone_number",
    "department",
    "department_name",
)
PENDING_STUDENT = text_schema("firstName", "lastName", "email", "dateOfBirth", "year", "phoneNumber", "department")
PENDING_ENVELOPE = T.StructType(
    [
        T.StructField("description", T.StringType()),
        T.StructField("exportedAt", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("students", T.ArrayType(PENDING_STUDENT)),
    ]
)

DEPARTMENT = "department_id int, department_name string, department_head string"
STUDENT = (
    "student_id long, student_first_name string, student_last_name string, student_email string, "
    "student_date_of_birth date, student_year int, student_phone_number string, department_id int"
)
COURSE = "course_id string, course_name string, department_id int, course_credits int"
ENROLLMENT = "enrollment_id long, enrollment_date date, student_id long, course_id string, grade string"
SYNC_LOG = (
    "sync_id long, table_name string, sync_type string, records_processed long, started_at timestamp_ntz, "
    "completed_at timestamp_ntz, status string, error_message string, source_until timestamp_ntz"
)
ARTIST = "ArtistId int, Name string"
ALBUM = "AlbumId int, Title string, ArtistId int"
GENRE = "GenreId int, Name string"
TRACK = (
    "TrackId int, Name string, AlbumId int, MediaTypeId int, GenreId int, Composer string, "
    "Milliseconds int, Bytes int, UnitPrice decimal(10,2)"
)
CUSTOMER = (
    "CustomerId int, FirstName string, LastName string, Company string, Address string, City string, "
    "State string, Country string, PostalCode string, Phone string, Fax string, Email string, SupportRepId int"
)
INVOICE = (
    "InvoiceId int, CustomerId int, InvoiceDate timestamp_ntz, BillingAddress string, BillingCity string, "
    "BillingState string, BillingCountry string, BillingPostalCode string, Total decimal(10,2)"
)
INVOICE_LINE = "InvoiceLineId int, InvoiceId int, TrackId int, UnitPrice decimal(10,2), Quantity int"
COUNTRY = (
    "overall_rank int, country_or_region string, score decimal(5,2), gdp_per_capita decimal(10,2), "
    "social_support decimal(10,2), healthy_life_expectancy decimal(10,2), "
    "freedom_to_make_life_choices decimal(10,2), generosity decimal(10,2), perceptions_of_corruption decimal(10,2)"
)
