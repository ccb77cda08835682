"""Cleaning rules for registration and enrollment fields, one Column expression per rule."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.grades import GRADES

# Characters counted as blank, accepted shapes, spelled-out years, department spellings.
BLANKS = (
    " \t\n\x0b\f\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
EMAIL_PATTERN = rf"^[^{BLANKS}@]+@[^{BLANKS}@]+\.[^{BLANKS}@]+$"
PHONE_PATTERN = r"^[0-9+ -]{7,20}$"
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
YEAR_WORDS = {
    "one": 1,
    "first": 1,
    "1st": 1,
    "two": 2,
    "second": 2,
    "2nd": 2,
    "three": 3,
    "third": 3,
    "3rd": 3,
    "four": 4,
    "fourth": 4,
    "4th": 4,
}
DEPARTMENT_SPELLINGS = {
    "computer science": "Computer Science",
    "cs": "Computer Science",
    "comp sci": "Computer Science",
    "comp. sci.": "Computer Science",
    "cse": "Computer Science",
    "electronics": "Electronics",
    "ece": "Electronics",
    "ec": "Electronics",
    "mechanical": "Mechanical",
    "mech": "Mechanical",
    "me": "Mechanical",
    "electrical engineering": "Electrical Engineering",
    "electrical": "Electrical Engineering",
    "ee": "Electrical Engineering",
    "eee": "Electrical Engineering",
}
PHONE_COUNTRY_PREFIX = "+91-"

# The spellings under which one field arrives, in order of preference.
FIELD_SPELLINGS = {
    "email": ("email", "student_email"),
    "year": ("year", "student_year"),
    "date_of_birth": ("date_of_birth", "dateOfBirth", "student_date_of_birth"),
    "phone_number": ("phone_number", "phoneNumber", "student_phone_number"),
    "department": ("department", "department_name"),
}


def _lookup(mapping: dict) -> Column:
    return F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())])


def trim_text(text: Column) -> Column:
    """Trim every kind of blank (``trim`` alone strips spaces only)."""
    return F.btrim(text, F.lit(BLANKS))


def filled(text: Column) -> Column:
    """True where the raw text is neither missing nor empty."""
    return F.coalesce(text != "", F.lit(False))


def clean_text(text: Column) -> Column:
    return F.nullif(trim_text(text), F.lit(""))


def normalize_email(text: Column) -> Column:
    return F.nullif(F.lower(trim_text(text)), F.lit(""))


def is_email(text: Column) -> Column:
    return F.coalesce(trim_text(text).rlike(EMAIL_PATTERN), F.lit(False))


def parse_year(text: Column) -> Column:
    """Leading integer, else a spelled-out year, else NULL."""
    clean = trim_text(text)
    digits = F.regexp_extract(clean, r"^([+-]?\d+)", 1)
    words = F.try_element_at(_lookup(YEAR_WORDS), F.lower(clean))
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), words)


def is_year(year: Column) -> Column:
    return F.coalesce(year.between(1, 4), F.lit(False))


def standard_department(text: Column) -> Column:
    return F.try_element_at(_lookup(DEPARTMENT_SPELLINGS), F.lower(trim_text(text)))


def is_grade(text: Column) -> Column:
    """An absent grade passes; a present one has to be one of the letters, in any case."""
    return ~filled(text) | F.upper(trim_text(text)).isin(*GRADES)


def normalize_phone(text: Column) -> Column:
    kept = F.trim(F.regexp_replace(text, r"[^0-9+\- ]", ""))
    digits = F.regexp_replace(kept, r"[^0-9]", "")
    return F.when(F.length(digits) == 10, F.concat(F.lit(PHONE_COUNTRY_PREFIX), digits)).otherwise(kept)


def is_phone(text: Column) -> Column:
    return F.coalesce(trim_text(text).rlike(PHONE_PATTERN), F.lit(False))


def number(text: Column) -> Column:
    """The text as a double where it is a plain number (a cast alone would also take ``2d``)."""
    clean = trim_text(text)
    return F.when(clean.rlike(NUMBER_PATTERN), clean.try_cast("double"))


def _name_parts(text: Column) -> Column:
    return F.split(trim_text(text), f"[{BLANKS}]+")


def first_name_of(full_name: Column) -> Column:
    return F.nullif(F.get(_name_parts(full_name), F.lit(0)), F.lit(""))


def last_name_of(full_name: Column) -> Column:
    """Everything after the first token, joined by single spaces; empty for a single token."""
    parts = _name_parts(full_name)
    return F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), " ")


def field(df: DataFrame, name: str) -> Column:
    """First non-empty spelling of a field among the columns the frame has, untrimmed."""
    present = [F.nullif(df[c], F.lit("")) for c in FIELD_SPELLINGS[name] if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def column_or_null(df: DataFrame, name: str) -> Column:
    return df[name] if name in df.columns else F.lit(None).cast("string")
