"""Letter grades and grade-point averages."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grade scale.
GRADE_POINTS = {
    "A": "4.00",
    "A-": "3.70",
    "B": "3.00",
    "B-": "2.70",
    "C": "2.00",
    "C-": "1.70",
    "D": "1.00",
    "F": "0.00",
}
GRADES = tuple(GRADE_POINTS)

# Lower bounds of the performance levels, compared with the unrounded average.
PERFORMANCE_LEVELS = (("3.5", "Excellent"), ("3.0", "Good"), ("2.0", "Average"))


def grade_to_points(grade: Column) -> Column:
    """Points of a letter as ``decimal(3,2)``; anything off the scale, plus-grades included, is NULL."""
    arms = [(F.lit(letter), F.lit(points).cast("decimal(3,2)")) for letter, points in GRADE_POINTS.items()]
    return reduce(lambda acc, arm: acc.when(grade == arm[0], arm[1]), arms[1:], F.when(grade == arms[0][0], arms[0][1]))


def grade_hundredths(grade: Column) -> Column:
    """Points of a letter times a hundred as ``bigint``: sums of it do not overflow on a hot key."""
    return (grade_to_points(grade) * 100).cast("bigint")


def average(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` rounded half up; NULL where nothing was counted.

    ``avg`` of a decimal keeps only four more digits, so rounding its result rounds twice. Dividing the
    two partial sums keeps enough digits, and both sums merge map-side.
    """
    return F.round(total / F.nullif(count, F.lit(0)), scale)


def gpa(hundredths: Column, graded: Column) -> Column:
    """Average of summed hundredths of grade points, divided and rounded once."""
    return average(hundredths.cast("decimal(19,0)"), graded * 100).cast("decimal(3,2)")


def performance_level(hundredths: Column, graded: Column) -> Column:
    """Level of the unrounded average, decided without a division."""
    level = F.when(F.coalesce(graded, F.lit(0)) == 0, F.lit("No Grades"))
    for bound, name in PERFORMANCE_LEVELS:
        level = level.when(reaches(hundredths, graded, bound), F.lit(name))
    return level.otherwise(F.lit("Below Average"))


def reaches(hundredths: Column, graded: Column, bound: str) -> Column:
    """Whether the unrounded average is at least ``bound``."""
    return hundredths >= F.lit(int(Decimal(bound) * 100)) * graded
