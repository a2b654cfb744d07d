"""Calendar expressions: school years, day keys, ages.

Column functions stay inside code generation; the ``*_of`` helpers do the same
for the fixed ``as_of`` date that every job takes instead of reading the clock.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_MONTH = 8

# Labels of the current school year and the four before it.
RELATIVE_LABELS = (
    "Indeværende",
    "Indeværende-1",
    "Indeværende-2",
    "Indeværende-3",
    "Indeværende-4",
)

DAY_FORMATS = ("yyyyMMdd", "yyyy-MM-dd")


def school_year(day: Column) -> Column:
    """Year in which the school year of ``day`` began."""
    return F.year(day) - (F.month(day) < FIRST_MONTH).cast("int")


def school_year_of(day: date) -> int:
    return day.year - (day.month < FIRST_MONTH)


def school_year_name(start: Column) -> Column:
    """``2026`` -> ``2026/2027``; names sort like the years they stand for."""
    return F.concat_ws("/", start.cast("string"), (start + 1).cast("string"))


def school_year_name_of(start: int) -> str:
    return f"{start}/{start + 1}"


def school_year_start(start: Column) -> Column:
    return F.make_date(start, F.lit(FIRST_MONTH), F.lit(1))


def school_year_start_of(day: date) -> date:
    return date(school_year_of(day), FIRST_MONTH, 1)


def relative_label(day: Column, as_of: date, labels: Sequence[str] = RELATIVE_LABELS) -> Column:
    """Label of the school year of ``day`` seen from ``as_of``; null outside the labels."""
    back = F.lit(school_year_of(as_of)) - school_year(day)
    label = F.lit(None).cast("string")
    for years, text in enumerate(labels):
        label = F.when(back == years, F.lit(text)).otherwise(label)
    return label


def day_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_key_of(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def yesterday_of(as_of: date) -> date:
    return as_of - timedelta(days=1)


def parse_day(text: Column, formats: Sequence[str] = DAY_FORMATS) -> Column:
    """Date from text in the first format that fits, else null."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def age(birth: Column, as_of: date) -> Column:
    """Completed years; someone born on 29 February has the birthday on the 28th in common years."""
    today = F.lit(as_of)
    years = F.year(today) - F.year(birth)
    return (years - (F.add_months(birth, years * 12) > today).cast("int")).cast("int")
