from datetime import date

import pytest
from pyspark.sql import functions as F

from dimkeep.functions import dates, predicates, text


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "day,name", [("2026-07-31", "2025/2026"), ("2026-08-01", "2026/2027"), ("2026-01-01", "2025/2026")]
)
def test_school_year(spark, day, name):
    year = dates.school_year(F.lit(day).cast("date"))
    assert one(spark, dates.school_year_name(year)) == name
    parsed = date.fromisoformat(day)
    assert dates.school_year_name_of(dates.school_year_of(parsed)) == name
    assert one(spark, dates.school_year_start(year)) == dates.school_year_start_of(parsed)
    assert one(spark, dates.day_key(F.lit(day).cast("date"))) == dates.day_key_of(parsed) == int(day.replace("-", ""))


@pytest.mark.parametrize(
    "day,label",
    [
        ("2026-09-01", "Indeværende"), ("2025-09-01", "Indeværende-1"), ("2022-09-01", "Indeværende-4"),
        ("2021-09-01", None), ("2027-09-01", None),
    ],
)
def test_relative_label(spark, day, label):
    assert one(spark, dates.relative_label(F.lit(day).cast("date"), date(2026, 9, 16))) == label


@pytest.mark.parametrize(
    "as_of,age", [("2025-02-27", 12), ("2025-02-28", 13), ("2024-02-28", 11), ("2024-02-29", 12)]
)
def test_age_of_leap_day_birth(spark, as_of, age):
    born = dates.parse_day(F.lit("20120229"))
    assert one(spark, dates.age(born, date.fromisoformat(as_of))) == age


def test_age_of_invalid_birth_date_is_null(spark):
    assert one(spark, dates.age(dates.parse_day(F.lit("20121301")), date(2026, 1, 1))) is None


def test_dates_in_either_format(spark):
    assert one(spark, dates.parse_day(F.lit("2012-02-29"))) == date(2012, 2, 29)


@pytest.mark.parametrize(
    "value,result", [(None, False), ("0", False), ("1", True), ("2", True), ("-1", True), ("true", True), ("FALSE", False)]
)
def test_flag(spark, value, result):
    assert one(spark, predicates.flag(F.lit(value).cast("string"))) is result


def test_flag_rejects_other_words(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, predicates.flag(F.lit("ja")))


def test_whitelist_and_fallback(spark):
    assert one(spark, predicates.keep_known(F.lit(11), [1, 11])) == 11
    assert one(spark, predicates.keep_known(F.lit(12), [1, 11])) == -1
    assert one(spark, predicates.keep_known(F.lit(None).cast("int"), [1, 11])) == -1
    null = F.lit(None).cast("int")
    assert one(spark, predicates.first_known(F.lit(-1), F.lit(5))) == 5
    assert one(spark, predicates.first_known(null, F.lit(-1))) == -1
    assert one(spark, predicates.first_known(F.lit(3), F.lit(5))) == 3


def test_windows_text(spark):
    every = bytes(b for b in range(256) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    raw = spark.createDataFrame([(bytearray(every),)], "raw binary")
    line = raw.select(text.windows_line(F.col("raw"))).first()[0]
    assert line == every.decode("windows-1252")
    assert text.windows_name(every.decode("latin-1")) == line
