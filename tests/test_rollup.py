from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimkeep.operators.calendar_gaps import asof_source, baseline_rows, fill_gaps, last_school_days
from dimkeep.operators.lookup import eligible_members, latest_prior_parent, lookup
from dimkeep.operators.rollup import collapse_min, daily_rollup, with_fallback
from dimkeep.plans.dims import previous_main_school

FIRST, LAST = "første", "sidste"
CASES = {
    "full day": ([(5, "S", "8", None)], ("S", "1.0", "Hele dagen")),
    "first half": ([(7, "L", "8", FIRST)], ("L", "0.5", "Første lektion")),
    "last half": ([(7, "L", "8", LAST)], ("L", "0.5", "Sidste lektion")),
    "same half twice": ([(7, "L", "8", FIRST), (7, "L", "8", FIRST)], ("L", "1.0", "Hele dagen")),
    "half in a low grade": ([(7, "F", "3", LAST)], ("F", "1.0", "Hele dagen")),
    "half without grade": ([(7, "F", None, None)], ("F", "0.5", None)),
    "half with other grade": ([(7, "F", "x", LAST)], ("F", "0.5", "Sidste lektion")),
    "reason and value apart": ([(5, "S", "8", None), (7, "U", "8", FIRST)], ("U", "1.0", "Hele dagen")),
    "two halves": ([(7, "F", "9", FIRST), (7, "L", "9", LAST)], ("L", "1.0", "Hele dagen")),
    "unknown reason": ([(5, "X", "8", None)], None),
    "other kind": ([(6, "S", "8", None)], None),
}


@pytest.mark.parametrize("case", CASES)
def test_daily_rollup(spark, case):
    given, expected = CASES[case]
    rows = spark.createDataFrame([(1, *r) for r in given], "id int, kind int, reason string, grade string, part string")
    got = daily_rollup(rows, ["id"], kind="kind", reason="reason", grade="grade", part="part").collect()
    if expected is None:
        assert got == []
    else:
        reason, value, label = expected
        assert [(r.absence_reason_code, r.absence_value, r.lesson) for r in got] == [(reason, Decimal(value), label)]


def test_grade_is_compared_as_a_number(spark):
    rows = spark.createDataFrame([(1, 5, "S", "9"), (1, 5, "S", "10")], "id int, kind int, reason string, grade string")
    assert daily_rollup(rows, ["id"], kind="kind", reason="reason", grade="grade").first().grade_level == 10


def test_collapse_takes_each_minimum(spark, rows):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (None, "c", 3)], "k int, x string, y int")
    assert rows(collapse_min(df, "k", ["x", "y"])) == [(1, "a", 1)]


def test_fallback_only_for_missing_codes(spark, rows):
    a = spark.createDataFrame([(1, "a")], "k int, n string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, n string")
    assert rows(with_fallback(a, b, "k")) == [(1, "a"), (2, "y")]


# -- calendar -------------------------------------------------------------------

AS_OF = date(2026, 9, 16)


@pytest.fixture(scope="module")
def calendar(spark):
    days = [date(2026, 8, 24 + i) if i < 8 else date(2026, 9, i - 7) for i in range(38)]
    return spark.createDataFrame(
        [(d.year * 10000 + d.month * 100 + d.day, d, d.weekday() >= 5, False) for d in days],
        "date_id int, full_date date, is_weekend boolean, is_vacation_day boolean",
    )


WINDOW = [20260902, 20260903, 20260904, 20260907, 20260908, 20260909, 20260910, 20260911, 20260914, 20260915]


def facts(spark, days, extra=()):
    rows = [(1, d, 100, 4, "A") for d in days] + list(extra)
    return spark.createDataFrame(rows, "student_id int, date_id int, school_code int, grade_level int, track string")


@pytest.fixture(scope="module")
def roster(spark):
    return spark.createDataFrame([(8, 200, 5, "B"), (9, 200, 5, "B")], "student_id int, school_code int, grade_level int, track string")


def fill(fact, calendar, roster):
    return fill_gaps(fact, calendar, roster, AS_OF, copied=["student_id", "school_code", "grade_level", "track"])


def test_window(calendar, rows):
    assert [r[0] for r in rows(last_school_days(calendar, AS_OF))] == WINDOW


def test_one_hole(spark, calendar, roster, rows):
    fact = facts(spark, [d for d in WINDOW if d != 20260910], [(2, 20260909, 101, 3, None), (3, 20260908, 1, 1, "C")])
    got = rows(fill(fact, calendar, roster))
    assert got == sorted(
        [(20260910, 1, 100, 4, "A", "IF", Decimal("0.0"), None), (20260910, 2, 101, 3, None, "IF", Decimal("0.0"), None)],
        key=repr,
    )


def test_two_holes_share_a_source(spark, calendar, roster, rows):
    fact = facts(spark, [d for d in WINDOW if d not in (20260909, 20260910)])
    assert [r[:2] for r in rows(fill(fact, calendar, roster))] == [(20260909, 1), (20260910, 1)]


def test_hole_at_the_start_takes_the_roster(spark, calendar, roster, rows):
    fact = facts(spark, [20260901, *WINDOW[1:]])
    assert [r[:3] for r in rows(fill(fact, calendar, roster))] == [(20260902, 8, 200), (20260902, 9, 200)]


def test_vacation_is_not_filled(spark, calendar, roster, rows):
    holiday = calendar.withColumn("is_vacation_day", F.col("date_id") == 20260911)
    fact = facts(spark, [d for d in [20260901, *WINDOW] if d != 20260911])
    assert rows(fill(fact, holiday, roster)) == []
    assert 20260901 in [r[0] for r in rows(last_school_days(holiday, AS_OF))]


def test_two_grades_on_the_source_day_give_two_rows(spark, calendar, roster, rows):
    fact = facts(spark, [d for d in WINDOW if d != 20260910], [(1, 20260909, 100, 5, "A")])
    assert [r[:4] for r in rows(fill(fact, calendar, roster))] == [(20260910, 1, 100, 4), (20260910, 1, 100, 5)]


def test_filling_twice_adds_nothing(spark, calendar, roster):
    fact = facts(spark, [d for d in WINDOW if d != 20260910])
    filled = fact.unionByName(fill(fact, calendar, roster).select(fact.columns))
    assert fill(filled, calendar, roster).count() == 0


def test_empty_fact_takes_the_roster_everywhere(spark, calendar, roster):
    assert fill(facts(spark, []), calendar, roster).count() == 20


def test_asof_source(spark, calendar, rows):
    present = spark.createDataFrame([(20260903,), (20260907,)], "date_id int")
    days = spark.createDataFrame([(d,) for d in WINDOW[:5]], "date_id int")
    assert rows(asof_source(days, present)) == sorted(
        [(20260902, None), (20260904, 20260903), (20260908, 20260907)], key=repr
    )


def test_baseline_only_on_school_days_and_where_missing(spark, calendar, roster, rows):
    fact = facts(spark, [], [(8, 20260915, 200, 5, "B"), (9, 20260915, 201, 5, "B")])
    got = rows(baseline_rows(roster, fact, calendar, 20260915, ["student_id", "school_code"]), "student_id", "date_id")
    assert got == [(9, 20260915)]
    assert baseline_rows(roster, fact, calendar, 20260913, ["student_id", "school_code"]).count() == 0


# -- lookups --------------------------------------------------------------------


def test_lookup(spark, rows):
    df = spark.createDataFrame([(1, "7"), (2, "x"), (3, None), (4, "8")], "id int, code string")
    dim = spark.createDataFrame([(7, "seven"), (-1, "?")], "code int, name string")
    key = F.col("code").try_cast("int")
    assert rows(lookup(df, dim, key, "code", {"code": "code"}, default=-1)) == [(1, 7), (2, -1), (3, -1), (4, -1)]
    assert rows(lookup(df, dim, key, "code", {"name": "name"}, required=True)) == [(1, "7", "seven")]


def test_eligible_members(spark, rows):
    members = spark.createDataFrame([(1, 10), (2, 20), (3, 99), (-1, 10)], "m int, u int")
    units = spark.createDataFrame([(10, 100), (20, 200)], "u int, g int")
    groups = spark.createDataFrame([(100, True), (200, None)], "g int, ok boolean")
    args = dict(member_key="m", unit_key="u", group_key="g", flag="ok")
    assert rows(eligible_members(members, units, groups, **args), "m") == [(1,)]
    assert rows(eligible_members(members, units, groups, **args, unknown=None), "m") == [(-1,), (1,)]


def test_latest_prior_parent_keeps_ties(spark, rows):
    stays = spark.createDataFrame(
        [(1, 10, 5), (1, 20, 5), (1, 10, 3), (1, 7, 9), (1, 10, None), (2, 10, 4)], "m int, u int, till int"
    )
    units = spark.createDataFrame([(10, 100), (20, 200), (7, 700)], "u int, p int")
    members = spark.createDataFrame([(1, 7), (2, 10)], "m int, u int")
    got = latest_prior_parent(stays, units, members, member="m", unit="u", until="till", parent="p", this_unit=7)
    assert rows(got) == [(1, 100), (1, 200)]


def test_previous_main_school_is_one_where_two_stays_end_together(spark, rows):
    stays = spark.createDataFrame([(1, 10, 5), (1, 20, 5), (1, 30, 5), (1, 20, 3), (2, 10, 4), (3, 20, 6)], "student_id int, school_code int, to_date_id int")
    schools = spark.createDataFrame([(10, 100), (20, 200), (30, None), (7, 700)], "school_code int, main_school_code int")
    students = spark.createDataFrame([(1, 7), (2, 7), (3, 10)], "student_id int, school_code int")
    got = previous_main_school(stays, schools, students, transfer_school=7)
    assert rows(got, "student_id", "main_school_code") == [(1, 200), (2, 100)]
