"""Fact loads. Each takes typed staging and current tables and returns the changed table or its new rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.functions import dates
from dimkeep.functions.predicates import UNKNOWN, any_of, differs, or_unknown
from dimkeep.operators.calendar_gaps import BASELINE_REASON, BASELINE_VALUE, baseline_rows, fill_gaps
from dimkeep.operators.lookup import eligible_members, lookup, on_school_days
from dimkeep.operators.merge import delete_members, mark_members, merge, rows_to_insert
from dimkeep.operators.rollup import daily_rollup, until
from dimkeep.plans import fixed_values as fixed
from dimkeep.plans.model import FLAGS, GRADES

_DAILY_KEY = ["student_id", "date_id", "school_code"]
_ELIGIBLE = "_eligible"


# -- shared pieces --------------------------------------------------------------


def of_type(rows: DataFrame, *types: int) -> DataFrame:
    return rows.where(F.col("row_type").isin(list(types)))


def with_student(rows: DataFrame, people: DataFrame) -> DataFrame:
    return lookup(rows, people, "cpr_nr", "cpr_nr", {"student_id": "student_id"}, required=True)


def with_code(rows: DataFrame, dim: DataFrame, code: str, key=None, default=UNKNOWN) -> DataFrame:
    return lookup(rows, dim, code if key is None else key, code, {code: code}, default=default)


def absence_students(students: DataFrame, schools: DataFrame, main_schools: DataFrame) -> DataFrame:
    """Students whose main school takes part in absence reporting."""
    return eligible_members(
        students,
        schools,
        main_schools,
        member_key="student_id",
        unit_key="school_code",
        group_key="main_school_code",
        flag="include_absence",
    )


def roster(students: DataFrame, schools: DataFrame, main_schools: DataFrame) -> DataFrame:
    """The columns a baseline row takes from its student."""
    return absence_students(students, schools, main_schools).select(
        "student_id",
        or_unknown(F.col("school_code")).alias("school_code"),
        F.col("grade_level").cast("smallint").alias("grade_level"),
        F.col("class_track").alias("track"),
    )


# -- retention ------------------------------------------------------------------


def departed(people: DataFrame, as_of: date, years: int = 5) -> DataFrame:
    """Students last seen before the current school year and the ``years`` before it."""
    cutoff = dates.school_year_name_of(dates.school_year_of(as_of) - years)
    return people.where(
        (F.col("student_id") != UNKNOWN) & (F.col("last_seen").isNull() | (F.col("last_seen") < cutoff))
    ).select("student_id")


def without(table: DataFrame, gone: DataFrame) -> DataFrame:
    return delete_members(table, gone, ["student_id"])


# -- loads from the history -----------------------------------------------------


def enrollment_rows(history, people, schools, school_types, class_types) -> DataFrame:
    rows = of_type(history, fixed.ENROLLMENT).where(F.col("valid_from").isNotNull())
    rows = with_student(rows, people)
    rows = with_code(rows, schools, "school_code")
    rows = with_code(rows, school_types, "school_type_code")
    rows = with_code(rows, class_types, "class_type_code")
    return rows.select(
        "student_id",
        "school_code",
        "school_name",
        "school_type_code",
        F.col("class_label").alias("class_name"),
        "class_type_code",
        F.col("student_level").alias("student_grade_level"),
        F.col("class_level").alias("home_grade_level"),
        F.col("class_track").alias("track"),
        F.col("valid_from").cast("int").alias("from_date_id"),
        F.col("valid_to").try_cast("int").alias("to_date_id"),
    )


def enrollment(target, rows) -> DataFrame:
    blanks = {
        "to_date_id": -1,
        "school_name": "",
        "school_type_code": None,
        "class_name": "",
        "class_type_code": None,
        "student_grade_level": -1,
        "home_grade_level": -1,
        "track": "",
    }
    return merge(
        target,
        rows,
        ["student_id", "school_code", "from_date_id"],
        changed=lambda t, s: any_of([differs(t(c), s(c), blank) for c, blank in blanks.items()]),
    )


def student_action(history, people, action_types, reasons) -> DataFrame:
    """The whole fact anew."""
    rows = of_type(history, fixed.ACTION).where(F.col("valid_from").isNotNull())
    rows = with_student(rows, people)
    rows = with_code(rows, action_types, "action_type_code", F.col("action_type_code").try_cast("int"))
    rows = with_code(rows, reasons, "referral_reason_code", F.col("referral_reason_code").try_cast("int"))
    return rows.select(
        "student_id",
        "action_type_code",
        "referral_reason_code",
        F.col("valid_from").cast("int").alias("from_date_id"),
        F.col("valid_to").try_cast("int").alias("to_date_id"),
        "hours",
        F.col("hours_outside").alias("hours_outside_teaching"),
    )


def event_rows(history, people, event_types) -> DataFrame:
    rows = of_type(history, fixed.EVENT).where(F.col("event_date").isNotNull())
    rows = with_code(with_student(rows, people), event_types, "event_type_code")
    return rows.select("student_id", "event_type_code", F.col("event_date").cast("int").alias("date_id"))


def student_event(history, target, people, event_types) -> DataFrame:
    """New rows only; repeats within one extract all go in."""
    return new_events(target, event_rows(history, people, event_types))


def new_events(target, rows) -> DataFrame:
    return rows_to_insert(target, rows, ["student_id", "event_type_code", "date_id"], distinct=False)


def field_rows(history, people, field_names) -> DataFrame:
    rows = with_student(of_type(history, fixed.FIELD), people)
    rows = lookup(rows, field_names, "field_name", "field_name", {"field_name": "field_name"}, required=True)
    return rows.select("student_id", "field_name", "field_value")


def student_field(target, rows) -> DataFrame:
    return merge(
        target,
        rows,
        ["student_id", "field_name"],
        changed=lambda t, s: differs(t("field_value"), s("field_value"), ""),
    )


def relocation_rows(history, people, municipalities) -> DataFrame:
    rows = of_type(history, fixed.RELOCATION).where(F.col("moved_date").isNotNull())
    rows = lookup(
        with_student(rows, people), municipalities, "moved_to_mun_code", "municipality_code",
        {"municipality_code": "municipality_code"}, default=UNKNOWN,
    )
    return rows.select(
        "student_id", "municipality_code", F.col("moved_date").cast("int").alias("relocation_date_id")
    )


def student_relocation(history, target, people, municipalities) -> DataFrame:
    """New rows only; the municipality is not part of the key."""
    return new_relocations(target, relocation_rows(history, people, municipalities))


def new_relocations(target, rows) -> DataFrame:
    return rows_to_insert(target, rows, ["student_id", "relocation_date_id"], distinct=False)


# -- absence --------------------------------------------------------------------


def absence_gaps(fact, calendar, students, schools, main_schools, as_of: date, n: int = 10) -> DataFrame:
    """Baseline rows for the last school days without any registration."""
    return fill_gaps(
        fact,
        calendar,
        roster(students, schools, main_schools),
        as_of,
        copied=["student_id", "school_code", "grade_level", "track"],
        n=n,
    )


def absence_baseline(fact, calendar, students, schools, main_schools, as_of: date) -> DataFrame:
    """Baseline rows of yesterday for the students who have none yet."""
    return baseline_rows(
        roster(students, schools, main_schools),
        fact,
        calendar,
        dates.day_key_of(dates.yesterday_of(as_of)),
        ["student_id", "school_code"],
    )


def absences(staged, *types: int) -> DataFrame:
    """Registrations of these kinds for a reason that counts."""
    return of_type(staged, *types).where(F.col("absence_reason").isin(list(fixed.REASONS)))


def absence_rollup(staged, people, students, schools, main_schools, calendar, as_of: date) -> DataFrame:
    """One row per student, school day and school, up to yesterday."""
    rows = absences(staged, *fixed.DAILY)
    rows = until(rows, F.to_date("absence_date", "yyyyMMdd"), dates.yesterday_of(as_of))
    rows = with_student(rows, people).withColumn("date_id", F.col("absence_date").cast("int"))
    rows = rows.join(
        absence_students(students, schools, main_schools).select("student_id"), "student_id", "left_semi"
    )
    rows = with_code(on_school_days(rows, "date_id", calendar), schools, "school_code")
    return daily_rollup(
        rows,
        _DAILY_KEY,
        kind="row_type",
        reason="absence_reason",
        grade="class_level",
        part="half_day_part",
        track="class_track",
    )


def absence_daily(fact, rollup, eligible, as_of: date) -> DataFrame:
    """Merge the rollup; registrations of this school year that are gone fall back to the baseline."""
    start = dates.day_key_of(dates.school_year_start_of(as_of))
    blanks = {
        "absence_reason_code": None,
        "absence_value": None,
        "lesson": "",
        "grade_level": -1,
        "track": "",
    }
    return merge(
        mark_members(fact, eligible, ["student_id"], _ELIGIBLE),
        rollup,
        _DAILY_KEY,
        changed=lambda t, s: any_of([differs(t(c), s(c), blank) for c, blank in blanks.items()]),
        gone={"absence_reason_code": BASELINE_REASON, "absence_value": BASELINE_VALUE, "lesson": None},
        gone_if=lambda t: (t("absence_reason_code") != BASELINE_REASON)
        & (t("date_id") >= start)
        & t(_ELIGIBLE),
        markers=[_ELIGIBLE],
        unique=True,
    )


def lesson_rows(staged, people, students, schools, main_schools, subjects) -> DataFrame:
    rows = absences(staged, fixed.LESSON)
    # Here the sentinel student is not excluded.
    eligible = eligible_members(
        students, schools, main_schools,
        member_key="student_id", unit_key="school_code", group_key="main_school_code",
        flag="include_absence", unknown=None,
    ).select("student_id")
    rows = with_student(rows, people).join(eligible, "student_id", "left_semi")
    rows = with_code(with_code(rows, subjects, "subject_code"), schools, "school_code")
    return rows.select(
        "student_id",
        F.col("absence_reason").alias("absence_reason_code"),
        F.col("absence_date").cast("int").alias("date_id"),
        "lesson_number",
        "subject_code",
        "school_code",
        F.col("class_level").cast("smallint").alias("grade_level"),
        F.col("class_track").alias("track"),
        F.lit(1).cast("decimal(3,1)").alias("absence_value"),
    )


def absence_lesson(target, rows) -> DataFrame:
    """Lesson registrations. Only a changed reason updates a row; grade and track then come along."""
    return merge(
        target,
        rows,
        ["student_id", "date_id", "lesson_number", "school_code", "subject_code"],
        changed=lambda t, s: differs(t("absence_reason_code"), s("absence_reason_code")),
        update=["absence_reason_code", "grade_level", "track"],
    )


# -- grades and snapshot --------------------------------------------------------


def grade_rows(staged, people, subjects, disciplines, schools, exam_types) -> DataFrame:
    rows = with_student(staged, people)
    rows = with_code(rows, subjects, "subject_code", F.col("subject_code").try_cast("int"))
    rows = with_code(rows, disciplines, "discipline_code", F.col("discipline_code").try_cast("int"))
    rows = with_code(rows, schools, "school_code")
    rows = with_code(rows, exam_types, "exam_type_code", default=fixed.UNKNOWN_EXAM)
    taken = ("grade_sp1", "grade_sp2", "grade_sp_final", "grade_work1", "grade_work2", "grade_work_final", "grade_exam")
    return rows.select(
        "student_id",
        "subject_code",
        "discipline_code",
        F.col("class_level").alias("grade_level"),
        F.col("school_year_int").alias("school_year"),
        F.col("is_fs10").alias("fs10"),
        *[F.col(old).alias(new) for old, new in zip(taken, GRADES)],
        "school_code",
        "exam_type_code",
    )


def grade(target, rows) -> DataFrame:
    def changed(t, s):
        blank = [differs(t(c), s(c), "") for c in GRADES]
        return any_of([*blank, differs(t("fs10"), s("fs10")), differs(t("school_code"), s("school_code"))])

    return merge(
        target,
        rows,
        ["student_id", "subject_code", "discipline_code", "grade_level", "school_year", "exam_type_code"],
        changed=changed,
    )


def student_snapshot(students: DataFrame, people: DataFrame, as_of: date) -> DataFrame:
    """All current students as of today, without the sentinel. The fact holds this one day."""
    rows = lookup(
        students.where(F.col("student_id") != UNKNOWN), people, "student_id", "student_id",
        {"gender": "gender"}, required=True,
    )
    return rows.select(
        F.lit(dates.day_key_of(as_of)).alias("date_id"),
        "student_id",
        "school_code",
        "municipality_code",
        "paying_mun_code",
        "student_type_code",
        "citizenship_code",
        "country_code",
        "language_code",
        "grade_level",
        "class_track",
        "student_level",
        "gender",
        "age",
        *[F.col(c).cast("smallint").alias(c) for c in FLAGS],
    )
