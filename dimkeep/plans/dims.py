"""Dimension loads. Each takes typed staging and current tables and returns the changed table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeep.functions import dates
from dimkeep.functions.predicates import UNKNOWN, any_of, differs, first_known, flag, keep_known, or_unknown
from dimkeep.operators.keys import assign_keys
from dimkeep.operators.lookup import latest_prior_parent, lookup
from dimkeep.operators.merge import ACTION, INSERT, NONE, insert_new, merge, rows_to_insert, update_where
from dimkeep.operators.rollup import code_names, collapse_min, with_fallback
from dimkeep.plans import fixed_values as fixed
from dimkeep.plans.model import FLAGS, TABLES

#: Stores a frame that several branches of a plan use.
Keep = Callable[[DataFrame], DataFrame]


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


def refresh_school_year_label(calendar: DataFrame, as_of: date) -> DataFrame:
    """Relabel the days relative to the current school year, touching only days whose label changes."""
    label = dates.relative_label(F.col("full_date"), as_of)
    return update_where(
        calendar, differs(F.col("school_year_label"), label, ""), {"school_year_label": label}
    )


def named_codes(
    basis: DataFrame, target: DataFrame, pairs: Sequence[tuple[str, str]], code: str, name: str
) -> DataFrame:
    """Code dimension kept by name: new codes go in, a changed name is taken over."""
    source = code_names(basis, pairs, code, name)
    return merge(target, source, [code], changed=lambda t, s: differs(t(name), s(name)))


# Code dimensions: table -> staged (code, name) pairs.
NAMED_CODES = {
    "dim_municipality": [("municipality_code", "municipality_name"), ("paying_mun_code", "paying_mun_name")],
    "dim_main_school": [("main_school_code", "main_school_name")],
    "dim_citizenship": [("nationality_code", "nationality_name")],
    "dim_country": [("birth_country_code", "birth_country_name")],
    "dim_language": [("mother_tongue_code", "mother_tongue_name")],
}


def school_type(basis: DataFrame, history: DataFrame, target: DataFrame) -> DataFrame:
    """Insert-only. Types seen in the history alone get a generated name."""
    code, name = "school_type_code", "school_type_name"
    known = code_names(basis, [(code, name)], code, name)
    others = (
        history.where(F.col(code) > 0)
        .select(code)
        .distinct()
        .withColumn(name, F.concat(F.lit(fixed.SCHOOL_TYPE_PREFIX), F.col(code).cast("string")))
    )
    return insert_new(target, with_fallback(known, others, code), [code])


def school(
    basis: DataFrame,
    history: DataFrame,
    target: DataFrame,
    own_main: Sequence[int] = fixed.OWN_MAIN_SCHOOLS,
    main_schools: Sequence[int] = fixed.MAIN_SCHOOLS,
) -> DataFrame:
    """One row per school code, from the basis or else from the history."""
    attributes = ["school_name", "school_owner", "school_type_code", "main_school_code"]

    def source(rows: DataFrame, owner, main) -> DataFrame:
        return collapse_min(
            rows.select(
                "school_code",
                "school_name",
                owner.alias("school_owner"),
                or_unknown(F.col("school_type_code")).alias("school_type_code"),
                main.alias("main_school_code"),
            ),
            "school_code",
            attributes,
        )

    current = source(basis, F.col("school_owner_type"), or_unknown(F.col("main_school_code")))
    past = source(history, F.lit(None).cast("string"), F.lit(UNKNOWN))
    schools = with_fallback(current, past, "school_code").withColumn(
        "main_school_code",
        F.when(F.col("school_code").isin(list(own_main)), F.col("school_code")).otherwise(
            keep_known(F.col("main_school_code"), main_schools)
        ),
    )

    def changed(t, s):
        return any_of(
            [
                differs(t("school_name"), s("school_name")),
                differs(t("school_owner"), s("school_owner"), ""),
                differs(t("school_type_code"), s("school_type_code")),
                differs(t("main_school_code"), s("main_school_code")),
            ]
        )

    return merge(target, schools, ["school_code"], changed=changed, unique=True)


def _insert_numbered(target: DataFrame, rows: DataFrame, natural: str, key: str) -> DataFrame:
    """Insert-only with a generated key."""
    new = rows_to_insert(target, rows, [natural], distinct=True)
    return target.withColumn(ACTION, F.lit(NONE)).unionByName(
        assign_keys(target, new, [natural], key).withColumn(ACTION, F.lit(INSERT)), allowMissingColumns=True
    )


def student_type(basis: DataFrame, target: DataFrame) -> DataFrame:
    names = basis.where(F.col("student_type_name").isNotNull()).select("student_type_name")
    return _insert_numbered(target, names, "student_type_name", "student_type_code")


def field_name(history: DataFrame, target: DataFrame) -> DataFrame:
    names = history.where((F.col("row_type") == fixed.FIELD) & F.col("field_name").isNotNull()).select("field_name")
    return insert_new(target, names, ["field_name"])


def student_sensitive(basis: DataFrame, target: DataFrame, as_of: date, keep: Keep = _as_it_is) -> DataFrame:
    """Personal data by civil number. Every student seen is marked with the current school year.

    ``keep`` may store what the merge reads several times: the source under its keys.
    """
    seen = dates.school_year_name_of(dates.school_year_of(as_of))
    attributes = [c for c in TABLES["dim_student_sensitive"].fieldNames() if c not in ("student_id", "cpr_nr", "last_seen")]
    rows = (
        basis.where(F.col("cpr_nr").isNotNull())
        .withColumn("birth_date", dates.parse_day(F.col("birth_date")))
        .select("cpr_nr", *attributes, F.lit(seen).alias("last_seen"))
    )
    rows = keep(rows)
    # Students not known yet are numbered first; the merge then inserts them under their keys.
    unknown = rows_to_insert(target, rows.select("cpr_nr"), ["cpr_nr"], distinct=True)
    source = rows.join(keep(assign_keys(target, unknown, ["cpr_nr"], "student_id")), "cpr_nr", "left")
    no_date = date(1900, 1, 1)

    def changed(t, s):
        tests = [differs(t(c), s(c), no_date if c == "birth_date" else "") for c in attributes]
        return any_of([*tests, differs(t("last_seen"), s("last_seen"))])

    return merge(target, source, ["cpr_nr"], changed=changed, update=[*attributes, "last_seen"])


def previous_main_school(
    enrollment: DataFrame, schools: DataFrame, students: DataFrame, transfer_school: int = fixed.TRANSFER_SCHOOL
) -> DataFrame:
    """Main school of the last ended enrolment elsewhere, for students now at the transfer school.

    Of several enrolments that ended on that day, the one under the highest main school counts.
    """
    found = latest_prior_parent(
        enrollment,
        schools,
        students,
        member="student_id",
        unit="school_code",
        until="to_date_id",
        parent="main_school_code",
        this_unit=transfer_school,
    )
    return found.groupBy("student_id").agg(F.max("main_school_code").alias("main_school_code"))


def student(
    basis: DataFrame,
    target: DataFrame,
    people: DataFrame,
    student_types: DataFrame,
    districts: DataFrame,
    enrollment: DataFrame,
    schools: DataFrame,
    as_of: date,
    known_districts: Sequence[int] = fixed.DISTRICTS,
    transfer_school: int = fixed.TRANSFER_SCHOOL,
    keep: Keep = _as_it_is,
) -> DataFrame:
    """Current students under their surrogate key; those gone from the extract are deleted.

    ``keep`` may store the source, with all its lookups resolved.
    """
    rows = lookup(
        basis.drop("student_id"), people, "cpr_nr", "cpr_nr", {"student_id": "student_id"}, required=True
    )
    rows = lookup(
        rows, student_types, "student_type_name", "student_type_name",
        {"student_type_code": "student_type_code"}, default=UNKNOWN,
    )
    rows = lookup(
        rows, districts, keep_known(F.col("school_district_code"), known_districts), "school_district_code",
        {"school_district_code": "school_district_code"}, default=UNKNOWN,
    )
    rows = lookup(
        rows, previous_main_school(enrollment, schools, target, transfer_school), "student_id", "student_id",
        {"previous": "main_school_code"},
    )
    source = rows.select(
        "student_id",
        dates.age(dates.parse_day(F.col("birth_date")), as_of).alias("age"),
        "student_level",
        F.col("class_level").alias("grade_level"),
        "class_track",
        "class_label",
        "school_district_code",
        "photo_permission",
        "transport_permission",
        *[flag(F.col(c)).alias(c) for c in FLAGS],
        or_unknown(F.col("municipality_code")).alias("municipality_code"),
        or_unknown(F.col("paying_mun_code")).alias("paying_mun_code"),
        or_unknown(F.col("school_code")).alias("school_code"),
        "student_type_code",
        or_unknown(F.col("nationality_code")).alias("citizenship_code"),
        or_unknown(F.col("birth_country_code")).alias("country_code"),
        or_unknown(F.col("mother_tongue_code")).alias("language_code"),
        first_known(F.col("previous"), F.col("school_district_code")).alias("previous_main_school_code"),
    )
    return merge(
        target, keep(source), ["student_id"], gone="delete", gone_if=lambda t: t("student_id") != UNKNOWN
    )
