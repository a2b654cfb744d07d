"""Staging and target schemas of the school model."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

from dimkeep.plans.fixed_values import COLUMNS, DROPPED


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(3,1)": T.DecimalType(3, 1),
}


def schema_of(columns: str) -> T.StructType:
    """``"a int, b string"`` -> schema, without needing a session."""
    pairs = [column.split() for column in columns.replace("(3,1)", "(3;1)").split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind.replace(";", ",")]) for name, kind in pairs])


def _columns(kind: str, names: str) -> str:
    return ", ".join(f"{n} {kind}" for n in names.split())


# Staged text whose integer type the loads rely on; the rest stays text.
_INTEGERS = {
    "student_basis": "municipality_code paying_mun_code school_district_code student_level class_level "
    "nationality_code birth_country_code mother_tongue_code school_code school_type_code main_school_code",
    "student_history": "row_type school_code school_type_code class_type_code student_level class_level "
    "event_type_code moved_to_mun_code",
    "student_absence": "row_type lesson_number subject_code school_code",
    "student_grades": "class_level school_year_int school_code",
}


def staged(table: str) -> T.StructType:
    """The columns of a staging table with the types the loads use, as they are stored."""
    integers = set(_INTEGERS[table].split())
    names = [n for n in dict.fromkeys(COLUMNS[table].values()) if n not in DROPPED.get(table, ())]
    columns = [T.StructField(n, T.IntegerType() if n in integers else T.StringType()) for n in names]
    return T.StructType([*columns, T.StructField("stg_load_date", T.TimestampNTZType())])


#: Staging tables stored in parts by what kind of row it is, so that a load reads its own rows alone.
STAGED_BY = {"student_history": "row_type", "student_absence": "row_type"}


_PERSON = (
    "cpr_nr first_name last_name uni_login gender father_cpr mother_cpr address_line1 address_line2 "
    "postal_code city_name secret_address father_first_name father_last_name mother_first_name "
    "mother_last_name father_nationality father_birth_country father_custody mother_nationality "
    "mother_birth_country mother_custody"
)
FLAGS = (
    "action_danish_second_lang",
    "action_reception_class",
    "action_special_education",
    "action_supp_danish",
    "action_junior_master",
    "action_intermediate",
)
GRADES = ("sp1_grade", "sp2_grade", "sps_grade", "arb1_grade", "arb2_grade", "arbs_grade", "prv_grade")

TABLES: dict[str, T.StructType] = {
    **{
        f"dim_{x}": schema_of(f"{x}_code int, {x}_name string")
        for x in ("municipality", "citizenship", "country", "language", "school_type", "student_type")
    },
    "dim_main_school": schema_of("main_school_code int, main_school_name string, include_absence boolean"),
    "dim_school": schema_of(
        "school_code int, school_name string, school_owner string, school_type_code int, main_school_code int"
    ),
    "dim_school_district": schema_of("school_district_code int, school_district_name string"),
    "dim_field_name": schema_of("field_name string, description string"),
    "dim_student_sensitive": schema_of(
        f"student_id int, {_columns('string', _PERSON)}, birth_date date, last_seen string"
    ),
    "dim_student": schema_of(
        "student_id int, age int, student_level int, grade_level int, class_track string, class_label string, "
        f"school_district_code int, photo_permission string, transport_permission string, {_columns('boolean', ' '.join(FLAGS))}, "
        "municipality_code int, paying_mun_code int, school_code int, student_type_code int, citizenship_code int, "
        "country_code int, language_code int, previous_main_school_code int"
    ),
    "dim_date": schema_of(
        "date_id int, full_date date, is_weekend boolean, is_vacation_day boolean, school_year_label string"
    ),
    **{
        f"dim_{x}": schema_of(f"{x}_code int, {x}_name string")
        for x in ("class_type", "action_type", "referral_reason", "event_type", "subject", "discipline")
    },
    "dim_exam_type": schema_of("exam_type_code string, exam_type_name string"),
    "fact_enrollment": schema_of(
        "student_id int, school_code int, school_name string, school_type_code int, class_name string, "
        "class_type_code int, student_grade_level int, home_grade_level int, track string, from_date_id int, to_date_id int"
    ),
    "fact_student_action": schema_of(
        "student_id int, action_type_code int, referral_reason_code int, from_date_id int, to_date_id int, "
        "hours string, hours_outside_teaching string"
    ),
    "fact_student_event": schema_of("student_id int, event_type_code int, date_id int"),
    "fact_student_field": schema_of("student_id int, field_name string, field_value string"),
    "fact_student_relocation": schema_of("student_id int, municipality_code int, relocation_date_id int"),
    "fact_absence_daily": schema_of(
        "student_id int, absence_reason_code string, date_id int, school_code int, grade_level smallint, "
        "track string, absence_value decimal(3,1), lesson string"
    ),
    "fact_absence_lesson": schema_of(
        "student_id int, absence_reason_code string, date_id int, lesson_number int, subject_code int, "
        "school_code int, grade_level smallint, track string, absence_value decimal(3,1)"
    ),
    "fact_grade": schema_of(
        "student_id int, subject_code int, discipline_code int, grade_level int, school_year int, fs10 string, "
        f"{_columns('string', ' '.join(GRADES))}, school_code int, exam_type_code string"
    ),
    "fact_student_snapshot": schema_of(
        "date_id int, student_id int, school_code int, municipality_code int, paying_mun_code int, "
        "student_type_code int, citizenship_code int, country_code int, language_code int, grade_level int, "
        f"class_track string, student_level int, gender string, age int, {_columns('smallint', ' '.join(FLAGS))}"
    ),
}

class Parts(NamedTuple):
    """How a table is cut: by a key column divided by a number, or by a hash of it into so many buckets."""

    column: str
    divisor: int = 1
    buckets: int | None = None


# Large facts are stored in parts by a column of their key, so that a run rewrites only the parts
# it has news for; a null belongs to part 0.
PARTS = {
    "fact_absence_daily": Parts("date_id", 100),
    "fact_absence_lesson": Parts("date_id", 100),
    "fact_enrollment": Parts("from_date_id", 10000),
    "fact_grade": Parts("school_year"),
    "fact_student_event": Parts("date_id", 10000),
    "fact_student_field": Parts("student_id", buckets=64),
    "fact_student_relocation": Parts("relocation_date_id", 10000),
}
PART = "part_id"

STUDENT_FACTS = (
    "fact_absence_daily",
    "fact_absence_lesson",
    "fact_grade",
    "fact_enrollment",
    "fact_student_action",
    "fact_student_event",
    "fact_student_relocation",
    "fact_student_field",
    "fact_student_snapshot",
)
