"""An invented school world: extract files and a warehouse with its reference tables."""

from datetime import date, timedelta
from pathlib import Path

from dimkeep.plans.fixed_values import COLUMNS
from dimkeep.plans.model import TABLES
from dimkeep.plans.warehouse import Warehouse

AS_OF = date(2026, 9, 16)


def student(cpr, school=280093, main=280093, **more):
    """One row of the basis extract by staged names."""
    row = {
        "cpr_nr": cpr, "first_name": f"F{cpr}", "last_name": "L", "birth_date": "20150301", "gender": "K",
        "municipality_code": 860, "municipality_name": "North", "school_district_code": 11,
        "student_level": 4, "class_level": 4, "class_track": "A", "class_label": "4A",
        "student_type_name": "Normal", "nationality_code": 5100, "nationality_name": "DK",
        "birth_country_code": 5100, "birth_country_name": "DK", "mother_tongue_code": 1, "mother_tongue_name": "dansk",
        "school_code": school, "school_name": f"School {school}", "school_type_code": 121, "school_type_name": "Folk",
        "main_school_code": main, "main_school_name": f"Main {main}", "school_owner_type": "K",
        "action_reception_class": 1,
    }
    row.update(more)
    return row


def write_basis(folder, students):
    names = COLUMNS["student_basis"]
    lines = [";".join(names)]
    for s in students:
        lines.append(";".join("" if s.get(t) is None else str(s[t]) for t in names.values()))
    Path(folder, "elev_basis.csv").write_bytes("\r\n".join(lines).encode("windows-1252"))


def write_sections(folder, file, sections):
    """sections: list of (header names, rows as lists starting with the row type)."""
    lines = ["1;extract;20260916"]
    for header, rows in sections:
        lines.append(";".join(["2", *header]))
        lines += [";".join("" if c is None else str(c) for c in r) for r in rows]
        lines.append(f"3;{len(rows)}")
    Path(folder, file).write_bytes(("\r\n".join(lines) + "\r\n").encode("windows-1252"))


STAY = ["Cprnr", "Skolekode", "Skolenavn", "Skoletype", "Klassebetegnelse", "Klassetype", "Elevklassetrin",
        "Stamklassetrin", "Klassespor", "Fradato", "Tildato"]


def stay(cpr, school, start, end=None, name=None, kind=121):
    return [4, cpr, school, name or f"School {school}", kind, "4A", 1, 4, 4, "A", start, end]


def write_history(folder, stays=(), actions=(), events=(), fields=(), moves=()):
    write_sections(
        folder,
        "elev_historik.csv",
        [
            (STAY, list(stays)),
            (["Cprnr", "Tiltagstype", "Henvisningsaarsag", "Fradato", "Tildato", "Timer", "TimerUdenForundervisning"],
             [[5, *a] for a in actions]),
            (["Cprnr", "Haendelsestype", "Dato"], [[6, *e] for e in events]),
            (["Cprnr", "Feltnavn", "Feltvaerdi"], [[7, *f] for f in fields]),
            (["Cprnr", "Tilflyttetkommunekode", "TilflyttetDato"], [[8, *m] for m in moves]),
        ],
    )


def write_absence(folder, full=(), half=(), lessons=()):
    """full: (cpr, reason, day, school, level); half adds the part; lessons: number and subject."""
    write_sections(
        folder,
        "elev_fravaer.csv",
        [
            (["cprnr", "aarsag", "dato", "skolekode", "trin", "spor"], [[5, *r, "A"] for r in full]),
            (["cprnr", "aarsag", "dato", "skolekode", "trin", "lektion", "spor"], [[7, *r, "A"] for r in half]),
            (["cprnr", "aarsag", "dato", "skolekode", "trin", "lektionsnr", "fagkode", "spor"], [[6, *r, "A"] for r in lessons]),
        ],
    )


def write_grades(folder, grades=()):
    """grades: (cpr, subject, discipline, level, year, fs10, first grade, school, exam type)."""
    header = ["Cprnr", "Fagkode", "Disciplin", "Klassetrin", "Skoleaar", "FS10", "SP1_Karakter", "Skolekode", "Prøvetype"]
    write_sections(folder, "elev_karakterer.csv", [(header, [["4", *g] for g in grades])])


def new_warehouse(spark, root, main_schools=((280093, True), (280628, True))):
    """Reference tables, sentinels and two years of calendar; no facts."""
    wh = Warehouse(spark, str(root))

    def put(name, data):
        schema = TABLES[name]
        wh.replace(name, spark.createDataFrame([tuple(r) + (None,) * (len(schema) - len(r)) for r in data], schema))

    first, days = date(2025, 8, 1), []
    for i in range(720):
        d = first + timedelta(days=i)
        days.append((d.year * 10000 + d.month * 100 + d.day, d, d.weekday() >= 5, False, None))
    put("dim_date", days)
    put("dim_main_school", [(code, f"Main {code}", flag) for code, flag in main_schools] + [(-1, "?", False)])
    put("dim_school_district", [(c, f"D{c}") for c in (-1, 1, 11, 18, 20, 22, 23)])
    put("dim_student_type", [(-1, "?")])
    put("dim_class_type", [(1, "Class")])
    put("dim_action_type", [(3, "Help")])
    put("dim_referral_reason", [(7, "Need")])
    put("dim_event_type", [(40, "Move")])
    put("dim_subject", [(1, "Dansk"), (2, "Matematik")])
    put("dim_discipline", [(1, "Written")])
    put("dim_exam_type", [("FP9", "Exam"), ("-1", "?")])
    return wh
