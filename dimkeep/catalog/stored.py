"""Staging, the store, the run and its log on whole tables, each on a store of its own in the shared folder."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dimkeep.catalog.extracts import new_scratch
from dimkeep.catalog.jobs import AS_OF, School, sql_of
from dimkeep.catalog.registry import Tables, key_of, oracles, query
from dimkeep.functions.dates import day_key
from dimkeep.functions.predicates import differs
from dimkeep.operators.merge import merge
from dimkeep.plans import fixed_values as fixed
from dimkeep.plans.audit import Run, run_log, step_log
from dimkeep.plans.model import STUDENT_FACTS, schema_of, staged
from dimkeep.plans.daily import DailyLoad, run_daily
from dimkeep.plans.staging_load import load_staging, stage
from dimkeep.plans.warehouse import Warehouse
from dimkeep.sources.store import Store, observed

_ORDERS = schema_of("o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderstatus string, o_year int")


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("o_year"))


def _second_day(before: DataFrame, orders: DataFrame) -> DataFrame:
    """Finished orders get their status, new ones come, those of low priority go."""
    return merge(
        before,
        orders.where("o_orderpriority <> '5-LOW'"),
        ["o_orderkey"],
        changed=lambda old, new: differs(old("o_orderstatus"), new("o_orderstatus"), ""),
        gone="delete",
    )


def _two_days(t: Tables) -> tuple[Store, str]:
    """A table in parts: all but the last years as open orders, then the merge of all orders, under an audited run."""
    store = Store(t.spark, new_scratch(t).place())
    log = f"{store.files.root}/_log"
    orders = _orders(t)
    early = orders.where("o_year < 2001").withColumn("o_orderstatus", F.lit("O"))

    def change() -> dict:
        seen = Observation()
        watched = orders.observe(seen, F.count(F.lit(1)).alias("rows"))
        done = store.apply("orders", _second_day(store.rows("orders", _ORDERS), watched), _ORDERS, "o_year")
        return {"read": observed(seen, orders, ["rows"])["rows"], **done}

    with Run(t.spark, log) as run:
        run.step("load", "replace", lambda: {"inserted": store.replace("orders", early, "o_year")})
        run.step("load", "append nothing", lambda: {"inserted": store.append("orders", early.where("o_orderstatus IS NULL"), "o_year")})
        run.step("load", "merge", change)
        run.step("load", "merge again", change)
    return store, log


@query("SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders WHERE o_orderpriority <> '5-LOW'")
def stored_merge(t: Tables) -> DataFrame:
    """What the store holds after a replace, an empty append and two merges."""
    return _two_days(t)[0].read("orders", _ORDERS)


@query("""
WITH o AS (SELECT *, year(o_orderdate) < 2001 AS early, o_orderpriority <> '5-LOW' AS stays FROM orders)
SELECT 'replace' AS step_name, 'success' AS status, CAST(NULL AS BIGINT) AS rows_read, count(*) FILTER (early) AS rows_inserted,
       CAST(NULL AS BIGINT) AS rows_updated, CAST(NULL AS BIGINT) AS rows_deleted FROM o
UNION ALL SELECT 'append nothing', 'success', NULL, 0, NULL, NULL
UNION ALL SELECT 'merge', 'success', count(*), count(*) FILTER (NOT early AND stays),
       count(*) FILTER (early AND stays AND o_orderstatus <> 'O'), count(*) FILTER (early AND NOT stays) FROM o
UNION ALL SELECT 'merge again', 'success', count(*), 0, 0, 0 FROM o
""")
def audited_run(t: Tables) -> DataFrame:
    """The step log of that run, joined to its run."""
    log = _two_days(t)[1]
    done = run_log(t.spark, log).where("status = 'success'").select("run_id")
    return step_log(t.spark, log).join(done, "run_id").select("step_name", "status", "rows_read", "rows_inserted", "rows_updated", "rows_deleted")


@query(sql_of("basis") + """
SELECT cpr_nr, first_name, birth_date, CAST(school_code AS INTEGER) AS school_code, CAST(school_type_code AS INTEGER) AS school_type_code, 20240131 AS load_day
FROM basis WHERE first_name <> 'BUILDING'
""")
def stage_basis(t: Tables) -> DataFrame:
    """The basis extract staged under its source names, without the rows that have no school type, and replaced twice in a store."""
    basis = School(t).basis
    source_of = {target: source for source, target in reversed(fixed.COLUMNS["student_basis"].items())}
    parsed = basis.select(
        *[F.col(c).cast("string").alias(source_of[c]) for c in ("cpr_nr", "first_name", "birth_date", "school_code")],
        F.when(F.col("first_name") != "BUILDING", F.col("school_type_code")).cast("string").alias(source_of["school_type_code"]),
    )
    store = Store(t.spark, new_scratch(t).place())
    rows = stage(parsed, "student_basis", datetime(2024, 1, 31, 4))
    store.replace("student_basis", rows.where("cpr_nr IS NULL"))
    store.replace("student_basis", rows)
    kept = store.read("student_basis", staged("student_basis"))
    return kept.select(
        "cpr_nr", "first_name", "birth_date", F.col("school_code").cast("int").alias("school_code"),
        F.col("school_type_code").cast("int").alias("school_type_code"), F.date_format("stg_load_date", "yyyyMMdd").cast("int").alias("load_day"),
    )


def _facts(t: Tables) -> dict[str, DataFrame]:
    """Rows of every student fact, as far as the cleanup looks at them: students and what the parts are made of."""
    orders = t.orders.select(
        (F.col("o_custkey") + 1).alias("student_id"), day_key(F.col("o_orderdate")).alias("date_id"), "o_orderpriority"
    )
    events = t.events.select((F.col("user_id") + 1).alias("student_id"), key_of("ts").alias("date_id"))
    of = lambda priority, *columns: orders.where(F.col("o_orderpriority") == priority).select("student_id", *columns)
    return {
        "fact_absence_daily": events,
        "fact_absence_lesson": events,
        "fact_grade": t.lineitem.select((F.col("l_suppkey") + 1).alias("student_id"), F.year("l_shipdate").alias("school_year")),
        "fact_enrollment": of("1-URGENT", F.col("date_id").alias("from_date_id")),
        "fact_student_action": of("2-HIGH"),
        "fact_student_event": of("3-MEDIUM", "date_id"),
        "fact_student_relocation": of("5-LOW", F.col("date_id").alias("relocation_date_id")),
        "fact_student_field": of("4-NOT SPECIFIED"),
        "fact_student_snapshot": orders.select("student_id"),
    }


@query(sql_of("people") + """, gone AS (SELECT student_id FROM people WHERE last_seen IS NULL OR last_seen < '2023/2024'),
o AS (SELECT o_orderpriority, o_custkey + 1 IN (SELECT student_id FROM gone) AS hit FROM orders),
e AS (SELECT user_id + 1 IN (SELECT student_id FROM gone) AS hit FROM events),
g AS (SELECT l_suppkey + 1 IN (SELECT student_id FROM gone) AS hit FROM lineitem)
SELECT 'Cleanup fact_absence_daily' AS step_name, count(*) FILTER (hit) AS rows_deleted, count(*) FILTER (NOT hit) AS rows_left FROM e
UNION ALL SELECT 'Cleanup fact_absence_lesson', count(*) FILTER (hit), count(*) FILTER (NOT hit) FROM e
UNION ALL SELECT 'Cleanup fact_grade', count(*) FILTER (hit), count(*) FILTER (NOT hit) FROM g
UNION ALL SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Cleanup fact_enrollment' WHEN '2-HIGH' THEN 'Cleanup fact_student_action'
  WHEN '3-MEDIUM' THEN 'Cleanup fact_student_event' WHEN '5-LOW' THEN 'Cleanup fact_student_relocation' ELSE 'Cleanup fact_student_field' END,
  count(*) FILTER (hit), count(*) FILTER (NOT hit) FROM o GROUP BY o_orderpriority
UNION ALL SELECT 'Cleanup fact_student_snapshot', count(*) FILTER (hit), count(*) FILTER (NOT hit) FROM o
UNION ALL SELECT 'Cleanup students', (SELECT count(*) FROM gone), count(*) FROM people WHERE student_id NOT IN (SELECT student_id FROM gone)
""")
def cleanup_all(t: Tables) -> DataFrame:
    """Retention over all nine facts and both person tables of a warehouse: the step log, and what is left of each table."""
    s = School(t)
    wh = Warehouse(t.spark, new_scratch(t).place())
    for name, rows in _facts(t).items():
        wh.replace(name, rows)
    wh.replace("dim_student_sensitive", s.people)
    wh.replace("dim_student", s.students)
    log = f"{wh.root}/_log"
    load = DailyLoad(wh, AS_OF, keep_years=0)
    with load.scratch, Run(t.spark, log) as run:
        load.cleanup(run)
    left = None
    for name in (*_facts(t), "dim_student_sensitive"):
        step = "Cleanup students" if name == "dim_student_sensitive" else f"Cleanup {name}"
        one = wh.table(name).agg(F.count(F.lit(1)).alias("rows_left")).select(F.lit(step).alias("step_name"), "rows_left")
        left = one if left is None else left.union(one)
    return step_log(t.spark, log).join(left, "step_name").select("step_name", "rows_deleted", "rows_left")


#: Rows a section file is written for, about; a file is one task's.
_FILE_ROWS = 500_000


def _section_text(rows: DataFrame, table: str, kinds: tuple[int, ...], files: int) -> DataFrame:
    """Typed staging rows as the lines of section files: a line of metadata, then a header and rows of each kind."""
    source = {new: old for old, new in reversed(fixed.COLUMNS[table].items()) if not old.startswith("_extra_")}
    names = [c for c in rows.columns if c in source and c != "row_type"]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    line = F.concat_ws(";", F.col("row_type").cast("string"), *cells)
    file = F.pmod(F.xxhash64("cpr_nr"), F.lit(files)).cast("int")
    body = rows.where(F.col("row_type").isin(list(kinds))).select(file.alias("file"), (F.col("row_type") * 2 + 1).alias("at"), line.alias("value"))
    heads = [(0, "1;extract")] + [(2 * k, ";".join(["2", *[source[c] for c in names]])) for k in kinds]
    fixed_lines = F.explode(F.array(*[F.struct(F.lit(at).alias("at"), F.lit(text).alias("value")) for at, text in heads])).alias("l")
    return body.union(rows.sparkSession.range(files).select(F.col("id").cast("int").alias("file"), fixed_lines).select("file", "l.at", "l.value"))


def _write_extracts(t: Tables, folder: str, *, with_grades: bool) -> None:
    s = School(t)
    sectioned = {
        "elev_historik.csv": (s.history, "student_history", (4, 5, 6, 7, 8), t.orders),
        "elev_fravaer.csv": (s.absence, "student_absence", (5, 6, 7), t.events),
        "elev_karakterer.csv": (s.grades.withColumn("row_type", F.lit(1 if with_grades else None).cast("int")), "student_grades", (1,), t.lineitem),
    }
    for file, (rows, table, kinds, of) in sectioned.items():
        # Eight files, and more of them where the table is large.
        lines = _section_text(rows, table, kinds, max(8, of.count() // _FILE_ROWS))
        # A file's lines must lie in order; the rows of a kind may lie in any.
        lines.repartition("file").sortWithinPartitions("file", "at").select("file", "value").write.partitionBy("file").option(
            "encoding", "windows-1252"
        ).text(f"{folder}/{file}")
    source = {new: old for old, new in reversed(fixed.COLUMNS["student_basis"].items())}
    flat = s.basis.select(*[F.col(c).cast("string").alias(source[c]) for c in s.basis.columns if c in source])
    flat.write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(f"{folder}/elev_basis.csv")


@query(sql_of("basis", "history", "absence", "grades") + """, d AS (SELECT unnest([1, 2]) AS day)
SELECT day, 'student_basis' AS name, count(*) AS loaded, count(*) AS staged, count(school_code) AS schools FROM d, basis GROUP BY day
UNION ALL SELECT day, 'student_history', count(*), count(*), count(school_code) FROM d, history GROUP BY day
UNION ALL SELECT day, 'student_absence', count(*), count(*), count(school_code) FROM d, absence GROUP BY day
UNION ALL SELECT day, 'student_grades', CASE day WHEN 1 THEN count(*) ELSE 0 END, count(*), count(school_code) FROM d, grades GROUP BY day
""")
def staging_load(t: Tables) -> DataFrame:
    """All four extracts written as files and staged on two days; on the second the grades are empty and those of the first stay."""
    out = None
    wh = Warehouse(t.spark, new_scratch(t).place())
    for day in (1, 2):
        folder = new_scratch(t).place()
        _write_extracts(t, folder, with_grades=day == 1)
        for name, loaded in load_staging(wh, folder, datetime(2024, 1, 30 + day - 1, 4)).items():
            # staged tables are replaced on the second day, so what is there on the first is counted at once
            there = wh.staging(name).agg(F.count(F.lit(1)).alias("staged"), F.count("school_code").alias("schools")).first()
            one = t.spark.range(1).select(
                F.lit(day).alias("day"), F.lit(name).alias("name"), F.lit(loaded).cast("long").alias("loaded"),
                F.lit(there["staged"]).cast("long").alias("staged"), F.lit(there["schools"]).cast("long").alias("schools"),
            )
            out = one if out is None else out.union(one)
    return out


_HELD = {
    "dim_student_sensitive": "people", "dim_student": "students", "dim_school": "schools", "dim_main_school": "mains", "dim_school_type": "kinds",
    "dim_student_type": "types", "dim_date": "calendar", "dim_citizenship": "citizenships", "dim_country": "countries",
    "dim_language": "languages", "dim_municipality": "municipalities",
}
_CODES = {
    "dim_subject": range(1, 7), "dim_discipline": (1, 2), "dim_class_type": (1,), "dim_action_type": (3,),
    "dim_referral_reason": (7,), "dim_event_type": (40,),
}
_ABSENCE_STEPS = ["Fill absence gaps", "Load fact_absence_daily", "Load fact_absence_lesson"]


def _inserted_sql() -> str:
    """(step_name, rows_inserted) of each step."""
    merged = oracles()
    of_type = "SELECT count(*) FROM orders WHERE o_orderpriority = "
    counts = {
        **{
            f"Load {d}": f"SELECT count(*) FROM ({merged[f'load_{d}']}) WHERE action = 'INSERT'"
            for d in ("dim_municipality", "dim_school_type", "dim_main_school", "dim_school", "dim_student_type", "dim_citizenship", "dim_country", "dim_language")
        },
        "Load dim_school_district": "SELECT 0",
        # students without a last year are cleaned away first, and come back under new numbers
        "Load dim_student_sensitive": "SELECT count(*) FROM customer WHERE NOT (c_acctbal >= 0 AND c_mktsegment <> 'HOUSEHOLD')",
        "Load dim_student": "SELECT count(*) FROM customer WHERE NOT (c_acctbal >= 0 AND c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY'))",
        "Load dim_field_name": of_type + "'4-NOT SPECIFIED'",
        "Load fact_enrollment": of_type + "'1-URGENT'",
        "Load fact_student_action": of_type + "'2-HIGH'",
        "Load fact_student_event": of_type + "'3-MEDIUM'",
        "Load fact_student_field": of_type + "'4-NOT SPECIFIED'",
        "Load fact_student_relocation": of_type + "'5-LOW'",
        "Load fact_grade": "SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag, l_orderkey FROM lineitem)",
        "Load fact_student_snapshot": "SELECT count(*) FROM customer",
    }
    rows = [f"SELECT '{step}' AS step_name, ({sql}) AS rows_inserted" for step, sql in counts.items()]
    silent = [*_ABSENCE_STEPS, "Refresh school_year_label", "Cleanup students", *(f"Cleanup {f}" for f in STUDENT_FACTS)]
    return " UNION ALL ".join([*rows, *(f"SELECT '{step}', NULL" for step in silent)])


@query(f"SELECT step_name, 'success' AS status, rows_inserted FROM ({_inserted_sql()})")
def daily_run(t: Tables) -> DataFrame:
    """The whole daily order on staged extracts, in a warehouse that holds older dimensions: the step log.

    What the absence steps insert is left out; they have queries of their own.
    """
    s = School(t)
    wh = Warehouse(t.spark, new_scratch(t).place())
    for table, view in _HELD.items():
        wh.replace(table, getattr(s, view))
    for table, codes in _CODES.items():
        wh.replace(table, s.codes(table, *codes))
    folder = new_scratch(t).place()
    _write_extracts(t, folder, with_grades=True)
    run_daily(t.spark, wh.root, folder, AS_OF, datetime(2024, 1, 31, 4))
    log = f"{wh.root}/_log"
    done = run_log(t.spark, log).where("status = 'success'").select("run_id")
    steps = step_log(t.spark, log).join(done, "run_id")
    own = F.col("step_name").isin(_ABSENCE_STEPS)
    return steps.select("step_name", "status", F.when(~own, F.col("rows_inserted")).alias("rows_inserted"))
