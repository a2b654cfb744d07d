"""Two days of the invented school, then runs that fail or have nothing new."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimkeep.operators.merge import merge
from dimkeep.plans.audit import Run, run_log, step_log
from dimkeep.plans.daily import DailyLoad, run_daily
from dimkeep.plans.staging_load import load_staging
from dimkeep.plans import facts
from dimkeep.plans.model import TABLES, staged
from dimkeep.plans.warehouse import Warehouse
from dimkeep.sources.files import Files
from dimkeep.sources.staging import typed
from tests.school import (
    new_warehouse,
    stay,
    student,
    write_absence,
    write_basis,
    write_grades,
    write_history,
)

DAY1, DAY2 = date(2026, 9, 16), date(2026, 9, 17)


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("school")
    folder, root = base / "in", base / "wh"
    folder.mkdir()
    wh = new_warehouse(spark, root)
    seen = {}

    write_basis(
        folder,
        [
            student("P1", birth_date="20120229"),
            student("P2", 280628, 280628, first_name="Zoë", student_type_name=None, school_district_code=99),
            student("P3", 999999, 555555),
            student("P4", school_type_code=None),
        ],
    )
    write_history(
        folder,
        [stay("P1", 280093, 20250801), stay("P2", 280093, 20250801, 20260731), stay("P2", 280628, 20260801), stay("P9", 1, 20250801)],
        [("P1", 3, "x", 20250901, None, "2,5", None), ("P1", 99, 7, 20250901, "?", None, None)],
        [("P1", 40, 20260901), ("P1", 40, 20260901), ("P2", 77, 20260902)],
        [("P1", "bus", "yes"), ("P2", "bus", None)],
        [("P2", 860, 20250101), ("P2", 1, 20250102)],
    )
    write_absence(
        folder,
        full=[("P1", "S", 20260914, 280093, 4), ("P1", "S", 20260916, 280093, 4), ("P1", "S", 20260913, 280093, 4), ("P3", "S", 20260914, 999999, 4), ("P2", "S", 20260911, 12345, 8)],
        half=[("P2", "L", 20260915, 280628, 8, "første"), ("P1", "X", 20260915, 280093, 4, "sidste")],
        lessons=[("P1", "U", 20260915, 280093, 4, 1, 1), ("P2", "S", 20260920, 280628, 8, 2, 99), ("P1", "Q", 20260915, 280093, 4, 2, 1)],
    )
    write_grades(folder, [("P1", "1", "x", 9, 2026, "0", "7", 280093, "FP9"), ("P2", "z", "1", 9, 2026, "0", None, 4242, "??")])
    seen["loaded1"] = run_daily(spark, str(root), str(folder), DAY1, datetime(2026, 9, 16, 4))
    seen["absence1"] = [tuple(r) for r in wh.table("fact_absence_daily").collect()]
    seen["students1"] = {r.cpr_nr: r.student_id for r in wh.table("dim_student_sensitive").collect()}
    seen["previous1"] = {r.student_id: r.previous_main_school_code for r in wh.table("dim_student").collect()}

    # The next day: P3 is gone, P1's absence of the 14th was withdrawn, P5 is new, names change.
    write_basis(
        folder,
        [
            student("P1", birth_date="20120229", municipality_name="Northern"),
            student("P2", 280628, 280628, first_name="Zoë", student_type_name="Extern", school_district_code=99, municipality_name="Northern"),
            student("P5", municipality_name="Northern"),
        ],
    )
    write_history(
        folder,
        [stay("P1", 280093, 20250801, 20260930), stay("P2", 280093, 20250801, 20260731), stay("P2", 280628, 20260801), stay("P5", 777777, 20240801, 20260601, name="Old school", kind=300)],
        [("P1", 3, "x", 20250901, None, "3", None)],
        [("P1", 40, 20260901), ("P1", 40, 20260901), ("P2", 77, 20260902), ("P2", 40, 20260916)],
        [("P1", "bus", "no"), ("P2", "bus", None), ("P2", "diet", "veg")],
        [("P2", 861, 20250101), ("P2", 860, 20260916)],
    )
    write_absence(
        folder,
        half=[("P2", "L", 20260915, 280628, 8, "første"), ("P2", "U", 20260915, 280628, 8, "sidste")],
        lessons=[("P1", "U", 20260915, 280093, 5, 1, 1), ("P2", "L", 20260920, 280628, 9, 2, 99)],
    )
    write_grades(folder, [("P1", "1", "x", 9, 2026, "0", "10", 280093, "FP9")])
    seen["loaded2"] = run_daily(spark, str(root), str(folder), DAY2, datetime(2026, 9, 17, 4))
    return wh, str(folder), seen


def steps(wh, run):
    log = step_log(wh.spark, f"{wh.root}/_log").where(F.col("run_id") == run)
    return {
        r.step_name: (r.rows_read, r.rows_inserted, r.rows_updated, r.rows_deleted) for r in log.collect()
    }


def ids(wh):
    return {r.student_id: r.cpr_nr for r in wh.table("dim_student_sensitive").collect()}


def test_rows_loaded(days):
    _, _, seen = days
    assert seen["loaded1"] == {"student_basis": 3, "student_history": 13, "student_absence": 10, "student_grades": 2}
    assert seen["loaded2"] == {"student_basis": 3, "student_history": 14, "student_absence": 4, "student_grades": 1}


def test_log_of_the_first_day(days):
    wh, _, _ = days
    got = steps(wh, 1)
    assert len(got) == 33
    assert got["Load dim_municipality"] == (None, 1, 0, None)
    assert got["Load dim_school"] == (None, 4, 0, None)
    assert got["Load dim_school_district"] == (None, 0, None, None)
    assert got["Load dim_student_sensitive"] == (3, 3, 0, None)
    assert got["Load dim_student"] == (3, 3, 0, 0)
    assert got["Load fact_enrollment"] == (4, 3, 0, None)
    assert got["Load fact_student_action"] == (2, 2, None, 0)
    assert got["Load fact_student_event"] == (3, 3, None, None)
    assert got["Load fact_student_relocation"] == (2, 2, None, None)
    # Two baseline rows for the 15th; the rollup then updates one and brings two more.
    assert got["Load fact_absence_daily"] == (6, 4, 1, None)
    assert got["Load fact_absence_lesson"] == (2, 2, 0, None)
    assert got["Load fact_grade"] == (2, 2, 0, None)
    assert got["Load fact_student_snapshot"] == (None, 3, None, 0)


def test_log_of_the_second_day(days):
    wh, _, _ = days
    got = steps(wh, 2)
    assert got["Load dim_municipality"] == (None, 0, 1, None)
    assert got["Load dim_student"] == (3, 1, 2, 1)
    assert got["Load dim_student_sensitive"] == (3, 1, 0, None)
    assert got["Load dim_field_name"] == (None, 1, None, None)
    assert got["Load dim_student_type"] == (None, 1, None, None)
    assert got["Load dim_school_type"] == (None, 1, None, None)
    assert got["Load dim_school"] == (None, 1, 0, None)
    assert got["Load fact_enrollment"] == (4, 1, 1, None)
    assert got["Load fact_student_action"] == (1, 1, None, 2)
    assert got["Load fact_student_event"] == (4, 1, None, None)
    assert got["Load fact_student_field"] == (3, 1, 1, None)
    assert got["Load fact_student_relocation"] == (2, 1, None, None)
    assert got["Load fact_absence_lesson"] == (2, 0, 1, None)
    assert got["Load fact_grade"] == (1, 0, 1, None)
    assert got["Load fact_student_snapshot"] == (None, 3, None, 3)
    assert run_log(wh.spark, f"{wh.root}/_log").where("status = 'success'").count() == 2


def test_first_day_absence(days):
    _, _, seen = days
    one, two = seen["students1"]["P1"], seen["students1"]["P2"]
    assert sorted(seen["absence1"], key=repr) == sorted(
        [
            (one, "S", 20260914, 280093, 4, "A", Decimal("1.0"), "Hele dagen"),
            (one, "IF", 20260915, 280093, 4, "A", Decimal("0.0"), None),
            (two, "L", 20260915, 280628, 8, "A", Decimal("0.5"), "Første lektion"),
            # A school the dimension does not know.
            (two, "S", 20260911, -1, 8, "A", Decimal("1.0"), "Hele dagen"),
        ],
        key=repr,
    )


def test_second_day_absence(days):
    wh, _, seen = days
    names = ids(wh)
    got = {(names[r.student_id], r.date_id, r.school_code): r for r in wh.table("fact_absence_daily").collect()}
    withdrawn = got["P1", 20260914, 280093]
    assert (withdrawn.absence_reason_code, withdrawn.absence_value, withdrawn.lesson, withdrawn.grade_level) == ("IF", 0, None, 4)
    both = got["P2", 20260915, 280628]
    assert (both.absence_reason_code, both.absence_value, both.lesson) == ("U", 1, "Hele dagen")
    # The 16th had no rows, so it was filled from the 15th before P5 was known; P5 came with the baseline.
    assert {k[0] for k in got if k[1] == 20260916} == {"P1", "P2", "P5"}
    # Days of the window before the first fact take the roster of the day before.
    assert {k[0] for k in got if k[1] == 20260904} == {"P1", "P2"}


def test_one_row_per_key(days):
    wh, _, _ = days
    for table, keys in {
        "fact_absence_daily": ["student_id", "date_id", "school_code"],
        "fact_enrollment": ["student_id", "school_code", "from_date_id"],
        "dim_student": ["student_id"],
        "dim_school": ["school_code"],
    }.items():
        assert wh.table(table).groupBy(keys).count().where("count > 1").count() == 0


def test_surrogates_stay(days):
    wh, _, seen = days
    now = {v: k for k, v in ids(wh).items()}
    assert {c: now[c] for c in seen["students1"]} == seen["students1"]
    assert now["P5"] == 4 and "P4" not in now and "P9" not in now


def test_previous_main_school_follows_a_day_later(days):
    wh, _, seen = days
    two = seen["students1"]["P2"]
    assert seen["previous1"][two] == -1
    assert {r.student_id: r.previous_main_school_code for r in wh.table("dim_student").collect()}[two] == 280093


def test_student_attributes(days):
    wh, _, seen = days
    got = {r.student_id: r for r in wh.table("dim_student").collect()}
    one, two = got[seen["students1"]["P1"]], got[seen["students1"]["P2"]]
    assert one.age == 14 and one.school_district_code == 11 and two.school_district_code == -1
    assert one.action_reception_class is True and one.action_supp_danish is False
    assert two.student_type_code == {r.student_type_name: r.student_type_code for r in wh.table("dim_student_type").collect()}["Extern"]


def test_dimensions_of_the_second_day(days, rows):
    wh, _, _ = days
    assert rows(wh.table("dim_municipality")) == [(860, "Northern")]
    assert (300, "Skoletype 300") in rows(wh.table("dim_school_type"))
    assert (777777, "Old school", None, 300, -1) in rows(wh.table("dim_school"))
    assert (999999, "School 999999", "K", 121, -1) in rows(wh.table("dim_school"))
    assert [r for r in rows(wh.table("dim_main_school")) if r[0] == 555555] == [(555555, "Main 555555", None)]
    assert rows(wh.table("dim_field_name")) == [("bus", None), ("diet", None)]


def test_facts_of_the_second_day(days, rows):
    wh, _, seen = days
    one, two = seen["students1"]["P1"], seen["students1"]["P2"]
    assert rows(wh.table("fact_student_action")) == [(one, 3, -1, 20250901, None, "3", None)]
    assert rows(wh.table("fact_student_event")).count((one, 40, 20260901)) == 2
    assert (two, -1, 20260902) in rows(wh.table("fact_student_event"))
    assert rows(wh.table("fact_student_relocation").where("relocation_date_id = 20250101")) == [(two, 860, 20250101)]
    # The grade changed without the reason in the first lesson, with it in the second.
    lessons = {r.student_id: (r.absence_reason_code, r.grade_level, r.subject_code) for r in wh.table("fact_absence_lesson").collect()}
    assert lessons == {one: ("U", 4, 1), two: ("L", 9, -1)}
    grades = {r.student_id: r for r in wh.table("fact_grade").collect()}
    assert grades[one].sp1_grade == "10" and grades[one].discipline_code == -1
    assert grades[two].exam_type_code == "-1" and grades[two].subject_code == -1 and grades[two].school_code == -1
    assert {r.date_id for r in wh.table("fact_student_snapshot").collect()} == {20260917}
    assert wh.table("dim_date").where("school_year_label = 'Indeværende'").count() > 300


def test_empty_extract_keeps_the_old_staging(days):
    wh, folder, _ = days
    before = wh.staging("student_grades").count(), wh.staging("student_basis").count()
    write_grades(folder, [])
    write_basis(folder, [])
    loaded = load_staging(wh, folder, datetime(2026, 9, 18, 4))
    assert loaded["student_grades"] == 0 and loaded["student_basis"] == 0
    assert (wh.staging("student_grades").count(), wh.staging("student_basis").count()) == before
    # Rows that are all filtered out do empty the table.
    write_basis(folder, [student("P1", school_type_code=None)])
    assert load_staging(wh, folder, datetime(2026, 9, 18, 4))["student_basis"] == 0
    assert wh.staging("student_basis").count() == 0


def test_retention(spark, tmp_path, rows):
    wh = new_warehouse(spark, tmp_path / "wh")
    people = [(-1, None), (1, "2021/2022"), (2, "2020/2021"), (3, None)]
    wide = spark.createDataFrame(people, "student_id int, last_seen string")
    wh.replace("dim_student_sensitive", wide)
    event = spark.createDataFrame([(1, 40, 20220101), (2, 40, 20200101), (3, 40, 20200101), (3, 40, 20200102)], "student_id int, event_type_code int, date_id int")
    wh.replace("fact_student_event", event)
    absence = spark.createDataFrame([(1, 20260901), (2, 20200901)], "student_id int, date_id int")
    wh.replace("fact_absence_daily", absence)
    load = DailyLoad(wh, DAY1)
    with Run(spark, f"{wh.root}/_log") as run:
        load.cleanup(run)
    assert rows(wh.table("dim_student_sensitive"), "student_id") == [(-1,), (1,)]
    assert rows(wh.table("fact_student_event"), "student_id") == [(1,)]
    assert rows(wh.table("fact_absence_daily"), "student_id") == [(1,)]
    # The last step counts students, not rows.
    assert steps(wh, 1)["Cleanup students"] == (None, None, None, 2)
    assert steps(wh, 1)["Cleanup fact_student_event"] == (None, None, None, 3)
    assert steps(wh, 1)["Cleanup fact_grade"] == (None, None, None, 0)


@pytest.mark.parametrize("table", ["fact_student_event", "fact_student_action"])
def test_deleting_members_names_no_rows(spark, tmp_path, rows, table):
    """No draft holds the deleted rows, rows do not meet by file name, and parts without a hit stay."""
    wh = Warehouse(spark, str(tmp_path))
    day = "date_id" if table == "fact_student_event" else "from_date_id"
    data = [(1, 20220101), (2, 20220102), (None, 20220103), (2, 20230101), (2, 20230101), (1, 20240101)]
    wh.replace(table, spark.createDataFrame(data, f"student_id int, {day} int"))
    before = {n: wh.store.files.names(f"{table}/{n}") for n in wh.store.files.names(table)}
    gone = spark.createDataFrame([(2,), (3,), (2,)], "student_id int")
    seen = len(executions(spark))
    assert wh.delete_members(table, gone) == 3
    assert not any("row_index" in plan for plan in executions(spark)[seen:])
    left = [(1, 20220101), (1, 20240101), (None, 20220103)]
    assert rows(wh.table(table), "student_id", day) == left
    after = {n: wh.store.files.names(f"{table}/{n}") for n in wh.store.files.names(table)}
    if table == "fact_student_event":
        same = {n for n in before if before[n] == after.get(n)}
        assert len(before) == 3 and len(after) == 2 and len(same) == 1
    assert wh.delete_members(table, gone) == 0
    assert rows(wh.table(table), "student_id", day) == left
    assert after == {n: wh.store.files.names(f"{table}/{n}") for n in wh.store.files.names(table)}


def test_nothing_of_the_departed_is_left(spark, tmp_path):
    """After a run no file of the warehouse holds a departed student's number or id."""
    root, folder = tmp_path / "wh", tmp_path / "in"
    folder.mkdir()
    wh = new_warehouse(spark, root)
    write_basis(folder, [student("P1")])
    write_history(folder, [stay("P1", 280093, 20250801)], [], [], [], [])
    write_absence(folder, half=[], lessons=[])
    write_grades(folder, [])
    people = [(-1, None, None), (1, "P1", "2025/2026"), (777_777, "GONE-NUMBER", "2015/2016")]
    wh.replace("dim_student_sensitive", spark.createDataFrame(people, "student_id int, cpr_nr string, last_seen string"))
    wh.replace("fact_student_event", spark.createDataFrame([(777_777, 40, 20150101), (1, 40, 20250101)], "student_id int, event_type_code int, date_id int"))
    run_daily(spark, str(root), str(folder), DAY1, datetime(2026, 9, 16, 4))
    files = [str(p) for p in root.rglob("*.parquet")]
    assert files and not any("_scratch" in f for f in files)
    for f in files:
        cells = spark.read.parquet(f).select(F.concat_ws("|", *[F.col(c).cast("string") for c in spark.read.parquet(f).columns]).alias("c"))
        assert cells.filter(F.col("c").contains("GONE-NUMBER") | F.col("c").contains("777777")).isEmpty(), f


def test_failure_is_logged_and_stops_the_run(spark, tmp_path):
    root = str(tmp_path)

    def fail():
        raise ValueError("no such luck" + "!" * 5000)

    done = []
    with pytest.raises(ValueError, match="no such luck"):
        with Run(spark, root) as run:
            run.step("a", "first", lambda: {"inserted": 3})
            run.step("b", "second", fail)
            run.step("c", "third", lambda: done.append(1) or {})
    assert not done
    assert [(r.status, r.error_message) for r in run_log(spark, root).collect()] == [("failed", "no such luck" + "!" * 5000)]
    log = {r.step_name: r for r in step_log(spark, root).collect()}
    assert set(log) == {"first", "second"}
    assert (log["first"].status, log["first"].rows_inserted, log["first"].rows_updated) == ("success", 3, None)
    assert (log["second"].status, log["second"].error_message) == ("failed", "no such luck" + "!" * 5000)
    assert Run(spark, root).run_id == 2
    assert run_log(spark, root).where("run_id = 2").first().status == "running"


def test_a_second_warehouse_starts_empty(spark, tmp_path):
    assert Warehouse(spark, str(tmp_path)).table("fact_absence_daily").count() == 0


def executions(spark):
    """Plans of all queries that have run so far in the session."""
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [listed.apply(i).physicalPlanDescription() for i in range(listed.size())]


def test_the_merge_runs_once_and_only_its_parts_are_written(spark, tmp_path, rows):
    wh = Warehouse(spark, str(tmp_path))
    columns = "student_id int, date_id int, school_code int, absence_reason_code string"
    wh.replace("fact_absence_daily", spark.createDataFrame([(1, 20260901, 1, "S"), (1, 20261001, 1, "S"), (1, 20261101, 1, "S")], columns))
    source = wh.spark.createDataFrame([(1, 20260901, 1, "S"), (1, 20261001, 1, "U"), (2, 20261201, 1, "S")], columns)
    source.write.parquet(f"{tmp_path}/_source")
    source = spark.read.parquet(f"{tmp_path}/_source")

    def merged():
        return merge(
            wh.rows("fact_absence_daily", [202609, 202610, 202612]), source, ["student_id", "date_id", "school_code"],
            changed=lambda t, s: t("absence_reason_code") != s("absence_reason_code"),
        )

    def files():
        return {n: wh.store.files.names(f"fact_absence_daily/{n}") for n in wh.store.files.names("fact_absence_daily")}

    before, seen = files(), len(executions(spark))
    assert wh.apply("fact_absence_daily", merged()) == {"inserted": 1, "updated": 1, "deleted": 0}
    ran = executions(spark)[seen:]
    # one query joins source and fact, one rewrites the parts from what that found
    assert sum("/_source]" in plan for plan in ran) == 1
    assert sum("/fact_absence_daily]" in plan for plan in ran) == 2
    assert all("PartitionFilters: [part_id" in plan for plan in ran if "/fact_absence_daily]" in plan)
    assert rows(wh.table("fact_absence_daily"), *source.columns) == [
        (1, 20260901, 1, "S"), (1, 20261001, 1, "U"), (1, 20261101, 1, "S"), (2, 20261201, 1, "S")
    ]
    after = files()
    assert {n for n in after if after[n] != before.get(n)} == {"part_id=202610", "part_id=202612"}
    assert wh.apply("fact_absence_daily", merged())["inserted"] == 0
    assert files() == after


def test_a_side_that_is_large_in_memory_is_not_broadcast(spark, tmp_path, monkeypatch, rows):
    """The keys of people lie beside empty columns, so the plan takes them for a fraction of what they are."""
    monkeypatch.setattr("dimkeep.session.SURELY_SMALL", 4_000, raising=False)
    wh = new_warehouse(spark, tmp_path)
    people = spark.range(20_000).select(F.col("id").cast("int").alias("student_id"), F.format_string("P%09d", "id").alias("cpr_nr"))
    wh.replace("dim_student_sensitive", people)
    events = people.crossJoin(spark.range(3)).select(
        F.lit(6).alias("row_type"), "cpr_nr", F.lit(40).alias("event_type_code"), (F.col("id") + 20260901).cast("string").alias("event_date")
    )
    wh.stage("student_history", typed(events, staged("student_history")), lambda _: False)
    load = DailyLoad(wh, DAY1)
    monkeypatch.setattr(load, "cleanup", lambda run: None)
    monkeypatch.setattr(load, "steps", lambda: [("fact_student_event", "Load fact_student_event", load.student_event)])
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set(names[0], "200k")
    try:
        load.run()
        after = [spark.conf.get(name, None) for name in names]
    finally:
        spark.conf.unset(names[0])
    assert after == ["200k", None]
    assert rows(wh.table("fact_student_event").agg(F.count("*"), F.countDistinct("student_id"))) == [(60_000, 20_000)]
    # The session lists its last thousand queries only, so the newest one that reads people is looked for.
    found = next(plan for plan in reversed(executions(spark)) if "cpr_nr" in plan).split("Initial Plan")[0]
    # People meet the rows by a shuffle; the handful of event types is broadcast.
    assert found.count("SortMergeJoin") == 1 and found.count("BroadcastHashJoin") == 1


def test_one_field_rewrites_one_part(spark, tmp_path, rows):
    wh = Warehouse(spark, str(tmp_path))
    names = "student_id int, field_name string, field_value string"
    wh.replace("fact_student_field", spark.createDataFrame([(i, "bus", "yes") for i in range(200)], names))
    assert len(wh.parts("fact_student_field")) > 40
    files = lambda: {p: wh.store.files.names(f"fact_student_field/part_id={p}") for p in wh.parts("fact_student_field")}
    before = files()
    news = spark.createDataFrame([(7, "bus", "no"), (8, "bus", "yes")], names)
    target = wh.rows("fact_student_field", wh.parts_in("fact_student_field", news))
    assert wh.apply("fact_student_field", facts.student_field(target, news)) == {"inserted": 0, "updated": 1, "deleted": 0}
    assert sum(before[p] != now for p, now in files().items()) == 1
    assert (7, "bus", "no") in rows(wh.table("fact_student_field"))


def test_a_load_reads_its_own_kind_of_rows(days):
    wh, _, _ = days
    history = facts.of_type(wh.staging("student_history"), 4)
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(row_type" in plan or "PartitionFilters: [(row_type" in plan
    assert len(history.inputFiles()) >= 1
    assert wh.staging("student_history").schema["class_level"].dataType.simpleString() == "int"


class Stopped(BaseException):
    """Ends the driver's work as a lost driver would: nothing is logged."""


def write_two_days(folder):
    write_basis(folder, [student("P1", birth_date="20120229"), student("P2", 280628, 280628, student_type_name=None)])
    write_history(
        folder,
        [stay("P1", 280093, 20250801), stay("P2", 280093, 20250801, 20260731), stay("P2", 280628, 20260801)],
        [("P1", 3, "x", 20250901, None, "2,5", None)],
        [("P1", 40, 20260901), ("P1", 40, 20260901)],
        [("P1", "bus", "yes")],
        [("P2", 860, 20250101)],
    )
    write_absence(folder, half=[("P2", "L", 20260915, 280628, 8, "første")], lessons=[("P1", "U", 20260915, 280093, 5, 1, 1)])
    write_grades(folder, [("P1", "1", "x", 9, 2026, "0", "10", 280093, "FP9")])


def content(wh):
    return {t: sorted((tuple(r) for r in wh.table(t).collect()), key=repr) for t in TABLES if t != "dim_date"}


def logged(wh):
    log = step_log(wh.spark, f"{wh.root}/_log").drop("finished_at")
    return sorted(tuple(r) for r in log.collect())


FEW = ("dim_student_sensitive", "dim_student", "fact_student_action", "fact_student_event", "fact_student_field", "fact_absence_daily")


def test_a_stopped_run_is_taken_up(spark, tmp_path, monkeypatch):
    """The driver is stopped after every fifth event of the log; in the end all is as without that."""
    every_step = DailyLoad.steps
    monkeypatch.setattr(DailyLoad, "steps", lambda self: [s for s in every_step(self) if s[0] in FEW])
    folder = tmp_path / "in"
    folder.mkdir()
    write_two_days(folder)
    plain, wh = (new_warehouse(spark, tmp_path / n) for n in ("plain", "wh"))
    for warehouse in (plain, wh):
        load_staging(warehouse, str(folder), datetime(2026, 9, 16, 4))
        people = [(-1, None, None), (1, "P1", "2025/2026"), (50, "GONE", "2015/2016")]
        warehouse.replace("dim_student_sensitive", spark.createDataFrame(people, "student_id int, cpr_nr string, last_seen string"))
    DailyLoad(plain, DAY1).run()

    written, stops = [0], [0]
    write_text = Files.write_text

    def stopping(self, name, text):
        write_text(self, name, text)
        written[0] += 1
        if written[0] % 5 == 0 and "runs/" not in name:
            stops[0] += 1
            raise Stopped

    monkeypatch.setattr(Files, "write_text", stopping)
    for _ in range(40):
        try:
            DailyLoad(Warehouse(spark, wh.root), DAY1).run()
            break
        except Stopped:
            pass
    assert stops[0] >= 6
    assert content(wh) == content(plain)
    assert logged(wh) == logged(plain)
    log = run_log(spark, f"{wh.root}/_log").collect()
    assert [(r.run_id, r.status) for r in log] == [(1, "success")]
    # a run that has succeeded is not taken up, nor is one of another day
    with Run(spark, f"{wh.root}/_log", DAY1.isoformat()) as run:
        assert run.run_id == 2
    assert Run(spark, f"{wh.root}/_log", DAY2.isoformat()).run_id == 3
    assert Run(spark, f"{wh.root}/_log", DAY1.isoformat()).run_id == 4
    assert Run(spark, f"{wh.root}/_log", DAY1.isoformat()).run_id == 4
