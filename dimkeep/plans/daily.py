"""The daily run: staging, then every load in dependency order, each one an audited step."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimkeep.functions import dates
from dimkeep.operators.calendar_gaps import last_school_days
from dimkeep.plans import dims, facts
from dimkeep.plans import fixed_values as fixed
from dimkeep.plans.audit import Run
from dimkeep.plans.model import STUDENT_FACTS
from dimkeep.plans.staging_load import load_staging
from dimkeep.plans.warehouse import Warehouse
from dimkeep.session import Scratch, measured_broadcasts

Counts = dict[str, int | None]


class DailyLoad:
    """The loads of one day. ``as_of`` is today; nothing reads the clock but the log."""

    def __init__(self, warehouse: Warehouse, as_of: date, keep_years: int = 5, gap_days: int = 10):
        self.wh = warehouse
        self.as_of = as_of
        self.keep_years = keep_years
        self.gap_days = gap_days
        self.scratch = Scratch(warehouse.spark, warehouse.root)

    # -- helpers ---------------------------------------------------------------

    def _named(self, *tables: str) -> list[DataFrame]:
        return [self.wh.table(t) for t in tables]

    @property
    def _eligible(self) -> list[DataFrame]:
        return self._named("dim_student", "dim_school", "dim_main_school")

    def _counted(self, rows: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
        """Rows that are counted by the pass that reads them, and the count once that is over."""
        seen = Observation()

        def count() -> int:
            try:
                return seen.get["rows"]
            except Py4JJavaError:
                # What the rows were to meet was empty, so Spark has left out the pass over them.
                return rows.count()

        return rows.observe(seen, F.count(F.lit(1)).alias("rows")), count

    def _history(self, row_type: int) -> tuple[DataFrame, Callable[[], int]]:
        return self._counted(facts.of_type(self.wh.staging("student_history"), row_type))

    def _change(self, table: str, changed: DataFrame) -> Counts:
        done = self.wh.apply(table, changed)
        return {"inserted": done["inserted"], "updated": done["updated"]}

    def _reload(self, table: str, rows: DataFrame) -> Counts:
        done = self.wh.reload(table, rows)
        return {"inserted": done["inserted"], "deleted": done["deleted"]}

    def _merge_parts(
        self, table: str, rows: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame], more: Sequence[int] = ()
    ) -> Counts:
        """Merge kept rows into those parts of a table that they fall into, and ``more``."""
        parts = sorted({*more, *self.wh.parts_in(table, rows)})
        return self._change(table, merged(self.wh.rows(table, parts), rows))

    def _append_new(self, table: str, rows: DataFrame, new: Callable[[DataFrame, DataFrame], DataFrame]) -> Counts:
        """Append those of the kept rows that their parts of the table lack."""
        known = self.wh.table(table, self.wh.parts_in(table, rows))
        return {"inserted": self.wh.append(table, new(known, rows))}

    # -- before the loads ------------------------------------------------------

    def cleanup(self, run: Run) -> None:
        gone = self.scratch.keep(facts.departed(self.wh.table("dim_student_sensitive"), self.as_of, self.keep_years))
        for table in STUDENT_FACTS:
            run.step(
                "cleanup", f"Cleanup {table}",
                lambda t=table: {"deleted": self.wh.delete_members(t, gone)},
            )

        def people() -> Counts:
            # The personal data goes last, so that a run that stops here can find the students again.
            self.wh.delete_members("dim_student", gone)
            return {"deleted": self.wh.delete_members("dim_student_sensitive", gone)}

        run.step("cleanup", "Cleanup students", people)

    def fill_absence_gaps(self) -> Counts:
        calendar = self.wh.table("dim_date")
        # The window is a handful of days; knowing them prunes the fact to its last months.
        days = last_school_days(calendar, self.as_of, self.gap_days).select("date_id")
        fact = self.wh.table("fact_absence_daily", self.wh.parts_in("fact_absence_daily", days))
        rows = facts.absence_gaps(fact, calendar, *self._eligible, self.as_of, self.gap_days)
        return {"inserted": self.wh.append("fact_absence_daily", rows)}

    def refresh_school_year_label(self) -> Counts:
        changed = dims.refresh_school_year_label(self.wh.rows("dim_date"), self.as_of)
        return {"updated": self.wh.apply("dim_date", changed)["updated"]}

    # -- dimensions ------------------------------------------------------------

    def named_codes(self, table: str) -> Counts:
        target = self.wh.rows(table)
        code, name = target.columns[:2]
        basis = self.wh.staging("student_basis")
        return self._change(table, dims.named_codes(basis, target, dims.NAMED_CODES[table], code, name))

    def _inserted(self, table: str, changed: DataFrame) -> Counts:
        return {"inserted": self.wh.apply(table, changed)["inserted"]}

    def school_type(self) -> Counts:
        basis, history = self.wh.staging("student_basis"), self.wh.staging("student_history")
        return self._inserted("dim_school_type", dims.school_type(basis, history, self.wh.rows("dim_school_type")))

    def school_district(self) -> Counts:
        """A static table; nothing to load."""
        return {"inserted": 0}

    def school(self) -> Counts:
        basis, history = self.wh.staging("student_basis"), self.wh.staging("student_history")
        return self._change("dim_school", dims.school(basis, history, self.wh.rows("dim_school")))

    def student_type(self) -> Counts:
        basis = self.wh.staging("student_basis")
        return self._inserted("dim_student_type", dims.student_type(basis, self.wh.rows("dim_student_type")))

    def student_sensitive(self) -> Counts:
        basis, read = self._counted(self.wh.staging("student_basis"))
        target = self.wh.rows("dim_student_sensitive")
        done = self._change("dim_student_sensitive", dims.student_sensitive(basis, target, self.as_of, self.scratch.keep))
        return {"read": read(), **done}

    def student(self) -> Counts:
        basis, read = self._counted(self.wh.staging("student_basis"))
        others = self._named("dim_student_sensitive", "dim_student_type", "dim_school_district", "fact_enrollment", "dim_school")
        changed = dims.student(basis, self.wh.rows("dim_student"), *others, self.as_of, keep=self.scratch.keep)
        return {"read": read(), **self.wh.apply("dim_student", changed)}

    def field_name(self) -> Counts:
        history = self.wh.staging("student_history")
        return self._inserted("dim_field_name", dims.field_name(history, self.wh.rows("dim_field_name")))

    # -- facts -----------------------------------------------------------------
    # The source of a fact, with all its lookups, is kept once: it says which parts it falls
    # into, and the merge reads it in several joins.

    def enrollment(self) -> Counts:
        history, read = self._history(fixed.ENROLLMENT)
        dimensions = self._named("dim_student_sensitive", "dim_school", "dim_school_type", "dim_class_type")
        rows = self.scratch.keep(facts.enrollment_rows(history, *dimensions))
        return {"read": read(), **self._merge_parts("fact_enrollment", rows, facts.enrollment)}

    def student_action(self) -> Counts:
        history, read = self._history(fixed.ACTION)
        rows = self.scratch.keep(
            facts.student_action(history, *self._named("dim_student_sensitive", "dim_action_type", "dim_referral_reason"))
        )
        return {"read": read(), **self._reload("fact_student_action", rows)}

    def student_event(self) -> Counts:
        history, read = self._history(fixed.EVENT)
        rows = self.scratch.keep(facts.event_rows(history, *self._named("dim_student_sensitive", "dim_event_type")))
        return {"read": read(), **self._append_new("fact_student_event", rows, facts.new_events)}

    def student_field(self) -> Counts:
        history, read = self._history(fixed.FIELD)
        rows = self.scratch.keep(facts.field_rows(history, *self._named("dim_student_sensitive", "dim_field_name")))
        return {"read": read(), **self._merge_parts("fact_student_field", rows, facts.student_field)}

    def student_relocation(self) -> Counts:
        history, read = self._history(fixed.RELOCATION)
        rows = self.scratch.keep(facts.relocation_rows(history, *self._named("dim_student_sensitive", "dim_municipality")))
        return {"read": read(), **self._append_new("fact_student_relocation", rows, facts.new_relocations)}

    def absence_daily(self) -> Counts:
        table = "fact_absence_daily"
        calendar = self.wh.table("dim_date")

        yesterday = dates.day_key_of(dates.yesterday_of(self.as_of))
        fact = self.wh.table(table, [yesterday // 100])
        baseline = facts.absence_baseline(fact, calendar, *self._eligible, self.as_of)
        inserted = self.wh.append(table, baseline)

        staged, read = self._counted(facts.absences(self.wh.staging("student_absence"), *fixed.DAILY))
        rollup = self.scratch.keep(
            facts.absence_rollup(
                staged, self.wh.table("dim_student_sensitive"), *self._eligible, calendar, self.as_of
            )
        )
        first = dates.day_key_of(dates.school_year_start_of(self.as_of)) // 100
        resettable = [p for p in self.wh.parts(table) if p >= first]
        eligible = facts.absence_students(*self._eligible).select("student_id")
        done = self._merge_parts(
            table, rollup, lambda fact, rows: facts.absence_daily(fact, rows, eligible, self.as_of), resettable
        )
        return {"read": read(), "updated": done["updated"], "inserted": inserted + done["inserted"]}

    def absence_lesson(self) -> Counts:
        staged, read = self._counted(facts.absences(self.wh.staging("student_absence"), fixed.LESSON))
        others = [self.wh.table("dim_student_sensitive"), *self._eligible, self.wh.table("dim_subject")]
        rows = self.scratch.keep(facts.lesson_rows(staged, *others))
        return {"read": read(), **self._merge_parts("fact_absence_lesson", rows, facts.absence_lesson)}

    def grade(self) -> Counts:
        staged, read = self._counted(self.wh.staging("student_grades"))
        dimensions = self._named(
            "dim_student_sensitive", "dim_subject", "dim_discipline", "dim_school", "dim_exam_type"
        )
        rows = self.scratch.keep(facts.grade_rows(staged, *dimensions))
        return {"read": read(), **self._merge_parts("fact_grade", rows, facts.grade)}

    def student_snapshot(self) -> Counts:
        return self._reload(
            "fact_student_snapshot", facts.student_snapshot(*self._named("dim_student", "dim_student_sensitive"), self.as_of)
        )

    # -- order -----------------------------------------------------------------

    def steps(self) -> list[tuple[str, str, Callable[[], Counts]]]:
        """(job, step, work) after the cleanup. The order is part of the result: gap filling and
        previous schools look at tables as the day before left them."""

        def load(table: str, work: Callable[[], Counts]):
            return table, f"Load {table}", work

        def codes(table: str):
            return load(table, lambda: self.named_codes(table))

        return [
            ("fill_absence_gaps", "Fill absence gaps", self.fill_absence_gaps),
            ("refresh_school_year_label", "Refresh school_year_label", self.refresh_school_year_label),
            codes("dim_municipality"),
            load("dim_school_type", self.school_type),
            codes("dim_main_school"),
            load("dim_school_district", self.school_district),
            load("dim_school", self.school),
            load("dim_student_type", self.student_type),
            codes("dim_citizenship"),
            codes("dim_country"),
            codes("dim_language"),
            load("dim_student_sensitive", self.student_sensitive),
            load("dim_student", self.student),
            load("dim_field_name", self.field_name),
            load("fact_enrollment", self.enrollment),
            load("fact_student_action", self.student_action),
            load("fact_student_event", self.student_event),
            load("fact_student_field", self.student_field),
            load("fact_student_relocation", self.student_relocation),
            load("fact_absence_daily", self.absence_daily),
            load("fact_absence_lesson", self.absence_lesson),
            load("fact_grade", self.grade),
            load("fact_student_snapshot", self.student_snapshot),
        ]

    def run(self) -> int:
        """All loads under one audited run; returns its id. The first failure is logged and raised.

        A run of the same day that was stopped is taken up where it stopped: its steps and
        writes that are done are not repeated. Afterwards nothing is left of earlier
        versions of the tables, and so of deleted students, nor of what the run kept for itself.
        """
        spark = self.wh.spark
        with measured_broadcasts(spark), self.scratch, Run(spark, f"{self.wh.root}/_log", self.as_of.isoformat()) as run:
            self.wh.store.once = run.once
            self.cleanup(run)
            for job, name, work in self.steps():
                run.step(job, name, work)
            self.wh.tidy()
        return run.run_id


def run_daily(spark: SparkSession, root: str, folder: str, as_of: date, moment: datetime) -> dict[str, int]:
    """Stage the extracts in ``folder``, then bring the warehouse under ``root`` up to date."""
    warehouse = Warehouse(spark, root)
    loaded = load_staging(warehouse, folder, moment)
    DailyLoad(warehouse, as_of).run()
    return loaded
