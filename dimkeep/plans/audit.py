"""Run log and step log.

Each event is one small file that is never changed; the log tables show the
latest event of each run and step.

A run that was stopped is taken up again by the next one for the same day. Steps
that have succeeded are left out. Within a step each write has two halves: first it
prepares what it is going to write, which an event records with the counts, then it
makes that visible, and a second event says so. So a step that is run again knows
which of its writes have been prepared or done, and repeats none of them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeep.sources.files import Files

RUNNING, SUCCESS, FAILED = "running", "success", "failed"
COUNTS = ("rows_read", "rows_inserted", "rows_updated", "rows_deleted")

_RUN = "run_id int, event int, status string, finished_at timestamp, error_message string"
_STEP = (
    "run_id int, step_id int, event int, procedure_name string, step_name string, status string, "
    "finished_at timestamp, rows_read bigint, rows_inserted bigint, rows_updated bigint, "
    "rows_deleted bigint, error_message string"
)


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


class Run:
    """One audited run: steps in order, the first failure ends it.

    ``day`` names what the run is for. If the last run of that day did not succeed, it goes on.
    """

    def __init__(self, spark: SparkSession, root: str, day: str | None = None):
        self._files = Files(spark, root)
        last = max((n for n in self._files.names("runs") if n.endswith(".json")), default=None)
        self.run_id = 1 if last is None else int(last.split("_")[0]) + 1
        if last is not None and day is not None:
            row = json.loads(self._files.read_text(f"runs/{last}"))
            if row.get("day") == day and row["status"] != SUCCESS:
                self.run_id -= 1
        self._day = day
        self._steps = 0
        self._writes = 0
        self._run_event(RUNNING)

    def _add(self, folder: str, name: str, row: dict) -> None:
        """One more event of ``name``."""
        event = sum(n.startswith(f"{name}_") for n in self._files.names(folder))
        if row.get("status") in (SUCCESS, FAILED):
            row["finished_at"] = _now()
        self._files.write_text(f"{folder}/{name}_{event:04d}.json", json.dumps({**row, "event": event}))

    def _last(self, folder: str, name: str) -> dict | None:
        events = [n for n in self._files.names(folder) if n.startswith(f"{name}_") and n.endswith(".json")]
        return json.loads(self._files.read_text(f"{folder}/{events[-1]}")) if events else None

    def _run_event(self, status: str, error: str | None = None) -> None:
        self._add("runs", f"{self.run_id:08d}", {"run_id": self.run_id, "day": self._day, "status": status, "error_message": error})

    @property
    def _step(self) -> str:
        return f"{self.run_id:08d}_{self._steps:04d}"

    def _step_event(self, job: str, name: str, status: str, counts, error=None) -> None:
        row = {
            "run_id": self.run_id,
            "step_id": self._steps,
            "procedure_name": job,
            "step_name": name,
            "status": status,
            "error_message": error,
            **counts,
        }
        self._add("steps", self._step, row)

    def step(self, job: str, name: str, work: Callable[[], Mapping[str, int | None]]) -> None:
        """Run ``work`` and log what it read, inserted, updated and deleted; errors are logged and raised.

        Left out where this run has already been through it.
        """
        self._steps += 1
        self._writes = 0
        if (last := self._last("steps", self._step)) is not None and last["status"] == SUCCESS:
            return
        self._step_event(job, name, RUNNING, {})
        try:
            counts = work()
        except Exception as error:
            self._step_event(job, name, FAILED, {}, str(error))
            raise
        self._step_event(job, name, SUCCESS, {f"rows_{k}": v for k, v in counts.items()})

    def once(self, prepare: Callable[[], dict], publish: Callable[[dict], None] | None = None) -> dict:
        """A write of the current step in its two halves, neither of which is done twice.

        What ``prepare`` returns can be held as JSON. ``publish`` may be stopped at any point and begun again.
        """
        self._writes += 1
        name = f"{self._step}_{self._writes:02d}"
        known = self._last("writes", name)
        if known is None:
            known = {"plan": prepare(), "done": publish is None}
            self._add("writes", name, dict(known))
        if not known["done"]:
            publish(known["plan"])
            self._add("writes", name, {"plan": known["plan"], "done": True})
        return known["plan"]

    def __enter__(self) -> "Run":
        return self

    def __exit__(self, kind, error, trace) -> bool:
        if error is None:
            self._run_event(SUCCESS)
            self._files.remove("writes")
        else:
            self._run_event(FAILED, str(error))
        return False


def _latest(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    events = spark.read.schema(schema).json(path)
    rest = [c for c in events.columns if c not in {*keys, "event"}]
    return (
        events.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), "event").alias("_last"))
        .select(*keys, "_last.*")
    )


def run_log(spark: SparkSession, root: str) -> DataFrame:
    return _latest(spark, f"{root}/runs", _RUN, ["run_id"])


def step_log(spark: SparkSession, root: str) -> DataFrame:
    return _latest(spark, f"{root}/steps", _STEP, ["run_id", "step_id"])
