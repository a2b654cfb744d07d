"""Warehouse tables as plain Parquet folders.

Three ways to write, all Spark's own: a new folder that takes the place of the old
one when it is complete, an append, and a dynamic partition overwrite of the parts
in which a row changes. A table may be read by the very rows that are written to it;
a write that fails leaves the old rows.

A change is computed once. What it inserts, updates and deletes is kept beside the
tables, each old row named by its file and its place there; the parts to write follow
from that, and their new content is the old rows but those plus the new ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeep.operators.merge import ACTION, DELETE, INSERT, NONE, count_columns, survivors
from dimkeep.sources.files import Files

#: Which row of which file a row is; null for a row that is new.
ROW_ID = T.StructType([T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType())])

#: A table, or a part of one, in more files than this is united.
SCATTERED = 64

_DRAFTS = "_drafts"

Plan = dict  # what has been prepared, as JSON holds it
Counts = dict[str, int]


def observed(seen: Observation, df: DataFrame, names: Sequence[str]) -> Counts:
    """The counts of a finished write; none arrive if Spark found its plan to be empty and ran nothing."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        if not df.isEmpty():
            raise
        return dict.fromkeys(names, 0)


def _at_once(prepare: Callable[[], Plan], publish: Callable[[Plan], None] | None = None) -> Plan:
    plan = prepare()
    if publish is not None:
        publish(plan)
    return plan


class Store:
    """``once`` runs a write in its two halves: what it prepares, and what makes that visible (see ``audit.Run.once``)."""

    def __init__(self, spark: SparkSession, root: str, once=_at_once):
        self.spark = spark
        self.files = Files(spark, root)
        self.once = once

    # -- reading -----------------------------------------------------------

    def _path(self, name: str) -> str:
        return f"{self.files.root}/{name}"

    def exists(self, table: str) -> bool:
        return bool(self.files.names(table))

    def tables(self) -> list[str]:
        return [n for n in self.files.names("") if not n.startswith(("_", "."))]

    def _folders(self, table: str) -> list[tuple[str, str]]:
        """(partition column, value) of each folder of a table in parts."""
        return [tuple(n.split("=", 1)) for n in self.files.names(table) if "=" in n]

    def parts(self, table: str) -> list[int]:
        return sorted(int(value) for _, value in self._folders(table) if value.lstrip("-").isdigit())

    def read(self, table: str, schema: T.StructType, parts: Sequence | None = None) -> DataFrame:
        """The current rows; ``parts`` keeps only these partition values, as a filter that prunes the scan."""
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(self._path(table))
        if parts is not None and (folders := self._folders(table)):
            df = df.where(F.col(folders[0][0]).isin(list(parts)))
        return df

    def rows(self, table: str, schema: T.StructType, parts: Sequence | None = None) -> DataFrame:
        """The current rows with their ``ROW_ID``, as a change takes them."""
        if not self.exists(table):
            return self.spark.createDataFrame([], T.StructType([*schema.fields, *ROW_ID.fields]))
        place = (F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        return self.read(table, schema, parts).select(*schema.fieldNames(), *place)

    # -- writing -----------------------------------------------------------

    def _written(self, df: DataFrame, to: str, mode: str, partition: str | None = None, *, deleted: bool = True) -> Counts:
        """Write ``df`` and count its rows or, if it has any, its actions on the way; ``deleted`` rows may be left out."""
        counts, names = [F.count(F.lit(1)).alias("rows")], ["rows"]
        if ACTION in df.columns:
            counts, names = count_columns(), ["inserted", "updated", "deleted"]
        if partition is not None:
            # Even files per partition; a large partition is split over several tasks.
            df = df.hint("rebalance", partition)
        # Observed after the last shuffle: there, tasks that run again are not counted twice.
        seen = Observation()
        rows = df.observe(seen, *counts)
        writer = (rows if deleted else survivors(rows)).write.mode(mode)
        if partition is not None:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
        writer.parquet(self._path(to))
        return observed(seen, df, names)

    def _draft(self) -> str:
        return f"{_DRAFTS}/{uuid.uuid4().hex}"

    def _swap(self, table: str, plan: Plan) -> None:
        """The draft takes the table's place. It is complete, so doing it again after a stop finishes it."""
        if plan["draft"] is not None and self.files.names(plan["draft"]):
            self.files.move(plan["draft"], table)

    def replace(
        self, table: str, df: DataFrame, partition: str | None = None, *, keep_if: Callable[[Counts], bool] | None = None
    ) -> int:
        """New content for the whole table; returns its rows. ``keep_if`` may look at them and keep the old content."""

        def prepare() -> Plan:
            draft = self._draft()
            counts = self._written(df, draft, "error", partition)
            return {"counts": counts, "draft": None if keep_if is not None and keep_if(counts) else draft}

        return self.once(prepare, lambda plan: self._swap(table, plan))["counts"]["rows"]

    def reload(self, table: str, df: DataFrame, schema: T.StructType) -> Counts:
        """Empty the table and load it anew; the old rows are counted in the same pass, without reading a column."""
        old = self.read(table, schema).select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        rows = old.withColumn(ACTION, F.lit(DELETE)).unionByName(df.withColumn(ACTION, F.lit(INSERT)))

        def prepare() -> Plan:
            draft = self._draft()
            return {"counts": self._written(rows, draft, "error", deleted=False), "draft": draft}

        return self.once(prepare, lambda plan: self._swap(table, plan))["counts"]

    def append(self, table: str, df: DataFrame, partition: str | None = None) -> int:
        """More rows. An insert-only load that is run again finds those that are there already."""

        def write() -> Plan:
            return {"counts": self._written(df, table, "append", partition)}

        return self.once(write)["counts"]["rows"]

    def apply(self, table: str, changed: DataFrame, schema: T.StructType, partition: str | None = None) -> Counts:
        """Write a change and count its actions.

        ``changed`` holds rows of :meth:`rows` with their action and new rows; those
        that stay as they are may be among them or not. It is run once. Only the
        parts with a change are written, and nothing is if there is none.
        """
        columns = schema.fieldNames()
        if partition is not None and partition not in columns:
            raise ValueError(f"{table} has no column {partition}")

        def prepare() -> Plan:
            draft = self._draft()
            changes = changed.where(F.col(ACTION) != NONE).select(*columns, *ROW_ID.fieldNames(), ACTION)
            counts = self._written(changes, draft, "error")
            if not any(counts.values()):
                return {"counts": counts, "changes": None}
            kept = self.spark.read.schema(changes.schema).parquet(self._path(draft))
            if partition is None:
                whole = self._draft()
                self._written(self._merged(self.rows(table, schema), kept, columns), whole, "error")
                return {"counts": counts, "changes": draft, "draft": whole}
            stays = F.count_if(F.col(ACTION) != DELETE).alias("stays")
            hit = {r[0]: r for r in kept.groupBy(partition).agg(stays, F.count(F.lit(1)).alias("all")).collect()}  # a row a part
            fewer = [p for p, r in hit.items() if not r["stays"]]
            left = {}
            if fewer:  # row counts of these parts, from the files' own
                left = {r[0]: r[1] for r in self.read(table, schema, fewer).groupBy(partition).count().collect()}
            emptied = [p for p in fewer if left.get(p, 0) == hit[p]["all"]]
            before = {str(p): self.files.names(f"{table}/{partition}={p}") for p in hit}
            return {"counts": counts, "changes": draft, "before": before, "emptied": emptied}

        def publish(plan: Plan) -> None:
            if plan["changes"] is None:
                return
            if partition is None:
                return self._swap(table, plan)
            kept = self.spark.read.schema(self._with_action(schema)).parquet(self._path(plan["changes"]))
            self._exchange(table, schema, partition, kept, plan)

        return self.once(prepare, publish)["counts"]

    def delete(self, table: str, members: DataFrame, schema: T.StructType, partition: str | None = None) -> int:
        """Delete the rows that agree with one of ``members`` in its columns; returns how many there were.

        A scan of these columns alone counts them by part. Then the parts that have some, or
        the table, are written without them; nothing is where there is none. When a
        stopped write is taken up, ``members`` must be those of before.
        """
        on = members.columns
        others = lambda parts=None: self.read(table, schema, parts).join(members, on, "left_anti").select(schema.fieldNames())

        def prepare() -> Plan:
            hit = self.read(table, schema).join(members, on, "left_semi")
            if partition is None:
                plan = {"deleted": hit.count(), "draft": None}
                if plan["deleted"]:
                    plan["draft"] = self._draft()
                    self._written(others(), plan["draft"], "error")
                return plan
            counts = {r[0]: r[1] for r in hit.groupBy(partition).count().collect()}  # a row a part
            there = {}
            if counts:  # row counts of these parts, from the files' own
                there = {r[0]: r[1] for r in self.read(table, schema, list(counts)).groupBy(partition).count().collect()}
            before = {str(p): self.files.names(f"{table}/{partition}={p}") for p in counts}
            return {"deleted": sum(counts.values()), "before": before, "emptied": [p for p, n in counts.items() if there[p] == n]}

        def publish(plan: Plan) -> None:
            if partition is None:
                return self._swap(table, plan)
            self._rewrite(table, partition, plan, others)

        return self.once(prepare, publish)["deleted"]

    @staticmethod
    def _with_action(schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, *ROW_ID.fields, T.StructField(ACTION, T.StringType())])

    @staticmethod
    def _merged(old: DataFrame, changes: DataFrame, columns: Sequence[str], on: Sequence[str] = ()) -> DataFrame:
        """The old rows that no change names, and the rows of the changes."""
        gone = changes.where(F.col("_file").isNotNull()).select(*on, "_file", "_row")
        stay = old.join(gone, [*on, "_file", "_row"], "left_anti")
        return stay.select(columns).unionByName(changes.where(F.col(ACTION) != DELETE).select(columns))

    def _exchange(self, table: str, schema: T.StructType, partition: str, changes: DataFrame, plan: Plan) -> None:
        """Overwrite the parts that a change hits with what it makes of them."""

        def new(parts: list[int]) -> DataFrame:
            here = changes.where(F.col(partition).isin(parts))
            # Files of one write have the same names in each part, so the part belongs to a row's name.
            return self._merged(self.rows(table, schema, parts), here, schema.fieldNames(), [partition])

        self._rewrite(table, partition, plan, new)

    def _rewrite(self, table: str, partition: str, plan: Plan, new: Callable[[list[int]], DataFrame]) -> None:
        """Overwrite the parts that a change hits with their ``new`` rows.

        Spark puts the finished parts in place one by one. After a stop, those whose files
        are not the ones of before are done.
        """
        emptied = set(plan["emptied"])
        as_before = lambda p, files: self.files.names(f"{table}/{partition}={p}") == files
        todo = [int(p) for p, files in plan["before"].items() if int(p) not in emptied and as_before(p, files)]
        if todo:
            self._written(new(todo), table, "overwrite", partition)
        for p in emptied:
            self.files.remove(f"{table}/{partition}={p}")
        lost = [p for p in plan["before"] if int(p) not in emptied and not self.files.names(f"{table}/{partition}={p}")]
        if lost:
            raise RuntimeError(f"parts {lost} of {table} are missing; a stopped write left their rows in its staging folder")

    # -- tidying -----------------------------------------------------------

    def unite(self, table: str, schema: T.StructType, partition: str | None = None) -> None:
        """Rewrite a table, or those of its parts, that appends have scattered over many files."""
        if partition is None:
            if len(self.files.names(table)) > SCATTERED:
                self.replace(table, self.read(table, schema).hint("rebalance"))
            return
        many = [p for p in self.parts(table) if len(self.files.names(f"{table}/{partition}={p}")) > SCATTERED]
        if many:
            self._written(self.read(table, schema, many), table, "overwrite", partition)

    def drop_drafts(self) -> None:
        """What writes have prepared; nothing of it is needed once they are published."""
        self.files.remove(_DRAFTS)
