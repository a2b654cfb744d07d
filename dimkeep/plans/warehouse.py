"""The school model's tables in a store."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeep.plans.model import PART, PARTS, STAGED_BY, TABLES, staged
from dimkeep.sources.staging import typed
from dimkeep.sources.store import ROW_ID, Counts, Store


def part_of(table: str, column: Column) -> Column:
    parts = PARTS[table]
    if parts.buckets is not None:
        part = F.pmod(F.xxhash64(column), F.lit(parts.buckets))
    else:
        part = F.floor(column / parts.divisor) if parts.divisor > 1 else column
    return F.coalesce(part.cast("int"), F.lit(0))


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.store = Store(spark, root)
        self.root = self.store.files.root

    # -- reading -----------------------------------------------------------

    def staging(self, table: str) -> DataFrame:
        """Staged rows under the types the loads use; a filter on the row type prunes the scan."""
        return self.store.read(table, staged(table))

    def _schema(self, name: str) -> T.StructType:
        """As stored, with the part."""
        fields = TABLES[name].fields
        return T.StructType([*fields, T.StructField(PART, T.IntegerType())] if name in PARTS else fields)

    def _partition(self, name: str) -> str | None:
        return PART if name in PARTS else None

    def table(self, name: str, parts: Iterable[int] | None = None) -> DataFrame:
        parts = None if parts is None else list(parts)
        return self.store.read(name, self._schema(name), parts).select(TABLES[name].fieldNames())

    def rows(self, name: str, parts: Iterable[int] | None = None) -> DataFrame:
        """The table as a change takes it: each row knows which one it is."""
        parts = None if parts is None else list(parts)
        return self.store.rows(name, self._schema(name), parts).select(*TABLES[name].fieldNames(), *ROW_ID.fieldNames())

    def parts(self, name: str) -> list[int]:
        return self.store.parts(name)

    def parts_in(self, name: str, rows: DataFrame) -> list[int]:
        """Parts of ``name`` that ``rows``, with its part column, fall into; one number a part comes back."""
        part = part_of(name, F.col(PARTS[name].column))
        return sorted(r[0] for r in rows.select(part.alias(PART)).distinct().collect())

    # -- writing -----------------------------------------------------------

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, part_of(name, F.col(PARTS[name].column))) if name in PARTS else df

    def stage(self, table: str, rows: DataFrame, keep_if: Callable[[Counts], bool]) -> int:
        return self.store.replace(table, rows, STAGED_BY.get(table), keep_if=keep_if)

    def replace(self, name: str, df: DataFrame) -> int:
        return self.store.replace(name, self._stored(name, typed(df, TABLES[name])), self._partition(name))

    def append(self, name: str, df: DataFrame) -> int:
        return self.store.append(name, self._stored(name, typed(df, TABLES[name])), self._partition(name))

    def apply(self, name: str, changed: DataFrame) -> Counts:
        """Write a change of :meth:`rows`; only the parts in which a row changes are written.

        The part is a function of a key column, so no row leaves its part.
        """
        return self.store.apply(name, self._stored(name, changed), self._schema(name), self._partition(name))

    def reload(self, name: str, rows: DataFrame) -> Counts:
        """Empty the table and load it anew."""
        return self.store.reload(name, typed(rows, TABLES[name]), TABLES[name])

    def tidy(self) -> None:
        """Unite what many small appends have scattered, and drop what writes have prepared."""
        for name in self.store.tables():
            if name in TABLES:
                self.store.unite(name, self._schema(name), self._partition(name))
        self.store.drop_drafts()

    def delete_members(self, name: str, gone: DataFrame) -> int:
        """Delete the members' rows: one narrow scan counts them by part, then only the parts that have some are rewritten."""
        return self.store.delete(name, gone, self._schema(name), self._partition(name))
