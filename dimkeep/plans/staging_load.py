"""Extract files -> staging tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimkeep.plans import fixed_values as fixed
from dimkeep.plans.model import staged
from dimkeep.plans.warehouse import Warehouse
from dimkeep.session import Scratch, measured_broadcasts
from dimkeep.sources.delimited import read_delimited
from dimkeep.sources.sections import parse_sections, read_lines, section_columns
from dimkeep.sources.staging import select_renamed, typed, with_load_date
from dimkeep.sources.store import observed


def read_extract(spark: SparkSession, path, file: str, scratch: Scratch) -> DataFrame:
    """Parsed extract under its source column names. ``path`` may be a list or a glob of files of one kind."""
    if file not in fixed.SECTIONED:
        return read_delimited(spark, path, scratch=scratch)
    mapping = fixed.COLUMNS[fixed.FILES[file]]
    lines = read_lines(spark, path, scratch)
    if len(set(mapping.values())) == len(mapping):
        return parse_sections(lines, [c for c in mapping if c != "row_type"], scratch.keep)
    # Two source columns share a name: which one comes first is up to the files.
    return parse_sections(lines, [c for c in section_columns(lines, scratch.keep) if c in mapping], scratch.keep)


def stage(parsed: DataFrame, table: str, moment: datetime) -> DataFrame:
    """Parsed extract -> staged rows. Text that does not fit its type fails the job."""
    df = select_renamed(parsed, fixed.COLUMNS[table], fixed.DROPPED.get(table, ()))
    if table == "student_basis" and "school_type_code" in df.columns:
        df = df.where(F.col("school_type_code").isNotNull())
    return typed(with_load_date(df, moment), staged(table))


def load_staging(warehouse: Warehouse, folder: str, moment: datetime) -> dict[str, int]:
    """Replace every staging table; returns rows per table.

    All tables get the same load date. A file without rows counts 0 and leaves
    the table of the day before in place; the run goes on with that. Rows are
    counted where the file has been parsed and where they are written, in one pass.
    """
    loaded = {}
    with measured_broadcasts(warehouse.spark), Scratch(warehouse.spark, warehouse.root) as scratch:
        for file, table in fixed.FILES.items():
            seen = Observation()
            parsed = read_extract(warehouse.spark, f"{folder}/{file}", file, scratch)
            rows = stage(parsed.observe(seen, F.count(F.lit(1)).alias("rows")), table, moment)
            loaded[table] = warehouse.stage(table, rows, lambda _: not observed(seen, parsed, ["rows"])["rows"])  # noqa: B023
    return loaded
