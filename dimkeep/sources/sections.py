"""Files of several sections, each with its own header.

The first field of a line says what it is: ``2`` a header, ``3`` a sum line,
anything else a data row of that type. Line 1 is metadata.

The header a row belongs to is the last one above it, found in two levels. Within a
block of lines the last header is carried from line to line; from block to block it
is carried over one small row each. So a row knows the place of its header, which it
meets in one join; neither a file nor its headers are ever one group, and a file of
very many sections costs no more than one of few.

Blocks of files are their splits: the lines are written to a shared folder with their
positions as one execution deals them out, and everything after that works on this
copy, however the cluster has changed in between.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimkeep.functions.text import windows_line
from dimkeep.operators.skew import evenly
from dimkeep.session import Scratch

#: Stores what holds a row for each block or header, so that the join with the lines knows how small it is.
Keep = Callable[[DataFrame], DataFrame]

SEPARATOR = ";"
HEADER, TOTAL = "2", "3"
EXTRA = "_extra_"
#: Lines of a block, where the lines do not come from files.
_BLOCK = 1 << 16
#: Columns whose cells are looked up one by one.
_APART = 16
# What Python's strip() removes, as far as it occurs in single-byte text.
_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f "


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (path, start, ln, line, header, width) with ``own`` in place of ``header``: the last header of the split so far.

    The first line of a file is no header. Splits come one after the other, each in order.
    """
    split, last = None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        path, start, ln = batch.column(0), batch.column(1), batch.column(2)
        begins = np.ones(n, bool)
        begins[0] = split != (path[0].as_py(), start[0].as_py())
        differ = pc.or_(pc.not_equal(path.slice(1), path.slice(0, n - 1)), pc.not_equal(start.slice(1), start.slice(0, n - 1)))
        begins[1:] = differ.to_numpy(zero_copy_only=False)
        header = batch.column(4).to_numpy(zero_copy_only=False) & ~(begins & (start.to_numpy() == 0))
        at = np.maximum.accumulate(np.where(header, np.arange(n), -1))
        group = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
        own = np.where((at >= 0) & (at >= group), ln.to_numpy()[np.maximum(at, 0)], -1)
        if last is not None:
            own[(group < 0) & (at < 0)] = last  # the split of the batch before goes on
        yield pa.record_batch(
            [path, start, ln, batch.column(3), pa.array(own, pa.int64(), mask=own < 0), batch.column(5)],
            names=["path", "start", "ln", "line", "own", "width"],
        )
        split, last = (path[n - 1].as_py(), start[n - 1].as_py()), (int(own[-1]) if own[-1] >= 0 else None)


def read_lines(spark: SparkSession, paths: str | Sequence[str], scratch: Scratch) -> DataFrame:
    """Lines of windows-1252 files as ``(path, start, ln, line, own, width)``, kept in the scratch folder.

    The scan stays splittable. Row ids grow along a split and splits are ordered
    by their offset. Both depend on how one execution deals the files out, so
    they are written down in that execution, and with them the place of the last
    header above each line in its split, and how far a row reaches: what looks at the
    rows only to place them or to measure them reads no text.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    rows = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("ln"),
        windows_line(F.col("value")).alias("line"),
    )
    rows = rows.select("*", _is_header().alias("header"), _width().alias("width"))
    return scratch.keep(rows.mapInArrow(_carried, "path string, start long, ln long, line string, own long, width int"))


def _is_blank(text: Column) -> Column:
    return F.trim(text, F.lit(_SPACE)) == ""


def _cells(line: Column) -> Column:
    return F.split(line, SEPARATOR, -1)


def _last_filled(line: Column) -> Column:
    """Position of the last cell of a line that is not blank, counted from 1; 0 if there is none."""
    filled = F.rtrim(line, F.lit(_SPACE + SEPARATOR))
    return F.when(filled == "", 0).otherwise(F.length(filled) - F.length(F.replace(filled, F.lit(SEPARATOR), F.lit(""))) + 1)


def _is_header() -> Column:
    return F.substring_index("line", SEPARATOR, 1) == HEADER


def _width() -> Column:
    """How far a data row reaches; null for any other line."""
    kind = F.substring_index("line", SEPARATOR, 1)
    return F.when(~kind.isin(HEADER, TOTAL) & ~_is_blank(F.col("line")), _last_filled(F.col("line")))


def _in_blocks(lines: DataFrame) -> DataFrame:
    """``(path, start, ln, line, own, width)``: a block is (path, start), and ``own`` the last header in it above or at a line."""
    if "own" in lines.columns:
        return lines
    tops = lines.groupBy("path").agg(F.min("ln").alias("_top"))
    above = Window.partitionBy("path", "start").orderBy("ln")
    header = F.when(_is_header() & (F.col("ln") != F.col("_top")), F.col("ln"))
    rows = lines.join(tops, "path").withColumn("start", F.floor(F.col("ln") / _BLOCK))
    return rows.select("path", "start", "ln", "line", F.last(header, ignorenulls=True).over(above).alias("own"), _width().alias("width"))


def _headers(lines: DataFrame) -> DataFrame:
    """``(path, section, line)`` of each header; a section is the place of its header."""
    return lines.where(F.col("own") == F.col("ln")).select("path", F.struct("start", F.col("ln")).alias("section"), "line")


def _rows(lines: DataFrame, keep: Keep) -> DataFrame:
    """Data rows below a header: ``(path, section, line, width)``."""
    # What a block takes from the blocks before it: one row for each block.
    blocks = lines.groupBy("path", "start").agg(F.max("own").alias("_last"))
    known = F.when(F.col("_last").isNotNull(), F.struct("start", F.col("_last").alias("ln")))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select("path", "start", F.last(known, ignorenulls=True).over(before).alias("_carry"))
    section = F.when(F.col("own").isNotNull(), F.struct("start", F.col("own").alias("ln"))).otherwise(F.col("_carry"))
    return (
        lines.where(F.col("width").isNotNull())
        .join(keep(carry), ["path", "start"], "left")
        .select("path", section.alias("section"), "line", "width")
        .where(F.col("section").isNotNull())
    )


def _widths(rows: DataFrame) -> DataFrame:
    """How far the rows of each section reach, white space aside: ``(path, section, width)``."""
    return rows.groupBy("path", "section").agg(F.max("width").alias("width"))


def _names(header: Column) -> Column:
    """Column names of a header line; blank ones at the end are dropped."""
    # Cell 0 is the row type, so the header's own columns are the cells after it.
    return F.slice(_cells(header), F.lit(2), F.greatest(_last_filled(header) - 1, F.lit(0)))


def _extra_position(name: str) -> int | None:
    """N of ``_extra_N``."""
    number = name.removeprefix(EXTRA)
    return int(number) if name.startswith(EXTRA) and number.isdigit() else None


def _marks(headers: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The sections with where the wanted columns lie: worked out per header, not per row."""
    names = F.col("_names")

    def cell(name: str) -> Column:
        place = F.array_position(names, F.lit(name)).cast("int")
        added = _extra_position(name)
        if added is None:
            return place
        return F.when((place == 0) & (F.size(names) <= added), F.lit(added + 1)).otherwise(place)

    at = F.array(*[cell(name) for name in wanted]).cast("array<int>")
    named = headers.select("path", "section", _names(F.col("line")).alias("_names"))
    return named.select("path", "section", F.size("_names").alias("named"), at.alias("cells"))


def section_columns(lines: DataFrame, keep: Keep = evenly) -> list[str]:
    """Names of all sections with rows, in order of first appearance.

    Like a header read of a flat file this runs a job; only the distinct names
    come back. Blank names inside a header have no use as a column and are left out.
    """
    lines = _in_blocks(lines)
    named = _headers(lines).select("path", "section", _names(F.col("line")).alias("named"))
    # Where rows reach further than the header, ``_extra_N`` names are added, N counting its positions from 0.
    size, reach = F.size("named"), F.col("width") - 1
    added = F.when(reach > size, F.sequence(size, reach - 1)).otherwise(F.array().cast("array<int>"))
    names = F.concat("named", F.transform(added, lambda n: F.concat(F.lit(EXTRA), n.cast("string"))))
    found = (
        named.join(_widths(_rows(lines, keep)), ["path", "section"])
        .select("path", "section", F.posexplode(names).alias("pos", "name"))
        .where("name != ''")
        .groupBy("name")
        .agg(F.min(F.struct("path", "section", "pos")).alias("seen"))
    )
    return [r["name"] for r in sorted(found.collect(), key=lambda r: r["seen"])]


def parse_sections(lines: DataFrame, columns: Sequence[str] | None = None, keep: Keep = evenly) -> DataFrame:
    """All data rows of all sections, united by column name: ``row_type`` and ``columns``.

    ``lines`` is ``(path, ln, line)``, ``ln`` counting from the top of each file, or
    what :func:`read_lines` gives. Columns a section does not have are null, and
    so are empty cells; other white space is kept. Without ``columns`` the names
    are looked up at once. With ``keep`` (a scratch folder's) the places of headers
    are stored first; while they are few, no row is shuffled to meet its header.
    """
    wanted = section_columns(lines, keep) if columns is None else list(columns)
    lines = _in_blocks(lines)
    rows = _rows(lines, keep)
    marks = _marks(_headers(lines), wanted)
    extras = [i for i, name in enumerate(wanted) if _extra_position(name) is not None]
    if extras:
        # An added column exists only as far as some row of the section has text.
        marks = marks.join(_widths(rows), ["path", "section"], "left")
    at = [F.get("cells", F.lit(i)) for i in range(len(wanted))]
    there = [(c <= F.col("named")) | (c < F.col("width")) if i in extras else F.lit(True) for i, c in enumerate(at)]
    cells = F.array(*[F.when((c > 0) & reached, c) for c, reached in zip(at, there)]).cast("array<int>")
    marks = marks.select("path", "section", cells.alias("cells"))
    if keep is not evenly:
        marks = keep(marks)
    rows = rows.drop("width").join(marks, ["path", "section"])
    rows = rows.withColumn("_cell", _cells(F.col("line")))

    def text(at: Column) -> Column:
        return F.nullif(F.get("_cell", at), F.lit(""))

    first = text(F.lit(0)).alias("row_type")
    if len(wanted) <= _APART:
        return rows.select(first, *[text(F.get("cells", F.lit(i))).alias(name) for i, name in enumerate(wanted)])
    # One expression looks up all cells: one for each makes a method too long for the JVM to compile.
    rows = rows.select(first, F.transform("cells", text).alias("_found"))
    return rows.select("row_type", *[F.get("_found", F.lit(i)).alias(name) for i, name in enumerate(wanted)])
