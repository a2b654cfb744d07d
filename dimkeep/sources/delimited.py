"""Flat delimited extracts.

Files without a quoted line break are read by Spark's reader, in splits. In the others a
record may go on over several lines, and whether a line stands inside a quote depends
on all the quotes before it. That is found in two levels: within a split lines are
counted as if it began outside a quote, and as if it began inside one; which of the two
is true follows from the splits before it, one small row each. Lines of one record are
then joined, also over the border of two splits, so one huge file is read by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeep.functions.text import windows_line, windows_name, windows_text
from dimkeep.session import Scratch

SEPARATOR = ";"
_RECORD = "_record"


def _files(spark: SparkSession, paths: list[str]) -> list[tuple[str, str, bool, bool]]:
    """(path, first line, whether a line leaves a quote open, whether the file does) of each file with a line.

    One pass over the text; a row per file comes back.
    """
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), place.alias("at"), windows_line(F.col("value")).alias("line"), quotes.alias("quotes")
    )
    # The path is given as a URI.
    plain = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    found = lines.groupBy("path").agg(
        F.min_by("line", "at").alias("head"),
        (F.max(F.col("quotes") % 2) > 0).alias("open"),
        (F.sum("quotes") % 2 > 0).alias("unclosed"),
    )
    return sorted((r["path"], r["head"], r["open"], r["unclosed"]) for r in found.select(plain.alias("path"), "head", "open", "unclosed").collect())


def read_delimited(
    spark: SparkSession, paths: str | Sequence[str], *, multi_line: bool | None = None, scratch: Scratch | None = None
) -> DataFrame:
    """Windows-1252 files with a header line each; every column is text and only an empty cell is null.

    Files are united by column name, whatever the order of their columns; a column
    that a file lacks is null there. A row with more cells than its header fails
    the job instead of being cut, and a quote that is never closed fails at once.

    All files are read in splits. The lines of files with quoted line breaks are kept in
    ``scratch`` (one of its own if none is given) while records are put together from
    them. ``multi_line=False`` refuses such files, ``True`` takes all for such.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    alike: dict[tuple[str, bool], list[str]] = {}
    for path, head, open_, unclosed in _files(spark, paths):
        if unclosed:
            raise ValueError(f"a quote is not closed in {path}")
        if open_ and multi_line is False:
            raise ValueError(f"a quoted line break in {path}")
        alike.setdefault((head, open_ or bool(multi_line)), []).append(path)
    if not alike:
        return _read_alike(spark, paths, False)
    frames = []
    for (_, open_), found in alike.items():
        if open_:
            scratch = scratch or Scratch(spark, spark.conf.get("spark.sql.warehouse.dir"))
            frames.append(_read_quoted(spark, found, scratch))
        else:
            frames.append(_read_alike(spark, found, False))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def _with_quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (path, start, ln, line, odd) with what a split alone says of its quotes.

    ``before`` and ``after``: whether an odd number of quotes stands in the split before and
    after the line. ``own0`` and ``own1``: the last line so far that begins outside a
    quote if the split begins outside or inside one.
    """
    split, after, own = None, 0, [-1, -1]
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        begins = np.array([keys[0] != split, *(a != b for a, b in zip(keys[1:], keys))])
        odd, ln = batch.column(4).to_numpy(), batch.column(2).to_numpy()
        edges = [0, *np.flatnonzero(begins[1:] if n > 1 else begins[:0]) + 1, n]
        befores, afters, owns = [], [], ([], [])
        for lo, hi in zip(edges[:-1], edges[1:]):
            if begins[lo]:
                after, own = 0, [-1, -1]
            total = (after + np.cumsum(odd[lo:hi])) % 2
            before = np.append(after, total[:-1])
            for side in (0, 1):
                at = np.maximum.accumulate(np.where(before == side, np.arange(hi - lo), -1))
                last = np.where(at >= 0, ln[lo:hi][np.maximum(at, 0)], own[side])
                owns[side].append(last)
                own[side] = int(last[-1])
            befores.append(before)
            afters.append(total)
            after = int(total[-1])
        split = keys[-1]
        columns = [batch.column(i) for i in range(4)]
        columns += [pa.array(np.concatenate(x).astype(np.int32)) for x in (befores, afters)]
        columns += [pa.array(x := np.concatenate(o), pa.int64(), mask=x < 0) for o in owns]
        yield pa.record_batch(columns, names=["path", "start", "ln", "line", "before", "after", "own0", "own1"])


def _records(spark: SparkSession, paths: list[str], scratch: Scratch) -> DataFrame:
    """``record`` of every record of the files but the first of each, its header."""
    line = windows_line(F.col("value"))
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    rows = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("ln"),
        line.alias("line"),
        (quotes % 2).cast("int").alias("odd"),
    )
    # Where a line stands depends on how one execution deals the splits out, so that is written down.
    lines = scratch.keep(
        rows.mapInArrow(_with_quotes, "path string, start long, ln long, line string, before int, after int, own0 long, own1 long")
    )
    above = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("path", "start").agg(
        F.max_by("after", "ln").alias("odd"), F.max("own0").alias("own0"), F.max("own1").alias("own1")
    )
    side = F.pmod(F.coalesce(F.sum("odd").over(above), F.lit(0)), F.lit(2))
    splits = splits.withColumn("_inside", side)

    def of_side(zero: str, one: str) -> Column:
        return F.when(F.col("_inside") == 0, F.col(zero)).otherwise(F.col(one))

    last = F.when(of_side("own0", "own1").isNotNull(), F.struct("start", of_side("own0", "own1").alias("ln")))
    splits = splits.withColumn("_last", last).select(
        F.col("path"), "start", "_inside", F.last("_last", ignorenulls=True).over(above).alias("_carry")
    )
    own = of_side("own0", "own1")
    placed = lines.join(splits, ["path", "start"]).select(
        "path",
        F.struct("start", "ln").alias("at"),
        "line",
        F.when(own.isNotNull(), F.struct("start", own.alias("ln"))).otherwise(F.col("_carry")).alias("record"),
        ((F.col("before") + F.col("_inside")) % 2 == 1).alias("goes_on"),
        ((F.col("after") + F.col("_inside")) % 2 == 1).alias("open"),
    )
    tops = lines.groupBy("path").agg(F.min(F.struct("start", "ln")).alias("_top"))
    placed = placed.join(tops, "path").where(F.col("record") != F.col("_top"))
    whole = ~F.col("goes_on") & ~F.col("open")
    joined = (
        placed.where(~whole)
        .groupBy("path", "record")
        .agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("_lines"))  # of one record
        .select(F.array_join(F.transform("_lines", lambda x: x["line"]), "\n").alias("record"))
    )
    single = placed.where(whole & (F.trim("line") != "")).select(F.col("line").alias("record"))
    return single.union(joined)


def _read_quoted(spark: SparkSession, paths: list[str], scratch: Scratch) -> DataFrame:
    """Files of one header that have quoted line breaks."""
    options = {"sep": SEPARATOR, "quote": '"', "escape": '"'}
    reader = spark.read.options(**options).option("header", True).option("encoding", "ISO-8859-1").option("multiLine", True)
    names = [windows_name(n) for n in reader.csv(paths[:1], inferSchema=False).columns]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RECORD]])
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD}
    cells = F.from_csv("record", F.lit(", ".join(f"`{f.name}` STRING" for f in schema.fields)), options)
    raw = _records(spark, paths, scratch).select(cells.alias("_cells")).select("_cells.*")
    return raw.where(_fits(names)).select([F.nullif(F.col(f"`{n}`"), F.lit("")).alias(n) for n in names])


def _fits(names: Sequence[str]) -> Column:
    """Fails on a record of more cells than the header has.

    Rows whose cell count is not the header's carry their text in the record
    column. Short ones are fine; a long one has more separators outside quotes.
    """
    outside = F.regexp_replace(F.col(_RECORD), '"[^"]*"', "")
    separators = F.length(outside) - F.length(F.replace(outside, F.lit(SEPARATOR), F.lit("")))
    # Naming the first cell keeps a data column in the plan; Spark refuses to read the record alone.
    message = F.concat(
        F.lit(f"more than {len(names)} cells in the row of "),
        F.coalesce(F.col(f"`{names[0]}`"), F.lit("")),
        F.lit(": "),
        F.col(_RECORD),
    )
    too_long = F.when(separators >= len(names), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return F.col(_RECORD).isNull() | too_long


def _read_alike(spark: SparkSession, paths: list[str], multi_line: bool) -> DataFrame:
    """Files of one header."""
    reader = (
        spark.read.option("sep", SEPARATOR)
        .option("header", True)
        .option("encoding", "ISO-8859-1")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        # A pruned parser does not see the cells beyond the header.
        .option("columnPruning", False)
    )
    names = reader.csv(paths, inferSchema=False).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RECORD]])
    raw = reader.option("columnNameOfCorruptRecord", _RECORD).schema(schema).csv(paths)
    return raw.where(_fits(names)).select(
        [F.nullif(windows_text(F.col(f"`{n}`")), F.lit("")).alias(windows_name(n)) for n in names]
    )
