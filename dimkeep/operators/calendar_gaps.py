"""Baseline rows and gap filling along the school calendar.

A calendar has ``date_id``, ``full_date``, ``is_weekend``, ``is_vacation_day``,
one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimkeep.functions.dates import yesterday_of
from dimkeep.operators.lookup import on_school_days, school_days
from dimkeep.operators.rollup import VALUE_TYPE

# Reason and value of a day without absence.
BASELINE_REASON = "IF"
BASELINE_VALUE = 0.0


def last_school_days(calendar: DataFrame, as_of: date, n: int = 10) -> DataFrame:
    """The latest ``n`` school days before ``as_of``."""
    return (
        school_days(calendar)
        .where(F.col("full_date") <= F.lit(yesterday_of(as_of)))
        .select("date_id", "full_date")
        .orderBy(F.desc("full_date"))
        .limit(n)
    )


def asof_source(days: DataFrame, present: DataFrame) -> DataFrame:
    """For each day without data, the nearest strictly earlier day that has some.

    ``days`` are calendar rows (``date_id``) and ``present`` the day keys with
    data, each day once. A running maximum over the days answers all of them in
    one pass instead of comparing every pair; its input is calendar days only,
    never the data behind them.
    """
    flagged = days.select("date_id").join(
        present.select("date_id").withColumn("_present", F.lit(True)), "date_id", "left"
    )
    earlier = Window.orderBy("date_id").rowsBetween(Window.unboundedPreceding, -1)
    return (
        flagged.withColumn("source_date_id", F.max(F.when(F.col("_present"), F.col("date_id"))).over(earlier))
        .where(F.col("_present").isNull())
        .select("date_id", "source_date_id")
    )


def _baseline(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*",
        F.lit(BASELINE_REASON).alias("absence_reason_code"),
        F.lit(BASELINE_VALUE).cast(VALUE_TYPE).alias("absence_value"),
        F.lit(None).cast("string").alias("lesson"),
    )


def fill_gaps(
    fact: DataFrame,
    calendar: DataFrame,
    roster: DataFrame,
    as_of: date,
    *,
    copied: Sequence[str],
    n: int = 10,
) -> DataFrame:
    """Baseline rows for the days without any fact among the last ``n`` school days.

    Each such day gets the distinct ``copied`` columns of the nearest earlier day
    with facts inside the window, or, if there is none, those of ``roster``.
    A filled day had no rows before, so nothing there can be met twice.

    Only day lists are broadcast; they hold at most ``n`` rows.
    """
    copied = list(copied)
    window = last_school_days(calendar, as_of, n)
    present = (
        fact.join(F.broadcast(window.select("date_id")), "date_id", "left_semi")
        .select("date_id")
        .distinct()
    )
    missing = asof_source(window, present)

    sources = missing.where(F.col("source_date_id").isNotNull()).select(
        F.col("date_id").alias("_missing"), F.col("source_date_id").alias("date_id")
    )
    from_fact = (
        fact.select("date_id", *copied)
        .join(F.broadcast(sources), "date_id")
        .select(F.col("_missing").alias("date_id"), *copied)
        .distinct()
    )
    # At most n days, folded into one array, so that the roster is read once and no join is needed.
    without = missing.where(F.col("source_date_id").isNull()).agg(F.collect_list("date_id"))
    from_roster = roster.select(F.explode(without.scalar()).alias("date_id"), *copied)
    return _baseline(from_fact.unionByName(from_roster))


def baseline_rows(
    roster: DataFrame,
    fact: DataFrame,
    calendar: DataFrame,
    day: int,
    keys: Sequence[str],
) -> DataFrame:
    """Baseline rows of one day for the roster members without a row, if it is a school day.

    ``keys`` (without the day) identify a member's row of that day.
    """
    keys = list(keys)
    rows = on_school_days(roster.withColumn("date_id", F.lit(day)), "date_id", calendar)
    taken = fact.where(F.col("date_id") == day).select(keys).distinct()
    return _baseline(rows.join(taken, keys, "left_anti"))
