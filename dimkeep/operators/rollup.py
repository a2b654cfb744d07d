"""Aggregations: daily rollup of registrations, one row per code."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeep.operators.skew import distinct_keys, evenly

VALUE_TYPE = "decimal(3,1)"


@dataclass(frozen=True)
class RollupRules:
    """How registrations of one member and day reduce to one row."""

    # Registration kinds, reasons from strongest to weakest, half days, labels.
    full: tuple = (5,)
    half: tuple = (7,)
    priority: tuple[str, ...] = ("U", "S", "L", "F")
    first_part: str = "første"
    last_part: str = "sidste"
    label_full: str = "Hele dagen"
    label_first: str = "Første lektion"
    label_last: str = "Sidste lektion"
    # A half day counts as a whole one in these grades.
    whole_day_grades: tuple[int, int] = (0, 6)


def until(df: DataFrame, day: Column, last) -> DataFrame:
    """Rows up to the last day; later registrations are in the future and wait."""
    return df.where(day <= F.lit(last))


def daily_rollup(
    rows: DataFrame,
    keys: Sequence[str],
    *,
    kind: str,
    reason: str,
    grade: str,
    part: str | None = None,
    track: str | None = None,
    rules: RollupRules = RollupRules(),
) -> DataFrame:
    """One row per key: strongest reason, value capped at one day, label.

    Rows of another kind or reason are ignored. Reason and value are reduced
    separately. Everything is a max or a sum of integers, so map-side partial
    aggregation absorbs a hot key.
    """
    is_full = F.col(kind).isin(list(rules.full))
    is_half = F.col(kind).isin(list(rules.half))
    level = F.col(grade).try_cast("int")
    rank = F.lit(None).cast("int")
    for strength, name in enumerate(reversed(rules.priority)):
        rank = F.when(F.col(reason) == name, F.lit(strength)).otherwise(rank)

    aggregates = [
        F.max(level).alias("grade_level"),
        F.max(rank).alias("_rank"),
        F.max((is_full | (is_half & F.coalesce(level.between(*rules.whole_day_grades), F.lit(False)))).cast("int")).alias("_whole"),
        F.sum(is_half.cast("int")).alias("_halves"),
    ]
    if part is not None:
        for name, text in (("_first", rules.first_part), ("_last", rules.last_part)):
            aggregates.append(
                F.max((is_half & F.coalesce(F.col(part) == text, F.lit(False))).cast("int")).alias(name)
            )
    if track is not None:
        aggregates.append(F.max(track).alias("track"))

    reduced = (
        rows.where((is_full | is_half) & F.col(reason).isin(list(rules.priority)))
        .groupBy(*keys)
        .agg(*aggregates)
    )
    whole = (F.col("_whole") == 1) | (F.col("_halves") >= 2)
    strongest = F.element_at(F.array(*[F.lit(r) for r in reversed(rules.priority)]), F.col("_rank") + 1)
    label = F.when(whole, F.lit(rules.label_full))
    if part is not None:
        label = label.when(F.col("_first") == 1, F.lit(rules.label_first)).when(
            F.col("_last") == 1, F.lit(rules.label_last)
        )
    return reduced.select(
        *keys,
        "grade_level",
        *(["track"] if track is not None else []),
        strongest.alias("absence_reason_code"),
        F.when(whole, F.lit(1.0)).otherwise(F.col("_halves") * F.lit(0.5)).cast(VALUE_TYPE).alias("absence_value"),
        label.alias("lesson"),
    )


def collapse_min(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per code. Each attribute is its own minimum, so they may come from different rows."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.min(c).alias(c) for c in columns])
    )


def code_names(df: DataFrame, pairs: Sequence[tuple[str, str]], code: str, name: str) -> DataFrame:
    """Distinct (code, name) rows from one or more column pairs, both parts present."""
    out = None
    for old_code, old_name in pairs:
        part = df.where(F.col(old_code).isNotNull() & F.col(old_name).isNotNull()).select(
            F.col(old_code).alias(code), F.col(old_name).alias(name)
        )
        out = part if out is None else out.union(part)
    return out.distinct()


def with_fallback(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """The primary rows, and the fallback rows of codes the primary does not have."""
    only = fallback.join(evenly(distinct_keys(primary, [key])), key, "left_anti")
    return primary.unionByName(only.select(primary.columns))
