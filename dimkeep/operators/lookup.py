"""Key lookups against dimensions.

No join carries a broadcast hint: dimensions below the session's threshold are
broadcast by their measured size, larger ones are shuffled, and adaptive
execution splits the partition of a hot code (the sentinel, or null).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeep.functions.predicates import UNKNOWN
from dimkeep.operators.skew import evenly

_KEY = "_dim_key"


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: Column | str,
    dim_key: str,
    take: Mapping[str, str],
    *,
    default=None,
    required: bool = False,
) -> DataFrame:
    """Add dimension columns to ``df``.

    key       column or expression of ``df`` (a tolerant cast, a CASE, a name, ...).
    dim_key   column of ``dim`` it must equal.
    take      new column -> dimension column.
    default   value of the new columns where the key is null or unknown.
    required  drop such rows instead.
    """
    key = F.col(key) if isinstance(key, str) else key
    side = dim.select(
        F.col(dim_key).alias(_KEY), *[F.col(old).alias(f"_dim_{new}") for new, old in take.items()]
    )
    joined = df.join(side, key == F.col(_KEY), "inner" if required else "left")
    kept = [c for c in df.columns if c not in take]
    added = []
    for new in take:
        value = F.col(f"_dim_{new}")
        if default is not None:
            value = F.coalesce(value, F.lit(default).cast(side.schema[f"_dim_{new}"].dataType))
        added.append(value.alias(new))
    return joined.select(*kept, *added)


def eligible_members(
    members: DataFrame,
    units: DataFrame,
    groups: DataFrame,
    *,
    member_key: str,
    unit_key: str,
    group_key: str,
    flag: str,
    unknown=UNKNOWN,
) -> DataFrame:
    """Members whose unit belongs to a flagged group: member -> unit -> group, without the sentinel member."""
    flagged = groups.where(F.col(flag)).select(group_key)
    wanted = units.join(flagged, group_key, "left_semi").select(unit_key)
    if unknown is not None:
        members = members.where(F.col(member_key) != F.lit(unknown))
    return members.join(wanted, unit_key, "left_semi")


def school_days(calendar: DataFrame) -> DataFrame:
    return calendar.where(~F.col("is_weekend") & ~F.col("is_vacation_day"))


def on_school_days(df: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """Rows whose day key is a school day."""
    days = school_days(calendar).select(F.col("date_id").alias(day))
    return df.join(days, day, "left_semi")


def latest_prior_parent(
    stays: DataFrame,
    units: DataFrame,
    members: DataFrame,
    *,
    member: str,
    unit: str,
    until: str,
    parent: str,
    this_unit,
) -> DataFrame:
    """Parent unit of the last ended stay elsewhere, for members now at ``this_unit``; ties are kept.

    The last day per member is an aggregate, cut down to the members concerned
    and joined back on (member, day): no member's stays are ever gathered in one
    task, and the stays move once.
    """
    here = members.where(F.col(unit) == F.lit(this_unit)).select(member)
    ended = stays.where((F.col(unit) != F.lit(this_unit)) & F.col(until).isNotNull()).select(
        member, unit, until
    )
    last = ended.groupBy(member).agg(F.max(until).alias(until)).join(here, member, "left_semi")
    return (
        ended.join(evenly(last), [member, until], "left_semi")
        .join(units.select(unit, parent), unit)
        .select(member, parent)
        .distinct()
    )
