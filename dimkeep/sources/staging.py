"""From a parsed extract to a staging table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_renamed(df: DataFrame, mapping: Mapping[str, str], drop: Iterable[str] = ()) -> DataFrame:
    """Project to the mapping's targets, in its order.

    Columns outside the mapping go, absent ones are tolerated. Of several
    columns mapped to one name the first in the file wins, null or not.
    """
    drop = set(drop)
    chosen: dict[str, str] = {}
    for column in df.columns:
        chosen.setdefault(mapping.get(column, column), column)
    wanted = [t for t in dict.fromkeys(mapping.values()) if t in chosen and t not in drop]
    return df.select([F.col(f"`{chosen[t]}`").alias(t) for t in wanted])


def with_load_date(df: DataFrame, moment: datetime) -> DataFrame:
    return df.withColumn("stg_load_date", F.lit(moment).cast("timestamp_ntz"))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Strict casts to the declared types; absent columns are null. Text that does not fit fails the job."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
