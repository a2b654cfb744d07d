"""Surrogate keys for new natural keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Buckets are the first three hex digits of a hash: 4,096 at most, whatever the data.
_DIGITS = 3


def assign_keys(target: DataFrame, new: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """Number the new rows densely from the target's highest key on.

    ``new`` holds each natural key once. The order is that of (md5 of the
    natural key, natural key): it depends on nothing but the rows themselves, so
    a task that runs again hands out the same numbers. Rows are numbered within
    hash buckets, which are even because the keys are distinct, and each bucket
    starts after those before it; no task sees all rows.
    """
    natural = list(natural)
    text = [F.col(c).cast("string") for c in natural]
    hashed = F.md5(text[0] if len(text) == 1 else F.concat_ws("\x1f", *text))
    rows = new.withColumn("_hash", hashed).withColumn("_bucket", F.substring("_hash", 1, _DIGITS))

    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", *natural))
    top = target.agg(F.coalesce(F.max(F.greatest(F.col(key), F.lit(0))), F.lit(0))).scalar()
    return rows.join(F.broadcast(offsets), "_bucket").select(
        (top + F.col("_before") + within).cast(target.schema[key].dataType).alias(key), *new.columns
    )
