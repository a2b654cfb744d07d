"""Joins that stay even when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def evenly(df: DataFrame) -> DataFrame:
    """The reduced side of a join, moved once more.

    Adaptive execution splits a hot key of one join side only if both sides are
    shuffled for that join. A side that was just grouped by the join keys is not,
    so it gives up its partitioning here. It holds one row per key, which makes
    this cheap next to the side with the hot key.
    """
    return df.hint("rebalance")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once; a hot key is reduced before it moves."""
    return df.select(list(keys)).distinct()
