"""Register of (query, SQL) pairs and readers of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeep.functions.dates import day_key

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of one scale, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


def query(sql: str):
    """Register ``fn(tables)`` under its own name with its oracle."""

    def register(fn: Callable[[Tables], DataFrame]):
        _QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
        _ORACLES[fn.__name__] = sql
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def key_of(timestamp: str) -> Column:
    """Day key of a timestamp column."""
    return day_key(F.to_date(timestamp))


def sql_key(timestamp: str) -> str:
    return f"CAST(strftime({timestamp}, '%Y%m%d') AS INTEGER)"
