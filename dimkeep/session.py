"""A session with the settings the loads rely on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from dimkeep.sources.files import Files

#: Bytes of a join's side as planned from its files up to which it is broadcast unmeasured.
SURELY_SMALL = 256 << 10

_PLANNED, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def build_session(app: str = "dimkeep", master: str | None = None, **extra: str) -> SparkSession:
    """Adaptive execution splits hot join partitions and picks broadcasts by measured size.

    ``master`` and memory are left to ``spark-submit`` unless given.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
    }
    settings.update(extra)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def measured_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Joins that run within broadcast a side that is surely small, any other only once its rows have been measured.

    The driver holds what is broadcast. From files Spark plans with their bytes times the
    share of the columns that are read, as if all were alike; keys packed beside many empty
    columns have come to a hundred times that in memory. So only the rows that a shuffle
    has counted are held against the session's own threshold, which is set back at the end.
    """
    own = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if own <= SURELY_SMALL:
        yield
        return
    before = {name: spark.conf.get(name, None) for name in (_PLANNED, _MEASURED)}
    if before[_MEASURED] is None:
        spark.conf.set(_MEASURED, str(own))
    spark.conf.set(_PLANNED, str(SURELY_SMALL))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class Scratch:
    """A folder of its own for what one run keeps between jobs; every executor can reach it.

    It lies in the folder that ``spark.checkpoint.dir`` names, and only where none
    is set under ``root``. What several joins use is computed once that way, a
    lost executor does not mean starting over, and the joins know the real sizes.
    ``clear`` removes it; used in a ``with`` statement it is removed at the end.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None) or f"{root}/_scratch"
        self._base, self._name = base.rstrip("/"), f"dimkeep-{uuid.uuid4().hex}"
        self.folder = f"{self._base}/{self._name}"

    def place(self) -> str:
        """A new path inside."""
        return f"{self.folder}/{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written once and read back."""
        path = self.place()
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        Files(self._spark, self._base).remove(self._name)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.clear()
