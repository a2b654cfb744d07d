"""What several operators of this package need: free column names and tables written once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use in any spelling."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share.

    It lies in ``spark.checkpoint.dir``; where that is not set, as in tests on one
    machine, under the warehouse. On a cluster that fails, as executors may not share it. All folders of one application share a parent, which
    can be removed when the application has ended.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and it outlives a lost executor."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
