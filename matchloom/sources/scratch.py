"""Tables written on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; a temporary one only where none is set (local sessions)."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = f"file://{tempfile.gettempdir()}/scratch"
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}-{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once and read back, for what is read several times. Other than of a cached table, plans that read it don't hold its own plan,
    which the driver keeps as text for each query and each step of its adaptive planning."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
