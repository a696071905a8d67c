"""Checks of inputs, on the driver and before any work."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def require_unique(df: DataFrame, column: str, what: str) -> None:
    """Lookups by id must not fan out."""
    twice = df.groupBy(column).count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"{what} has repeated {column} values, such as {[r[column] for r in twice]}")
