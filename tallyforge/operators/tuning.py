"""Small helpers around a user's own DataFrame: lean inputs, persistence, plan text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lean_input(df: DataFrame, group: Sequence[str], values: Sequence[str], cache: bool = False) -> DataFrame:
    """Only the columns an aggregate needs, without rows whose first group column is NULL.

    Caching pays only if the result is read several times.
    """
    lean = df.filter(F.col(group[0]).isNotNull()).select(*group, *values)
    return lean.cache() if cache else lean


def drop_temporary(df: DataFrame, suffix: str = "_temp", level: StorageLevel | None = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Drop scratch columns and persist; ``level=None`` leaves persistence to the caller."""
    kept = df.drop(*[c for c in df.columns if c.endswith(suffix)])
    return kept if level is None else kept.persist(level)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text that ``explain`` prints."""
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))
