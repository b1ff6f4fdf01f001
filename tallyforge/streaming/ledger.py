"""Batches of a stream, each written once however often it runs, and a ledger of what each one held.

A batch writes its own folder ``batch=<id>`` and replaces it if it runs again; its ledger row comes last. A run that dies between the
write and the commit of the stream's checkpoint repeats the batch under the same id, so nothing is written twice, and counts
come from the ledger whatever Spark still remembers of its progress.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sources.writers import exists


def replace_batch(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_batch(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    """What a finished batch wrote, or None."""
    folder = f"{path}/batch={batch}"
    return spark.read.parquet(folder) if exists(spark, f"{folder}/_SUCCESS") else None


def enter(spark: SparkSession, path: str, batch: int, facts: Mapping[str, object], kinds: str) -> None:
    """The ledger row of a batch; ``kinds`` is the DDL of ``facts``."""
    replace_batch(spark.createDataFrame([tuple(facts.values())], kinds).coalesce(1), path, batch)


def entries(spark: SparkSession, path: str, kinds: str) -> DataFrame:
    """All ledger rows with their batch ids; none if nothing ran yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"{kinds}, batch bigint")
    return spark.read.schema(f"{kinds}, batch bigint").parquet(path)


def last_batch(spark: SparkSession, path: str, kinds: str, before: int | None = None) -> int | None:
    rows = entries(spark, path, kinds)
    if before is not None:
        rows = rows.filter(F.col("batch") < before)
    return rows.agg(F.max("batch")).first()[0]
