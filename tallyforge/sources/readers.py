"""Checked reads, CSV and JSON input, fallback sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class EmptySourceError(ValueError):
    """A source that must have rows has none."""


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Return ``df``, or raise if it is empty; looks for one row instead of counting all."""
    if df.isEmpty():
        raise EmptySourceError(f"{name} has no rows")
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return require_rows(spark.table(name), name)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    register_as: str | None = None,
    sep: str = ",",
    quote: str = '"',
    escape: str = "\\",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Headered CSV. Without a schema the types are inferred, which reads the data once more."""
    reader = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", escape)
        .option("encoding", encoding)
    )
    df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)
    if register_as:
        df.createOrReplaceTempView(register_as)
    return df


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_with_fallback(
    spark: SparkSession, table: str, backup_path: str, check: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """The table if it exists, has rows and passes ``check``; otherwise the Parquet backup."""
    try:
        df = read_table(spark, table)
        if check:
            check(df)
        return df
    except (AnalysisException, PySparkException, ValueError):
        return require_rows(spark.read.parquet(backup_path), backup_path)


def file_report(df: DataFrame) -> DataFrame:
    """Rows, bytes and rows per MB of every file behind a file-based DataFrame."""
    mb = F.col("file_size_bytes") / 1024.0 / 1024.0
    return (
        df.groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size_bytes"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumns({"file_size_mb": F.round(mb, 2), "records_per_mb": F.try_divide(F.col("record_count"), mb)})
    )


def partition_report(df: DataFrame, partitions: list[str], value: str, watched: list[str]) -> DataFrame:
    """Per partition: rows, range and mean of ``value``, NULL counts of ``watched``, NULL share of ``value``."""
    rows = F.count(F.lit(1))
    return df.groupBy(*partitions).agg(
        rows.alias("record_count"),
        F.min(value).alias(f"min_{value}"),
        F.max(value).alias(f"max_{value}"),
        F.avg(value).alias(f"avg_{value}"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}_count") for c in watched],
        F.round(F.try_divide(F.count_if(F.col(value).isNull()) * 100.0, rows), 2).alias(f"null_{value}_pct"),
    )
