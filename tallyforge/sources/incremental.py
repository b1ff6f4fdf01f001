"""Process only what has arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.streaming import ledger


COUNTS = "rows bigint"


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    file_format: str = "parquet",
    files_per_batch: int = 1000,
) -> int:
    """Add the rows of files not seen before to ``target``; return how many were added.

    The streaming checkpoint is the bookmark. Every batch writes its own folder of ``target`` and then a ledger row beside the
    checkpoint, and replaces both if it runs again, so a run that dies at any point is repeated without loss or repetition. The count
    comes from the ledger. A backlog is taken in batches of ``files_per_batch`` files; ``loaded`` reads the result.
    """
    facts = f"{checkpoint.rstrip('/')}-ledger"

    def step(batch: DataFrame, number: int) -> None:
        seen = Observation(f"batch-{number}")
        rows = transform(batch) if transform else batch
        ledger.replace_batch(rows.observe(seen, F.count(F.lit(1)).alias("rows")), target, number)
        ledger.enter(batch.sparkSession, facts, number, {"rows": seen.get["rows"]}, COUNTS)

    before = ledger.last_batch(spark, facts, COUNTS)
    rows = spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(source)
    rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    added = ledger.entries(spark, facts, COUNTS).filter(F.col("batch") > (-1 if before is None else before))
    return added.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """All rows that loads have added to ``target``."""
    return spark.read.parquet(target).drop("batch")


def rows_after(df: DataFrame, done: DataFrame, column: str, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` beyond the largest ``column`` in ``done``; all rows if ``done`` is empty.

    The bookmark is one value, read first, so that it reaches the scan as a literal filter. Rows at the
    bookmark itself and rows without a value count too, unless ``done`` has them: the same ``keys``, or without keys the same
    values in all columns that both have (NULLs are equal). With an empty list of keys all of them are taken as done.
    """
    last = done.agg(F.max(column)).first()[0]
    if last is None and keys is not None and not keys:
        return df
    if keys is not None and not keys:
        return df.filter(F.col(column) > F.lit(last))
    at_edge = F.col(column).isNull() if last is None else (F.col(column) == F.lit(last)) | F.col(column).isNull()
    open_rows = df if last is None else df.filter((F.col(column) >= F.lit(last)) | F.col(column).isNull())
    same = [c for c in df.columns if c in done.columns] if keys is None else list(keys)
    # one struct column, in which NULLs are equal
    key = F.struct(*same)
    known = done.filter(at_edge).select(key.alias("__key")).distinct()
    return open_rows.withColumn("__key", key).join(known, "__key", "left_anti").select(df.columns)
