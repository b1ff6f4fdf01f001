"""Writes: flat, partitioned, size-targeted, staged, checkpointed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


MB = 1024 * 1024


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
    mode: str = "overwrite",
    max_records_per_file: int = 0,
    cluster: bool = True,
    sort_by: Sequence[str] = (),
) -> None:
    """Parquet, optionally partitioned, with rows sorted inside each file by ``sort_by``.

    Sorted files have narrow min/max statistics, so later filters on those columns skip row groups.

    For a partitioned write the rows are first brought together by partition value, so that a
    partition gets few files. ``REBALANCE`` lets AQE split a partition value that holds a large
    share of the rows over several tasks, instead of writing it from one.
    """
    if partition_by and cluster:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def with_year_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


def write_by_date(df: DataFrame, date: str, path: str) -> DataFrame:
    """Write by (year, month) and return the rows per partition, read from what was written."""
    write_parquet(with_year_month(df, date), path, ["year", "month"])
    written = df.sparkSession.read.parquet(path)
    return written.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


def cap_categories(df: DataFrame, category: str, max_partitions: int = 50, other: str = "others") -> DataFrame:
    """Add ``<category>_partition``, a string: the category, or ``other`` beyond the ``max_partitions - 1`` largest.

    All categories are kept if there are at most ``max_partitions``; NULL is a category like any other and stays
    NULL where it is kept. Equally large ones are taken in name order. A category that is itself
    called ``other`` shares its partition with those beyond the cap.
    """
    text = F.col(category).cast("string")
    counts = df.groupBy(text.alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    largest = [r["__c"] for r in counts.orderBy(F.desc("__n"), F.asc_nulls_last("__c")).limit(max_partitions + 1).collect()]
    kept = largest if len(largest) <= max_partitions else largest[: max_partitions - 1]
    named = text.isin([c for c in kept if c is not None])
    known = F.coalesce(named, F.lit(None in kept))
    return df.withColumn(f"{category}_partition", F.when(known, text).otherwise(F.lit(other)))


def write_by_category(df: DataFrame, category: str, path: str, max_partitions: int = 50) -> None:
    write_parquet(cap_categories(df, category, max_partitions), path, [f"{category}_partition"])


def bytes_per_row(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> float:
    """Mean length of a row as JSON, estimated from a sample; 0 for an empty sample."""
    sampled = df.sample(fraction=fraction, seed=seed).select(F.length(F.to_json(F.struct("*"))).alias("n"))
    return float(sampled.agg(F.avg("n")).first()[0] or 0.0)


def target_partitions(rows: int, row_bytes: float, target_mb: float = 128) -> int:
    return max(1, int(rows * row_bytes / MB / target_mb))


def size_files(df: DataFrame, target_mb: float = 128, fraction: float = 0.01) -> DataFrame:
    """Repartition so that written files come near ``target_mb`` (before compression)."""
    rows = df.count()
    sample = fraction if rows * fraction >= 1000 else min(1.0, 1000 / max(rows, 1))
    return df.repartition(target_partitions(rows, bytes_per_row(df, sample), target_mb))


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def written_row_bytes(spark: SparkSession, path: str) -> float | None:
    """Bytes per row that earlier files of an output take, compression included; None where there are no rows yet."""
    if not exists(spark, path):
        return None
    files = spark.read.parquet(path).groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    seen = files.agg(F.sum("file_size"), F.sum("n")).first()
    return seen[0] / seen[1] if seen[1] else None


def write_sized(df: DataFrame, path: str, target_mb: float = 128, like: str | None = None, mode: str = "overwrite", compression: str = "snappy") -> None:
    """Parquet files of about ``target_mb``, from one pass over ``df``.

    A rebalancing exchange with the target as its advisory size joins small partitions and splits large ones by what the exchange
    itself measures, so nothing is counted or sampled first. Where an earlier output ``like`` this one exists, its bytes per row also
    bound the rows of a file, which corrects for the ratio between exchanged and compressed bytes. The advisory size holds for the
    session until the write is done.
    """
    spark = df.sparkSession
    row_bytes = written_row_bytes(spark, like) if like else None
    before = spark.conf.get(ADVISORY, None)
    spark.conf.set(ADVISORY, f"{max(int(target_mb * MB), 1)}b")
    try:
        writer = df.hint("rebalance").write.mode(mode).option("compression", compression)
        if row_bytes:
            writer = writer.option("maxRecordsPerFile", max(1, int(target_mb * MB / row_bytes)))
        writer.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(ADVISORY)
        else:
            spark.conf.set(ADVISORY, before)


def create_partitioned_table(spark: SparkSession, table: str, columns: str, partition: str, location: str) -> DataFrame:
    """External Parquet table over existing partition folders.

    ``columns`` is the DDL of all columns; ``partition`` names one of them.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({partition}) LOCATION '{location}'")
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


# --- staged write --------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


class StagedWriteError(RuntimeError):
    """The staged output did not pass validation; the previous output is untouched."""


def staged_write(
    df: DataFrame,
    final: str,
    staging: str,
    rejected: str,
    validate: Callable[[DataFrame], bool] | None = None,
    partition_by: Sequence[str] = (),
) -> int:
    """Write to ``staging``, read back and check, then publish to ``final``; return the row count.

    Readers see the old or the new output: publication is a rename, and the old output is kept
    beside it until the rename has succeeded. Output that fails the check is moved to
    ``rejected``. On object stores without atomic rename, publish through a table format instead.
    """
    spark = df.sparkSession
    write_parquet(df, staging, partition_by)
    written = spark.read.parquet(staging)
    rows = written.count()
    same_columns = {(f.name, f.dataType.simpleString()) for f in written.schema if f.name not in partition_by} == {(f.name, f.dataType.simpleString()) for f in df.schema if f.name not in partition_by}
    same_columns = same_columns and set(written.columns) == set(df.columns)
    fs, staged = _fs(spark, staging)
    _, target = _fs(spark, final)
    if rows == 0 or not same_columns or (validate is not None and not validate(written)):
        _, away = _fs(spark, f"{rejected.rstrip('/')}/{spark.sparkContext.applicationId}-{_stamp(spark)}")
        fs.mkdirs(away.getParent())
        _rename(fs, staged, away)
        raise StagedWriteError(f"output for {final} failed validation; kept at {away}")
    _, old = _fs(spark, final.rstrip("/") + f".old-{_stamp(spark)}")
    replaced = fs.exists(target)
    if replaced:
        _rename(fs, target, old)  # else the staged folder would be moved into the old output
    else:
        fs.mkdirs(target.getParent())
    if not fs.rename(staged, target):
        if replaced:
            _rename(fs, old, target)
        raise StagedWriteError(f"could not publish {final}")
    if replaced:
        fs.delete(old, True)
    return rows


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise StagedWriteError(f"could not move {source} to {target}")


def _stamp(spark: SparkSession) -> str:
    return str(spark._jvm.java.util.UUID.randomUUID())


# --- step checkpoints ----------------------------------------------------------------------------


def step_path(root: str, job: str, step: str) -> str:
    return f"{root.rstrip('/')}/{job}/{step}"


def save_step(df: DataFrame, root: str, job: str, step: str) -> str:
    """Write a step's result in shared storage and return its path."""
    path = step_path(root, job, step)
    df.write.mode("overwrite").parquet(path)
    return path


def load_step(spark: SparkSession, root: str, job: str, step: str) -> DataFrame | None:
    """A finished step, or None. A step counts as finished only with its commit marker."""
    path = step_path(root, job, step)
    if not exists(spark, f"{path}/_SUCCESS"):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def checkpointed(spark: SparkSession, root: str, job: str, step: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The saved result of a step, computing and saving it only if it is not there yet."""
    done = load_step(spark, root, job, step)
    if done is None:
        save_step(compute(), root, job, step)
        done = load_step(spark, root, job, step)
    return done
