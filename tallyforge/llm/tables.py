"""Tables between the steps of an operator, joins of texts with small tables, and connected components."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.session import ensure_checkpoint_dir

#: A table is broadcast only if its rows, counted first, take no more than this.
BROADCAST_BYTES = 16_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``; from here on Python workers find this package where it lies, if they see that folder."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, (root, env.get("PYTHONPATH"))))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: lineage ends here."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_texts(texts: DataFrame, small: DataFrame, on: str, how: str = "inner", row_bytes: str = "40") -> DataFrame:
    """Join wide text rows with a saved narrow table.

    Up to BROADCAST_BYTES (summed over its rows first) the narrow side is broadcast and texts stay where
    they are; beyond, Spark shuffles both sides by the key. The result is the same.
    """
    if (small.agg(F.sum(F.expr(row_bytes))).first()[0] or 0) <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return texts.join(small, on, how)


def unique_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) with ids that are not null; of several rows with one id the smallest text counts."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    return docs


def plain_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether every row has an id of its own."""
    ids = docs.groupBy(F.col(id_col).cast("long").alias("id")).count()
    return not ids.where("count > 1 OR id IS NULL").limit(1).count()


def row_keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """For ids that are null or repeated: ``docs`` with _row, a number of each distinct (id, text), and (doc_id, text) with _row for doc_id.

    So every text is judged by itself, whatever its id; rows with the same id and text are one. Null texts count as empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.struct(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2"))
    rows = docs.withColumn("_key", key)
    numbers = save(rows.select("_key").distinct().withColumn("_row", F.monotonically_increasing_id()))
    rows = save(rows.join(numbers, "_key").drop("_key"))
    return rows, save(rows.select(F.col("_row").alias("doc_id"), F.col(text_col).alias("text")).dropDuplicates(["doc_id"]))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (node, component) of every node that is not its smallest itself.

    Alternating large-star and small-star steps; each step is two shuffles over the links, no node's
    neighbours are ever collected, and the links end as stars around the smallest node.
    """
    edges = save(links.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.toDF("node", "component")
        before = state
        edges = save(_small_star(_large_star(edges)))
