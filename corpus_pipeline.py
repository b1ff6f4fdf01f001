"""The corpus pipeline: quality rules, near-duplicate removal, passage removal, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import bpe, decontaminate, jaccard, rules, substring
from tallyforge.llm.queries import PATTERN, RANKS
from tallyforge.llm.tables import read_table, save

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return rules.kept(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return jaccard.first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; where passages go, the words left are joined by one space and counted anew."""
    cut = substring.cut_passages(docs)
    changed = F.col("_n_removed") > 0
    kept = {"text": F.when(changed, F.col("_kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kept["n_chars"] = F.when(changed, F.length("_kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumns(kept).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, packed, with digests of the ids and of the bytes they decode to."""
    encoded = bpe.encode(docs.select("doc_id", "text"), RANKS, PATTERN, decoded=True)
    return encoded.select("doc_id", "n_tokens", "tokens", F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", encoding),
]

#: The learned rules and the token ids cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
