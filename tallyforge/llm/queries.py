"""One query per operator over its whole table, and SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import bpe, chat, classifier, decontaminate, jaccard, licenses, phrases, repair, rules, sketches, substring, tokencount, urls
from tallyforge.llm.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(read_table(spark, sf_dir, "conversations"))


def made_edits() -> F.Column:
    """Three edits of a document, places and texts from its id: a replacement, an insertion and a deletion."""
    puts = F.array(*map(F.lit, ("don't", " and then ", "\n\n  ", "1234", "'re", "é", "   ", "x")))

    def one(k: int, cut: F.Column, put: F.Column) -> F.Column:
        at = F.pmod(F.xxhash64("doc_id", F.lit(k)), F.length(F.coalesce("text", F.lit(""))) + 1)
        return F.struct(at.cast("long").alias("at"), cut.cast("long").alias("cut"), put.alias("put"))

    size = F.pmod(F.xxhash64("doc_id"), F.lit(9))
    put = F.get(puts, F.pmod(F.xxhash64("doc_id", F.lit("put")), F.lit(8)).cast("int"))
    return F.array(one(1, size, put), one(2, F.lit(0), put), one(3, size * 3, F.lit("")))


def op2_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", made_edits())
    after = tokencount.apply_edits(rows, RANKS, PATTERN)
    return after.select("doc_id", "n_before", F.col("n_tokens").alias("n_after"), "n_recounted", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), RANKS, PATTERN, decoded=True)
    return encoded.select("doc_id", "n_tokens", F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules.judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(read_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents")).drop("blocks")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.cut_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_duplicates(read_table(spark, sf_dir, "documents"))


def damaged(chats: DataFrame) -> DataFrame:
    """Conversations with faults that a checksum of ``conv_id:turn`` chooses: lost, emptied, open-ended, repeated or renamed rows."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fate = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = chats.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("times"),
    )
    return rows.withColumn("time", F.explode(F.expr("filter(array(1, 2), x -> x <= times)"))).drop("times", "time")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.report(damaged(chats)).withColumnRenamed("conv_id", "c")
    rows = chats.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_edit_aware_counts,
        op3_byte_bpe,
        op4_quality_rules,
        op5_url_filters,
        op6_license_scans,
        op7_ngram_jaccard_join,
        op8_substring_dedup,
        op9_quality_classifier,
        op10_decontamination,
        op11_phrase_collocations,
        op12_minhash_near_dedup,
        op13_conversation_repair,
    )
}

ORACLES: dict[str, str] = {
    "op1_chat_formatting": " ".join(chat.ORACLE.split()),
    "op6_license_scans": licenses.oracle(),
    "op11_phrase_collocations": phrases.oracle(),
}
