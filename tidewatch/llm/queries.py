"""The registered queries of this subpackage; SQL in ``oracles``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import best_fit, byte_bpe, chat_format, divergence, iso_media, katz, katz_tables, language_id, line_crf, line_rules, periodic_runs, pii_anchors, simhash, winnow
from tidewatch.llm.common import remainder, table
from tidewatch.llm.oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def packing_items(documents: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens (words and an end) and cluster (hash of the text without case and space) of documents.

    A null text is the empty one (one token, in the cluster of blank texts); texts of any length are counted whole; rows keep null ids and
    sources; repeated rows stay repeated; an empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    cluster = F.xxhash64(F.regexp_replace(F.lower(text), line_rules.SPACE, " "))
    return documents.select("doc_id", "source", (F.regexp_count(text, F.lit(line_rules.WORD)) + 1).cast("long").alias("n_tokens"), cluster.alias("cluster"))


def op1_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; the field is fitted on documents that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = line_crf.fit(line_crf.labelled(docs.filter(~held_out), table(spark, sf_dir, "labels")))
    scored = line_crf.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= line_crf.THRESHOLD).cast("int").alias("predicted"), "n_good_lines", "n_bad_lines")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document, with a digest of the cleaned text."""
    judged = line_rules.evaluate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "kept_chars", F.sha2("cleaned_text", 256).alias("cleaned_sha256"),
    )


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that imitates the template's control strings, formatted and read back.

    The conversations become JSON records of mixed layouts first; the hash of each record's field paths tells how it is read.
    """
    trap = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), trap.alias("text"))
    turns = chat_format.turn_rows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))
    records = chat_format.as_records(chat_format.gathered(turns))
    return chat_format.digest(chat_format.read_back(chat_format.format_conversations(chat_format.canonical_records(records))))


def op4_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in bins of ``CAPACITY`` tokens."""
    return best_fit.pack_documents(packing_items(table(spark, sf_dir, "documents")), "doc_id", "n_tokens", "source", "cluster")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the model is fitted on documents that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the bigram model of those that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.score(docs, remainder(F.col("doc_id"), 7) == 2)


def katz_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the stored trigram tables of those that aren't held out, read back and joined by token."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = katz_tables.fit(docs.filter(remainder(F.col("doc_id"), 7) != 2), order=3)
    return katz_tables.score(docs, model)


def op9_iso_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a container and read back by its sample tables."""
    found = iso_media.text_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("n_keyframes", F.size("media_keyframes").cast("long")).drop("media_keyframes", "media_tracks", "media_error")


def op10_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the repeated runs, as a digest of what is left."""
    cleaned = winnow.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_lines_removed", "n_words_removed", F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("left_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms that stand out in each."""
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii_anchors.digests(table(spark, sf_dir, "documents"))


def planted_runs(documents: DataFrame) -> DataFrame:
    """Runs of documents, one in ten of which is made periodic."""
    docs = documents.select("doc_id", periodic_runs.planted(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic_runs.digests(docs)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, one in ten of which is made periodic."""
    return planted_runs(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_crf": op1_quality_crf,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_rules": op3_quality_rules,
    "op4_best_fit": op4_best_fit,
    "op5_simhash": op5_simhash,
    "op6_chat_format": op6_chat_format,
    "op7_language_id": op7_language_id,
    "op8_katz": op8_katz,
    "katz_trigrams": katz_trigrams,
    "op9_iso_media": op9_iso_media,
    "op10_winnow": op10_winnow,
    "op11_divergence": op11_divergence,
    "op12_pii_anchors": op12_pii_anchors,
    "op13_periodic_runs": op13_periodic_runs,
}
