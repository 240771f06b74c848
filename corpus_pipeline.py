"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept and
returns the columns of ``documents``; the last returns the packing. The stages share nothing
but their input.

Cases, for every stage: columns besides those of ``documents`` are dropped; an empty table gives an
empty result; texts of any length are used whole. A null or letterless text has no language and goes
in the first stage. Without labels of both kinds every text has quality 0.5 and stays. Line dedup
keeps all rows (rows of one id and text are one document) and may leave texts empty; near-dedup
keeps the smallest id of each group, a row without an id only where its group has no row with
one, and one of the rows of the same id and text. Packing keeps all rows; a null source or cluster
conflicts with none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import best_fit, language_id, line_crf, near_copies, simhash, winnow
from tidewatch.llm.common import stored, table
from tidewatch.llm.queries import packing_items

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose most likely language is less likely than this is rejected.
MIN_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no recognised language."""
    found = language_id.predict(docs, language_id.fit(docs))
    return found.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the field over their lines calls bad."""
    model = line_crf.fit(line_crf.labelled(docs, table(spark, sf_dir, "labels")))
    return line_crf.score(docs, model).filter(F.col("quality_score") >= line_crf.THRESHOLD).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later repeats of runs of words."""
    cleaned = winnow.remove_repeats(docs)
    return cleaned.withColumn("n_chars", F.when(F.col("n_words_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five-word Jaccard similarity 0.8 or more): fingerprints find them by byte positions, then an index on shingles those they miss."""
    return simhash.keep_one(docs, groups=near_copies.members).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into training sequences."""
    return best_fit.pack_documents(packing_items(docs), "doc_id", "n_tokens", "source", "cluster")


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("best_fit_packing", pack),
]

#: Trained models and greedy packing aren't SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
