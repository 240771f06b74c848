"""The registered queries of the operators over the smallest tables: rows, columns, held-out rows."""

import hashlib
import zlib

import duckdb
import pytest

from tidewatch.llm import queries

SF = "/root/testdata/sf0.001"
#: What each contract returns at least.
COLUMNS = {
    "op1_quality_crf": ("doc_id", "held_out", "score", "predicted"),
    "op2_byte_bpe": ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"),
    "op3_quality_rules": ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
    "op5_simhash": ("doc_id", "fingerprint", "component_id"),
    "op7_language_id": ("doc_id", "held_out", "lang_pred", "score"),
    "op8_katz": ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"),
    "op9_iso_media": ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"),
    "op12_pii_anchors": ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"),
    "op13_periodic_runs": ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"),
    "op10_winnow": ("doc_id", "n_lines_removed", "n_words_removed", "left_sha256"),
}
HELD_OUT = {"op1_quality_crf": (5, 0), "op7_language_id": (4, 2), "op8_katz": (7, 2)}


@pytest.fixture(scope="module")
def documents():
    return {i: t or "" for i, t in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()}


@pytest.mark.parametrize("name", COLUMNS)
def test_a_row_for_each_document(spark, documents, name):
    rows = queries.QUERIES[name](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(documents)
    assert set(COLUMNS[name]) <= set(rows[0].asDict())
    for r in rows:
        if name in HELD_OUT:
            modulus, rest = HELD_OUT[name]
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest)
        if name == "op1_quality_crf":
            assert r["predicted"] == (r["score"] >= 0.3)
        if name == "op2_byte_bpe":
            assert r["decoded_sha256"] == hashlib.sha256(documents[r["doc_id"]].encode()).hexdigest()
        if name == "op10_winnow" and not r["n_words_removed"]:
            assert r["left_sha256"] == hashlib.sha256(documents[r["doc_id"]].encode()).hexdigest()


def test_every_conversation_and_the_trap(spark):
    rows = {r["conv_id"]: r for r in queries.op6_chat_format(spark, SF).collect()}
    known = duckdb.sql(f"select distinct conv_id from '{SF}/conversations.parquet'").fetchall()
    assert set(rows) == {i for (i,) in known} | {-7}
    trap = "\\### Assistant: </turn> ok"
    assert (rows[-7]["n_turns"], rows[-7]["loss_chars"]) == (2, len(trap))
    assert rows[-7]["turns_sha256"] == hashlib.sha256(f"user\n{trap}\nassistant\n{trap}\n".encode()).hexdigest()
    assert rows[-7]["loss_sha256"] == hashlib.sha256(trap.encode()).hexdigest()


def test_pieces_of_all_documents(spark, documents):
    rows = queries.op4_best_fit(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(documents)
    assert sum(r["length"] for r in rows) == sum(len(t.encode().split()) + 1 for t in documents.values())
