"""Byte-level BPE against the tiktoken library."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tidewatch.llm import byte_bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, part string, ids long"
TEXTS = [
    None, "", "a", "don't we'll  I've\n\n x", "x" * 700, "ab" * 900 + "!" * 400, " " * 500 + "y" + "\n" * 300 + "z",
    "naïve café 東京 🙂🙂 " * 60, "Words, and more words; 12345 678. " * 80, "\t\r\n 'S 's" * 50, "   é" * 40, "日本語" * 300,
]


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (128, 100), (byte_bpe.CHUNK, byte_bpe.OVERLAP)])
def test_same_ids_as_the_library(spark, reference, chunk, overlap):
    rows = [(i, t, "p", 1) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "p", 1), (None, TEXTS[5], None, None), (None, TEXTS[5], None, None)]
    got = byte_bpe.digests(spark.createDataFrame(rows, SCHEMA), RANKS, P.PATTERN, chunk=chunk, overlap=overlap).collect()
    want = []
    for i, t, *_ in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert byte_bpe.digests(spark.createDataFrame([], SCHEMA), RANKS, P.PATTERN).count() == 0


def test_long_pretoken(reference):
    ranks = byte_bpe.read_ranks(RANKS)
    for text in ("a" * 5000, "banana" * 300, "=-" * 700):
        assert byte_bpe.merge(text.encode(), ranks) == reference.encode_ordinary(text)
