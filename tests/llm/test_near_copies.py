"""The pipeline's near-duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tidewatch.llm import near_copies


def plain_groups(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both and both / len(sets[i] | sets[j]) >= 0.8 - 1e-12:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    tail = " ".join(rng.choices(words, k=30))
    texts = [None, "", " \n", "a b", "A  b", "a b c", "one two three four five", "one two three four five six"]
    for size in (6, 20, 60, 200):
        for _ in range(6):
            text = rng.choices(words, k=size)
            texts.append(" ".join(text))
            for edits in (0, 1, 2, 4, 6, 8):
                copy = list(text)
                for _ in range(edits * size // 200 + (edits > 0)):
                    copy[rng.randrange(len(copy))] = rng.choice(words)
                texts += [" ".join(copy), " ".join(copy) + " " + tail]
    return texts


@pytest.mark.parametrize("frequent", [2, 10**9])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, frequent):
    monkeypatch.setattr(near_copies, "FREQUENT", frequent)
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["component_id"] for r in near_copies.near_duplicates(df).orderBy("doc_id").collect()] == plain_groups(texts)


def test_stage_keeps_one_of_all_pairs_groups(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.dedup_documents(spark, docs, "").collect())
    assert kept == sorted(set(plain_groups(texts)))
    assert near_copies.near_duplicates(docs.limit(0)).count() == 0


def test_lists_that_join_many_components(spark, monkeypatch):
    """A phrase in every document: its lists are paired in cells, or its shingles go last, with the same groups."""
    rng = random.Random(8)
    phrase = " ".join(f"p{i}" for i in range(14))
    texts = []
    for _ in range(60):
        words = [f"v{rng.randrange(5000)}" for _ in range(rng.randrange(16, 60))]
        texts += [" ".join(words[:5]) + f" {phrase} " + " ".join(words[5:]), " ".join(words[:5]) + f" {phrase} " + " ".join(words[5:-1])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(near_copies, "frequent", lambda *_: np.zeros(0, np.int64))
    monkeypatch.setattr(near_copies, "CELL", 7)
    monkeypatch.setattr(near_copies, "BY_SIZE", 20)
    want = plain_groups(texts)
    anew = []
    real = near_copies._again
    monkeypatch.setattr(near_copies, "_again", lambda *a: anew.append(1) or real(*a))
    for long, rounds in ((1000, 3), (10, 3), (10, 0)):
        monkeypatch.setattr(near_copies, "JOINED", long)
        monkeypatch.setattr(near_copies, "ROUNDS", rounds)
        anew.clear()
        assert [r["component_id"] for r in near_copies.near_duplicates(df).orderBy("doc_id").collect()] == want
        assert bool(anew) == (long == 10 and rounds == 3)


def test_sketches_bound_what_two_sets_do_not_share(spark):
    rng = np.random.default_rng(1)
    drawn = lambda n: np.unique(rng.integers(-(1 << 62), 1 << 62, n))
    assert [len(near_copies.sketch(drawn(n))) for n in (0, 1, 63, 64, 65, 100, 129, 1000)] == [1, 1, 1, 1, 2, 2, 4, 16]
    a = rng.permutation(drawn(120))
    b = np.concatenate([a[:110], drawn(30)])
    pair = spark.createDataFrame([(1, 2)], "a long, b long")
    heads = lambda x, y: spark.createDataFrame([(1, len(x), near_copies.sketch(x).tolist()), (2, len(y), near_copies.sketch(y).tolist())], "node long, n int, sketch array<bigint>")
    assert near_copies._likely(pair, heads(a, a[:110])).count() == 1
    assert near_copies._likely(pair, heads(a[:60], np.concatenate([a[:58], drawn(12)]))).count() == 1
    assert near_copies._likely(pair, heads(a[:100], b)).count() == 0
    assert near_copies._likely(pair, heads(a, drawn(120))).count() == 0


def test_fingerprints_come_first(spark, monkeypatch):
    """The stage joins what fingerprints find, verified; the index on shingles then verifies only what is left, with the groups of all pairs."""
    texts = corpus()
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    made = {}
    real = near_copies.stored

    def kept_too(x, what):
        found = real(x, what)
        made.setdefault(what, found)
        return found

    monkeypatch.setattr(near_copies, "stored", kept_too)
    kept = sorted(r["doc_id"] for r in corpus_pipeline.dedup_documents(spark, df, "").collect())
    assert kept == sorted(set(plain_groups(texts)))
    known, root = made["copies-known"], {r["node"]: r["root"] for r in made["copies-joined"].collect()}
    assert known.count() > 10
    later = made["copies-stars"].collect()
    assert later and all(root.get(r["a"], r["a"]) != root.get(r["b"], r["b"]) for r in later)


def test_very_long_texts(spark):
    words = [f"w{i % 50_021}" for i in range(120_000)]
    texts = [" ".join(words), " ".join(words[:-900]), " ".join(words[:60_000]), None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["component_id"] for r in near_copies.near_duplicates(df).orderBy("doc_id").collect()] == plain_groups(texts)
