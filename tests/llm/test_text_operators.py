"""Line rules, language ID, the line field and media containers on small fixtures."""

import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import iso_media, language_id, line_crf, line_rules

SCHEMA = "doc_id long, text string, lang string, score string, kept string"
GOOD = "The quick brown fox jumps over the lazy dog near the river bank today.\nAnother sentence follows here, with several other words in it."
NAV = "Home | About | Contact | Login | Register | Help"
EDGE = [None, "", " \n\t\n ", "x", "a b c d e f g h i j", GOOD, GOOD + "\n" + NAV, "\n".join([NAV] * 9), "same words again and again. " * 40, "é" * 5000, GOOD * 200, "W\x0bX\x0cY\x1fZ $$$ ### !! ||"]


def edge_rows(spark):
    rows = [(i, t, "en", "s", "k") for i, t in enumerate(EDGE)] + [(3, EDGE[3], None, None, None), (None, GOOD, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA), rows


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_line_rules(spark):
    df, rows = edge_rows(spark)
    out = line_rules.evaluate(df).collect()
    assert len(out) == len(rows) and "lang" in out[0].asDict()
    for r in out:
        text = next(t for i, t, *_ in rows if i == r["doc_id"])
        want = plain_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["kept"] and r["base_failed"])
    by = {r["doc_id"]: r for r in out}
    assert by[5]["kept"] and by[5]["cleaned_text"] == GOOD
    assert by[6]["kept"] and by[6]["cleaned_text"] == GOOD and by[6]["n_lines_removed"] == 1
    assert not by[7]["kept"] and by[0]["cleaned_text"] == ""
    assert line_rules.evaluate(df.limit(0)).count() == 0


def test_line_rules_random(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "bb", " ", " ", "\n", "\t", "#", "é", "a b a b a "]) for _ in range(rng.randrange(120))) for _ in range(150)]
    out = line_rules.evaluate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in out:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_counts(texts[r["doc_id"]])


def test_language(spark):
    rng = random.Random(2)
    vocab = {"aa": ["bla", "blo", "blim", "foo", "gnar"], "bb": ["üzt", "ürk", "quaz", "zork", "wuz"]}
    make = lambda lang, n: " ".join(rng.choice(vocab[lang]) for _ in range(n))
    rows = [(i, make(lang, 30), lang, "s", "k") for i, lang in enumerate(["aa", "bb"] * 40)] + [(900, "nolabel", None, "s", "k")]
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == ["aa", "bb"]
    tests = [(0, "Bla blo!", "aa"), (1, "ZORK wuz", "bb"), (2, "blimblo", "aa"), (3, "zürk", "bb"), (4, None, "und"), (5, "", "und"), (6, "123 !?", "und"), (7, "bla " * 50_000, "aa")]
    out = language_id.predict(spark.createDataFrame([(i, t, "x", None, None) for i, t, _ in tests], SCHEMA), model).collect()
    for r in out:
        assert r["lang_pred"] == tests[r["doc_id"]][2] and 0 <= r["lang_score"] <= 1
        assert (r["lang_score"] == 0) == (r["lang_pred"] == "und")
    none = language_id.fit(spark.createDataFrame([(1, "x", None, None, None)], SCHEMA))
    assert language_id.predict(spark.createDataFrame([(1, "x", None, None, None)], SCHEMA), none).first()["lang_pred"] == "und"
    assert language_id.predict(spark.createDataFrame([], SCHEMA), model).count() == 0


def brute_marginals(model, scores):
    """P(good) of each line by summing over all label sequences."""
    n, total, good = len(scores), 0.0, np.zeros(len(scores))
    for labels in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(s for s, y in zip(scores, labels, strict=True) if y) + model.start * labels[0] + sum(model.transitions[a, b] for a, b in itertools.pairwise(labels)))
        total += w
        good += w * np.array(labels)
    return good / total


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    model = line_crf.Model(rng.normal(0, 0.3, 1 + 3 * line_crf.N_FEATURES), rng.normal(0, 1, (2, 2)), 0.4, 1.0, 0.0)
    texts = ["One line here.\nTWO!! | THREE\n\nfour $$$ five\nsix seven.", "x", None, "a\nb\nc"]
    good, ink, begins = line_crf.marginals(model, texts)
    x, _, _ = line_crf.line_features(texts)
    ends = [*begins[1:], len(x)]
    for a, b in zip(begins, ends, strict=True):
        assert good[a:b] == pytest.approx(brute_marginals(model, (x[a:b] @ model.weights).tolist()))
    chains = line_crf.Chains([b - a for a, b in zip(begins, ends, strict=True)])
    scores, want = np.zeros(len(x)), np.zeros(len(x))
    for k, i in enumerate(chains.order):
        a, b = begins[i], ends[i]
        scores[chains.rows(k, b - a)], want[chains.rows(k, b - a)] = x[a:b] @ model.weights, good[a:b]
    got, pairs = chains.marginals(scores, model.transitions, model.start, np.ones(len(x)))
    assert got == pytest.approx(want) and pairs.sum() == pytest.approx(len(x) - len(texts))
    assert pairs.sum(axis=0)[1] == pytest.approx(sum(good[a + 1 : b].sum() for a, b in zip(begins, ends, strict=True)))


def test_changes_of_label_are_learnt():
    """Bad documents with good lines: the second round tells their lines apart."""
    rng = np.random.default_rng(1)
    documents = []
    for y in [0, 1] * 60:
        n = 12
        x = np.zeros((n, 1 + 3 * line_crf.N_FEATURES), np.float32)
        bad = np.zeros(n, bool) if y else np.arange(n) >= rng.integers(3, 9)
        x[:, 0], x[:, 1], x[:, 2] = 1, bad + rng.normal(0, 0.2, n), rng.normal(0, 1, n)
        documents.append((x, np.ones(n, np.float32), y, bad))
    model = line_crf.train([d[:3] for d in documents], for_bad=0.0)
    right = [((line_crf._good(model, x @ model.weights, [(0, len(x))]) < 0.5) == bad).mean() for x, _, y, bad in documents if not y]
    assert np.mean(right) > 0.9


def test_score_is_the_weighted_mean_of_marginals(spark):
    rng = np.random.default_rng(5)
    model = line_crf.Model(rng.normal(0, 0.4, 1 + 3 * line_crf.N_FEATURES), rng.normal(0, 1, (2, 2)), -0.3, 1.3, 0.2)
    texts = ["One line here.\nTWO!! | THREE\n\nfour $$$ five\nsix seven.", "x y", "a\n bb\nccc"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "again")]
    for r in line_crf.score(spark.createDataFrame(rows, "doc_id int, text string, quality_score string"), model).collect():
        x, _, _ = line_crf.line_features([r["text"]])
        good = brute_marginals(model, (x @ model.weights).tolist())
        ink = np.array([len(re.sub(r"\s", "", line)) for line in r["text"].split("\n")])
        mean = (good * ink).sum() / ink.sum()
        assert r["quality_score"] == pytest.approx(1 / (1 + math.exp(-(1.3 * math.log(mean / (1 - mean)) + 0.2))), abs=1e-6)


def test_texts_of_many_lines_take_slices(monkeypatch):
    rng = np.random.default_rng(7)
    model = line_crf.Model(rng.normal(0, 0.4, 1 + 3 * line_crf.N_FEATURES), rng.normal(0, 1, (2, 2)), 0.1, 1.0, 0.0)
    texts = ["\n".join("word " * (i % 5) + "." for i in range(77)), None, "\n" * 9, "end"]
    whole = line_crf.marginals(model, texts)
    for size in (1, 8):
        monkeypatch.setattr(line_crf, "SLICE", size)
        for a, b in zip(whole, line_crf.marginals(model, texts), strict=True):
            assert a == pytest.approx(b, abs=1e-5)


def test_quality_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = line_crf.labelled(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = line_crf.fit(rows.filter(~held))
    out = line_crf.score(rows.filter(held), model).collect()
    right = sum((r["quality_score"] >= line_crf.THRESHOLD) == (r["quality"] == 1) for r in out)
    assert right / len(out) > 0.93
    df, edges = edge_rows(spark)
    scored = line_crf.score(df, model).collect()
    assert len(scored) == len(edges) and all(0 <= r["quality_score"] <= 1 for r in scored)
    assert {r["quality_score"] for r in scored if r["doc_id"] in (0, 1, 2)} == {0.0}
    assert line_crf.score(df.limit(0), model).count() == 0


def test_media_round_trip(spark):
    df, rows = edge_rows(spark)
    stored = iso_media.stored_texts(df.select("doc_id", "text"))
    out = iso_media.digests(stored).collect()
    for r in out:
        raw = (next(t for i, t, *_ in rows if i == r["doc_id"]) or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 192)) * 192, b" ")
        assert (r["n_bytes"], r["payload_bytes"]) == (len(raw), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(payload[-16:])
        assert r["media_sha256"] == hashlib.sha256(iso_media.mux(payload)).hexdigest()
    apart = iso_media.digests(iso_media.describe(stored, "media")).drop("media")
    assert sorted(map(str, iso_media.text_digests(df.select("doc_id", "text")).select(*apart.columns).collect())) == sorted(map(str, apart.collect()))
    seen = iso_media.describe(stored, "media").filter("doc_id = 10").first()
    frames = len(EDGE[10].encode()) // 192 + 1
    assert (seen["media_codec"].strip(), seen["media_samples"], seen["media_seconds"]) == ("raw", frames, frames / 25)
    assert len(seen["media_keyframes"]) == -(-frames // 12)
    first, last = seen["media_keyframes"][1]
    assert seen["media"][first : last + 1] == EDGE[10].encode()[12 * 192 : 13 * 192]


def test_broken_media(spark):
    good = iso_media.mux(b"x" * 192 * 40)
    cut = [None, b"", b"abc", good[:40], good[:-200], b"\0" * 64, struct.pack(">I4s", 500, b"moov")]
    out = iso_media.describe(spark.createDataFrame([(i, x, "e") for i, x in enumerate(cut)] + [(99, good, "e")], "i int, m binary, media_error string"), "m").collect()
    for r in out:
        assert (r["media_error"] is None) == (r["i"] == 99) and (r["media_codec"] is None) == (r["i"] != 99)
    rng = random.Random(1)
    for _ in range(300):
        bad = bytearray(good[:700])
        bad[rng.randrange(len(bad))] = rng.randrange(256)
        try:
            iso_media.track(memoryview(bytes(bad)))
        except iso_media.MediaError:
            pass


def test_counting_in_parts_changes_nothing(monkeypatch):
    texts = ["One line here.\nTWO!! | THREE\n\nfour $$$ five", None, "x" * 50 + "\n\n" + "Y" * 33, "é\n"]
    whole = line_crf.line_features(texts)
    for part in (1, 7, 64):
        monkeypatch.setattr(line_crf, "COUNTED", part)
        for a, b in zip(whole, line_crf.line_features(texts), strict=True):
            assert (a == b).all()


def test_filters_stay_above_the_rules(spark):
    long = "\n".join(f"Line {i} of a long text with the same words in it." for i in range(4000))
    kept = line_rules.evaluate(spark.createDataFrame([(1, long), (2, GOOD)], "doc_id long, text string")).filter("kept and not base_failed")
    assert [r["doc_id"] for r in kept.collect()] == [2]
    assert "inline" in kept._jdf.queryExecution().optimizedPlan().toString()
