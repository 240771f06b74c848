"""Line dedup against brute force over all runs of words."""

import random
import re

import numpy as np
import pytest

from tidewatch.llm import winnow

SCHEMA = "doc_id long, text string, fp string, n_lines string"


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "x", None) for i, t in zip(ids or range(len(texts)), texts, strict=True)], SCHEMA)


def plain_dedup(texts, min_words):
    """Every word in a run of ``min_words`` words that begins earlier too, by document and position, is deleted."""
    seen, out = set(), []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = np.zeros(len(words), bool)
        for a in range(len(words) - min_words + 1):
            key = tuple(words[a : a + min_words])
            if key in seen:
                gone[a : a + min_words] = True
            seen.add(key)
        out.append(winnow.without(text, gone)[0] if gone.any() else text or "")
    return out


@pytest.mark.parametrize("min_words", [9, 50])
def test_line_dedup(spark, min_words):
    rng = random.Random(min_words)
    vocabulary = [f"t{i}" + rng.choice(["", "", "", "."]) for i in range(40_000)]
    prose = lambda n: [rng.choice(vocabulary) + rng.choice([" "] * 9 + ["\n"]) for _ in range(n)]
    passages = [prose(n) for n in (min_words, min_words + 1, 2 * min_words, 5 * min_words, 20 * min_words)]
    texts = []
    for i in range(60):
        parts = [prose(rng.randrange(3 * min_words)) for _ in range(3)]
        for _ in range(i % 3):
            parts.insert(rng.randrange(4), rng.choice(passages))
        texts.append("".join(w for p in parts for w in p))
    texts += [None, "", texts[0], "\n\n", "".join(passages[3]) + "own words\n" + "".join(passages[3])]
    out = winnow.remove_repeats(frame(spark, texts), min_words=min_words).collect()
    got = {r["doc_id"]: r["text"] or "" for r in out}
    assert [got[i] for i in range(len(texts))] == plain_dedup(texts, min_words)
    assert len(out) == len(texts) and sum(r["n_words_removed"] for r in out) > 0


def test_fingerprints_are_guaranteed():
    rng = random.Random(3)
    words = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    for n in range(50, 80):
        shared = words(n)
        texts = [f"{words(rng.randrange(90))} {shared} {words(rng.randrange(90))}" for _ in range(2)]
        seeds = [set(winnow.fingerprints(winnow.Words.of([t]), 50)[0].tolist()) for t in texts]
        assert seeds[0] & seeds[1]
        both = winnow.fingerprints(winnow.Words.of([None, texts[0], "x y", texts[1]]), 50)[0].tolist()
        assert set(both) == seeds[0] | seeds[1]


def test_words_are_those_of_the_pattern(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab.…é \n\t\r\x0b\x1f") for _ in range(rng.randrange(60))) for _ in range(40)] + [None, "x" * 300]
    plain = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    for size in (7, 1 << 21):
        monkeypatch.setattr(winnow, "SLICE", size)
        words = winnow.Words.of(texts)
        assert np.diff(words.first).tolist() == [len(w) for w in plain]
        known = {}
        for i, w in enumerate(plain):
            for x, h in zip(w, words.hashes[words.text(i)].tolist(), strict=True):
                assert known.setdefault(x, h) == h
        assert len(set(known.values())) == len(known)


def test_passages_inside_lines(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(f"w{rng.randrange(9000)}" for _ in range(n))
    passage, short = words(51), words(49)
    texts = [f"{words(30)} {passage} {words(12)}", f"{words(70)}\n{words(9)} {passage}  {words(40)}", f"{short} {words(80)}", f"{words(80)} {short}"]
    out = {r["doc_id"]: r for r in winnow.remove_repeats(frame(spark, texts)).collect()}
    assert out[0]["text"] == texts[0] and out[2]["text"] == texts[2] and out[3]["text"] == texts[3]
    assert out[1]["text"] == texts[1].replace(passage + "  ", "") and (out[1]["n_words_removed"], out[1]["n_lines_removed"], out[1]["n_lines"]) == (51, 0, 2)
    assert out[1]["fp"] == "x"


def test_line_dedup_edges(spark):
    long = " ".join(["word"] * 60)
    endless = " ".join(["a", "b"] * 30_000)
    out = winnow.remove_repeats(frame(spark, [long, long, "short line", "short line", long + "\nown words", long, endless], [None, 2, 3, 4, 5, 2, 9])).collect()
    by = sorted(((r["doc_id"], r["text"], r["n_lines_removed"]) for r in out), key=str)
    assert [x for x in by if x[0] != 9] == sorted([(None, long, 0), (2, "", 1), (2, "", 1), (3, "short line", 0), (4, "short line", 0), (5, "own words", 1)], key=str)
    assert next(len(x[1].split()) for x in by if x[0] == 9) < 100
    assert winnow.remove_repeats(frame(spark, [])).count() == 0
