"""Training of the line field on long documents."""

import random

import pytest

from tidewatch.llm import line_crf


def test_chains_hold_all_lines():
    for n in (1, 2, 63, 64, 65, 120, 121, 400):
        spans = line_crf.cut(n)
        assert sorted({i for a, b in spans for i in range(a, b)}) == list(range(n))
        assert all(b - a <= line_crf.CHAIN_LINES for a, b in spans) and spans[-1][1] == n


def test_what_is_bad_after_many_lines_is_learnt(spark):
    rng = random.Random(2)
    words = "river stone maple garden window letter summer bridge candle market".split()
    line = lambda: " ".join(rng.choices(words, k=9)).capitalize() + "."
    junk = lambda: " | ".join(rng.choices(words, k=6)).upper() + " !!!"
    rows = [(i, "\n".join([line() for _ in range(80)] + [(junk if i % 2 else line)() for _ in range(120)]), 1 - i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = line_crf.fit(df.filter("doc_id < 40"))
    out = {r["doc_id"]: r["quality_score"] for r in line_crf.score(df.filter("doc_id >= 40"), model).collect()}
    assert all((s >= 0.8) == (i % 2 == 0) and (s <= 0.2) == (i % 2 == 1) for i, s in out.items())


def test_one_text_of_very_many_lines_hides_no_label(spark, monkeypatch):
    monkeypatch.setattr(line_crf, "MAX_LINES", 200)
    rows = [(i, ["A calm river ran past the old stone mill.", "| BUY | NOW | !!! | $$$ |"][i % 2], 1 - i % 2) for i in range(200)]
    rows.append((900, "\n".join(["A calm river ran."] * 300_000), 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = line_crf.fit(df)
    assert model.slope > 0
    out = {r["doc_id"] % 2: r["quality_score"] for r in line_crf.score(df.filter("doc_id < 2"), model).collect()}
    assert out[0] > 0.5 > out[1]


def test_documents_within_lines():
    small = [(h, h % 2, 2, 1) for h in range(50)]
    assert line_crf.within_lines(small, 100) == list(range(50))
    giant = [*small, (-1, 1, 10**6, 1)]
    assert {h % 2 for h in line_crf.within_lines(giant, 100)} == {0, 1} and -1 not in line_crf.within_lines(giant, 100)
    assert line_crf.within_lines([(1, 0, 60, 1), (2, 1, 90, 1)], 100) == [1, 2]
    with pytest.raises(ValueError, match="more lines"):
        line_crf.within_lines([(1, 0, 60, 1), (2, 1, 900, 1)], 100)
