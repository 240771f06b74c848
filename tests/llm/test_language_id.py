"""Language ID against plain dictionaries, and its edges."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import language_id
from tidewatch.llm.common import drawn, threshold

SCHEMA = "doc_id long, text string, lang string, lang_pred string"
SYLLABLES = {"aa": "bla blo gim foo nar tel", "bb": "üzt ürk qua zork wuz pel", "cc": "ska ente oum rai viel"}


def corpus(seed, n=90):
    rng = random.Random(seed)
    word = lambda lang: "".join(rng.choices(SYLLABLES[lang].split(), k=rng.randrange(1, 4)))
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, " ".join(word(lang) for _ in range(rng.randrange(1, 60))).capitalize() + rng.choice(["", ".", " 12 ½"]), lang, None))
    return rows


def plain_model(texts):
    """Counts of words and n-grams by language."""
    counts = {}
    for lang, text in texts:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            for part in re.sub(r"[½]", " ", word).split():
                marked = f"<{part}>"
                counts.setdefault((lang, 0), Counter())[part] += 1
                for g in range(1, 5):
                    counts.setdefault((lang, g), Counter()).update(marked[i : i + g] for i in range(len(marked) - g + 1))
    return counts


def plain_sums(counts, text):
    langs = sorted({lang for lang, _ in counts})
    log = lambda lang, g, k: math.log(max(counts[lang, g][k], 0.5)) - math.log(sum(counts[lang, g].values()) + 1)
    sums, covers, n = dict.fromkeys(langs, 0.0), dict.fromkeys(langs, 0.0), 0
    for word in re.findall(r"[^\W\d_½]+", text.lower()):
        n += 1
        marked = f"<{word}>"
        cut = lambda g: [marked[i : i + g] for i in range(len(marked) - g + 1)]
        if any(word in counts[lang, 0] for lang in langs):
            scores = {lang: log(lang, 0, word) for lang in langs}
            cover = {lang: float(word in counts[lang, 0]) for lang in langs}
        else:
            scores = dict.fromkeys(langs, language_id.NOWHERE)
            for g in range(4, 0, -1):
                hits = [k for k in cut(g) if any(k in counts[lang, g] for lang in langs)]
                if hits:
                    scores = {lang: sum(log(lang, g, k) for k in hits) / len(hits) for lang in langs}
                    break
            top = min(4, len(marked))
            cover = {lang: sum(k in counts[lang, top] for k in cut(top)) / len(cut(top)) for lang in langs}
        for lang in langs:
            sums[lang] += scores[lang]
            covers[lang] += cover[lang]
    return langs, sums, covers, n


def test_same_as_plain(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, SCHEMA)
    model = language_id.fit(df)
    texts = language_id.sample(df, "text", "lang", "doc_id", language_id.PER_LANGUAGE).collect()
    assert len(texts) == len(rows)
    counts = plain_model([(r["lang"], r["text"]) for r in texts if not r["apart"]])
    new = corpus(2, 40) + [(900, "Blablo zürk entexx", None, None), (901, "日本 語", None, None), (902, "x" * 9, None, None)]
    for r in language_id.predict(spark.createDataFrame(new, SCHEMA), model).collect():
        langs, sums, covers, n = plain_sums(counts, r["text"])
        best = max(langs, key=lambda x: sums[x])
        assert r["lang_pred"] == best
        mean, words, docs = model.usual[langs.index(best)]
        z = (covers[best] / n - mean) / math.sqrt(words / n + docs + language_id.LEAST**2)
        ahead = sum(math.exp((sums[x] - sums[best]) / n * min(n, language_id.EVIDENCE)) for x in langs)
        assert r["lang_score"] == pytest.approx(1 / ahead / (1 + math.exp(-(z + language_id.FAR))), rel=1e-3, abs=1e-9)


def test_no_letters_and_unlearned_language(spark):
    model = language_id.fit(spark.createDataFrame(corpus(3, 200), SCHEMA))
    rng = random.Random(4)
    other = " ".join("".join(rng.choices(["kyy", "mää", "hju", "öös"], k=3)) for _ in range(40))
    tests = [(i, t, None, "clash") for i, t in enumerate(["½ ② 12", "Ⅳ", "_ 7", None, "", other, other[:30]])] + [(100 + i, t, lang, None) for i, t, lang, _ in corpus(5)] * 2
    out = language_id.predict(spark.createDataFrame(tests, SCHEMA), model).collect()
    assert len(out) == len(tests)
    for r in out:
        if r["doc_id"] < 5:
            assert (r["lang_pred"], r["lang_score"]) == ("und", 0.0)
        elif r["doc_id"] < 100:
            assert r["lang_score"] < 0.01
        elif len(r["text"].split()) > 5:
            assert r["lang_pred"] == r["lang"] and r["lang_score"] > 0.9


def test_every_language_is_learnt(spark):
    rows = [(i, f"word{i % 80} other{i % 80}", f"l{i % 80:02}", None) for i in range(400)] + [(1000 + i, "hot words", "l00", None) for i in range(3000)]
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA), per_language=100)
    assert model.languages == [f"l{i:02}" for i in range(80)]
    drawn_texts = language_id.sample(spark.createDataFrame(rows, SCHEMA), "text", "lang", "doc_id", 100).groupBy("lang").count().collect()
    assert {r["count"] for r in drawn_texts if r["lang"] != "l00"} == {5} and next(r["count"] for r in drawn_texts if r["lang"] == "l00") == 100


def test_limits_share_the_last_level(spark):
    counts = spark.createDataFrame([("a", 0, f"w{i}", 1 if i > 10 else 9) for i in range(4000)], "lang string, size int, k string, n long")
    kept = language_id.most_frequent(counts, 1011, None).collect()
    assert sum(r["n"] == 9 for r in kept) == 11 and 800 < len(kept) < 1200
    assert language_id.most_frequent(counts, None, None).count() == 4000


def test_samples_are_bounded_and_never_empty(spark):
    assert threshold(8_000 / 1e11) > 1 << 30 and threshold(2.0) == (1 << 63) - 1
    df = spark.range(20_000).select(F.col("id"), F.lit("x").alias("text"))
    assert drawn(df, ["id", "text"], 500).count() == 500
    equal = spark.range(20_000).select(F.lit(None).cast("long").alias("id"), F.lit("x").alias("text"))
    assert drawn(equal, ["id", "text"], 500).count() == 500
    assert drawn(df, ["id"], 30_000).count() == 20_000
    mixed = df.select("id", "text", F.when(F.col("id") < 19_000, "hot").when(F.col("id") < 19_990, "mid").otherwise("few").alias("g"))
    mixed = mixed.unionByName(equal.withColumn("g", F.lit("copies"))).withColumn("text", F.when(F.col("id") % 2 == 0, "even").otherwise(F.col("text")))
    drawn_rows = drawn(mixed, ["id", "text"], 100, "g").groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids")).collect()
    assert {r["g"]: (r["n"], r["ids"]) for r in drawn_rows} == {"hot": (100, 100), "mid": (100, 100), "few": (10, 10), "copies": (100, 0)}
    assert drawn(mixed.limit(0), ["id"], 5).count() == 0


def test_a_language_of_copies_is_learnt(spark):
    rows = [(None, "ghi jkl mno", "cc", None)] * 30_000 + corpus(6, 200)
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert "cc" in model.languages
    found = language_id.predict(spark.createDataFrame([(1, "ghi jkl mno", None, None)], SCHEMA), model).first()
    assert found["lang_pred"] == "cc"
