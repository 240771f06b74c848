"""The audit of sources against plain dictionaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewatch.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n string, part string"


def plain(rows, min_docs, top=50):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, c in docs[lang].items() if c >= min_docs]
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            d = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // d for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, r + 1) for r, (item, value) in enumerate(ranked)]
    return sorted(out)


def corpus(n=400):
    rng = random.Random(11)
    words = {x: [f"{x}{chr(97 + i % 26)}{chr(233 + i % 9)}{'ab' * (i % 3)}" for i in range(150)] for x in ("en", "fr", None)}
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "fr", None])
        source = rng.choice(["s0"] * 5 + ["s1", "s2", "é", None, ""])
        text = " ".join(rng.choices(words[lang], k=rng.randrange(60)))
        rows.append((text.title() + rng.choice(["", "\x00x_y", " 12[Z]"]), lang, source))
    rows += [(None, "en", "quiet"), ("", "xx", "a"), ("rare words", "xx", "b"), ("alone", "yy", "only")] + [rows[0]] * 40
    return rows


@pytest.mark.parametrize(("min_docs", "shard", "held"), [(30, 1 << 18, 1_000_000), (3, 50, 40), (1, 7, 1_000_000)])
def test_same_as_plain(spark, monkeypatch, min_docs, shard, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rows = corpus()
    df = spark.createDataFrame([(i, *r, "x", "y", "z") for i, r in enumerate(rows)], SCHEMA)
    found = divergence.audit(df, min_docs=min_docs, shard=shard)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, min_docs)


def test_ties_and_empty(spark):
    rows = [("b a é", "en", "s1"), ("b a é", "en", "s2"), ("c", "en", "s3"), ("c", "en", "s4")]
    df = spark.createDataFrame([(i, *r, "x", "y", "z") for i, r in enumerate(rows)], SCHEMA)
    assert sorted(tuple(r) for r in divergence.audit(df, min_docs=1).collect()) == plain(rows, 1)
    assert divergence.audit(df.limit(0)).count() == 0


def test_long_texts_are_cut_at_separators(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "SLICE", 64)
    texts = ["Ab cd é" * 300, "", "x" * 500, " ".join(f"w{chr(97 + i % 20)}" for i in range(150_000))]
    batch = pa.record_batch({"lang": ["en"] * 4, "source": ["s"] * 4, "text": texts})
    got = {r["term"]: (r["n"], r["docs"]) for r in divergence._counted(batch).to_pylist()}
    want = Counter(t.lower() for x in texts for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", x))
    assert {t: n for t, (n, _) in got.items() if t} == want and got[None] == (0, 0)


def test_shares_are_exact():
    big = [0, 1, 9_300_000_000, 200_000_000_000_000, 4 * 10**17]
    got = divergence.shares(np.array(big), np.array([10**10, 7, 3 * 10**10, 2 * 10**14, 5 * 10**17]), 3)
    assert got.tolist() == [1 + 10**9 * (c + 5) // (t + 15) for c, t in zip(big, [10**10, 7, 3 * 10**10, 2 * 10**14, 5 * 10**17], strict=True)]
