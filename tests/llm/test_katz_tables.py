"""Stored Katz tables of order 3 against plain dictionaries, and of order 2 against the block form."""

import math
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import katz, katz_tables, queries

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, held boolean, score string"
ROWS = [(i, " ".join(f"W{(i * j * 7) % (5 + j % 11)}" for j in range(1, 3 + i % 29)), i % 7 == 2, "x") for i in range(120)]
ROWS += [(900 + i, t, False, None) for i, t in enumerate([None, "", "A b\tB a\na b c", "long " * 300, "once", "once"])] + [(None, "w1 w2 zzz", True, None), (None, "w1 w2 zzz", True, None), (None, "w1 zzz w2", True, None)]


def split(text):
    # Only A-Z become lower case, so that all texts are cut alike whatever their alphabet.
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["</s>\n"]


def plain(rows, order):
    """Katz by recursion over dictionaries of counts."""
    grams = [Counter() for _ in range(order + 1)]
    padded = lambda t: ["<s>\n"] * (order - 1) + split(t)
    for _, text, held, _ in rows:
        if not held:
            w = padded(text)
            for i in range(order - 1, len(w)):
                for k in range(1, order + 1):
                    grams[k][tuple(w[i - k + 1 : i + 1])] += 1
    d = [None] + [katz.discounts([sum(v == r for v in grams[k].values()) for r in range(1, katz.K + 2)]) for k in range(1, order + 1)]
    disc = lambda k, n: d[k][n] * n if n <= katz.K else n
    follow = [defaultdict(dict) for _ in range(order + 1)]
    for k in range(1, order + 1):
        for g, n in grams[k].items():
            follow[k][g[:-1]][g[-1]] = n

    @cache
    def weight(k, context):
        seen = follow[k][context]
        total, freed = sum(seen.values()), sum(n - disc(k, n) for n in seen.values())
        total, freed = (total, freed) if freed > 1e-9 else (total + 1, 1.0)
        return total, freed / total if k == 1 else freed / total / (1 - sum(p(k - 1, context[1:], w) for w in seen))

    def p(k, context, word):
        if k == 0:
            return 1.0
        seen = follow[k].get(context)
        if seen is None:
            return p(k - 1, context[1:], word)
        total, left = weight(k, context)
        if word in seen:
            return disc(k, seen[word]) / total
        return left if k == 1 else left * p(k - 1, context[1:], word)

    for context in list(follow[order])[:20]:
        assert abs(sum(p(order, context, w) for (w,) in grams[1]) + p(order, context, "never") - 1) < 1e-9
    for i, text, _, _ in rows:
        w = padded(text)
        yield i, len(split(text)), sum(math.log10(p(order, tuple(w[j - order + 1 : j]), w[j])) for j in range(order - 1, len(w)))


@pytest.mark.parametrize("order", [1, 3])
def test_same_as_plain(spark, order):
    df = spark.createDataFrame(ROWS, SCHEMA)
    model = katz_tables.fit(df.filter("not held"), order=order)
    got = katz_tables.score(df, model).collect()
    key = lambda r: (str(r[0]), round(r[2], 4))
    for a, b in zip(sorted(got, key=key), sorted(plain(ROWS, order), key=key), strict=True):
        assert tuple(a)[:2] == b[:2] and a["score"] == pytest.approx(b[2], abs=1e-8)
    again = katz_tables.score(spark.createDataFrame([(1, "w1 w2 new words", None, None)], SCHEMA), katz_tables.Model(model.path, model.order, model.unknown)).first()
    assert again["n_tokens"] == 5 and again["score"] < 0


def test_registered_trigrams(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2, None) for r in docs]
    got = {r["doc_id"]: (r["n_tokens"], r["score"]) for r in queries.QUERIES["katz_trigrams"](spark, SF).collect()}
    want = {i: (n, s) for i, n, s in plain(rows, 3)}
    assert got.keys() == want.keys() and any(held for *_, held, _ in rows)
    for i, (n, s) in want.items():
        assert got[i] == (n, pytest.approx(s, rel=1e-9))


def test_same_as_blocks(spark):
    df = spark.createDataFrame([r for r in ROWS if r[0] is not None], SCHEMA)
    blocks = {r["doc_id"]: r["score"] for r in katz.score(df, F.col("held")).collect()}
    tables = {r["doc_id"]: r["score"] for r in katz_tables.score(df, katz_tables.fit(df.filter("not held"), order=2)).collect()}
    assert tables == pytest.approx(blocks, abs=1e-6)


def test_nothing_to_learn_from_and_empty(spark):
    df = spark.createDataFrame([(1, "a b", True, None)], SCHEMA)
    model = katz_tables.fit(df.filter("not held"), order=2)
    assert tuple(katz_tables.score(df, model).first()) == (1, 3, 0.0)
    assert katz_tables.score(df.limit(0), model).count() == 0


def test_only_tokens_not_found_go_on(spark, monkeypatch):
    """No table of tokens is stored, and texts that were learnt need the n-grams of the highest order only."""
    made = {}
    real = katz_tables.stored
    monkeypatch.setattr(katz_tables, "stored", lambda df, what: made.setdefault(what, []).append(real(df, what)) or made[what][-1])
    learnt = spark.createDataFrame([r for r in ROWS if not r[2]], SCHEMA)
    model = katz_tables.fit(learnt, order=3)
    assert not any("tokens" in what for what in made)
    for df, lost in ((learnt, False), (spark.createDataFrame([(1, "w1 never w2", True, None)], SCHEMA), True)):
        made.clear()
        katz_tables.score(df, model).collect()
        assert [bool(x.agg(F.sum(F.size("misses"))).first()[0]) for x in made["katz-met"]] == [lost, lost]


def test_many_blocks_and_buckets(spark, monkeypatch):
    """What is sent is merged over blocks, whatever their size, and a word's numbers may fill a column of their own."""
    monkeypatch.setattr(katz, "BLOCK", 50)
    monkeypatch.setattr(katz_tables, "PART", 150)
    monkeypatch.setattr(katz_tables, "MERGED", 20)
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = katz_tables.score(df, katz_tables.fit(df.filter("not held"), order=4)).collect()
    key = lambda r: (str(r[0]), round(r[2], 4))
    for a, b in zip(sorted(got, key=key), sorted(plain(ROWS, 4), key=key), strict=True):
        assert tuple(a)[:2] == b[:2] and a["score"] == pytest.approx(b[2], abs=1e-8)


@pytest.mark.parametrize("bits", [4, 21, 40])
def test_grams_of_one_or_more_columns(bits):
    rng = np.random.default_rng(5)
    facts = katz_tables.Facts(3, bits, 0)
    table, asked = np.unique(rng.integers(0, 9, (3, 200)), axis=1), rng.integers(0, 9, (3, 300))
    if bits == 40:
        table, asked = table << 31, asked << 31
    where = {tuple(g): i for i, g in enumerate(table.T.tolist())}
    assert facts.places(table, asked).tolist() == [where.get(tuple(g), -1) for g in asked.T.tolist()]
    distinct, at, ends = facts.asked(asked)
    assert (distinct[:, at] == asked).all() and ends[-1] == distinct.shape[1] == len({tuple(g) for g in asked.T.tolist()})
    assert (np.diff(facts.bucket(distinct)) >= 0).all()
    merged, n = facts.merged(asked, np.ones(300, np.int64))
    assert {tuple(g): c for g, c in zip(merged.T.tolist(), n.tolist(), strict=True)} == Counter(map(tuple, asked.T.tolist()))


def test_tables_hold_numbers(spark, tmp_path):
    """The tables of 120,300 tokens take less room than with words as text (1,032,923 bytes; with numbers 639,036)."""
    rng = np.random.default_rng(7)
    texts = [(i, " ".join(f"word{w}" for w in rng.zipf(1.3, 400) % 20_000)) for i in range(300)]
    katz_tables.fit(spark.createDataFrame(texts, "doc_id long, text string"), order=3, path=f"{tmp_path}/m")
    assert sum(f.stat().st_size for f in (tmp_path / "m").rglob("*.parquet")) < 800_000
