"""Katz backoff against a plain dictionary model."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import katz

SCHEMA = "doc_id long, text string, held boolean, score string"


def plain(rows):
    """The model written with dictionaries, and every row's figures."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>\n"]
    uni, bi = Counter(), Counter()
    for _, text, held, _ in rows:
        if not held:
            w = split(text)
            uni.update(w)
            bi.update(zip(["<s>\n", *w], w, strict=False))
    counts = lambda c: [sum(v == r for v in c.values()) for r in range(1, katz.K + 2)]
    d1, d2 = katz.discounts(counts(uni)), katz.discounts(counts(bi))
    disc = lambda d, r: d[r] * r if r <= katz.K else r
    n = sum(uni.values())
    freed = n - sum(disc(d1, c) for c in uni.values())
    total, left = (n, freed) if freed > 1e-12 else (n + 1, 1)
    p1 = defaultdict(lambda: left / total, {w: disc(d1, c) / total for w, c in uni.items()})
    after, follow = Counter(), defaultdict(dict)
    for (a, b), r in bi.items():
        after[a] += r
        follow[a][b] = r

    def p2(a, b):
        if a not in follow:
            return p1[b]
        gone = sum(r - disc(d2, r) for r in follow[a].values())
        size, mass = (after[a], gone) if gone > 1e-12 else (after[a] + 1, 1)
        if b in follow[a]:
            return disc(d2, follow[a][b]) / size
        return mass / size / (1 - sum(p1[x] for x in follow[a])) * p1[b]

    for a in follow:
        assert abs(sum(p2(a, b) for b in [*uni, "never"]) - 1) < 1e-9
    for i, text, held, _ in rows:
        w = split(text)
        yield i, held, len(w), sum(uni[x] > 0 for x in w), n, sum(math.log10((uni[x] + 1) / (n + len(uni) + 1)) for x in w), sum(math.log10(p2(a, b)) for a, b in zip(["<s>\n", *w], w, strict=False))


ROWS = [(i, " ".join(f"w{(i * j * 7) % (5 + j % 11)}" for j in range(1, 3 + i % 29)), i % 7 == 2, "x") for i in range(150)]
ROWS += [(900 + i, t, False, None) for i, t in enumerate([None, "", "A b\tB a", "long " * 3000, "once", "once"])] + [(None, "w1 w2 zzz", True, None), (None, "w1 w2 zzz", True, None)]


@pytest.mark.parametrize("block", [40, katz.BLOCK])
def test_same_as_plain(spark, block):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3, "text")
    got = katz.score(df, F.col("held"), block_tokens=block).collect()
    want = list(plain(ROWS))
    key = lambda r: (str(r[0]), r[2], round(r[6], 4))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(a)[:5] == b[:5]
        assert a["base_score"] == pytest.approx(b[5], abs=1e-6)
        assert a["score"] == pytest.approx(b[6], abs=1e-6)


def test_blocks_are_bounded_whatever_parts_the_words(spark):
    rows = [(f"k{i}", "\n".join(f"w{(i * j) % 90}" for j in range(100)), False, None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id string, text string, held boolean, score string").coalesce(1)
    numbering = katz.Numbering()
    numbering.add(1, "a\tB\nc\x0bd", None)
    assert numbering.size == 5 and numbering.held == [False]
    got = {r["doc_id"]: r["score"] for r in katz.score(df, F.col("held"), block_tokens=1_000, bucket_keys=50).collect()}
    assert got == pytest.approx({r[0]: r[6] for r in plain(rows)}, abs=1e-6)
    dated = df.limit(2).withColumn("doc_id", F.lit("2024-01-01").cast("date"))
    assert katz.score(dated, F.col("held")).count() == 2


def test_nothing_to_learn_from(spark):
    got = katz.score(spark.createDataFrame([(1, "a b", True, None)], SCHEMA), F.col("held")).first()
    assert (got["n_tokens"], got["n_known"], got["train_tokens"]) == (3, 0, 0)
    assert got["score"] == 0


def test_empty_table(spark):
    assert katz.score(spark.createDataFrame([], SCHEMA), F.col("held")).count() == 0
