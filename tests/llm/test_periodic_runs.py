"""Runs against all periods of all stretches."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np

from tidewatch.llm import periodic_runs, queries


def plain_runs(words):
    codes = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.zeros(0, int)
    found = {}
    for p in range(1, len(codes) // 2 + 1):
        same = np.concatenate([[False], codes[:-p] == codes[p:], [False]])
        begins, ends = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])
        for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
            if j - i >= p and j + p - i >= 12:
                found.setdefault((i, j + p - i), p)
    return sorted(((s, size, p) for (s, size), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_left(words, runs):
    gone = {i for s, size, p in runs for i in range(s + p, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(n=500):
    rng = random.Random(9)
    out = [None, "", " \n", "a", "a " * 11, "a " * 12, "a " * 13, "a b " * 6, "a b " * 5 + "a", "x" + " y" * 40 + " z" + " y" * 40]
    for k in range(n):
        letters = rng.choice(["ab", "abc", "abcdefghij", "é日z"])
        words = rng.choices(letters, k=rng.randrange(90))
        for _ in range(rng.randrange(4)):
            a = rng.randrange(len(words) + 1)
            words[a:a] = rng.choices(letters, k=rng.randrange(1, 9)) * rng.randrange(1, 9)
        out.append(rng.choice([" ", "\n", " \t"]).join(words))
    base = " ".join(f"w{i}" for i in range(40))
    return [*out, base, base + " " + base, base + " x " + base, (base + " ") * 3 + "w0 w1", base]


def test_same_as_all_periods(spark):
    made = texts()
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(made)], "doc_id long, text string, runs string, n_words int").repartition(3)
    rows = {r["doc_id"]: r for r in periodic_runs.with_runs(df).collect()}
    assert len(rows) == len(made)
    some = 0
    for i, t in enumerate(made):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want = plain_runs(words)
        some += len(want)
        assert rows[i]["n_words"] == len(words)
        assert [tuple(r) for r in rows[i]["runs"]] == want, t
        assert rows[i]["collapsed"] == plain_left(words, want)
    assert some > 500
    assert periodic_runs.with_runs(df.limit(0)).count() == 0


def test_intervals_of_strings_with_very_many_runs():
    for words in (["a"] * 3000, list("ab" * 1500), (["x"] * 14 + ["y"]) * 60, list("abaab" * 200 + "abab" * 90)):
        fib = ["a", "b"]
        while len(fib) < 900:
            fib = fib + fib[: len(fib) // 2 + 1]
        for ws in (words, fib):
            _, codes = np.unique(ws, return_inverse=True)
            assert periodic_runs.find_runs(codes.astype(np.int64), np.array([len(ws)]))[0] == plain_runs(ws)


def test_long_text_stays_cheap():
    words = ["same"] * 100_000 + [f"w{i % 700}" for i in range(150_000)]
    codes = np.unique(words, return_inverse=True)[1].astype(np.int64)
    assert periodic_runs.find_runs(codes, np.array([len(words)]))[0] == [(0, 100_000, 1), (100_000, 150_000, 700)]


def test_query_against_all_periods(spark):
    sf = "/root/testdata/sf0.001"
    known = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall() + [(5_000_090, None), (None, "a " * 30)]
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    assert len(got) == len(known) - 2
    more = spark.createDataFrame([(5_000_090, None), (None, "a " * 30)], "doc_id long, text string")
    got |= {r["doc_id"]: r for r in queries.planted_runs(more).collect()}
    changed = 0
    for i, t in known:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (k - a) % p] if k >= a else w for k, w in enumerate(words)]
            changed += 1
        runs = plain_runs(words)
        r = got[i]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{size},{p}\n" for s, size, p in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_left(words, runs).encode()).hexdigest()
    assert changed
