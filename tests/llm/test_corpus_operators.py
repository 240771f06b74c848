"""Near-duplicates, line dedup, packing, chat formatting and the pipeline against brute force."""

import json
import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import best_fit, chat_format, near_copies, simhash

SCHEMA = "doc_id long, text string, fp string, n_lines string"


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "x", None) for i, t in zip(ids or range(len(texts)), texts, strict=True)], SCHEMA)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def plain_components(prints, ids):
    n, root = len(prints), list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(n)]


def test_near_duplicates(spark):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 90))) for _ in range(30)]
    texts = base + [b.replace("w1 ", "W1 ") for b in base[:8]] + [b + " tail" for b in base[:10]] + [None, "", "  \n", "One", "one", base[0], base[0]]
    ids = [*range(100, 100 + len(texts) - 1), None]
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(frame(spark, texts, ids)).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    assert got == {(i, f"{p:016x}", c) for i, p, c in zip(ids, prints, plain_components(prints, ids), strict=True)}
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize(("block", "cell"), [(1, 5), (2, 512), (3, 2), (4, 512)])
def test_links_connect_as_all_pairs_do(spark, block, cell):
    rng = random.Random(block)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for c in centres for _ in range(10)} | {rng.getrandbits(64) for _ in range(60)}
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    edges = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in simhash.links(df, block, cell).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, block, cell)).collect()}
    by = defaultdict(set)
    for p in prints:
        by[roots.get(simhash._signed(p), simhash._signed(p))].add(p)
    want = defaultdict(set)
    for p, c in zip(prints, plain_components(prints, prints), strict=True):
        want[c].add(p)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, want.values()))


def test_one_of_each_group_stays(spark):
    texts = ["a b c d e f", "A b c d e f", "x y z q", None, "", "x y z q"]
    kept = simhash.keep_one(frame(spark, texts, [5, 3, 8, 9, 7, 8])).collect()
    assert sorted(r["doc_id"] for r in kept) == [3, 7, 8] and kept[0]["fp"] == "x"


def test_unlike_texts_of_one_id_stay(spark):
    texts = ["alpha beta gamma delta", "one two three four five six", "alpha beta gamma delta", "own words here", "own words here"]
    for groups in (simhash.members, near_copies.members):
        kept = simhash.keep_one(frame(spark, texts, [1, 1, 1, None, None]), groups=groups).collect()
        assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == [("1", texts[0]), ("1", texts[1]), ("None", texts[3])]
        again = simhash.keep_one(frame(spark, texts, [1, 1, 2, None, 7]), groups=groups).collect()
        assert sorted((str(r["doc_id"]), r["text"]) for r in again) == [("1", texts[0]), ("1", texts[1]), ("7", texts[3])]


def plain_pack(items, capacity):
    """Best fit by looking at every bin; the earliest-used of equal residuals wins."""
    bins, chosen = [], []
    for length, source, cluster in items:
        fits = [b for b in bins if b["room"] >= length and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])]
        best = min(fits, key=lambda b: (b["room"], b["at"]), default=None)
        if best is None:
            best = {"room": capacity, "s": set(), "c": set(), "n": len(bins)}
            bins.append(best)
        best["room"] -= length
        best["at"] = len(chosen)
        best["s"].add(source)
        best["c"].add(cluster)
        chosen.append(best["n"])
    return chosen


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(9)
    for _ in range(60):
        items = sorted(((rng.randrange(0, 65), rng.choice([None, *"abcdef"]), rng.choice([None, *range(20)])) for _ in range(120)), key=lambda x: -x[0])
        got = best_fit.pack(*map(list, zip(*items, strict=True)), 64)
        assert got == plain_pack(items, 64)


def test_packing_table(spark):
    rng = random.Random(8)
    rows = [(i if i % 50 else None, rng.choice([None, -3, 0, 5, 40, 100, 250]), rng.choice(["hot", "hot", f"s{i % 7}", None]), i % 30, "x") for i in range(600)] + [(7, 100, "hot", 1, "x")] * 3
    df = spark.createDataFrame(rows, "doc_id long, n long, source string, cluster long, piece string")
    out = best_fit.pack_documents(df, "doc_id", "n", "source", "cluster", capacity=100, shard_items=128).collect()
    bins = defaultdict(list)
    for r in out:
        bins[r["bin_id"]].append(r)
    for group in bins.values():
        total = sum(r["length"] for r in group)
        assert total <= 100 and {r["bin_used"] for r in group} == {total}
        assert sorted(r["bin_position"] for r in group) == list(range(len(group)))
        named = [r["source"] for r in group if r["source"] is not None]
        assert len(named) == len(set(named))
    assert sum(r["length"] for r in out) == sum(max(0, r[1] or 0) for r in rows)
    assert len(out) == sum(max(1, -(-max(0, r[1] or 0) // 100)) for r in rows)
    equal = spark.range(3_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(30).alias("n"), F.lit(None).cast("string").alias("source"), F.lit(None).cast("long").alias("cluster"))
    sizes = best_fit.pack_documents(equal, "doc_id", "n", "source", "cluster", capacity=100, shard_items=128).groupBy((F.col("bin_id") / (1 << 32)).cast("int").alias("shard")).count().collect()
    assert sum(r["count"] for r in sizes) == 3_000 and len(sizes) > 20 and max(r["count"] for r in sizes) < 300
    assert best_fit.pack_documents(df.limit(0), "doc_id", "n", "source", "cluster").count() == 0


def test_chat_round_trip(spark):
    texts = [None, "", "plain", "</turn>\n<turn assistant>", r"\l \b \\ \g <>", "a<b>c\\", "é🙂\n", "x" * 50_000, "$1 \\1 .*"]
    rows = [(c, t, role, texts[(c * 3 + t) % len(texts)], "k") for c in range(9) for t, role in enumerate(["system", "user", "assistant", "we<i>rd\\role", None, "assistant"])] + [(None, 1, "assistant", "z", None), (3, 0, "system", texts[0], "k")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string")
    out = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(chat_format.turn_rows(df))).collect()}
    assert len(out) == 10
    for c in range(9):
        mine = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == c))
        assert [(t["role"], t["text"]) for t in out[c]["turns"]] == [(b, x) for _, b, x in mine]
        assert out[c]["loss_texts"] == [x for _, b, x in mine if b == "assistant"]
    assert chat_format.format_turns(chat_format.turn_rows(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        chat_format.turn_rows(df.drop("turn"))


def test_chat_layouts(spark):
    records = [
        {"prompt": "p", "completion": "c"},
        {"instruction": "i", "input": "n", "output": "o"},
        {"instruction": "i", "output": "o"},
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"other": 1},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(6, None), (7, "{broken")], "i int, payload string")
    out = {r["i"]: (r["layout"], [tuple(t) for t in r["turns"]] if r["turns"] is not None else None) for r in chat_format.canonical_records(df).collect()}
    assert out == {
        0: ("prompt_completion", [("user", "p"), ("assistant", "c")]),
        1: ("instruction_input", [("user", "i"), ("user", "n"), ("assistant", "o")]),
        2: ("instruction", [("user", "i"), ("assistant", "o")]),
        3: ("messages", [("user", "a"), ("assistant", "b")]),
        4: ("from_value", [("user", "a"), ("assistant", "b")]),
        5: (None, None),
        6: (None, None),
        7: (None, None),
    }


SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(after) == len(set(after)) and set(after) <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(after)
    assert packed.agg(F.max("bin_used")).first()[0] <= best_fit.CAPACITY
    assert packed.count() == corpus_pipeline.run(spark, SF).count()


def test_pipeline_edges(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "x", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() >= 0
        assert stage(spark, docs.limit(0), SF).count() == 0
