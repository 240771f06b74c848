"""Bigram language model with Katz backoff over the words of whole texts.

Counts are Good-Turing discounted (up to ``K``, as Katz does), and each context's backoff
weight is the freed mass over the unigram mass of the words never seen after it, so every
conditional distribution sums to one. A token is evaluated recursively: its bigram if seen,
else the weight of its context times the unigram; words never seen share one unknown event.

Texts are worked on in blocks of about ``BLOCK`` tokens (a longer text is a block of its own), which are written once. A block sends its distinct words and
word pairs with their counts to hash buckets and gets back the totals over the corpus, in its
own order: the model's tables stay partitioned, no task holds more of them than its own block
or bucket needs (there are as many buckets as the corpus needs), and a frequent word costs each block one entry. Three exchanges suffice:
word counts, pair counts (together), and the sums over each context's successors.

* If a count of counts is zero or a discount leaves (0, 1), the discount of r is (r - 0.5) / r.
* A context whose successors all have counts over ``K`` frees no mass; its denominator then
  grows by one, and that one goes to its unseen successors. The same holds for the unigrams.

Cases: a null text has one token, its end; rows are scored one by one, repeated ones and
those without id too; without training rows all words are unknown (score 0); an empty table gives
an empty result; extra columns are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewatch.llm.common import bounded_batches, stored

K = 5
#: Tokens of a block, and keys of a bucket, about.
BLOCK, BUCKET = 2_000_000, 1_000_000
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: No word holds white space, so these are no words.
START, END = b"\n<s>", b"\n</s>"


def pack(values: np.ndarray) -> bytes:
    """Eight-byte numbers as compressed byte planes."""
    return zstandard.compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys by their differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets begin in ascending keys; a bucket is a range of the hash."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


@dataclass
class Block:
    """Texts as numbers: ``words`` are ascending hashes, tokens and contexts index them."""

    words: np.ndarray
    tokens: np.ndarray
    contexts: np.ndarray
    text: np.ndarray  # of each token
    held_out: np.ndarray  # of each text

    @property
    def training(self) -> np.ndarray:
        return ~self.held_out[self.text]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ascending hashes of the distinct pairs, an occurrence of each, and each token's pair."""
        a, b = self.words[self.contexts], self.words[self.tokens]
        with np.errstate(over="ignore"):
            mixed = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed, return_index=True, return_inverse=True)


class Numbering:
    """Texts that become a block; words are numbered as they come."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = defaultdict(count().__next__)
        self.start, self.end = self.words[START], self.words[END]
        self.ids, self.held, self.tokens, self.lens, self.size = [], [], [], [], 0

    def add(self, i: object, text: str | None, held_out: bool | None) -> None:
        number = self.words.__getitem__
        own = np.fromiter(map(number, (text or "").encode().translate(LOWER).split()), np.int32)
        self.tokens.append(np.append(own, np.int32(self.end)))
        self.lens.append(len(own) + 1)
        self.size += len(own) + 1
        self.ids.append(i)
        self.held.append(bool(held_out))

    def row(self, name: int) -> dict:
        """The block as a row of the table of blocks; ``words`` are ascending hashes, which tokens index."""
        hashes = np.array(list(map(xxhash.xxh3_64_intdigest, self.words)), np.uint64)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        tokens = zstandard.compress(rank[np.concatenate(self.tokens)].tobytes(), 1)
        return {"block": name, "ids": self.ids, "held": self.held, "lens": self.lens, "words": pack_sorted(hashes[order]), "tokens": tokens, "start": int(rank[self.start])}


def block_of(row: dict) -> Block:
    """The block that a row of the table of blocks holds."""
    words, tokens, lens = unpack_sorted(row["words"]), np.frombuffer(zstandard.decompress(row["tokens"]), np.int32), np.array(row["lens"])
    contexts = np.empty_like(tokens)
    contexts[1:] = tokens[:-1]
    contexts[np.cumsum(lens) - lens] = row["start"]
    return Block(words, tokens, contexts, np.repeat(np.arange(len(lens)), lens), np.array(row["held"], bool))


def discounts(counts: list[int]) -> np.ndarray:
    """Discount of 0..K from the numbers of events seen 1..K+1 times (index 0 and over K: none)."""
    n = np.array(counts, float)
    r = np.arange(1, K + 1)
    d = np.ones(K + 1)
    if (n[: K + 1] > 0).all():
        tail = (K + 1) * n[K] / n[0]
        if tail < 1:
            d[1:] = ((r + 1) * n[1:] / n[:-1] / r - tail) / (1 - tail)
    if not ((d[1:] > 0) & (d[1:] < 1)).all():
        d[1:] = (r - 0.5) / r
    return d


@dataclass
class Stats:
    """Totals over the training texts: tokens, words, and the counts of counts."""

    tokens: int
    words: int
    unigrams: list[int]
    bigrams: list[int]

    def __post_init__(self) -> None:
        self.d1, self.d2 = discounts(self.unigrams), discounts(self.bigrams)
        r = np.arange(1, K + 1)
        freed = float(((1 - self.d1[1:]) * r * np.array(self.unigrams[:K])).sum())
        self.total = self.tokens + (0 if freed > 0 else 1)
        self.unknown = (freed if freed > 0 else 1.0) / self.total

    def unigram(self, c: np.ndarray) -> np.ndarray:
        """P of words seen ``c`` times; of the unknown event where ``c`` is 0."""
        return np.where(c > 0, self.d1[np.where(c <= K, c, 0)] * c / self.total, self.unknown)

    def kept(self, r: np.ndarray) -> np.ndarray:
        """Discounted counts of pairs."""
        return self.d2[np.where(r <= K, r, 0)] * r


def _sent(block: Block, buckets: int) -> Iterator[tuple[str, int, bytes, bytes]]:
    """Kind, bucket, keys and training counts of a block's words and pairs."""
    training = block.training
    pairs, _, of_token = block.pairs()
    for kind, keys, of in (("w", block.words, block.tokens), ("p", pairs, of_token)):
        counts = np.bincount(of[training], minlength=len(keys)).astype(np.int64)
        at = bounds(keys, buckets)
        for b in np.flatnonzero(np.diff(at)).tolist():
            part = slice(at[b], at[b + 1])
            yield kind, b, pack_sorted(keys[part]), pack(counts[part])


def _totals(rows: pa.Table) -> pa.Table:
    """Totals of a bucket's keys for each block that sent them, and the first block of each key."""
    keys = [unpack_sorted(x) for x in rows["keys"].to_pylist()]
    counts = [unpack(x, "<i8") for x in rows["counts"].to_pylist()]
    distinct, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)
    owned = np.zeros(len(at), bool)
    owned[first] = True
    # The sign tells who owns the key: one block alone adds it to its context's sums.
    signed = np.where(owned, total[at], -total[at])
    ends = np.cumsum([len(k) for k in keys])
    stats = [[0] * (K + 3) for _ in keys]
    stats[0] = [int(total.sum()), int((total > 0).sum()), *(int((total == r).sum()) for r in range(1, K + 2))]
    back = [pack(x) for x in np.split(signed, ends[:-1])]
    return pa.table({"block": rows["block"], "kind": rows["kind"], "bucket": rows["bucket"], "totals": pa.array(back, pa.binary()), "stats": pa.array(stats, pa.list_(pa.int64()))})


def _ordered(rows: pa.Table, kind: str, column: str, form: str) -> np.ndarray:
    """What came back for a block, in the order of its keys."""
    rows = rows.filter(pa.compute.equal(rows["kind"], kind)).sort_by("bucket")
    parts = [unpack(x, form) for x in rows[column].to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, form)


def _sums(rows: pa.Table) -> pa.Table:
    """Freed counts and unigram mass of a bucket's contexts for each block that sent them."""
    keys = [unpack_sorted(x) for x in rows["keys"].to_pylist()]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(k) for k in keys])[:-1]
    made = {}
    for name in ("freed", "mass"):
        total = np.bincount(at, np.concatenate([unpack(x, "<f8") for x in rows[name].to_pylist()]), len(distinct))
        made[name] = pa.array([pack(x) for x in np.split(total[at], ends)], pa.binary())
    return pa.table({"block": rows["block"], "kind": rows["kind"], "bucket": rows["bucket"], **made})


def score(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK, bucket_keys: int = BUCKET) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    The model learns from the rows that aren't held out. ``base_score`` is that of the
    add-one unigram model.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held_out"))
    id_type = rows.schema["id"].dataType.simpleString()
    batch_ids = pa.list_(to_arrow_type(rows.schema["id"].dataType))
    state = pa.schema([("block", pa.int64()), ("ids", batch_ids), ("held", pa.list_(pa.bool_())), ("lens", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary()), ("start", pa.int64())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, made = TaskContext.get().partitionId() << 32, Numbering()
        for batch in batches:
            for i, text, out in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), batch["held_out"].to_pylist(), strict=True):
                made.add(i, text, out)
                if made.size >= block_tokens:
                    yield from pa.Table.from_pylist([made.row(name)], schema=state).to_batches()
                    name, made = name + 1, Numbering()
        if made.ids:
            yield from pa.Table.from_pylist([made.row(name)], schema=state).to_batches()

    # The blocks are written once; a task that is run again reads the same ones.
    kept = stored(rows.mapInArrow(number, f"block long, ids array<{id_type}>, held array<boolean>, lens array<long>, words binary, tokens binary, start long"), "katz-texts")
    tokens = kept.agg(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    # A bucket's keys, and what a task reads, are bounded at any size of the corpus.
    buckets = parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // bucket_keys))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                kinds, numbers, keys, counts = zip(*_sent(block_of(row), buckets), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(kinds)), pa.array(kinds), pa.array(numbers, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())],
                    names=["block", "kind", "bucket", "keys", "counts"],
                )

    sent = kept.select("block", "held", "lens", "words", "tokens", "start").mapInArrow(send, "block long, kind string, bucket int, keys binary, counts binary")
    totals = sent.repartition(parts, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(_totals, "block long, kind string, bucket int, totals binary, stats array<long>")
    totals = stored(totals, "katz-totals")
    summed = totals.groupBy("kind").agg(F.array(*(F.sum(F.col("stats")[i]) for i in range(K + 3))).alias("s"))
    found = {r["kind"]: list(r["s"]) for r in summed.collect()}
    words, pairs = found.get("w", [0] * (K + 3)), found.get("p", [0] * (K + 3))
    stats = Stats(words[0], words[1], words[2:], pairs[2:])

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = block_of(row)
        keys, tokens, contexts, lens = block.words, block.tokens, block.contexts, np.array(row["lens"])
        c = np.abs(_ordered(right, "w", "totals", "<i8"))
        distinct, example, of_token = block.pairs()
        signed = _ordered(right, "p", "totals", "<i8")
        after = c.copy()
        after[row["start"]] = c[np.searchsorted(keys, np.uint64(xxhash.xxh3_64_intdigest(END)))]
        uni, r = stats.unigram(c), np.abs(signed)
        n = len(lens)
        per = lambda x: np.bincount(block.text, x, n)
        own = signed > 0
        context, follower, many = contexts[example[own]], tokens[example[own]], r[own]
        freed = np.bincount(context, many - stats.kept(many), len(keys))
        mass = np.bincount(context, uni[follower], len(keys))
        rt, ct = r[of_token], after[contexts]
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(rt > 0, np.log10(stats.kept(rt) / np.maximum(ct, 1)), np.log10(uni[tokens]))
        # What waits for its context's sums: unseen pairs, and seen ones of contexts not known to free mass.
        frees = np.zeros(len(keys), bool)
        low = (r > 0) & (r <= K)
        frees[contexts[example[low]]] = True
        waits = np.flatnonzero((ct > 0) & ((rt == 0) | ~frees[contexts]))
        need = np.union1d(np.flatnonzero(mass > 0), contexts[waits]).astype(np.int64)
        late = np.searchsorted(need, contexts[waits]).astype(np.int64)
        at = bounds(keys[need], buckets)
        out = []
        for b in np.flatnonzero(np.diff(at)).tolist():
            part = need[at[b] : at[b + 1]]
            out.append({"block": row["block"], "kind": "c", "bucket": b, "keys": pack_sorted(keys[part]), "freed": pack(freed[part]), "mass": pack(mass[part])})
        base = np.log10((c + 1) / (stats.tokens + stats.words + 1))
        known = {"lens": lens, "known": per((c > 0)[tokens]), "base": per(base[tokens]), "score": per(value)}
        out.append(
            {
                "block": row["block"], "kind": "d", "bucket": -1, "ids": row["ids"], "held": row["held"], **{k: v.tolist() for k, v in known.items()},
                "late": zstandard.compress(np.stack([block.text[waits], late, (rt[waits] == 0).astype(np.int64)]).astype("<i8").tobytes(), 1), "after": pack(after[need].astype("<i8")),
            }
        )
        return pa.Table.from_pylist(out, schema=shape)

    doubles = pa.list_(pa.float64())
    shape = pa.schema(
        [("block", pa.int64()), ("kind", pa.string()), ("bucket", pa.int32()), ("keys", pa.binary()), ("freed", pa.binary()), ("mass", pa.binary()), ("ids", batch_ids), ("held", pa.list_(pa.bool_()))]
        + [(k, doubles) for k in ("lens", "known", "base", "score")]
        + [("late", pa.binary()), ("after", pa.binary())]
    )
    ddl = f"block long, kind string, bucket int, keys binary, freed binary, mass binary, ids array<{id_type}>, held array<boolean>, lens array<double>, known array<double>, base array<double>, score array<double>, late binary, after binary"
    worked = kept.repartition(parts, "block").groupBy("block").cogroup(totals.select("block", "kind", "bucket", "totals").repartition(parts, "block").groupBy("block")).applyInArrow(apply, ddl)
    worked = stored(worked, "katz-blocks")
    sums = worked.filter("kind = 'c'").select("block", "kind", "bucket", "keys", "freed", "mass").repartition(parts, "bucket").groupBy("bucket").applyInArrow(_sums, "block long, kind string, bucket int, freed binary, mass binary")
    tokens_seen = stats.tokens

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        value, after = np.array(row["score"]), unpack(row["after"], "<i8").astype(float)
        freed, mass = _ordered(right, "c", "freed", "<f8"), _ordered(right, "c", "mass", "<f8")
        text, late, unseen = np.frombuffer(zstandard.decompress(row["late"]), "<i8").reshape(3, -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            none = freed <= 1e-9
            total = after + none
            weight = np.log10(np.where(none, 1.0, freed) / total / np.maximum(1 - mass, 1e-300))
            smaller = np.where(none, np.log10(after / total), 0.0)
        value = value + np.bincount(text, np.where(unseen == 1, weight[late], smaller[late]), len(value)) if len(text) else value
        long = lambda x: pa.array(np.array(x), pa.float64()).cast(pa.int64())
        made = [pa.array(row["ids"], batch_ids.value_type), pa.array(row["held"], pa.bool_()), long(row["lens"]), long(row["known"])]
        made += [pa.array([tokens_seen] * len(value), pa.int64()), pa.array(row["base"], pa.float64()), pa.array(value, pa.float64())]
        return pa.table(dict(zip(("id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"), made, strict=True)))

    texts = worked.filter("kind = 'd'").select("block", "ids", "held", "lens", "known", "base", "score", "late", "after")
    done = texts.repartition(parts, "block").groupBy("block").cogroup(sums.repartition(parts, "block").groupBy("block")).applyInArrow(finish, f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return done.withColumnRenamed("id", id_col)
