"""Katz backoff as stored tables of any order, which can be read again and applied to other texts.

``fit`` numbers the words and writes the vocabulary, the n-grams of each order that were seen in training with their counts and the totals of their contexts
(from which with the stored discounts the probability follows), and, from order 2, each context's
backoff weight; n-grams lie in buckets by their context.
``score`` evaluates a token recursively: its n-gram of the highest order if that was
seen, else the weight of its context times the value of the order below; unknown words share the
mass that the unigrams leave. Only tokens that weren't found go on
to the order below. ``katz`` gives the same scores at order 2 without stored tables.

Discounts, exact normalisation and tokens are those of ``katz``. A seen n-gram's shorter forms
were seen too, so the mass that a context's successors have in the order below is a sum over stored rows.

Texts are worked on in blocks of about ``katz.BLOCK`` tokens, which are written once. What is moved: a block's distinct words as text, and then numbers only,
packed as byte planes: the blocks, the distinct n-grams of each block with their counts, those of each bucket for the mass below, and when
texts are scored the distinct n-grams of each block and the tables. An n-gram that is met often in a block is sent once.

Cases: a null text has one token, its end; rows are scored one by one, repeated ones and those without id too; without training rows every token has
probability 1; an empty table gives an empty result; extra columns are ignored; words are compared whole, not by hashes, and n-grams by the numbers of their words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewatch.llm import katz
from tidewatch.llm.common import bounded_batches, shared_path, stored
from tidewatch.llm.katz import K, discounts, pack, unpack

#: Tokens for which there is a bucket, about.
PART = 1_000_000
#: Numbers of n-grams that are merged at once.
MERGED = 4_000_000
#: The word before a text; and a word without number, which no n-gram of the tables ends in.
START, UNKNOWN = 0, -1

GRAMS = "ids array<binary>, n binary"
NUMBERS = pa.list_(pa.binary())


@dataclass(frozen=True)
class Model:
    """Where the tables of a model are; ``order`` of them have n-grams."""

    path: str
    order: int
    unknown: float


@dataclass(frozen=True)
class Facts:
    """What tasks know of a model: its buckets, the bits of a word's number, all training tokens (one more if no unigram frees mass), and the discounts of each order."""

    buckets: int
    bits: int
    total: int
    d: list[list[float]] = field(default_factory=list)

    def kept(self, k: int, n: np.ndarray) -> np.ndarray:
        """Discounted counts of n-grams of order k."""
        return np.array(self.d[k - 1])[np.where(n <= K, n, 0)] * n

    def bucket(self, ids: np.ndarray) -> np.ndarray:
        """Where n-grams lie: words by their number, others by their context."""
        if len(ids) == 1:
            return ((ids[0] - 1) % self.buckets).astype(np.int64)
        mixed = np.zeros(ids.shape[1], np.uint64)
        with np.errstate(over="ignore"):
            for x in ids[:-1]:
                mixed = (mixed ^ x.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
        return (mixed % np.uint64(self.buckets)).astype(np.int64)

    def columns(self, ids: np.ndarray) -> list[np.ndarray]:
        """Numbers that order n-grams: as many of their words in one as it has bits for."""
        each, out = 64 // self.bits, []
        for at in range(0, len(ids), each):
            out.append(ids[at].astype(np.uint64))
            for x in ids[at + 1 : at + each]:
                out[-1] = (out[-1] << np.uint64(self.bits)) | x.astype(np.uint64)
        return out

    def groups(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A stable order of n-grams, and where in it another one begins."""
        columns = self.columns(ids)
        order = np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])
        first = np.ones(len(order), bool)
        if len(order):
            first[1:] = np.any([np.diff(c[order]) != 0 for c in columns], axis=0)
        return order, first

    def merged(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams in order, with the sums of their counts."""
        order, first = self.groups(ids)
        at = np.flatnonzero(first)
        return ids[:, order[at]], np.add.reduceat(n[order], at) if len(at) else n[:0]

    def places(self, table: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Where in ``table``, whose n-grams are distinct, those asked for stand; -1: nowhere."""
        order, first = self.groups(np.concatenate([table, asked], axis=1))
        # Equal ones follow each other, the table's first.
        head = order[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(order) else order
        out = np.empty(len(order), np.int64)
        out[order] = np.where(head < table.shape[1], head, -1)
        return out[table.shape[1] :]

    def asked(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct n-grams, dealt to buckets; where in them each n-gram stands; and where the buckets begin."""
        order, first = self.groups(ids)
        distinct = ids[:, order[first]]
        bucket = self.bucket(distinct)
        dealt = np.argsort(bucket, kind="stable")
        back = np.empty(len(dealt), np.int64)
        back[dealt] = np.arange(len(dealt))
        at = np.empty(len(order), np.int64)
        at[order] = back[np.cumsum(first) - 1]
        return distinct[:, dealt], at, np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=self.buckets))])


def packed(ids: np.ndarray) -> list[bytes]:
    """The words' numbers of n-grams; those of first words by their differences."""
    return [pack(np.diff(ids[0].astype(np.int64), prepend=0)), *(pack(x.astype(np.int64)) for x in ids[1:])]


def unpacked(parts: list[bytes]) -> np.ndarray:
    rows = [unpack(x, "<i8") for x in parts]
    return np.stack([np.cumsum(rows[0]), *rows[1:]])


def joined(parts: list[np.ndarray], k: int) -> np.ndarray:
    """N-grams one after another."""
    return np.concatenate(parts, axis=1) if parts else np.zeros((k, 0), np.int64)


def flat(parts: list[bytes | None], kind: str) -> np.ndarray:
    found = [unpack(x, kind) for x in parts if x is not None]
    return np.concatenate(found) if found else np.zeros(0, kind)


def _filled(made: katz.Numbering, name: int) -> dict:
    """A block as a row: its words by their hashes, and tokens that index them."""
    words = list(made.words)[1:]  # the first is the start, which is no token
    order = np.argsort(np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    tokens = zstandard.compress(rank[np.concatenate(made.tokens) - 1].tobytes(), 1)
    return {"block": name, "ids": made.ids, "lens": made.lens, "words": zstandard.compress(b" ".join(words[i] for i in order.tolist()), 1), "tokens": tokens}


def _tokens(row: dict) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(row["tokens"]), np.int32)


def _blocks(rows: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of the rows (id, text), written once, and the number of their tokens."""
    bounded_batches(rows.sparkSession)
    id_type, size = rows.schema["id"].dataType, katz.BLOCK
    state = pa.schema([("block", pa.int64()), ("ids", pa.list_(to_arrow_type(id_type))), ("lens", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, made = TaskContext.get().partitionId() << 32, katz.Numbering()
        for batch in batches:
            for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                made.add(i, text, False)
                if made.size >= size:
                    yield from pa.Table.from_pylist([_filled(made, name)], schema=state).to_batches()
                    name, made = name + 1, katz.Numbering()
        if made.ids:
            yield from pa.Table.from_pylist([_filled(made, name)], schema=state).to_batches()

    kept = stored(rows.mapInArrow(number, f"block long, ids array<{id_type.simpleString()}>, lens array<long>, words binary, tokens binary"), "katz-texts")
    return kept, kept.agg(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0


def _words_sent(kept: DataFrame, buckets: int) -> DataFrame:
    """A block's distinct words and their counts for each bucket of the vocabulary."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = zstandard.decompress(row["words"]).split(b" ")
                n = np.bincount(_tokens(row), minlength=len(words)).astype(np.int64)
                at = katz.bounds(np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64), buckets).tolist()
                made = [(b, at[b], at[b + 1]) for b in range(buckets) if at[b] < at[b + 1]]
                yield pa.RecordBatch.from_pydict(
                    {"block": [row["block"]] * len(made), "bucket": pa.array([b for b, *_ in made], pa.int32()), "words": [zstandard.compress(b" ".join(words[i:j]), 1) for _, i, j in made], "n": [pack(n[i:j]) for _, i, j in made]}
                )

    return kept.select("block", "words", "tokens").mapInArrow(send, "block long, bucket int, words binary, n binary")


def _texts(row: dict, answers: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each token of a block its text and its n-gram of order k, by the words' numbers that came back."""
    answers = answers.sort_by("bucket")
    numbers = flat(answers["numbers"].to_pylist(), "<i8")[_tokens(row)]
    lens = np.array(row["lens"])
    place = np.arange(len(numbers)) - np.repeat(np.cumsum(lens) - lens, lens)
    ids = np.empty((k, len(numbers)), np.int64)
    for j in range(k):
        ids[k - 1 - j] = np.where(place >= j, np.roll(numbers, j), START)
    return np.repeat(np.arange(len(lens)), lens), ids


def _sent(facts: Facts, ids: np.ndarray, also: np.ndarray | None = None) -> list[dict]:
    """Distinct n-grams by bucket; ``also`` are numbers of theirs, added up."""
    distinct, at, ends = facts.asked(ids)
    n = None if also is None else np.bincount(at, also, distinct.shape[1]).astype(np.int64)
    out = []
    for b in np.flatnonzero(np.diff(ends)).tolist():
        part = slice(ends[b], ends[b + 1])
        out.append({"bucket": b, "ids": packed(distinct[:, part])} | ({} if n is None else {"n": pack(n[part])}))
    return out


def fit(training: DataFrame, text_col: str = "text", order: int = 3, path: str | None = None) -> Model:
    """Count, discount and normalise; the tables are written under ``path``, by default in the shared folder."""
    spark = training.sparkSession
    path = path or shared_path(spark, "katz-model")
    write = lambda df, what: df.write.option("compression", "zstd").parquet(f"{path}/{what}")
    kept, tokens = _blocks(training.select(F.lit(0).alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // PART))

    def number(rows: pa.Table) -> pa.Table:
        sent = [zstandard.decompress(x).split(b" ") for x in rows["words"].to_pylist()]
        total, bucket = Counter(), rows["bucket"][0].as_py()
        for words, n in zip(sent, rows["n"].to_pylist(), strict=True):
            for w, c in zip(words, unpack(n, "<i8").tolist(), strict=True):
                total[w] += c
        # Frequent words get small numbers, which take less room.
        ranked = sorted(total, key=lambda w: (-total[w], w))
        number_of = {w: 1 + r * buckets + bucket for r, w in enumerate(ranked)}
        n = np.array([total[w] for w in ranked], np.int64)
        out = [{"block": b, "bucket": bucket, "numbers": pack(np.array([number_of[w] for w in words], np.int64))} for b, words in zip(rows["block"].to_pylist(), sent, strict=True)]
        numbers = np.array([[number_of[w] for w in ranked]], np.int64)
        out.append({"bucket": bucket, "words": zstandard.compress(b" ".join(ranked), 1), "ids": packed(numbers), "n": pack(n), "stats": [int(n.sum()), int(numbers.max()), *_counted(n)]})
        return pa.Table.from_pylist(out, schema=pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("numbers", pa.binary()), ("words", pa.binary()), ("ids", NUMBERS), ("n", pa.binary()), ("stats", pa.list_(pa.int64()))]))

    numbered = _words_sent(kept, buckets).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(number, f"block long, bucket int, numbers binary, words binary, {GRAMS}, stats array<long>")
    numbered = stored(numbered, "katz-words")
    write(numbered.filter("block is null").select("bucket", "words", "ids", "n"), "words")
    one = numbered.agg(F.max(F.col("stats")[1]), *(F.sum(F.get("stats", F.lit(i))) for i in (0, *range(2, K + 3)))).first()
    stats = {1: [x or 0 for x in one[2:]]}
    counting = Facts(buckets, max(1, int(one[0] or 0).bit_length()), 0)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        row, out = left.to_pylist()[0], []
        _, ids = _texts(row, right, order)
        for k in range(2, order + 1):
            out += [{"k": k} | x for x in _sent(counting, ids[order - k :], np.ones(ids.shape[1]))]
        return pa.Table.from_pylist(out, schema=pa.schema([("k", pa.int32()), ("bucket", pa.int32()), ("ids", NUMBERS), ("n", pa.binary())]))

    def total(rows: pa.Table) -> pa.Table:
        k, waiting, many = rows["k"][0].as_py(), [], 0
        for parts, n in zip(rows["ids"].to_pylist(), rows["n"].to_pylist(), strict=True):
            waiting.append((unpacked(parts), unpack(n, "<i8")))
            many += len(waiting[-1][1])
            if many > MERGED:
                waiting, many = [counting.merged(joined([x for x, _ in waiting], k), np.concatenate([n for _, n in waiting]))], 0
        ids, n = counting.merged(joined([x for x, _ in waiting], k), np.concatenate([n for _, n in waiting]))
        context, at = _contexts(counting, ids)
        sums, low = np.bincount(context, n), np.bincount(context, n <= K) > 0
        # Where nothing is freed, one more is counted for what wasn't seen.
        sums = (sums + ~low).astype(np.int64)[context]
        return pa.Table.from_pylist([{"k": k, "bucket": rows["bucket"][0].as_py(), "ids": packed(ids), "n": pack(n), "total": pack(sums), "stats": _counted(n)}], schema=TABLE)

    if order > 1:
        answers = numbered.filter("block is not null").select("block", "bucket", "numbers")
        sent = kept.select("block", "lens", "tokens").repartition(buckets, "block").groupBy("block").cogroup(answers.repartition(buckets, "block").groupBy("block")).applyInArrow(count, f"k int, bucket int, {GRAMS}")
        write(sent.repartition(buckets, "k", "bucket").groupBy("k", "bucket").applyInArrow(total, f"k int, bucket int, {GRAMS}, total binary, stats array<long>"), "grams")
        found = spark.read.parquet(f"{path}/grams").groupBy("k").agg(*(F.sum(F.col("stats")[i]) for i in range(K + 1))).collect()  # a row for each order
        stats |= {r["k"]: list(r[1:]) for r in found}
    d = [[float(x) for x in discounts(stats.get(k, [0] * (K + 1)))] for k in range(1, order + 1)]
    freed = sum(stats[1][r - 1] * r * (1 - d[0][r]) for r in range(1, K + 1))
    facts = Facts(buckets, counting.bits, (one[1] or 0) + (freed <= 1e-9), d)
    write(spark.createDataFrame([(facts.buckets, facts.bits, facts.total, facts.d)], "buckets int, bits int, total long, d array<array<double>>"), "facts")
    if order > 1:
        _weigh(spark, path, facts, write)
    return Model(path, order, (freed if freed > 1e-9 else 1.0) / facts.total)


TABLE = pa.schema([("k", pa.int32()), ("bucket", pa.int32()), ("ids", NUMBERS), ("n", pa.binary()), ("total", pa.binary()), ("stats", pa.list_(pa.int64()))])


def _counted(n: np.ndarray) -> list[int]:
    """How many are there once, twice, up to K + 1 times."""
    return [int((n == r).sum()) for r in range(1, K + 2)]


def _contexts(facts: Facts, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted n-grams the number of each one's context, and the first n-gram of each."""
    first = np.ones(ids.shape[1], bool)
    first[1:] = np.any([np.diff(x) != 0 for x in ids[:-1]], axis=0)
    return np.cumsum(first) - 1, np.flatnonzero(first)


def _tables(spark, path: str, facts: Facts, orders: range) -> DataFrame:
    """The n-grams of these orders: k, bucket, ids, n and total (of unigrams: null, all have the same)."""
    grams = spark.read.parquet(f"{path}/words").select(F.lit(1).alias("k"), "bucket", "ids", "n", F.lit(None).cast("binary").alias("total")) if 1 in orders else None
    if orders[-1] > 1:
        more = spark.read.parquet(f"{path}/grams").filter(F.col("k").between(orders[0], orders[-1])).select("k", "bucket", "ids", "n", "total")
        grams = more if grams is None else grams.unionByName(more)
    return grams


def _looked_up(facts: Facts, k: int, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bucket of a table: n-grams, counts and totals."""
    ids, n = joined([unpacked(x) for x in rows["ids"].to_pylist()], k), flat(rows["n"].to_pylist(), "<i8")
    return ids, n, np.full(len(n), facts.total, np.int64) if k == 1 else flat(rows["total"].to_pylist(), "<i8")


def _at(values: np.ndarray, places: np.ndarray, none: float = 0) -> np.ndarray:
    """The values at places, and ``none`` for -1."""
    return np.append(values, np.array([none], values.dtype))[places]


def _weigh(spark, path: str, facts: Facts, write: Callable) -> None:
    """Each context's weight: what it leaves, over what the order below leaves to words not seen after it. The last words of a bucket's n-grams are looked up in the order below."""
    grams = spark.read.parquet(f"{path}/grams").select("k", "bucket", "ids", "n", "total")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = [{"k": row["k"] - 1, "of": row["bucket"]} | x for x in _sent(facts, unpacked(row["ids"])[1:])]
                yield from pa.Table.from_pylist(out, schema=pa.schema([("k", pa.int32()), ("of", pa.int32()), ("bucket", pa.int32()), ("ids", NUMBERS)])).to_batches()

    def answer(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        k, bucket = (x.as_py() for x in key)
        table, n, total = _looked_up(facts, k, right)
        asked = [unpacked(x) for x in left["ids"].to_pylist()]
        places = facts.places(table, joined(asked, k))
        ends = np.cumsum([x.shape[1] for x in asked])[:-1]
        back = {"n": [pack(x) for x in np.split(_at(n, places), ends)], "total": [pack(x) for x in np.split(_at(total, places, 1), ends)]} if asked else {"n": [], "total": []}
        return pa.table({"k": pa.array([k + 1] * len(asked), pa.int32()), "bucket": left["of"], "at": pa.array([bucket] * len(asked), pa.int32()), **{c: pa.array(x, pa.binary()) for c, x in back.items()}})

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        row, right = left.to_pylist()[0], right.sort_by("at")
        k, ids, n, total = row["k"], unpacked(row["ids"]), unpack(row["n"], "<i8"), unpack(row["total"], "<i8")
        _, at, _ = facts.asked(ids[1:])
        p = (facts.kept(k - 1, flat(right["n"].to_pylist(), "<i8")) / flat(right["total"].to_pylist(), "<i8"))[at]
        context, first = _contexts(facts, ids)
        freed = np.bincount(context, n - facts.kept(k, n))
        weight = np.where(freed <= 1e-9, 1.0, freed) / total[first] / np.maximum(1 - np.bincount(context, p), 1e-300)
        made = {"k": k, "bucket": row["bucket"], "ids": packed(ids[:-1, first]), "weight": pack(weight)}
        return pa.Table.from_pylist([made], schema=pa.schema([("k", pa.int32()), ("bucket", pa.int32()), ("ids", NUMBERS), ("weight", pa.binary())]))

    by = lambda df: df.repartition(facts.buckets, "k", "bucket").groupBy("k", "bucket")
    asked = grams.select("k", "bucket", "ids").mapInArrow(ask, "k int, of int, bucket int, ids array<binary>")
    answers = by(asked).cogroup(by(_tables(spark, path, facts, range(1, len(facts.d))))).applyInArrow(answer, "k int, bucket int, at int, n binary, total binary")
    write(by(grams).cogroup(by(answers)).applyInArrow(weigh, "k int, bucket int, ids array<binary>, weight binary"), "weights")


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_tokens`` and ``score`` (the log10 probability of the text) of every row."""
    spark, order = df.sparkSession, model.order
    known = spark.read.parquet(f"{model.path}/facts").first()
    facts, unknown = Facts(known["buckets"], known["bits"], known["total"], [list(x) for x in known["d"]]), model.unknown
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = rows.schema["id"].dataType
    kept, tokens = _blocks(rows)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // PART))
    by = lambda df, c: df.repartition(max(parts, facts.buckets) if c == "bucket" else parts, c).groupBy(c)

    def number(left: pa.Table, right: pa.Table) -> pa.Table:
        of = {}
        for words, ids in zip(right["words"].to_pylist(), right["ids"].to_pylist(), strict=True):
            of |= zip(zstandard.decompress(words).split(b" "), unpacked(ids)[0].tolist(), strict=True)
        back = [pack(np.array([of.get(w, UNKNOWN) for w in zstandard.decompress(x).split(b" ")], np.int64)) for x in left["words"].to_pylist()]
        return pa.table({"block": left["block"], "bucket": left["bucket"], "numbers": pa.array(back, pa.binary())})

    words = by(_words_sent(kept, facts.buckets).drop("n"), "bucket").cogroup(by(spark.read.parquet(f"{model.path}/words").select("bucket", "words", "ids"), "bucket"))
    numbered = stored(words.applyInArrow(number, "block long, bucket int, numbers binary"), "katz-words")

    def asking(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """N-grams whose context may have been seen, and which ones they are; a word that wasn't is none that a table ends in."""
        may = (ids[:-1] >= 0).all(axis=0)
        ids = ids[:, may]
        ids[-1] = np.where(ids[-1] >= 0, ids[-1], START)
        return ids, may

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        out = [{"block": row["block"]} | x for x in _sent(facts, asking(_texts(row, right, order)[1])[0])]
        return pa.Table.from_pylist(out, schema=pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("ids", NUMBERS)]))

    def answering(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def answer(left: pa.Table, right: pa.Table) -> pa.Table:
            table, n, total = _looked_up(facts, k, right.filter(pa.compute.is_valid(right["n"])))
            weights = right.filter(pa.compute.is_valid(right["weight"]))
            contexts, weight = joined([unpacked(x) for x in weights["ids"].to_pylist()], max(k - 1, 1)), flat(weights["weight"].to_pylist(), "<f8")
            asked = [unpacked(x) for x in left["ids"].to_pylist()]
            back: dict[str, list[bytes]] = {"n": [], "total": [], "weight": []}
            if asked:
                ids = joined(asked, k)
                places, ends = facts.places(table, ids), np.cumsum([x.shape[1] for x in asked])[:-1]
                lost, none = places < 0, np.full(ids.shape[1], np.nan)
                if k > 1 and lost.any():
                    # Contexts that weren't seen weigh one.
                    distinct, at, _ = facts.asked(ids[:-1, lost])
                    none[lost] = _at(weight, facts.places(contexts, distinct), 1.0)[at]
                for found, m, t, w in zip(np.split(places, ends), np.split(_at(n, places), ends), np.split(_at(total, places, 1), ends), np.split(none, ends), strict=True):
                    back["n"].append(pack(m))
                    back["total"].append(pack(t))
                    back["weight"].append(pack(w[found < 0]))
            return pa.table({"block": left["block"], "bucket": left["bucket"], **{c: pa.array(x, pa.binary()) for c, x in back.items()}})

        return answer

    def settled(k: int, row: dict, text: np.ndarray, ids: np.ndarray, value: np.ndarray, found: pa.Table) -> pa.Table:
        """The block with what its n-grams of order k give; tokens that weren't found go on."""
        found = found.sort_by("bucket")
        open_, may = asking(ids)
        _, at, _ = facts.asked(open_)
        n, total = flat(found["n"].to_pylist(), "<i8"), flat(found["total"].to_pylist(), "<i8")
        weight = np.ones(len(n))
        weight[n == 0] = flat(found["weight"].to_pylist(), "<f8") if k > 1 else unknown
        p = np.log10(np.where(n > 0, facts.kept(k, n) / total, weight))[at]
        value = value + np.bincount(text[may], p, len(value))
        out = {"block": row["block"], "ids": row["ids"], "lens": row["lens"], "value": value.tolist(), "open": [], "misses": []}
        if k > 1:
            lost = ~may
            lost[may] = n[at] == 0
            text, ids = text[lost], ids[1:, lost]
            out |= {"open": packed(np.stack([text, *ids])), "misses": _sent(facts, asking(ids)[0])}
        return pa.Table.from_pylist([out], schema=state)

    state = pa.schema(
        [("block", pa.int64()), ("ids", pa.list_(to_arrow_type(id_type))), ("lens", pa.list_(pa.int64())), ("value", pa.list_(pa.float64())), ("open", NUMBERS)]
        + [("misses", pa.list_(pa.struct([("bucket", pa.int32()), ("ids", NUMBERS)])))]
    )
    ddl = f"block long, ids array<{id_type.simpleString()}>, lens array<long>, value array<double>, open array<binary>, misses array<struct<bucket:int,ids:array<binary>>>"

    def begin(left: pa.Table, right: pa.Table) -> pa.Table:
        row, first = left.to_pylist()[0], pa.compute.is_valid(right["numbers"])
        text, ids = _texts(row, right.filter(first), order)
        return settled(order, row, text, ids, np.zeros(len(row["lens"])), right.filter(pa.compute.invert(first)))

    def going_on(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        def go(left: pa.Table, right: pa.Table) -> pa.Table:
            row = left.to_pylist()[0]
            held = unpacked(row["open"])
            return settled(k, row, held[0], held[1:], np.array(row["value"]), right)

        return go

    asked = by(kept.select("block", "lens", "tokens", "ids"), "block").cogroup(by(numbered, "block")).applyInArrow(ask, "block long, bucket int, ids array<binary>")
    met = None
    for k in range(order, 0, -1):
        table = _tables(spark, model.path, facts, range(k, k + 1)).select("bucket", "ids", "n", "total", F.lit(None).cast("binary").alias("weight"))
        if k > 1:
            weights = spark.read.parquet(f"{model.path}/weights").filter(F.col("k") == k)
            table = table.unionByName(weights.select("bucket", "ids", F.lit(None).cast("binary").alias("n"), F.lit(None).cast("binary").alias("total"), "weight"))
        found = by(asked, "bucket").cogroup(by(table, "bucket")).applyInArrow(answering(k), "block long, bucket int, n binary, total binary, weight binary")
        if met is None:
            found = numbered.unionByName(found, allowMissingColumns=True)
            met = by(kept.select("block", "lens", "tokens", "ids"), "block").cogroup(by(found, "block")).applyInArrow(begin, ddl)
        else:
            met = by(met, "block").cogroup(by(found, "block")).applyInArrow(going_on(k), ddl)
        if k > 1:
            met = stored(met, "katz-met")
            asked, met = met.select("block", F.inline("misses")), met.drop("misses")
    each = met.select(F.inline(F.arrays_zip("ids", "lens", "value")))
    return each.select(F.col("ids").alias(id_col), F.col("lens").alias("n_tokens"), F.col("value").alias("score"))
