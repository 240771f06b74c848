"""Byte-level BPE by overlapping chunks.

A long text is cut into chunks of ``CHUNK`` code points, each reading ``OVERLAP`` code points
into the next. Chunks are pre-tokenised in parallel. Where the boundaries of two neighbours
meet inside the overlap (after a character that isn't white space), the pre-tokens of both
agree from there on, so the text is cut there; where they never meet, the neighbours are
joined and treated as one. The pieces between cuts hold whole pre-tokens and are encoded on
their own, in parallel; a document's ids are the pieces' ids in order, and decoding
concatenates the raw bytes of the ids. Texts of one chunk are encoded where they are read.

Cases: a null text is the empty text (no ids); repeated rows each get the same result; an
empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import BINARY, bounded_batches, with_columns

CHUNK = 16_384
OVERLAP = 512
#: Chunks that are cut from one part of a text.
SPAN = 64
#: Bytes of a pre-token that is scanned for its best pair, and a rank that no pair has.
SHORT, NEVER = 128, 1 << 62
#: Boundaries this near to a chunk's end may depend on what follows.
MARGIN = 4
#: Distinct pre-tokens whose ids a worker process remembers.
CACHE = 600_000
#: Ids of pre-tokens by vocabulary and pattern; a worker process keeps them from task to task.
_KNOWN: dict[tuple[str, str], dict[str, bytes]] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of the lowest rank merges first, the leftmost of equals.

    Short pre-tokens are scanned; longer ones use a heap of candidate pairs over linked parts,
    so that they cost n log n.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n <= SHORT:
        starts, get = list(range(n + 1)), ranks.get
        pairs = [get(piece[i : i + 2], NEVER) for i in range(n - 1)]
        while pairs and (best := min(pairs)) != NEVER:
            i = pairs.index(best)
            del starts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(piece[starts[i] : starts[i + 2]], NEVER)
            if i:
                pairs[i - 1] = get(piece[starts[i - 1] : starts[i + 1]], NEVER)
        return [ranks[piece[a:b]] for a, b in pairwise(starts)]
    ends, nexts, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = nexts[i] if ends[i] else n
        if j >= n or ends[j] != end:
            continue
        k = nexts[j]
        ends[i], nexts[i], ends[j] = end, k, 0
        if k < n:
            before[k] = i
            if (rank := ranks.get(piece[i : ends[k]])) is not None:
                heapq.heappush(heap, (rank, i, ends[k]))
        if (h := before[i]) >= 0 and (rank := ranks.get(piece[h:end])) is not None:
            heapq.heappush(heap, (rank, h, end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : ends[i]]])
        i = nexts[i]
    return ids


def encoder(ranks: dict[bytes, int], pattern: str, vocabulary: str | None = None) -> Callable[[str], bytes]:
    """From a text to its ids as little-endian unsigned 32-bit integers.

    Encoders of the same ``vocabulary`` in one process share what they remember.
    """
    find, cache = regex.compile(pattern).findall, {} if vocabulary is None else _KNOWN.setdefault((vocabulary, pattern), {})

    def encode(text: str) -> bytes:
        words = find(text)
        try:
            return b"".join(map(cache.__getitem__, words))
        except KeyError:
            pass
        if len(cache) > CACHE:
            cache.clear()
        for word in set(words).difference(cache):
            ids = merge(word.encode(), ranks)
            cache[word] = struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(cache.__getitem__, words))

    return encode


def decoder(ranks: dict[bytes, int]) -> Callable[[bytes], bytes]:
    """From packed ids to the raw bytes of their tokens."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token

    return lambda ids: b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def boundaries(text: str, pattern: regex.Pattern, first: int, last: bool) -> list[int]:
    """Where pre-tokens begin after a character that isn't white space, counted from ``first``."""
    stop = len(text) if last else len(text) - MARGIN
    return [first + i for m in pattern.finditer(text) if 0 < (i := m.start()) < stop and not text[i - 1].isspace()]


def pieces(long_texts: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of whole pre-tokens: ``key``, ``part``, ``id``, ``n_rows`` and ``piece``.

    ``long_texts`` has ``key``, ``id`` and ``text``; the ``n_rows`` rows of one key have one id
    and text, which is worked on once.
    """
    spark = long_texts.sparkSession
    size = F.length("text")
    # Cut in two steps, as a substring is searched from the start of what it is cut from.
    span = SPAN * chunk
    cut = long_texts.select("key", "id", "text", size.alias("size"), F.explode(F.sequence(F.lit(0), F.floor((size - 1) / span).cast("int"))).alias("b"))
    cut = cut.select("key", "id", "size", "b", F.substring("text", F.col("b") * span + 1, F.lit(span + overlap)).alias("text"))
    ends = F.least(F.lit(SPAN), F.ceil((F.col("size") - F.col("b") * span) / chunk)).cast("int")
    cut = cut.select("key", "id", "size", "b", "text", F.explode(F.sequence(F.lit(0), ends - 1)).alias("j")).withColumn("i", F.col("b") * SPAN + F.col("j"))
    cut = cut.select("key", "id", "i", (F.col("size") <= (F.col("i") + 1) * chunk).alias("last"), F.substring("text", F.col("j") * chunk + 1, F.lit(chunk + overlap)).alias("chunk"))
    # Chunks, not texts, are dealt out: one long text occupies many tasks, a repeated one counts once.
    cut = cut.groupBy("key", "i").agg(*(F.first(c).alias(c) for c in ("id", "last", "chunk")), F.count("*").alias("n_rows"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for i, last, text in zip(batch["i"].to_pylist(), batch["last"].to_pylist(), batch["chunk"].to_pylist(), strict=True):
                at = boundaries(text, find, i * chunk, last or len(text) < chunk + overlap)
                heads.append([x for x in at if x < i * chunk + overlap])
                tails.append([x for x in at if x >= (i + 1) * chunk])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))], names=[*batch.schema.names, "head", "tail"])

    id_type = long_texts.schema["id"].dataType.simpleString()
    bounded_batches(spark)
    met = cut.mapInArrow(meet, f"key string, i int, id {id_type}, last boolean, chunk string, n_rows long, head array<int>, tail array<int>")
    order = W.partitionBy("key").orderBy("i")
    met = met.select("key", "i", "id", "n_rows", "chunk", F.array_min(F.array_intersect("tail", F.lead("head").over(order))).alias("end"))
    met = met.withColumn("begin", F.when(F.col("i") == 0, F.lit(0)).otherwise(F.lag("end").over(order)))
    # A chunk whose begin is unknown belongs to the piece of the chunk before it.
    met = met.withColumn("part", F.sum(F.col("begin").isNotNull().cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    met = met.withColumn("at", F.col("i") * chunk)
    from_ = F.coalesce("begin", "at") - F.col("at")
    upto = F.coalesce("end", F.when(F.lead("i").over(order).isNotNull(), F.col("at") + chunk)) - F.col("at")
    text = F.when(upto.isNull(), F.substr("chunk", from_ + 1)).otherwise(F.substr("chunk", from_ + 1, upto - from_))
    met = met.select("key", "part", "id", "n_rows", F.struct("i", text.alias("t")).alias("t"))
    joined = met.groupBy("key", "part").agg(F.sort_array(F.collect_list("t")).alias("t"), F.first("id").alias("id"), F.first("n_rows").alias("n_rows"))
    return joined.select("key", "part", "id", "n_rows", F.array_join(F.transform("t", lambda x: x["t"]), "").alias("piece"))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def _split(df: DataFrame, id_col: str, text_col: str, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Rows of one chunk, and longer ones with a ``key`` of id and text."""
    rows = _rows(df, id_col, text_col)
    key = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.sha2("text", 256))
    return rows.filter(F.length("text") <= chunk), rows.filter(F.length("text") > chunk).withColumn("key", key)


def _encoded(df: DataFrame, ranks, ranks_path: str, pattern: str) -> DataFrame:
    """``df`` with ``ids`` (packed) in place of ``text``."""

    def start():
        encode_one = encoder(ranks.value, pattern, ranks_path)
        return lambda texts: [[encode_one(t or "") for t in texts]]

    return with_columns(df, "text", {"ids": BINARY}, start).drop("text")


def encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Ids of every row: id and ``ids`` (packed), whole texts."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    short, long = _split(df, id_col, text_col, chunk)
    parts = _encoded(pieces(long, pattern, chunk, overlap).withColumnRenamed("piece", "text"), ranks, ranks_path, pattern)

    def gather(rows: pa.Table) -> pa.Table:
        ids = b"".join(rows.sort_by("part")["ids"].to_pylist())
        return pa.table({"id": rows["id"][:1], "n_rows": rows["n_rows"][:1], "ids": pa.array([ids], pa.binary())})

    id_type = parts.schema["id"].dataType.simpleString()
    whole = parts.groupBy("key").applyInArrow(gather, f"id {id_type}, n_rows long, ids binary")
    # A repeated row gets the ids of its text once more.
    done = whole.select(F.explode(F.array_repeat("id", F.col("n_rows").cast("int"))).alias("id"), "ids")
    return _encoded(short, ranks, ranks_path, pattern).unionByName(done).withColumnRenamed("id", id_col)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the raw bytes of the ids' tokens; null ids have none."""
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def start():
        decode_one = decoder(ranks.value)
        return lambda values: [[decode_one(x or b"") for x in values]]

    return with_columns(df, ids_col, {"decoded": BINARY}, start, kind="binary")


def digests(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row for each input row: id, n_tokens, ids_sha256, decoded_sha256."""
    done = decode(encode(df, ranks_path, pattern, id_col, text_col, chunk, overlap), ranks_path)
    return done.select(id_col, (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
