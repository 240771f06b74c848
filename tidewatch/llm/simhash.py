"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most four bits agree in at least four of their
eight bytes. Each distinct fingerprint is posted under every set of ``BLOCK`` (position, byte)
pairs; two that share as many meet in a list, and are counted there at the first of their common
postings. The tally of all positions with the same byte has to reach four; pairs that do are
verified by their differing bits. With single positions a list would hold 1/256 of all
fingerprints; sets of three make that 1/2^24 (``block=4``: 1/2^32, for far over 10^8 fingerprints).
Equal fingerprints count as one from the start, so copies make no pairs.

Within a list, members are first compared with its smallest one. Only lists that hold more than
one component after that are paired, and only members of different components; the pairs of a
long list are dealt to cells, of two components one link is kept. The components are those of
all pairs at any list length.

Links join into components by large-star and small-star rounds over tables in the shared
folder.

Cases: a null text has no words (fingerprint zero, linked like any other); rows with a null
id get the component of their fingerprint; a component without any id has a null id; repeated
rows each get the same result; texts of any length are hashed whole, 65,536 shingles at a time; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import LONG, stored, with_columns

SHINGLE = 4
SEED = 42
BITS = 4
#: Positions of a pair's bytes that agree at least.
SHARED = 8 - BITS
#: Positions of a posting, and members of a list that one cell of its pairs holds.
BLOCK, CELL = 3, 512
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed number."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE, len(words))
    tally, n = np.zeros(64, np.int64), len(words) - k + 1
    digest, spans = xxhash.xxh64_intdigest, list(zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True))
    for a in range(0, n, 1 << 16):
        h = np.array([digest(joined[x:y], SEED) for x, y in spans[a : a + (1 << 16)]], "<u8")
        tally += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(tally * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint_of(hashes: np.ndarray) -> int:
    """The 64-bit SimHash of 64-bit hashes, as a signed number; 0 of none."""
    tally = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[a : a + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        tally += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(tally * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """id, ``fp`` (signed) and the columns ``more`` of every row."""

    def start():
        return lambda texts: [[fingerprint(t) for t in texts]]

    return with_columns(df.select(id_col, text_col, *more), text_col, {"fp": LONG}, start).select(id_col, "fp", *more)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def postings(fp: Column, block: int = BLOCK) -> Column:
    """The postings of a fingerprint: key, set of positions (a bit for each) and the positions up to the set's last."""
    made = []
    for chosen in combinations(range(8), block):
        mask = _signed(sum(0xFF << (8 * i) for i in chosen))
        at = sum(1 << i for i in chosen)
        made.append(F.struct(F.xxhash64(F.lit(at), fp.bitwiseAND(F.lit(mask))).alias("key"), F.lit(at).cast("short").alias("at"), F.lit((2 << chosen[-1]) - 1).cast("short").alias("upto")))
    return F.array(*made)


def same_positions(a: Column, b: Column) -> Column:
    """A bit for each position at which two fingerprints have the same byte."""
    x = a.bitwiseXOR(b)
    same = [F.when(x.bitwiseAND(F.lit(_signed(0xFF << (8 * i)))) == 0, 1 << i).otherwise(0) for i in range(8)]
    return sum(same[1:], same[0])


def _linked(a: Column, b: Column) -> Column:
    """The tally of shared bytes reaches the minimum, and the bits differ little."""
    return (F.bit_count(same_positions(a, b)) >= SHARED) & (F.bit_count(a.bitwiseXOR(b)) <= BITS)


def links(distinct: DataFrame, block: int = BLOCK, cell: int = CELL) -> DataFrame:
    """Links (a, b), a > b, that connect the distinct fingerprints ``fp`` within ``BITS`` bits as all pairs would."""
    spread = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posted = distinct.repartition(spread).select("fp", F.inline(postings(F.col("fp"), block))).repartition("key")
    lists = posted.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("least")).filter("n > 1")
    shared = stored(posted.join(lists, "key"), "simhash-lists")
    stars = shared.filter(F.col("fp") > F.col("least")).filter(_linked(F.col("fp"), F.col("least")))
    stars = stored(stars.select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct(), "simhash-stars")
    # Lists whose members are one component by now have nothing more to tell.
    rooted = shared.select("key", "fp", "at", "upto", "n").join(components(stars), F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).drop("node")
    rooted = stored(rooted, "simhash-rooted")
    split = rooted.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("key")
    rooted = rooted.join(split, "key", "left_semi").withColumn("parts", F.ceil(F.col("n") / cell))
    rooted = stored(rooted, "simhash-split")
    left = rooted.select("key", "at", "upto", F.pmod(F.xxhash64("fp"), "parts").alias("part"), F.col("fp").alias("a"), F.col("root").alias("root_a"))
    right = rooted.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("fp").alias("b"), F.col("root").alias("root_b"), F.col("at").alias("at_b"))
    a, b = F.col("a"), F.col("b")
    # A pair counts at the first of its common postings only.
    first = same_positions(a, b).bitwiseAND(F.col("upto")) == F.col("at")
    met = left.join(right, ["key", "part"]).filter((a > b) & (F.col("root_a") != F.col("root_b")) & (F.col("at") == F.col("at_b")) & first & _linked(a, b))
    # One link of two components says what all their links do.
    bridges = met.groupBy(F.least("root_a", "root_b").alias("x"), F.greatest("root_a", "root_b").alias("y")).agg(F.min(F.struct("a", "b")).alias("l"))
    return stars.unionByName(bridges.select("l.a", "l.b"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) of every node of ``edges`` (a, b)."""
    edges = stored(edges.select("a", "b"), "star-links")
    last, held = None, -1
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = stored(large, "star-links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("b", "m").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        edges = stored(small, "star-links")
        n = edges.count()
        if n == held and edges.join(last, ["a", "b"], "left_anti").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        last, held = edges, n


def _rooted(prints: DataFrame) -> DataFrame:
    """``prints`` (with ``fp``) with ``root``, one for each component."""
    distinct = stored(prints.select("fp").distinct(), "simhash-distinct")
    roots = components(links(distinct))
    return prints.join(roots, F.col("fp") == F.col("node"), "left").drop("node").withColumn("root", F.coalesce("root", "fp"))


def text_key(text_col: str) -> Column:
    """A hash that tells texts apart; null is the empty text."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def members(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``#own`` (key of the text) and ``root`` (one for each component) of every row."""
    prints = stored(fingerprints(df.select(id_col, text_col, text_key(text_col).alias("#own")), id_col, text_col, "#own"), "simhash-prints")
    return _rooted(prints).select(id_col, "#own", "root")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``fingerprint`` (hexadecimal) and ``component_id`` of every row."""
    prints = stored(fingerprints(df, id_col, text_col), "simhash-prints")
    rooted = stored(_rooted(prints.groupBy("fp").agg(F.min(id_col).alias("first_id"))), "simhash-roots")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: Callable[..., DataFrame] = members) -> DataFrame:
    """``df`` with one row of each component of ``groups``: that of the smallest id, and of the rows of that id, of the smallest ``text_key``.

    A row without an id stays only where its component has no row with one. Of rows of the same id and text one stays.
    """
    found = groups(df, id_col, text_col).select("root", F.col(id_col).alias("#id"), "#own").groupBy("root", "#id", "#own").agg(F.count("*").alias("#n"))
    least = found.groupBy("root").agg(F.min(F.struct(F.col("#id").isNull().alias("none"), "#id", "#own", "#n")).alias("x"))
    first = stored(least.select("x.#id", "x.#own", "x.#n"), "simhash-found")
    rows = df.withColumn("#key", text_key(text_col))
    kept = rows.join(first, F.col(f"`{id_col}`").eqNullSafe(F.col("#id")) & (F.col("#key") == F.col("#own"))).drop("#id", "#own")
    if first.filter("`#n` > 1").isEmpty():
        return kept.drop("#key", "#n")
    once, more = kept.filter("`#n` = 1"), kept.filter("`#n` > 1").dropDuplicates([id_col, "#key"])
    return once.unionByName(more).drop("#key", "#n")
