"""Near copies: all pairs of texts whose sets of five-word shingles have Jaccard similarity 0.8 or more.

First come SimHash fingerprints of the sets, in the inverted index of byte positions of ``simhash``: pairs that share bytes at enough positions
and differ in few bits are verified on the whole sets. No set of byte positions covers that similarity (such pairs differ in
about ten bits, often in all eight bytes), so a second index is on the shingles themselves; it verifies only pairs that fingerprints haven't joined. Two sets
with that similarity share at least four fifths of each; in any order that all sets follow,
each set's first n - ceil(4n/5) + 1 shingles therefore hold a common one. Those are posted with their place, which tells
how many more two sets can share from there on. The order puts frequent shingles last: those frequent in a sample,
and, in up to ``ROUNDS`` rounds, those whose lists still join many components; only the sets that post such a shingle are posted anew.
The order decides what the index costs; whatever it is, every pair meets.

Each set has a sketch of a bit for each of its shingles, or up to two: the parity of the shingles that fall there. Bits that
differ are shingles that only one of two sets has, and similar sets have few. Pairs that pass are verified on the whole sets.

Equal sets count as one from the start. The members of a list are first compared with its
smallest one; only those that are in different components afterwards are compared in pairs,
which gives the components of all pairs. Long lists are dealt to cells by size and by hash, so a
task pairs at most ``CELL`` members of one cell with all of a list.

Cases: upper-case ASCII letters count as lower-case; a text of fewer than five words has one
shingle; null and blank texts have none and are one component; rows with a null id get the
component of their set; a component without any id has a null id; texts of any length are used whole; repeated rows each get the
same result; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import simhash
from tidewatch.llm.common import INT, LONG, drawn, stored, with_columns
from tidewatch.llm.simhash import LOWER, WORD, components, text_key

SHINGLE = 5
#: The least similarity is PART / WHOLE.
PART, WHOLE = 4, 5
SEED = 42
#: Documents of the sample for frequent shingles, the least count there, and how many are kept.
SAMPLE, FREQUENT, MOST = 5_000, 3, 100_000
#: Components that one list may join before its shingle goes last, and rounds of that.
JOINED, ROUNDS = 1_000, 3
#: Members of a list that one cell holds, and from how many on lists are parted by size.
CELL, BY_SIZE = 512, 64
LONGS = (T.ArrayType(T.LongType()), pa.list_(pa.int64()))


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order."""
    words = WORD.findall((text or "").encode().translate(LOWER))
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(SHINGLE, len(words))
    digest, n = xxhash.xxh64_intdigest, len(words) - k + 1
    spans = zip(starts[:n].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[x:y], SEED) for x, y in spans), np.uint64, n).view(np.int64))


def prefix_length(n: int) -> int:
    """How many of n shingles are posted."""
    return n - -(-n * PART // WHOLE) + 1 if n else 0


def frequent(df: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Shingles that are frequent in a bounded sample, in order. They decide what the index costs, not what it finds."""
    sample = drawn(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"], SAMPLE).select(F.col("text").alias(text_col))

    def start():
        return lambda texts: [[shingles(t) for t in texts]]

    counts = with_columns(sample, text_col, {"s": LONGS}, start).select(F.explode("s").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    top = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "s").limit(MOST)
    return np.sort(np.array([r["s"] for r in top.select("s").collect()], np.int64))


def node_of(x: np.ndarray) -> int:
    """A hash of a set."""
    return xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63)


def sketch(x: np.ndarray) -> np.ndarray:
    """The parities of a set's shingles in as many cells as it has shingles, rounded up to a power of two from 64 on."""
    cells = max(64, 1 << (len(x) - 1).bit_length()) if len(x) else 64
    odd = np.bincount(x & (cells - 1), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def postings(df: DataFrame, id_col: str, text_col: str, last: np.ndarray) -> DataFrame:
    """id, ``#own`` (key of the text), ``node`` (hash of the set), ``n`` (its size), ``sketch``, ``fp`` (its fingerprint) and ``keys`` (the shingles that are posted, in order) of every row.

    ``last`` are the shingles that go last.
    """
    shared = df.sparkSession.sparkContext.broadcast(last)  # at most MOST for the sample and for each round

    def start():
        last = shared.value

        def apply(texts: list) -> list:
            made = [shingles(t) for t in texts]
            nodes, sizes, bits, prints = [node_of(x) for x in made], [len(x) for x in made], [sketch(x) for x in made], [simhash.fingerprint_of(x) for x in made]
            if len(last):
                late = [last[np.minimum(np.searchsorted(last, x), len(last) - 1)] == x for x in made]
                made = [np.concatenate([x[~y], x[y]]) for x, y in zip(made, late, strict=True)]
            return [nodes, sizes, bits, prints, [x[: prefix_length(len(x))] for x in made]]

        return apply

    rows = df.select(id_col, text_col, text_key(text_col).alias("#own"))
    return with_columns(rows, text_col, {"node": LONG, "n": INT, "sketch": LONGS, "fp": LONG, "keys": LONGS}, start).select(id_col, "#own", "node", "n", "sketch", "fp", "keys")


def sets(texts: DataFrame, text_col: str) -> DataFrame:
    """``node`` and ``shingles`` of the distinct sets of texts."""

    def start():
        def apply(values: list) -> list:
            made = [shingles(t) for t in values]
            return [[node_of(x) for x in made], made]

        return apply

    return with_columns(texts.select(text_col), text_col, {"node": LONG, "shingles": LONGS}, start).select("node", "shingles").dropDuplicates(["node"])


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * WHOLE >= F.greatest(a, b) * PART


def _places_allow(n_a: Column, at_a: Column, n_b: Column, at_b: Column) -> Column:
    """Whether two sets whose first common shingle has these places can share as much as similar sets do."""
    return F.least(n_a - at_a, n_b - at_b) * (PART + WHOLE) >= (n_a + n_b) * PART


def _folded(bits: Column, size: Column) -> Column:
    """A sketch in ``size`` words, half of what it has or all."""
    half = F.zip_with(F.slice(bits, F.lit(1), size), F.slice(bits, size + 1, size), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(bits) > size, half).otherwise(bits)


def _likely(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of similar sizes whose sketches differ in no more bits than similar sets have shingles of their own.

    Every differing bit is a shingle that only one set has, so no similar pair is lost. Sizes differ by a
    quarter at most, so one sketch is as long as the other or twice as long.
    """
    left, right = (heads.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
    size = F.least(F.size("sa"), F.size("sb"))
    apart = F.aggregate(F.zip_with(_folded(F.col("sa"), size), _folded(F.col("sb"), size), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)
    near = apart * (PART + WHOLE) <= (F.col("na") + F.col("nb")) * (WHOLE - PART)
    return pairs.join(left, "a").join(right, "b").filter(near).select("a", "b")


def _whole(pairs: DataFrame, rows: DataFrame, df: DataFrame, text_col: str) -> DataFrame:
    """The whole sets of the nodes of ``pairs``, made of their texts."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    met = stored(rows.join(nodes, "node", "left_semi").select("#own").distinct(), "copies-met")
    return stored(sets(df.select(text_col, text_key(text_col).alias("#own")).join(met, "#own", "left_semi"), text_col), "copies-sets")


def _verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose sets are similar enough."""
    left, right = (whole.select(F.col("node").alias(c), F.col("shingles").alias(f"#{c}")) for c in "ab")
    both = F.size(F.array_intersect("#a", "#b"))
    return pairs.join(left, "a").join(right, "b").filter(both * (PART + WHOLE) >= (F.size("#a") + F.size("#b")) * PART).select("a", "b")


def _size_class(n: Column) -> Column:
    """Similar sets are of one class or of neighbours."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.log(F.lit(WHOLE / PART))).cast("int")


def _paired(split: DataFrame) -> DataFrame:
    """Pairs (a, b), a > b, of the members of each list that are in different components and may be similar."""
    parts, by_size = F.ceil(F.col("m") / CELL), F.col("m") > BY_SIZE
    left = split.select("key", F.pmod(F.xxhash64("node"), parts).alias("part"), F.when(by_size, _size_class(F.col("n"))).otherwise(0).alias("class"), *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "at", "root")))
    near = F.when(by_size, F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: d + _size_class(F.col("n")))).otherwise(F.array(F.lit(0)))
    right = split.select("key", near.alias("classes"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"), *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "at", "root")))
    right = right.select("*", F.explode("classes").alias("class")).drop("classes")
    met = (F.col("node_a") > F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & _sizes_allow(F.col("n_a"), F.col("n_b")) & _places_allow(*(F.col(c) for c in ("n_a", "at_a", "n_b", "at_b")))
    return left.join(right, ["key", "part", "class"]).filter(met).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _again(rows: DataFrame, long: DataFrame, df: DataFrame, id_col: str, text_col: str, last: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """``rows`` with the sets that post a shingle of the ``MOST`` longest lists posted anew, these shingles last."""
    found = np.array([r["key"] for r in long.orderBy(F.desc("roots"), "key").limit(MOST).select("key").collect()], np.int64)
    last = np.union1d(last, found)
    keys = df.sparkSession.createDataFrame([(int(k),) for k in found], "key long")
    touched = stored(rows.select("#own", F.explode("keys").alias("key")).join(keys, "key", "left_semi").select("#own").distinct(), "copies-touched")
    texts = df.withColumn("#own", text_key(text_col)).join(touched, "#own", "left_semi").select(id_col, text_col)
    return stored(rows.join(touched, "#own", "left_anti").unionByName(postings(texts, id_col, text_col, last)), "copies-rows"), last


def fingerprint_links(rows: DataFrame, df: DataFrame, text_col: str) -> DataFrame:
    """Links (a, b), a > b, of similar sets of ``rows`` (``postings`` of ``df``) that fingerprints find.

    A set is compared with the smallest one of its fingerprint, and these are compared where their fingerprints are linked.
    """
    heads = stored(rows.select("node", "n", "sketch", "fp").dropDuplicates(["node"]), "copies-prints")
    first = stored(heads.groupBy("fp").agg(F.min("node").alias("first")), "copies-first")
    same = heads.join(first, "fp").filter("node > first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    met = simhash.links(first.select("fp"))
    for c in "ab":
        met = met.withColumnRenamed(c, "fp").join(first, "fp").select(F.col("first").alias(f"#{c}"), *(x for x in met.columns if x != c))
    near = met.select(F.greatest("#a", "#b").alias("a"), F.least("#a", "#b").alias("b"))
    likely = stored(_likely(same.unionByName(near).distinct(), heads), "copies-likely")
    return stored(_verified(likely, _whole(likely, rows, df, text_col)), "copies-known")


def links(rows: DataFrame, df: DataFrame, text_col: str, id_col: str = "doc_id", last: np.ndarray | None = None, known: DataFrame | None = None) -> DataFrame:
    """Links (a, b), a > b, that connect the nodes of ``rows`` (``postings`` of ``df``) as all similar pairs would; ``known`` are links that were found before."""
    heads = stored(rows.select("node", "n", "sketch").dropDuplicates(["node"]), "copies-heads")
    last = np.zeros(0, np.int64) if last is None else last
    joined = None if known is None else stored(components(known), "copies-joined")
    for left in range(ROUNDS, -1, -1):
        posted = rows.select("node", "n", F.posexplode("keys").alias("at", "key"))
        posted = posted.repartition("key").dropDuplicates(["key", "node"])
        lists = posted.groupBy("key").agg(F.min(F.struct("node", "n", "at")).alias("least"), F.count("*").alias("m")).filter("m > 1")
        lists = stored(posted.join(lists, "key"), "copies-lists")
        may = _sizes_allow(F.col("n"), F.col("least.n")) & _places_allow(F.col("n"), F.col("at"), F.col("least.n"), F.col("least.at"))
        least = lists.filter((F.col("node") > F.col("least.node")) & may)
        stars = least.select(F.col("node").alias("a"), F.col("least.node").alias("b")).distinct()
        if joined is not None:
            for c in "ab":
                stars = stars.join(joined.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
            stars = stars.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
        stars = stored(_likely(stars, heads), "copies-stars")
        first = _verified(stars, _whole(stars, rows, df, text_col))
        first = stored(first if known is None else first.unionByName(known), "copies-links")
        roots = stored(components(first), "copies-components")
        rooted = stored(lists.select("key", "node", "n", "at", "m").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "copies-rooted")
        several = rooted.groupBy("key", "root").agg(F.count("*").alias("members")).groupBy("key").agg(F.count("*").alias("roots")).filter("roots > 1")
        several = stored(several, "copies-several")
        long = several.filter(F.col("roots") > JOINED)
        if not left or long.isEmpty():
            break
        rows, last = _again(rows, long, df, id_col, text_col, last)
    split = stored(rooted.join(several.select("key"), "key", "left_semi"), "copies-split")
    pairs = _paired(split).join(stars, ["a", "b"], "left_anti")
    pairs = stored(_likely(pairs, heads), "copies-pairs")
    return first.unionByName(_verified(pairs, _whole(pairs, rows, df, text_col)))


def members(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``#own`` and ``root`` (one for each component) of every row."""
    last = frequent(df, id_col, text_col)
    rows = stored(postings(df, id_col, text_col, last), "copies-rows")
    known = fingerprint_links(rows, df, text_col)
    roots = stored(components(links(rows, df, text_col, id_col, last, known)), "copies-components")
    return rows.select(id_col, "#own", "node").join(roots, "node", "left").select(id_col, "#own", F.coalesce("root", "node").alias("root"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``component_id`` (the smallest id of the component) of every row."""
    found = stored(members(df, id_col, text_col), "copies-roots")
    ids = found.groupBy("root").agg(F.min(id_col).alias("component_id"))
    return found.select(id_col, "root").join(ids, "root").select(id_col, "component_id")
