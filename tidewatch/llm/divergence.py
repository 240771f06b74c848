"""Audit of sources: how far the words of each source lie from those of its language's others.

Terms are runs of letters beyond ASCII's other characters, only A-Z lower-cased. Tasks count them
with Arrow: ``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode`` and hash ``group_by`` over each
batch, then over the batches held, give partial counts by (language, source, term). Spark
merges those; a language keeps the terms that ``MIN_DOCS`` of its documents have. The kept counts are
dealt by term into columnar shards of about ``SHARD`` counts. A shard meets the totals of all sources of its
language, smooths counts to integer shares of ``SCALE`` and returns its part of each pair's divergence
and its best terms of each source; sums over shards and a bounded rank finish both.

All arithmetic is on integers. Two sources' divergence is the sum of the absolute differences of their
shares; a term of a source stands out by how much its share is above the language's.

Bounds: a task holds ``HELD`` partial counts, one batch and one text; a shard its counts and a square
of the language's sources. Nothing is sent to the driver. A very common term is one partial count for each task
and source; a source with most documents is spread over all shards.

Cases: null texts, languages and sources are empty strings, a group like any other; a text without
terms still makes its group appear; a language without kept terms has pairs of divergence 0 and
no terms; a language of one source has no pairs; repeated rows each count; ties go to the
item that is first in UTF-8 order; texts of any length are counted whole, very long ones in slices that end at a separator; an empty
table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, stored

#: What parts terms, once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x60\x7B-\x7F]+"
#: Documents of a language that have a kept term at least; the scale of shares and what is added to a count.
MIN_DOCS, SCALE, ADDED = 30, 1_000_000_000, 5
#: Best terms of a source that are returned.
TOP = 50
#: Partial counts that a task holds before it merges them, counts of a shard, cells of a dense block, bytes of a slice.
HELD, SHARD, BLOCK, SLICE = 1_000_000, 1 << 16, 1 << 20, 8 << 20
_SLICE_END = re.compile(r"[\x00-\x40\x5B-\x60\x7B-\x7F]")
#: SCALE is FIRST * SECOND; in two steps no product leaves 64 bits while totals are under LARGEST.
FIRST, SECOND, LARGEST = 31_250, 32_000, 280_000_000_000_000


def shares(count: np.ndarray, total: np.ndarray | int, terms: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms)), exactly."""
    a, d = np.asarray(count) + ADDED, np.asarray(total) + ADDED * np.asarray(terms)
    if a.size and max(int(a.max()), int(d.max())) >= LARGEST:
        a, d = a.astype(object), d.astype(object)
    whole, rest = a * FIRST // d, a * FIRST % d
    return (1 + whole * SECOND + rest * SECOND // d).astype(np.int64)


def _slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """The texts with the row of each, in arrays of about ``SLICE`` bytes; longer texts are cut at separators."""
    if texts.nbytes <= 2 * SLICE:
        yield np.arange(len(texts)), texts
        return
    for row, text in enumerate(texts):
        text, at = text.as_py(), 0
        while at < len(text):
            end = _SLICE_END.search(text, at + SLICE)
            to = end.start() if end else len(text)
            yield np.array([row]), pa.array([text[at:to]], texts.type)
            at = to


def _by_document(rows: np.ndarray, texts: pa.Array) -> pa.Table:
    """``row``, ``term`` and ``n`` of the terms of texts."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    terms = pc.list_flatten(lists)
    full = pc.greater(pc.binary_length(terms), 0)
    owner = pa.array(rows).take(pc.list_parent_indices(lists).filter(full))
    coded = terms.filter(full).dictionary_encode()
    counted = pa.table({"row": owner, "code": coded.indices}).group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    return pa.table({"row": counted["row"], "term": coded.dictionary.take(counted["code"].combine_chunks()), "n": counted["count_all"]})


def _merged(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    """The tables as one, with ``n`` (and ``docs``) summed by ``keys``."""
    sums = [c for c in ("n", "docs") if c in tables[0].column_names]
    got = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(c, "sum") for c in sums])
    return got.rename_columns([c.removesuffix("_sum") for c in got.column_names])


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Counts of a batch by (lang, source, term), and a row with a null term for each group."""
    parts = [_by_document(rows, texts) for rows, texts in _slices(batch.column("text"))]
    found = parts[0] if len(parts) == 1 else _merged(parts, ["row", "term"])
    groups = pa.table({"lang": batch.column("lang"), "source": batch.column("source")})
    known = groups.group_by(["lang", "source"], use_threads=False).aggregate([])
    known = known.append_column("group", pa.array(np.arange(len(known), dtype=np.int64)))
    key = lambda t: pc.binary_join_element_wise(t["lang"].cast(pa.binary()), t["source"].cast(pa.binary()), b"\xff")
    group = pc.index_in(key(groups), value_set=key(known).combine_chunks()).combine_chunks()
    coded = found["term"].combine_chunks().dictionary_encode()
    flat = pa.table({"group": group.take(found["row"].combine_chunks()), "code": coded.indices, "n": found["n"]})
    summed = flat.group_by(["group", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    at = summed["group"].combine_chunks()
    columns = {"lang": known["lang"].take(at), "source": known["source"].take(at), "term": coded.dictionary.take(summed["code"].combine_chunks()), "n": summed["n_sum"], "docs": summed["n_count"]}
    zeros = pa.array(np.zeros(len(known), np.int64))
    marks = {"lang": known["lang"], "source": known["source"], "term": pa.nulls(len(known), coded.dictionary.type), "n": zeros, "docs": zeros}
    return pa.concat_tables([pa.table(columns), pa.table(marks)])


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(_counted(batch))
            rows += len(held[-1])
        if rows > HELD:
            held = [_merged(held, ["lang", "source", "term"])]
            rows = len(held[0])
            if rows > HELD // 2:
                yield from held[0].to_batches(1 << 16)
                held, rows = [], 0
    if held:
        yield from _merged(held, ["lang", "source", "term"]).to_batches(1 << 16)


def counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n and docs, merged; a row with a null term for each (lang, source) that occurs."""
    bounded_batches(df.sparkSession)
    plain = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
    rows = df.select(plain(lang_col, "lang"), plain(source_col, "source"), plain(text_col, "text"))
    partial = rows.mapInArrow(_partials, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counted: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``counted`` without terms of too few documents; ``first`` is 1 on one row of each term of a language, else 0."""
    one = W.partitionBy("lang", "term")
    rows = counted.select("lang", "source", "term", "n", F.sum("docs").over(one).alias("docs"), F.min("source").over(one).alias("least"))
    rows = rows.filter((F.col("docs") >= min_docs) | F.col("term").isNull())
    return rows.select("lang", "source", "term", "n", (F.col("term").isNotNull() & (F.col("source") == F.col("least"))).cast("long").alias("first"))


def totals(kept: DataFrame, shard: int = SHARD) -> DataFrame:
    """A row for each (lang, source): its ``total``, the language's ``terms`` and ``lang_total``, and the ``parts`` to deal its counts to."""
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("first").alias("firsts"), F.count("term").alias("entries"))
    langs = groups.groupBy("lang").agg(F.sum("firsts").alias("terms"), F.sum("total").alias("lang_total"), F.greatest(F.lit(1), F.ceil(F.sum("entries") / shard)).cast("long").alias("parts"))
    return groups.select("lang", "source", "total").join(langs, "lang")


def _pairs(term: np.ndarray, at: np.ndarray, n: np.ndarray, n_terms: int, total: np.ndarray, terms: int) -> np.ndarray:
    """The square of summed differences between sources, over the shard's terms in dense blocks."""
    size = len(total)
    square, nothing = np.zeros((size, size), np.int64), shares(np.zeros(size, np.int64), total, terms) if terms else np.zeros(size, np.int64)
    order = np.argsort(term, kind="stable")
    term, at, share = term[order], at[order], shares(n, total[at], terms)[order]
    step = max(1, BLOCK // size)
    for a in range(0, n_terms, step):
        lo, hi = np.searchsorted(term, (a, a + step))
        dense = np.tile(nothing, (min(step, n_terms - a), 1))
        dense[term[lo:hi] - a, at[lo:hi]] = share[lo:hi]
        for i in range(size):
            square[i] += np.abs(dense - dense[:, i : i + 1]).sum(axis=0)
    return square


def _shard(counted: pa.Table, groups: pa.Table) -> pa.Table:
    """One shard's part of every pair, and its best terms of every source."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    if not len(groups):
        return schema.empty_table()
    lang, sources = groups["lang"][0].as_py(), groups["source"].combine_chunks()
    total, terms, lang_total = groups["total"].to_numpy(), groups["terms"][0].as_py(), groups["lang_total"][0].as_py()
    coded = counted["term"].combine_chunks().dictionary_encode()
    term, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counted["n"].to_numpy()
    at = pc.index_in(counted["source"], value_set=sources).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
    square = _pairs(term, at, n, len(coded.dictionary), total, terms)
    i, j = np.nonzero(~np.eye(len(sources), dtype=bool))
    made = lambda source, part, item, value: pa.table([pa.array([lang] * len(value), pa.string()), source.cast(pa.string()), pa.array([part] * len(value), pa.string()), item.cast(pa.string()), pa.array(value)], schema=schema)
    pairs = made(sources.take(pa.array(i)), "pair", sources.take(pa.array(j)), square[i, j])
    if not len(term):
        return pairs
    whole = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(whole, term, n)
    above = shares(n, total[at], terms) - shares(whole[term], lang_total, terms)
    best = pa.table({"at": at, "term": counted["term"].combine_chunks(), "value": above}).filter(pa.array(above > 0))
    best = best.take(pc.sort_indices(best, [("at", "ascending"), ("value", "descending"), ("term", "ascending")]))
    source = best["at"].to_numpy()
    few = np.arange(len(source)) - np.searchsorted(source, source) < TOP
    best = best.filter(pa.array(few))
    return pa.concat_tables([pairs, made(sources.take(best["at"].combine_chunks()), "term", best["term"].combine_chunks(), best["value"].to_numpy())])


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, shard: int = SHARD) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank; see above."""
    kept = stored(kept_terms(counts(df, text_col, lang_col, source_col), min_docs), "divergence-kept")
    groups = stored(totals(kept, shard), "divergence-totals")
    langs = groups.groupBy("lang").agg(F.max("parts").alias("parts"))
    dealt = kept.filter(F.col("term").isNotNull()).join(langs, "lang").select("lang", F.pmod(F.xxhash64("term"), "parts").alias("shard"), "source", "term", "n")
    sides = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("shard"), "source", "total", "terms", "lang_total")
    found = dealt.groupBy("lang", "shard").cogroup(sides.groupBy("lang", "shard")).applyInArrow(_shard, "lang string, source string, part string, item string, value long")
    found = stored(found, "divergence-shards")
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    terms = found.filter("part = 'term'").withColumn("rank", rank).filter(F.col("rank") <= TOP)
    return pairs.withColumn("rank", rank).unionByName(terms)
