"""Line dedup by winnowing over line hashes.

Lines are cut short first: a line ends at a newline, after a word that ends a sentence, and
after every word whose hash is a multiple of ``CUT``, so that the lines of a passage are the
same wherever it stands, inside longer lines too. A line's hash covers ``gram`` words from its start
(two thirds of ``min_words``). Of every window of ``min_words - gram`` word positions the
smallest line hash is selected as fingerprint (if no line starts there, the smallest hash of all its
positions). What a window selects depends on its words alone, so any two equal runs of ``min_words``
words share a fingerprint: they are guaranteed to be found.

The positions of fingerprints that occur twice are joined with the first occurrence, in
order of (id, text hash, position). Positions on one diagonal of two documents whose spans touch
are a match; it is extended word by word both ways, up to a window's length (beyond it
the next fingerprint would have been selected). Matches of ``min_words`` words or more are
deleted, and shorter ones that overlap them; the first occurrence stays. No pairs are made: an occurrence is compared with the first
one only.

Cases: a null text is the empty text; the words of a deleted run go with the space after
them, and lines that lose all their words go whole; blank lines stay, unless no word is left,
when the text is empty; rows of the same id and text are one document and get the same result;
rows with a null id come before all others; runs of fewer words are never touched; very long
texts are read whole; an empty table gives an empty result; an input column with the name of a
result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import bounded_batches, stored

MIN_WORDS = 50
#: One word in so many ends a line.
CUT = 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RESULTS = ("n_lines", "n_lines_removed", "n_words_removed")

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
ENDING = np.zeros(256, bool)
ENDING[list(b".!?;:")] = True
#: The bytes of the last two of the marks that end a sentence.
WIDE = [tuple(x.encode()) for x in "…。"]
BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
#: Bytes whose words are hashed at once.
SLICE = 1 << 19
#: Powers of the base and of its inverse, as many as were needed.
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _POWERS[i] = np.multiply.accumulate(row)
    return _POWERS


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))


def _slice_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, hash and whether it ends a line of every word of bytes that begin and end between words."""
    space = SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    begins, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    if len(ends) < len(begins):
        ends = np.append(ends, len(data))
    power, inverse = _powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)])])
    hashes = _mixed((sums[ends] - sums[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))
    last = ENDING[data[ends - 1]]
    for wide in WIDE:
        last |= (data[ends - 1] == wide[2]) & (data[np.maximum(ends - 2, 0)] == wide[1]) & (data[np.maximum(ends - 3, 0)] == wide[0])
    return begins, hashes, last | (hashes % np.uint64(CUT) == 0)


@dataclass
class Words:
    """The words of several texts, side by side."""

    hashes: np.ndarray
    starts: np.ndarray  # whether a line starts at a word
    first: np.ndarray  # the first word of each text, and the end

    @staticmethod
    def of(texts: list[str | None]) -> Words:
        raw = [(t or "").encode() for t in texts]
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        begins, hashes, lasts, at = [], [], [], 0
        while at < len(data):
            end = min(at + SLICE, len(data))
            if end < len(data):
                # Slices end after a space; the last one if there is any, else the next.
                near = np.flatnonzero(SPACE[data[at:end]])
                end = at + int(near[-1]) + 1 if len(near) else end + int(np.argmax(SPACE[data[end:]])) + 1
            with np.errstate(over="ignore"):
                b, h, last = _slice_words(data[at:end])
            begins.append(b + at)
            hashes.append(h)
            lasts.append(last)
            at = end
        begin, hashes, lasts = (np.concatenate(x) for x in (begins, hashes, lasts))
        stops = np.cumsum([len(x) + 1 for x in raw])
        first = np.concatenate([[0], np.searchsorted(begin, stops)])
        line = np.searchsorted(np.flatnonzero(data == 10), begin)
        starts = np.concatenate([[True], lasts[:-1] | (line[1:] != line[:-1])])[: len(begin)]
        return Words(hashes, starts, first)

    def text(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def sizes(min_words: int) -> tuple[int, int]:
    """Words of a line hash, and word positions of a window."""
    gram = max(1, min_words * 2 // 3)
    return gram, max(1, min_words - gram)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    done, span = values, 1
    while span < width:
        step = min(span, width - span)
        done = pick(done[: len(done) - step], done[step:])
        span += step
    return done


def fingerprints(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position (among all words) of the selected fingerprints."""
    gram, window = sizes(min_words)
    n = len(words.hashes) - gram + 1
    lens = np.diff(words.first)
    long = np.flatnonzero(lens >= min_words)
    if not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    spread = words.hashes ^ (words.hashes >> np.uint64(29))
    with np.errstate(over="ignore"):
        for k in range(gram):
            value *= np.uint64(BASE)
            value += spread[k : k + n]
        value = _mixed(value)
    order = (value >> np.uint64(1)) | np.where(words.starts[:n], np.uint64(0), np.uint64(1 << 63))
    width = max(1, min(window, min_words - gram + 1))
    # Windows lie in one text; the others select nothing.
    whole = np.zeros(max(n - width + 1, 0), bool)
    for i in long:
        whole[words.first[i] : words.first[i + 1] - gram - width + 2] = True
    least = np.where(whole, _sliding(order, width, np.minimum), np.uint64(0))
    # A position is selected if it is the least of one of the windows that hold it.
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding(padded, width, np.maximum) == order)
    seeds, text = value[chosen].view(np.int64), np.searchsorted(words.first, chosen, side="right") - 1
    by = np.lexsort((chosen, seeds, text))
    same = (seeds[by][1:] == seeds[by][:-1]) & (text[by][1:] == text[by][:-1])
    if not same.any():
        return seeds, chosen
    # Periodic text selects one hash at every place; one in a window is enough.
    again, last, keep = set(text[by][1:][same].tolist()), {}, np.ones(len(chosen), bool)
    for k in np.flatnonzero(np.isin(text, list(again))).tolist():
        key = (text[k], seeds[k])
        if chosen[k] - last.get(key, -window) < window:
            keep[k] = False
        else:
            last[key] = chosen[k]
    return seeds[keep], chosen[keep]


def _indexed(df: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``#id``, ``#hash`` (of the text), ``seeds`` and ``words`` (four bytes for each) of the rows that can hold runs."""
    bounded_batches(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("#id"), F.xxhash64(text).alias("#hash"), text.alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("seeds", T.ArrayType(T.StructType([T.StructField("seed", T.LongType()), T.StructField("at", T.IntegerType())]))), T.StructField("words", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = Words.of(batch.column("text").to_pylist())
            seeds, at = fingerprints(words, min_words)
            counts = np.searchsorted(at, words.first)
            held = np.flatnonzero(np.diff(counts))
            near = at - words.first[np.searchsorted(words.first, at, side="right") - 1]
            entries = pa.StructArray.from_arrays([pa.array(seeds, pa.int64()), pa.array(near, pa.int32())], ["seed", "at"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(counts[held], len(at)), pa.int32()), entries)
            kept = batch.select(["#id", "#hash"]).take(pa.array(held))
            codes = (words.hashes >> np.uint64(32)).astype("<u4")
            raw = pa.array([codes[words.text(i)].tobytes() for i in held.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, lists, raw], names=["#id", "#hash", "seeds", "words"])

    return rows.mapInArrow(run, schema)


def matches(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``#id``, ``#hash`` (of the text) and ``#found`` of the documents that share fingerprints with earlier places.

    ``#found`` has a match's first word and end, and the words (four bytes for each) that stand before
    and after the first occurrence.
    """
    gram, window = sizes(min_words)
    made = stored(_indexed(df, id_col, text_col, min_words), "winnow-documents")
    posted = made.select("#id", "#hash", F.inline("seeds"))
    # A fingerprint that stands at one place of the corpus is in no repeated run.
    marks = posted.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1").select("seed")
    # Written, as the tables below, so that the joins with them can split what a frequent passage gathers.
    marks = stored(marks, "winnow-marks")
    candidates = stored(posted.join(marks, "seed", "left_semi"), "winnow-candidates")
    here = F.struct("#id", "#hash", "at")
    firsts = candidates.groupBy("seed").agg(F.min(here).alias("o"))
    firsts = stored(firsts.select("seed", "o", F.col("o.#id").alias("oid"), F.col("o.#hash").alias("ohash"), F.col("o.at").alias("oat")), "winnow-firsts")
    later = candidates.join(firsts, "seed").filter(~here.eqNullSafe(F.col("o"))).select("#id", "#hash", "at", "oid", "ohash", (F.col("at") - F.col("oat")).alias("diagonal"))
    pair = W.partitionBy("#id", "#hash", "oid", "ohash", "diagonal").orderBy("at")
    apart = (F.col("at") - F.lag("at").over(pair) > gram).cast("int")
    chained = later.withColumn("apart", F.coalesce(apart, F.lit(0))).withColumn("chain", F.sum("apart").over(pair.rowsBetween(W.unboundedPreceding, 0)))
    chains = chained.groupBy("#id", "#hash", "oid", "ohash", "diagonal", "chain").agg(F.min("at").alias("first"), (F.max("at") + gram).alias("end"))
    chains = chains.select("#id", "#hash", "oid", "ohash", (F.col("first") - F.col("diagonal")).alias("ofirst"), (F.col("end") - F.col("diagonal")).alias("oend"), "first", "end")
    chains = stored(chains, "winnow-chains")
    # What surrounds each first occurrence is cut out once, however many documents repeat it.
    wanted = chains.select("oid", "ohash", "ofirst", "oend").distinct().groupBy("oid", "ohash").agg(F.collect_list(F.struct("ofirst", "oend")).alias("w"))
    sources = made.select(F.col("#id").alias("#i"), F.col("#hash").alias("#h"), "words")
    sources = wanted.join(sources, F.col("oid").eqNullSafe(F.col("#i")) & (F.col("ohash") == F.col("#h")))
    before = lambda x: F.substr("words", F.greatest(x["ofirst"] - window, F.lit(0)) * 4 + 1, F.least(x["ofirst"], F.lit(window)) * 4)
    around = F.transform("w", lambda x: F.struct(x["ofirst"].alias("ofirst"), x["oend"].alias("oend"), before(x).alias("before"), F.substr("words", x["oend"] * 4 + 1, F.lit(window * 4)).alias("after")))
    around = sources.select("oid", "ohash", F.inline(around)).dropDuplicates(["oid", "ohash", "ofirst", "oend"])
    around = stored(around.select(F.col("oid").alias("#i"), F.col("ohash").alias("#h"), F.col("ofirst").alias("#f"), F.col("oend").alias("#e"), "before", "after"), "winnow-around")
    same = F.col("oid").eqNullSafe(F.col("#i")) & (F.col("ohash") == F.col("#h")) & (F.col("ofirst") == F.col("#f")) & (F.col("oend") == F.col("#e"))
    found = chains.join(around, same)
    return found.groupBy("#id", "#hash").agg(F.collect_set(F.struct("first", "end", "before", "after")).alias("#found"))


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many words agree from the start."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def repeated_words(text: str, found: list[dict], min_words: int) -> np.ndarray:
    """Which words of a text are in matches that, extended both ways, have ``min_words`` words or more, or go on with such a match."""
    own = (Words.of([text]).hashes >> np.uint64(32)).astype("<u4")
    gone, short = np.zeros(len(own), bool), []
    for match in found:
        first, end = match["first"], match["end"]
        before, after = np.frombuffer(match["before"], "<u4"), np.frombuffer(match["after"], "<u4")
        first -= _agree(own[max(0, first - len(before)) : first][::-1], before[::-1])
        end += _agree(own[end : end + len(after)], after)
        if end - first >= min_words:
            gone[first:end] = True
        else:
            short.append((first, end))
    # A shorter match that overlaps a deleted run goes on with it, as in periodic text.
    for spans in (sorted(short), sorted(short, reverse=True)):
        for first, end in spans:
            if gone[first:end].any():
                gone[first:end] = True
    return gone


def without(text: str, gone: np.ndarray) -> tuple[str, int]:
    """A text without the words that ``gone`` marks, and how many lines lost all their words."""
    left, removed, at = [], 0, 0
    for line in text.split("\n"):
        words = [m.span() for m in WORD.finditer(line)]
        mine = gone[at : at + len(words)]
        at += len(words)
        if not mine.any():
            left.append(line)
        elif mine.all():
            removed += 1
        else:
            stops = [*(a for a, _ in words[1:]), len(line)]
            kept = [line[a:stop] for (a, _), stop, out in zip(words, stops, mine, strict=True) if not out]
            left.append(line[: words[0][0]] + "".join(kept).rstrip(" \t\r\x0b\x0c"))
    joined = "\n".join(left)
    return (joined if WORD.search(joined) else ""), removed


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with repeated runs deleted from ``text_col``, ``n_lines``, ``n_lines_removed`` and ``n_words_removed``."""
    bounded_batches(df.sparkSession)
    keep = [c for c in df.columns if c not in (*RESULTS, text_col)]
    text = F.col(f"`{text_col}`").cast("string")
    found = matches(df, id_col, text_col, min_words)
    rows = df.select(*(F.col(f"`{c}`") for c in keep), text.alias("#text"), F.col(f"`{id_col}`").alias("#key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("#own"))
    joined = rows.join(found, F.col("#key").eqNullSafe(F.col("#id")) & (F.col("#own") == F.col("#hash")), "left")
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(text_col, T.StringType()), *(T.StructField(c, T.LongType()) for c in RESULTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = batch.column("#text").to_pylist(), []
            for i, matched in enumerate(batch.column("#found")):
                n_lines, lines, words = (texts[i] or "").count("\n") + 1, 0, 0
                if matched.is_valid and (gone := repeated_words(texts[i] or "", matched.as_py(), min_words)).any():
                    words = int(gone.sum())
                    texts[i], lines = without(texts[i], gone)
                counts.append((n_lines, lines, words))
            made = [pa.array(texts, pa.string()), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], names=[*keep, text_col, *RESULTS])

    done = joined.select(*(F.col(f"`{c}`") for c in keep), "#text", "#found").mapInArrow(run, schema)
    order = [c for c in df.columns if c not in RESULTS]
    return done.select(*(F.col(f"`{c}`") for c in order), *RESULTS)
