"""Periodic runs of words, by maximal pairs.

A run (a stretch of words of smallest period q and at least 2q words that can't be extended) that starts at s and is L
words long is a maximal pair: its words from s and from s + q match for L - q words, and neither the words before nor
those after match. Conversely a maximal pair at distance d whose match is at least d words long is a run of a period that divides d; the
smallest distance of a stretch is its period.

For each batch, texts in which some ``SEED_WORDS`` words occur twice (any run of ``MIN_LENGTH`` words has such) go into one suffix array by prefix doubling, over
word codes that differ between texts. Its intervals of common prefixes are visited bottom-up. Each interval
keeps its positions in order and in lists by the word on their left; when two intervals meet, the members of the smaller
one look up partners with another left word, no farther than the common prefix is long. Such pairs are runs as they are, with nothing to
extend. Blocks of suffixes whose left words are all equal, or that are nowhere near enough to each other, are passed over at once.

Memory of a task: a batch of Arrow bytes (or one text) with an array of ranks for each doubling, that is log2 of the longest repeat.
Texts don't meet, so nothing is shuffled.

Cases: a null or blank text has no words and no runs; texts of any length are searched whole; of runs of equal length the first one counts, then the smaller period; repeated rows each get the
same result; an empty table gives an empty result; an input column with the name of a result is replaced.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right, insort
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import LONG, STRING, with_columns
from tidewatch.llm.line_rules import words_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Words of a run, at least.
MIN_LENGTH = 12
#: A run's first period and the next share this many words from the run's start.
SEED_WORDS = MIN_LENGTH // 2
RUNS = (T.ArrayType(T.ArrayType(T.LongType())), pa.list_(pa.list_(pa.int64())))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def suffix_order(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``codes``, and the ranks by the first 1, 2, 4, ... codes (with an end that equals nothing)."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    at = np.arange(n)
    new = np.concatenate([[True], codes[order][1:] != codes[order][:-1]]) if n else np.zeros(0, bool)
    ranks = np.full(n + 1, -1, np.int64)
    ranks[order] = np.maximum.accumulate(np.where(new, at, 0))
    levels, width = [ranks.astype(np.int32)], 1
    again = ~(new & np.concatenate([new[1:], [True]])) if n else new
    active = order[again]
    while len(active):
        first, second = ranks[active], ranks[np.minimum(active + width, n)]
        sort = np.lexsort((second, first))
        active, first, second = active[sort], first[sort], second[sort]
        at = np.arange(len(active))
        other = np.concatenate([[True], first[1:] != first[:-1]])
        new = other | np.concatenate([[True], second[1:] != second[:-1]])
        ranks[active] = first + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(other, at, 0))
        levels.append(ranks.astype(np.int32))
        active, width = active[~(new & np.concatenate([new[1:], [True]]))], width * 2
    suffixes = np.empty(n, np.int64)
    suffixes[ranks[:n]] = np.arange(n)
    return suffixes, levels


def common_prefixes(suffixes: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The length of the common prefix of each suffix and the next, from the ranks of all levels."""
    x, y = suffixes[:-1], suffixes[1:]
    length = np.zeros(len(x), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = levels[k][x + length], levels[k][y + length]
        length += np.where(a == b, 1 << k, 0)
    return length


class Interval:
    """Positions of one interval, in order and by left word."""

    __slots__ = ("by_left", "positions")

    def __init__(self, position: int, left: int) -> None:
        self.positions, self.by_left = [position], {left: [position]}


def _meet(a: Interval, b: Interval, prefix: int, left: list[int] | np.ndarray, out: list) -> Interval:
    """The union of two intervals; their maximal pairs at distances that make runs go to ``out``."""
    few, many = (a, b) if len(a.positions) <= len(b.positions) else (b, a)
    least = max(1, MIN_LENGTH - prefix)
    for own, members in few.by_left.items():
        for i in members:
            lo, hi = bisect_left(many.positions, i - prefix), bisect_right(many.positions, i + prefix)
            if hi - lo <= len(many.by_left):
                near = [j for j in many.positions[lo:hi] if left[j] != own]
            else:
                near = [j for other, c in many.by_left.items() if other != own for j in c[bisect_left(c, i - prefix) : bisect_right(c, i + prefix)]]
            out += [(min(i, j), abs(i - j), prefix) for j in near if abs(i - j) >= least]
    for own, members in few.by_left.items():
        into = many.by_left.setdefault(own, [])
        for i in members:
            insort(into, i)
            insort(many.positions, i)
    return many


def maximal_pairs(suffixes: np.ndarray, prefixes: np.ndarray, left: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, distance, match) of the maximal pairs that are runs; ``left`` is each position's left word."""
    deep = np.concatenate([[False], prefixes >= SEED_WORDS, [False]])
    begin, end = np.flatnonzero(deep[1:] & ~deep[:-1]), np.flatnonzero(deep[:-1] & ~deep[1:])  # blocks of suffixes begin..end, both included
    if not len(begin):
        return []
    sizes = end - begin + 1
    block = np.repeat(np.arange(len(begin)), sizes)
    member = suffixes[np.arange(len(block)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)]
    starts = np.cumsum(sizes) - sizes
    lefts = left[member]
    varied = np.minimum.reduceat(lefts, starts) != np.maximum.reduceat(lefts, starts)
    most = np.array([prefixes[a:b].max() for a, b in zip(begin[varied], end[varied], strict=True)], np.int64)
    chosen = np.flatnonzero(varied)
    in_order = np.lexsort((member, block))
    gap = np.diff(member[in_order], append=np.iinfo(np.int64).max)
    gap[starts + sizes - 1] = np.iinfo(np.int64).max
    chosen = chosen[np.minimum.reduceat(gap, starts)[chosen] <= most]
    out: list[tuple[int, int, int]] = []
    for a, b in zip(begin[chosen].tolist(), end[chosen].tolist(), strict=True):
        positions, depth = suffixes[a : b + 1].tolist(), prefixes[a:b].tolist()
        words = dict(zip(positions, left[suffixes[a : b + 1]].tolist(), strict=True))
        stack, seams = [Interval(positions[0], words[positions[0]])], []
        for position, prefix in zip(positions[1:], depth, strict=True):
            while seams and seams[-1] >= prefix:
                top = stack.pop()
                stack[-1] = _meet(stack[-1], top, seams.pop(), words, out)
            stack.append(Interval(position, words[position]))
            seams.append(prefix)
        while seams:
            top = stack.pop()
            stack[-1] = _meet(stack[-1], top, seams.pop(), words, out)
    return out


def find_runs(codes: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start and period; ``codes`` are the words of all texts, ``sizes`` how many each has."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    begins = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    if len(codes) < MIN_LENGTH:
        return found
    # A hash of each text's seeds only chooses texts; nothing relies on it.
    mixed = codes.astype(np.uint64) * _MIX[0] + text.astype(np.uint64) * _MIX[1]
    mixed ^= mixed >> np.uint64(29)
    n = len(codes) - SEED_WORDS + 1
    seed = np.zeros(n, np.uint64)
    for k in range(SEED_WORDS):
        seed += mixed[k : k + n] * _MIX[k]
        seed ^= seed >> np.uint64(31)
    whole = text[:n] == text[SEED_WORDS - 1 :]
    ordered = np.sort(seed[whole])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return found
    hit = np.minimum(np.searchsorted(twice, seed), len(twice) - 1)
    chosen = np.unique(text[:n][whole & (twice[hit] == seed)])
    at = np.concatenate([np.arange(begins[t], begins[t] + sizes[t]) for t in chosen])
    owner = text[at]
    _, own = np.unique(owner * (int(codes.max()) + 1) + codes[at], return_inverse=True)
    suffixes, levels = suffix_order(own)
    left = np.concatenate([[-1], own[:-1]])
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    left[first] = -1
    stretches: dict[tuple[int, int], int] = {}
    for start, distance, match in maximal_pairs(suffixes, common_prefixes(suffixes, levels), left):
        key = (start, match + distance)
        stretches[key] = min(distance, stretches.get(key, distance))
    for (start, length), period in stretches.items():
        t = owner[start]
        found[t].append((int(at[start] - begins[t]), int(length), int(period)))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of n words is in a run after that run's first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) > 0


def _start():
    def apply(texts: list) -> list:
        code: dict[bytes, int] = {}
        number = count()
        known = lambda w: code[w] if w in code else code.setdefault(w, next(number))
        words = [WORD.findall(t.encode()) if t else [] for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.fromiter((known(w) for ws in words for w in ws), np.int64, int(sizes.sum()))
        runs = find_runs(codes, sizes)
        left = []
        for ws, found in zip(words, runs, strict=True):
            if found:
                out = dropped(len(ws), found).tolist()
                ws = [w for w, gone in zip(ws, out, strict=True) if not gone]
            left.append(b" ".join(ws).decode())
        return [sizes.tolist(), runs, left]

    return apply


def with_runs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``runs`` (start, length and period of each, by start and period) and ``collapsed``, the text without the repeats, of every text."""
    return with_columns(df, text_col, {"n_words": LONG, "runs": RUNS, "collapsed": STRING}, _start)


def planted(doc_id: Column, text: Column) -> Column:
    """The texts in which one document in ten, by its id, is made periodic from some word on; the others as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = words_of(text)
    n = F.size(words).cast("long")

    def periodic(ws: Column) -> Column:
        n = F.size(ws).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(ws, lambda w, i: F.when(i >= a, F.get(ws, (a + (i - a) % p).cast("int"))).otherwise(w)), " ")

    one = F.transform(F.array(words), periodic)[0]
    return F.when((h % 10 == 0) & (n > 0), one).otherwise(text)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, how many runs each text has, the longest one, and digests of all runs and of what is left."""
    found = with_runs(df.select(id_col, text_col), text_col)
    longest = F.array_sort(F.transform("runs", lambda r: F.struct((-r[1]).alias("length"), r[0].alias("start"), r[2].alias("period"))))[0]
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r[0], r[1], r[2]), F.lit("\n"))), "")
    found = found.select(id_col, F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, longest).alias("#longest"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = -F.col("#longest.length"), F.col("#longest.period")
    return found.select(id_col, "n_runs", F.col("#longest.start").alias("start"), length.alias("length"), period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
