"""Language identification, word first.

A known word scores its log frequency in each language. An unseen word backs off to its
longest known character n-grams (of ``MAX_GRAM`` characters with the marks of the word's
ends, then shorter ones), averaged. The language with the highest sum over the words wins.

A text's score doesn't grow with its length: it is the probability of the winner by the mean
over at most ``EVIDENCE`` words, times how well the text fits it at all. The fit compares the
share of the text that the winner's tables cover (known words, or the known n-grams of unseen
ones) with that of texts of the language which were kept from the counts; text of a language that
wasn't learnt, or of random letters, gets a score near 0.

The model is fitted on at most ``per_language`` labelled texts of every language, those of the
smallest hashes of id and text, each used whole. For each language it keeps the ``top_words`` most
frequent words and, for each length, the ``top_grams`` most frequent n-grams (of the entries with the
count at which the limit falls, a share by hash; None keeps all), which bounds what is broadcast.

Words are runs of letters (the Unicode categories L), in lower case. Cases: a text that is null
or has no letter is ``und`` with score 0; equal scores fall to the language that comes first by
name; without any labelled text all are ``und``; over ``LABELS`` languages are an error; repeated rows each get the same result; very long
texts are read whole, ``STEP`` words at a time; an empty table gives an empty result; an input
column with the name of a result is replaced.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import DOUBLE, STRING, bounded_batches, drawn, hash63, stored, threshold, with_columns

PER_LANGUAGE = 1_000
#: Languages beyond which fitting is an error.
LABELS = 10_000
TOP_WORDS = 20_000
TOP_GRAMS = 10_000
MAX_GRAM = 4
#: One in so many of the drawn texts isn't counted, but measures the fit.
APART = 5
#: Words whose mean score decides how sure a result is.
EVIDENCE = 20
#: Deviations below a language's usual cover at which a text fits as well as not, and the least deviation.
FAR, LEAST = 6.0, 0.05
#: Log frequency of what has no known character.
NOWHERE = -25.0
#: Counts from here on are one level when the most frequent entries are looked for.
LEVELS = 4_096
#: Numbers for unseen words that a worker process remembers, and words of a text that are summed at once.
CELLS, STEP = 3_200_000, 20_000
#: Entries that a task counts before it sends them on.
ENTRIES = 200_000
#: Letters and the rarer numerals, which ``letters`` takes apart.
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def letters(word: str) -> list[str]:
    """The runs of letters in a match of ``WORD``."""
    return [word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split()


def entries(word: str) -> Iterator[tuple[int, str]]:
    """A word (length 0) and its n-grams."""
    yield 0, word
    marked = f"<{word}>"
    for length in range(1, MAX_GRAM + 1):
        for at in range(len(marked) - length + 1):
            yield length, marked[at : at + length]


@dataclass
class Model:
    """Log frequencies, and which languages have an entry: a row for each entry of ``words`` and ``grams``."""

    languages: list[str]
    words: dict[str, int]
    grams: list[dict[str, int]]
    word_scores: np.ndarray
    word_known: np.ndarray
    gram_scores: list[np.ndarray]
    gram_known: list[np.ndarray]
    #: Of the usual cover of each language: mean, variance over words and over texts.
    usual: np.ndarray
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def _logs(counts: list[tuple[str, str, int]], languages: list[str]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Entries, their log frequency in each language (half a count where one lacks them), and who has them."""
    at = {x: i for i, x in enumerate(languages)}
    index = {k: i for i, k in enumerate(dict.fromkeys(k for k, _, _ in counts))}
    table = np.zeros((len(index), len(languages)))
    for key, language, n in counts:
        table[index[key], at[language]] += n
    total = table.sum(axis=0)
    return index, (np.log(np.maximum(table, 0.5)) - np.log(total + 1.0)).astype(np.float32), table > 0


def sample(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, per_language: int) -> DataFrame:
    """lang, text and ``apart`` of ``per_language`` texts of each language, or of all that it has."""
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    chosen = drawn(rows, ["id", "text"], per_language, "lang", LABELS)
    # Equal texts are apart together, so none measures the fit of its own copies; a language's first hash always counts.
    first = F.min("hash").over(W.partitionBy("lang"))
    apart = (F.pmod(F.xxhash64("text", F.lit(APART)), F.lit(APART)) == 0) & (F.col("hash") != first)
    return chosen.select("lang", "text", "hash", apart.alias("apart")).select("lang", "text", "apart")


def count(texts: DataFrame) -> DataFrame:
    """lang, size, k and n: how often each word (size 0) and n-gram stands in the texts of a language."""
    bounded_batches(texts.sparkSession)

    def sent(found: dict[tuple[str, int], Counter]) -> Iterator[pa.RecordBatch]:
        for (lang, size), counts in found.items():
            n = len(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "size", "k", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for word, n in Counter(part for word in WORD.findall((text or "").lower()) for part in letters(word)).items():
                    for size, k in entries(word):
                        found[lang, size][k] += n
                if sum(map(len, found.values())) > ENTRIES:
                    yield from sent(found)
                    found.clear()
        yield from sent(found)

    counted = texts.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, "lang string, size int, k string, n long")
    return counted.groupBy("lang", "size", "k").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, top_words: int | None, top_grams: int | None) -> DataFrame:
    """The entries of ``counts`` within the limits of each language and size."""
    level = F.least("n", F.lit(LEVELS))
    levels: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for r in counts.groupBy("lang", "size", level.alias("level")).agg(F.count("*").alias("m")).collect():
        levels.setdefault((r["lang"], r["size"]), []).append((r["level"], r["m"]))
    cuts = []
    for (lang, size), found in levels.items():
        most = top_grams if size else top_words
        left = math.inf if most is None else most
        cut, part = 0, threshold(1)
        for n, m in sorted(found, reverse=True):
            if m > left:
                cut, part = n, threshold(left / m)
                break
            left -= m
        cuts.append((lang, size, cut, part))
    if not cuts:
        return counts
    cut = counts.sparkSession.createDataFrame(cuts, "lang string, size int, cut long, part long")
    return counts.join(cut, ["lang", "size"]).filter((level > F.col("cut")) | (level == F.col("cut")) & (hash63("k") <= F.col("part"))).select(*counts.columns)


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    per_language: int = PER_LANGUAGE, top_words: int | None = TOP_WORDS, top_grams: int | None = TOP_GRAMS,
) -> Model:
    """Learn from rows whose language isn't null. Counting is done by Spark; the driver gets the bounded tables."""
    texts = stored(sample(labelled, text_col, lang_col, id_col, per_language), "language-sample")
    counts = stored(count(texts.filter("not apart")), "language-counts")
    kept: list[list[tuple[str, str, int]]] = [[] for _ in range(MAX_GRAM + 1)]
    for r in most_frequent(counts, top_words, top_grams).collect():
        kept[r["size"]].append((r["k"], r["lang"], r["n"]))
    languages = sorted({lang for _, lang, _ in kept[0]})
    words, word_scores, word_known = _logs(sorted(kept[0]), languages)
    grams = [_logs(sorted(kept[g]), languages) for g in range(MAX_GRAM, 0, -1)]
    model = Model(languages, words, [g[0] for g in grams], word_scores, word_known, [g[1] for g in grams], [g[2] for g in grams], np.array([[0.0, 1.0, 0.0]] * len(languages)))
    return _calibrated(model, texts.filter("apart"))


def _calibrated(model: Model, texts: DataFrame) -> Model:
    """``model`` with the cover of texts that weren't counted."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Predictor(shared.value)
        at = {x: i for i, x in enumerate(shared.value.languages)}
        for batch in batches:
            rows = [(lang, *one.cover(text, at[lang])) for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True) if lang in at]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.float64()) for c in columns[1:])], names=["lang", "n", "total", "squares"])

    found = texts.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, "lang string, n double, total double, squares double").filter("n > 0").toPandas()
    for i, lang in enumerate(model.languages):
        own = found[found["lang"] == lang]
        if len(own):
            n, total = own["n"].sum(), own["total"].sum()
            mean = total / n
            over_words = max(own["squares"].sum() / n - mean**2, 0.0)
            over_texts = max(float(((own["total"] / own["n"] - mean) ** 2 - over_words / own["n"]).mean()), 0.0)
            model.usual[i] = mean, over_words, over_texts
    return model


class Predictor:
    """From texts to languages and scores.

    Known words and unseen ones met before are rows of one table: their log frequency in each
    language, how far each covers them, and the number of words.
    """

    def __init__(self, model: Model) -> None:
        self.model = model
        self.size = len(model.languages)
        self.forget()

    def forget(self) -> None:
        self.ids = dict(self.model.words)
        width, known = 2 * self.size + 1, len(self.ids)
        self.table = np.zeros((known + max(STEP, CELLS // width), width), np.float32)
        if self.size:
            self.table[:known, : self.size], self.table[:known, self.size : -1], self.table[:known, -1] = self.model.word_scores, self.model.word_known, 1

    def unseen(self, word: str) -> np.ndarray:
        """The row of a word that has none: mean score of its longest known n-grams, share of its known n-grams of the length that tells its cover."""
        row, n = np.zeros(2 * self.size + 1), self.size
        parts = letters(word)
        if parts != [word]:
            for part in parts:
                row += self.table[i] if (i := self.ids.get(part)) is not None else self.unseen(part)
            return row
        row[:n], row[-1] = NOWHERE, 1
        marked = f"<{word}>"
        for length, index, scores, known in zip(range(MAX_GRAM, 0, -1), self.model.grams, self.model.gram_scores, self.model.gram_known, strict=True):
            hits = [i for s in range(len(marked) - length + 1) if (i := index.get(marked[s : s + length])) is not None]
            if hits:
                row[:n] = scores[hits].mean(axis=0)
                if length == min(MAX_GRAM, len(marked)):
                    row[n:-1] = known[hits].sum(axis=0) / (len(marked) - length + 1)
                break
        return row

    def learn(self, words: list[str]) -> None:
        """Rows for words that have none, those with n-grams of the full length at once."""
        get, n, at = self.model.grams[0].get, self.size, len(self.ids)
        quick, flat, hit, all_ = [], [], [], []
        for word in words:
            if len(word) > MAX_GRAM - 2 and word.isalpha():
                marked = f"<{word}>"
                hits = [i for i in [get(marked[s : s + MAX_GRAM]) for s in range(len(marked) - MAX_GRAM + 1)] if i is not None]
                if hits:
                    quick.append(word)
                    flat += hits
                    hit.append(len(hits))
                    all_.append(len(marked) - MAX_GRAM + 1)
        if quick:
            begins = np.cumsum([0, *hit[:-1]])
            made = self.table[at : at + len(quick)]
            made[:, :n] = np.add.reduceat(self.model.gram_scores[0][flat], begins) / np.array(hit)[:, None]
            made[:, n:-1] = np.add.reduceat(self.model.gram_known[0][flat].astype(np.float32), begins) / np.array(all_)[:, None]
            made[:, -1] = 1
            self.ids.update(zip(quick, range(at, at + len(quick)), strict=True))
        for word in words:
            if word not in self.ids:
                self.table[len(self.ids)] = self.unseen(word)
                self.ids[word] = len(self.ids)

    def rows(self, words: list[str]) -> np.ndarray:
        """The rows of words, of which there are at most ``STEP``."""
        ids = list(map(self.ids.get, words))
        if None in ids:
            new = dict.fromkeys(w for w, i in zip(words, ids, strict=True) if i is None)
            if len(self.ids) + len(new) > len(self.table):
                self.forget()
                return self.rows(words)
            self.learn(list(new))
            ids = list(map(self.ids.__getitem__, words))
        return self.table[ids]

    def parts(self, text: str | None) -> Iterator[np.ndarray]:
        words = WORD.findall((text or "").lower())
        for a in range(0, len(words), STEP):
            yield self.rows(words[a : a + STEP])

    def cover(self, text: str | None, language: int) -> tuple[float, float, float]:
        """Words of a text, and the sum and the sum of squares of how far a language covers them."""
        n = total = squares = 0.0
        for rows in self.parts(text):
            own = rows[:, self.size + language].astype(float)
            n, total, squares = n + float(rows[:, -1].sum()), total + own.sum(), squares + (own**2).sum()
        return n, total, squares

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not self.size:
            return UNKNOWN, 0.0
        total = sum((rows.sum(axis=0, dtype=np.float64) for rows in self.parts(text)), np.zeros(2 * self.size + 1))
        n = total[-1]
        if n < 1:
            return UNKNOWN, 0.0
        scores = total[: self.size]
        best = int(np.argmax(scores))
        ahead = (scores - scores[best]) / n * min(n, EVIDENCE)
        mean, over_words, over_texts = self.model.usual[best]
        z = (total[self.size + best] / n - mean) / math.sqrt(over_words / n + over_texts + LEAST**2)
        fits = 1 / (1 + math.exp(min(700.0, -(z + FAR))))
        return self.model.languages[best], float(fits / np.exp(np.maximum(ahead, -700)).sum())


#: The predictor of a model that a worker process keeps from task to task.
_KNOWN: dict[str, Predictor] = {}


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``lang_score`` (0 to 1)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value
        if model.key not in _KNOWN:
            _KNOWN.clear()
            _KNOWN[model.key] = Predictor(model)
        one = _KNOWN[model.key]
        return lambda texts: list(map(list, zip(*map(one, texts), strict=True))) if texts else [[], []]

    return with_columns(df, text_col, {"lang_pred": STRING, "lang_score": DOUBLE}, start)
