"""Quality rules, line first: clean the lines, then judge what the document lost.

Native DataFrame functions only. Each line meets three groups of rules:

* punctuation: a line of at least ``MIN_LINE_WORDS`` words has to end like a sentence, and
  its marks (``#*$%&|<>`` and doubled exclamation marks) may be at most
  ``MAX_MARKS`` for each word;
* navigation: at most ``MAX_SEPARATORS`` stand-alone separators (``|``, ``>``, ``/``);
* boilerplate: no phrase of ``BOILERPLATE``.

Failing lines are removed. A document is rejected when the base rules fail (fewer than ten
words, or over a fifth of its words in five-word windows that occur twice), or when under
``MIN_KEPT`` of its word characters remain.

Cases: a null text is a text without words (rejected); blank lines neither pass nor fail and
stay; texts of any length are judged whole, in one row; repeated rows each get the same result; an empty table gives an empty result; an input
column with the name of a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import sealed

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Words in a repeated window.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_LINE_WORDS = 4
MAX_MARKS = 0.1
MAX_SEPARATORS = 2
MIN_KEPT = 0.5
#: Characters that may end a line, perhaps followed by closing quotes or brackets.
ENDS = ".!?…。:;,"
CLOSERS = "\"'”’»)] "
#: Phrases that mark a line as furniture of a site.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "cookie settings",
    "enable javascript", "javascript is disabled", "sign up for our newsletter", "click here", "lorem ipsum", "skip to content",
    "skip to main content", "share on facebook", "share on twitter",
)
MARKS = r"[#*$%&|<>]|!!"
SEPARATORS = r"(?:^|\s)[|>/](?=\s|$)"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lines_removed", "kept_chars", "base_failed", "kept", "cleaned_text")


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def line_fails(line: Column, n_words: Column) -> Column:
    """Whether one line with words breaks a rule."""
    body = F.rtrim(line, F.lit(CLOSERS))
    unpunctuated = (n_words >= MIN_LINE_WORDS) & ~F.lit(ENDS).contains(F.substring(body, -1, 1))
    separators = (F.contains(line, F.lit("|")) | F.contains(line, F.lit(">")) | F.contains(line, F.lit("/"))) & (F.regexp_count(line, F.lit(SEPARATORS)) > MAX_SEPARATORS)
    lower = F.lower(line)
    boilerplate = F.contains(lower, F.lit(BOILERPLATE[0]))
    for phrase in BOILERPLATE[1:]:
        boilerplate |= F.contains(lower, F.lit(phrase))
    return unpunctuated | (F.regexp_count(line, F.lit(MARKS)) > n_words * F.lit(MAX_MARKS)) | separators | boilerplate


def _sorted_windows(hashes: Column) -> Column:
    """The windows' 64-bit hashes in order, each with its start; null when all differ."""
    windows = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(windows))


def _repeat_starts(windows: Column) -> Column:
    """The starts of the windows that have an equal neighbour in sorted order."""
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    marked = F.transform(windows, lambda x, j: F.when(same(F.get(windows, j - 1), x) | same(F.get(windows, j + 1), x), x["i"]))
    return F.sort_array(F.array_compact(marked))


def evaluate(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts, the verdict and the cleaned text of every document."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keep = [c for c in df.columns if c not in RESULTS]
    split = df.select(*(F.col(f"`{c}`") for c in keep), text.alias("#text"))
    split = split.select("*", words_of(F.col("#text")).alias("#words"), F.split("#text", "\n", -1).alias("#lines"))
    words, lines = F.col("#words"), F.col("#lines")
    n = F.size(words)
    at = lambda i, k: F.get(words, i + k)
    hashes = F.when(n >= WINDOW, F.transform(F.slice(words, F.lit(1), n - (WINDOW - 1)), lambda x, i: F.xxhash64(x, *(at(i, k) for k in range(1, WINDOW)))))
    counts = F.transform(lines, lambda x: F.regexp_count(x, F.lit(WORD)))
    judged = F.transform(lines, lambda x, i: F.struct(x.alias("line"), F.get(F.col("#line_words"), i) > 0, line_fails(x, F.get(F.col("#line_words"), i))))
    counted = split.withColumn("#line_words", counts).select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count("#text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        "#words",
        hashes.alias("#hashes"),
        judged.alias("#judged"),
    )
    full = F.filter("#judged", lambda x: x["col2"])
    kept_lines = F.filter("#judged", lambda x: ~x["col2"] | ~x["col3"])
    counted = counted.select(
        "*",
        F.transform(full, lambda x: x["line"]).alias("#full"),
        F.array_join(F.transform(kept_lines, lambda x: x["line"]), "\n").alias("cleaned_text"),
        F.size(F.filter("#judged", lambda x: x["col2"] & x["col3"])).cast("long").alias("n_lines_removed"),
        F.size("#judged").cast("long").alias("n_lines"),
        _sorted_windows(F.col("#hashes")).alias("#windows"),
    )
    counted = counted.withColumn("#repeats", _repeat_starts(F.col("#windows")))
    repeats = F.col("#repeats")
    covered = F.aggregate(
        F.transform(repeats, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(repeats, j + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    result = counted.withColumns(
        {
            "n_dup_lines": (F.size("#full") - F.size(F.array_distinct("#full"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
            "kept_chars": F.length(F.regexp_replace("cleaned_text", SPACE, "")).cast("long"),
        }
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    result = result.withColumn("base_failed", failed)
    verdict = ~F.col("base_failed") & (F.col("kept_chars") >= F.col("word_chars") * F.lit(MIN_KEPT))
    result = result.withColumn("kept", verdict)
    return sealed(result, keep, {c: F.col(c) for c in RESULTS})
