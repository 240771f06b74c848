"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. A line's score weighs features of the line and of its two
neighbours; a transition matrix ties neighbouring labels. Forward-backward gives each line's
marginal, and a document's quality is the mean of the marginals weighted by the lines'
lengths, calibrated on the training documents by a logistic function of its log odds.

The field is fitted on at most ``max_docs`` labelled documents, those of the smallest hashes of id
and text, of each all lines. In a first round every line takes its document's label; after it the
label is only evidence about the lines, so the next round learns from bad lines in
good documents and good ones in bad documents, and from the changes between them. A document of more than
``CHAIN_LINES`` lines is several chains, each of which begins and ends ``OVERLAP`` lines within
its neighbours, and the chains of a document weigh as one. Calibration takes the marginals of
whole documents, as scoring does. If the drawn documents have over ``MAX_LINES`` lines, each label
gets its share of them, and documents that would take over an eighth of that share are passed over. Scoring uses all lines of all texts.

Cases: a null or empty text, or one of blank lines only, scores 0; without labels of both
kinds every text scores 0.5; a label whose documents all have over ``MAX_LINES`` lines is an error; repeated rows each get the same result; several labels of a
document count as their mean, rounded; very long texts and texts of very many lines are read whole, a
slice of lines at a time; an empty table gives an empty result; an input column
with the name of a result is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import BINARY, DOUBLE, LONG, drawn, hash63, stored, with_columns

MAX_DOCS = 3_000
#: The column of ``labelled`` by whose smallest values documents are drawn.
DRAWN = "#drawn"
#: Lines of a chain in training, and of them those that the next one repeats.
CHAIN_LINES, OVERLAP = 64, 8
#: Lines that the driver gets at most.
MAX_LINES = 200_000
#: Adam's steps in a round at most, and the slope at which it stops.
STEPS, ENOUGH = 60, 1e-4
#: Rounds of fitting, and the log odds by which a good or a bad document's label speaks for its lines from the second one on.
ROUNDS, FOR_GOOD, FOR_BAD = 4, 2.0, -2.0
RIDGE = 1e-3
THRESHOLD = 0.3

LOWER, UPPER, DIGIT, SPACE, SYMBOL, PIPE, BANG, STOP, COMMA, HIGH, END, OTHER = range(12)
CLASSES = np.full(256, OTHER, np.int64)
for _chars, _class in ((range(97, 123), LOWER), (range(65, 91), UPPER), (range(48, 58), DIGIT), (b" \t\r\x0b\x0c", SPACE), (b"#*$%&<>", SYMBOL), (b"|", PIPE), (b"!", BANG), (b".?", STOP), (b",;:", COMMA), (range(128, 256), HIGH), (b"\n", END)):
    CLASSES[list(_chars)] = _class
N_CLASSES = 12
#: Bytes that are counted at once.
COUNTED = 1 << 22
#: Lines whose features are made at once in scoring.
SLICE = 1 << 15
#: Features of one line; a line has those of its neighbours too.
N_FEATURES = 16


@dataclass
class Model:
    weights: np.ndarray
    transitions: np.ndarray
    start: float
    slope: float
    shift: float


@dataclass
class Lines:
    """The lines of texts, side by side in one array of bytes."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    again: np.ndarray  # whether a line repeats one of its text
    begins: np.ndarray  # the first line of each text

    @staticmethod
    def of(texts: list[str | None]) -> Lines:
        raw = [(t or "").encode() + b"\n" for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.flatnonzero(data == 10)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        per_text = np.array([x.count(b"\n") for x in raw], np.int64)
        begins = np.concatenate([[0], np.cumsum(per_text)])[:-1] if raw else np.zeros(0, np.int64)
        again, at = np.zeros(len(ends), bool), 0
        for x in raw:
            seen: set[bytes] = set()
            for piece in x[:-1].split(b"\n"):
                if piece in seen:
                    again[at] = True
                elif piece:
                    seen.add(piece)
                at += 1
        return Lines(data, starts, ends, again, begins)

    def own(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Features of lines i to j without their neighbours', and their lengths without spaces."""
        starts, ends, n = self.starts[i:j], self.ends[i:j], j - i
        lens = ends - starts + 1
        counts = np.zeros((n, N_CLASSES), np.float32)
        for a in range(int(starts[0]), int(ends[-1]) + 1, COUNTED):
            b = min(a + COUNTED, int(ends[-1]) + 1)
            low, high = np.searchsorted(ends, [a, b - 1])
            inside = np.minimum(ends[low : high + 1], b - 1) - np.maximum(starts[low : high + 1], a) + 1
            line = np.repeat(np.arange(high - low + 1), inside)
            found = np.bincount(line * N_CLASSES + CLASSES[self.data[a:b]], minlength=(high - low + 1) * N_CLASSES)
            counts[low : high + 1] += found.reshape(-1, N_CLASSES)
        size = np.maximum(lens - 1, 1).astype(np.float32)
        ink = np.maximum(lens - 1 - counts[:, SPACE], 0)
        words = np.maximum(counts[:, SPACE] + 1, 1)
        letters = np.maximum(counts[:, LOWER] + counts[:, UPPER] + counts[:, HIGH], 1)
        last, first = self.data[np.maximum(ends - 1, starts)], self.data[starts]
        own = np.stack(
            [
                np.log1p(size) / 5, counts[:, UPPER] / letters, counts[:, DIGIT] / size, counts[:, SPACE] / size * 3,
                np.minimum(counts[:, SYMBOL] / words, 3), np.minimum(counts[:, PIPE] / words, 1), np.minimum(counts[:, BANG] / words, 2),
                np.minimum(counts[:, STOP] / words, 1) * 3, np.minimum(counts[:, COMMA] / words, 1) * 3, np.minimum(counts[:, OTHER] / words, 2),
                CLASSES[last] == STOP, CLASSES[first] == UPPER, counts[:, UPPER] > letters * 0.5, lens <= 1, self.again[i:j], np.minimum(letters / words / 10, 3),
            ],
            axis=1,
        ).astype(np.float32)
        return own, ink

    def beside(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the lines before and after each line; zeros beyond the ends of a text."""
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1:], after[:-1] = own[:-1], own[1:]
        if len(self.begins):
            before[self.begins] = 0
            after[np.append(self.begins[1:], len(own)) - 1] = 0
        return before, after


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines (with their neighbours'), the lines' lengths without spaces, and each text's first line."""
    lines = Lines.of(texts)
    n = len(lines.ends)
    own, ink = lines.own(0, n) if n else (np.zeros((0, N_FEATURES), np.float32), np.zeros(0, np.float32))
    return np.concatenate([np.ones((n, 1), np.float32), own, *lines.beside(own)], axis=1), ink, lines.begins


def line_scores(texts: list[str | None], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The weighed features of all lines, their lengths and each text's first line.

    Weights are applied to ``SLICE`` lines at a time and then moved to the neighbours, so that a line costs a few numbers.
    """
    lines = Lines.of(texts)
    n = len(lines.ends)
    parts, ink = np.zeros((n, 3)), np.zeros(n, np.float32)
    for i in range(0, n, SLICE):
        j = min(n, i + SLICE)
        own, ink[i:j] = lines.own(i, j)
        parts[i:j] = own @ weights[1:].reshape(3, -1).T
    return weights[0] + parts[:, 0] + lines.beside(parts[:, 1])[0] + lines.beside(parts[:, 2])[1], ink, lines.begins


class Chains:
    """Chains of lines, longest first; step after step, those that are still going lie side by side."""

    def __init__(self, lens: list[int]) -> None:
        self.order = np.argsort(-np.array(lens), kind="stable")
        lens_ = np.array(lens)[self.order]
        self.going = np.searchsorted(-lens_, -np.arange(lens_[0] if len(lens_) else 0), side="left")
        self.at = np.concatenate([[0], np.cumsum(self.going)]).astype(np.int64)
        self.chain = np.concatenate([np.arange(m) for m in self.going]) if len(lens_) else np.zeros(0, np.int64)
        self.before = np.concatenate([np.arange(a, a + m) for a, m in zip(self.at, self.going[1:], strict=False)]) if len(self.going) > 1 else np.zeros(0, np.int64)

    def rows(self, k: int, n: int) -> np.ndarray:
        """Where the n lines of the k-th chain lie."""
        return self.at[:n] + k

    def marginals(self, scores: np.ndarray, transitions: np.ndarray, start: float | np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of every line and the weighed sums of the pairs' probabilities; ``start`` is of each chain, ``weights`` of each line."""
        emit = np.exp(np.clip(scores, -30, 30))
        (t00, t01), (t10, t11) = np.exp(transitions).tolist()
        p, r = np.empty(len(emit)), np.ones(len(emit))
        first = self.going[0]
        q = np.exp(start * np.ones(first)) * emit[:first]
        p[:first] = q / (1 + q)
        for a, b, m in zip(self.at, self.at[1:], self.going[1:], strict=False):
            old = p[a : a + m]
            one = ((1 - old) * t01 + old * t11) * emit[b : b + m]
            p[b : b + m] = one / (one + (1 - old) * t00 + old * t10)
        for a, b, m in zip(self.at[-3::-1], self.at[-2:0:-1], self.going[:0:-1], strict=True):
            e = emit[b : b + m] * r[b : b + m]
            r[a : a + m] = (t10 + t11 * e) / (t00 + t01 * e)
        good = p * r / (p * r + 1 - p)
        a, b = p[self.before], (emit * r)[first:]
        pairs = np.stack([(1 - a) * t00, (1 - a) * t01 * b, a * t10, a * t11 * b])
        pairs *= weights[first:] / pairs.sum(axis=0)
        return good, pairs.sum(axis=1).reshape(2, 2)


def cut(n: int) -> list[tuple[int, int]]:
    """First line and end of the chains of a document of ``n`` lines."""
    step = CHAIN_LINES - OVERLAP
    return [(a, min(n, a + CHAIN_LINES)) for a in range(0, max(1, n - OVERLAP), step)]


def train(documents: list[tuple[np.ndarray, np.ndarray, int]], for_good: float = FOR_GOOD, for_bad: float = FOR_BAD) -> Model:
    """Maximum likelihood with a ridge, by Adam; ``documents`` are (features, lengths, label) of all lines.

    Where bad documents hold many good lines, ``for_bad`` should be near 0.
    """
    width = 1 + 3 * N_FEATURES
    whole = np.array([y for *_, y in documents])
    if len(set(whole.tolist())) < 2:
        return Model(np.zeros(width), np.zeros((2, 2)), 0.0, 0.0, 0.0)
    pieces = [(x[a:b], y, a == 0, 1 / len(spans)) for x, _, y in documents for spans in [cut(len(x))] for a, b in spans]
    chains = Chains([len(x) for x, *_ in pieces])
    pieces = [pieces[i] for i in chains.order]
    flat = np.zeros((int(chains.at[-1]), width), np.float32)
    for k, (x, *_) in enumerate(pieces):
        flat[chains.rows(k, len(x))] = x
    of_chain, opens, weights = (np.array([c[i] for c in pieces], float) for i in (1, 2, 3))
    labels, weighed = of_chain[chains.chain], weights[chains.chain]
    total = weighed.sum()
    theta = np.zeros(width + 5)

    def marginals(evidence: float | np.ndarray = 0.0) -> tuple[np.ndarray, np.ndarray]:
        return chains.marginals(flat @ theta[:width] + evidence, theta[width : width + 4].reshape(2, 2), theta[-1] * opens, weighed)

    # At first every line has its document's label, and lines aren't tied to each other.
    target, seen = labels, None
    for _ in range(ROUNDS):
        m, v = np.zeros(width + 5), np.zeros(width + 5)
        for step in range(1, STEPS + 1):
            good, pairs = marginals()
            begun = ((target - good)[: len(pieces)] * opens * weights).sum()
            ties = np.zeros(4) if seen is None else (seen - pairs).ravel()
            slope = np.concatenate([flat.T @ ((target - good) * weighed).astype(np.float32), ties, [begun]]) / total - RIDGE * theta
            if np.abs(slope).max() < ENOUGH:
                break
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
            theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        # Then the document's label is evidence about each of its lines, which may differ from it.
        target, seen = marginals(np.where(labels == 1, for_good, for_bad))
    model = Model(theta[:width], theta[width : width + 4].reshape(2, 2), float(theta[-1]), 1.0, 0.0)
    means = np.array([(_good(model, x @ model.weights, [(0, len(x))]) * ink).sum() / max(ink.sum(), 1) for x, ink, _ in documents])
    odds = np.log(np.clip(means, 1e-4, 1 - 1e-4) / (1 - np.clip(means, 1e-4, 1 - 1e-4)))
    fit = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-(fit[0] * odds + fit[1])))
        w = p * (1 - p) + 1e-6
        x = np.stack([odds, np.ones_like(odds)])
        fit += np.linalg.solve((x * w) @ x.T + 1e-2 * np.eye(2), x @ (whole - p) - 1e-2 * fit)
    return replace(model, slope=float(max(fit[0], 1e-3)), shift=float(fit[1]))


def within_lines(sizes: list[tuple[int, int, int, int]], most: int) -> list[int]:
    """Which documents (hash, label, lines, copies) to take, in the order of their hashes, so that they have ``most`` lines at most.

    Each label has the share of the lines that it has of the documents, and one document at most an eighth of that;
    longer ones are passed over. A label of long documents only gives its shortest one; if that has more than ``most`` lines, it is an error.
    """
    if sum(lines * n for _, _, lines, n in sizes) <= most:
        return [h for h, *_ in sizes]
    total, chosen = sum(n for *_, n in sizes), []
    for label in sorted({y for _, y, _, _ in sizes}):
        own = sorted((h, lines, n) for h, y, lines, n in sizes if y == label)
        room = most * sum(n for *_, n in own) // total
        taken, longest = [], room // 8
        for h, lines, n in own:
            if lines <= longest and lines * n <= room:
                taken.append(h)
                room -= lines * n
        if not taken:
            lines, h = min((lines * n, h) for h, lines, n in own)
            if lines > most:
                raise ValueError(f"every document of label {label} has more lines than the {most} that a model may be fitted on")
            taken = [h]
        chosen += taken
    return chosen


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "quality", id_col: str = "doc_id", max_docs: int = MAX_DOCS) -> Model:
    """Learn from documents joined with their labels. Features are made in the tasks; the driver gets the bounded sample's."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).alias("label"), *(c for c in labelled.columns if c == DRAWN))
    sample = drawn(rows, ["id", "text"], max_docs, hashed=DRAWN if DRAWN in rows.columns else None).withColumn("lines", F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\n")) + 1)
    sample = stored(sample, "field-sample")
    sizes = [tuple(r) for r in sample.groupBy("hash", "label", "lines").agg(F.count("*").alias("n")).collect()]  # at most max_docs
    chosen = within_lines(sizes, MAX_LINES)
    if len(chosen) < len(sizes):
        sample = sample.join(F.broadcast(labelled.sparkSession.createDataFrame([(h,) for h in chosen], "hash long")), "hash")

    def start():
        def apply(texts: list) -> list:
            x, ink, begins = line_features(texts)
            spans = list(zip(begins.tolist(), np.append(begins[1:], len(x)).tolist(), strict=True))
            return [[x[a:b].tobytes() for a, b in spans], [ink[a:b].astype(np.float32).tobytes() for a, b in spans]]

        return apply

    got = with_columns(sample.select("text", "label"), "text", {"x": BINARY, "ink": BINARY}, start).select("label", "x", "ink").toPandas()
    width = 1 + 3 * N_FEATURES
    return train([(np.frombuffer(x, np.float32).reshape(-1, width), np.frombuffer(ink, np.float32), int(y)) for y, x, ink in zip(got["label"], got["x"], got["ink"], strict=True)])


def labelled(documents: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with a label; several labels of one document count as their mean, rounded. ``DRAWN`` is hashed below the join, so that drawing moves no texts."""
    one = labels.filter(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.round(F.avg(label_col)).cast("int").alias(label_col))
    return documents.withColumn(DRAWN, hash63(id_col, text_col)).join(one, id_col)


def _good(model: Model, scores: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """P(good) of every line; ``spans`` are the first line and end of each text."""
    (t00, t01), (t10, t11) = np.exp(model.transitions).tolist()
    good = np.empty(len(scores))
    for first, end in spans:
        old, going = 0.0, False
        for a in range(first, end, SLICE):
            part = np.exp(np.clip(scores[a : min(end, a + SLICE)], -30, 30)).tolist()
            for k, e in enumerate(part):
                one = ((1 - old) * t01 + old * t11) * e if going else math.exp(model.start) * e
                old = one / (one + ((1 - old) * t00 + old * t10 if going else 1.0))
                part[k], going = old, True
            good[a : a + len(part)] = part
        r = 1.0  # backward message of good over bad
        for a in range(first + (end - first - 1) // SLICE * SLICE, first - 1, -SLICE):
            b = min(end, a + SLICE)
            emit, part = np.exp(np.clip(scores[a:b], -30, 30)).tolist(), good[a:b].tolist()
            for k in range(b - a - 1, -1, -1):
                p = part[k]
                part[k] = p * r / (p * r + 1 - p)
                e = emit[k] * r
                r = (t10 + t11 * e) / (t00 + t01 * e)
            good[a:b] = part
    return good


def marginals(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(good) of every line of every text, the lines' lengths and each text's first line."""
    scores, ink, begins = line_scores(texts, model.weights)
    ends = np.append(begins[1:], len(scores)).tolist()
    return _good(model, scores, list(zip(begins.tolist(), ends, strict=True))), ink, begins


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with ``quality_score`` (0 to 1), ``n_good_lines`` and ``n_bad_lines``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model = shared.value

        def apply(texts: list) -> list:
            if not texts:
                return [[], [], []]
            good, ink, begins = marginals(model, texts)
            total = np.add.reduceat(ink, begins)
            mean = np.clip(np.add.reduceat(good * ink, begins) / np.maximum(total, 1), 1e-4, 1 - 1e-4)
            scores = 1 / (1 + np.exp(-(model.slope * np.log(mean / (1 - mean)) + model.shift)))
            full = ink > 0
            fine = np.add.reduceat((full & (good >= 0.5)).astype(np.int64), begins)
            return [np.where(total > 0, scores, 0.0), fine, np.add.reduceat(full.astype(np.int64), begins) - fine]

        return apply

    return with_columns(df, text_col, {"quality_score": DOUBLE, "n_good_lines": LONG, "n_bad_lines": LONG}, start)
