"""Gradient-boosted trees of a bounded number of leaves, grown best-first from histograms.

Columns become bins between their quantiles, a byte for each column and row. A round of boosting grows one
tree: the leaf whose split gains most is split next, until there are ``leaves`` leaves. What a split gains is read off the
histogram of gradients by (leaf, column, bin), which one aggregate makes for all leaves that lack one: tasks add
up their rows with numpy, Spark adds up the tasks. Rows of the same bins and label stand as one with their number. Children's histograms are asked for together with those of all other children
that the best splits of the present leaves would make, so a tree takes about as many aggregates as it is deep, not one for each leaf.

Gradients are integers of ``UNIT`` parts, so sums don't depend on how rows lie in partitions and a fit can be repeated exactly.
The driver gets histograms (leaves x columns x bins) and never rows. Every ``REFRESH`` trees the rows are written anew with
their present score, which bounds what later rounds evaluate and cuts the lineage.

A split has to leave ``rows_in_leaf`` rows and some curvature on both sides; equal gains fall to the column that is first, then to the smaller bin.
Leaves have the value that minimises the second-order loss with an L2 penalty, times the rate.

Cases: columns have to be without nulls (see ``ml.Imputation``); rows without a label don't count; a constant column has one bin and no split; labels of one
kind give trees without splits.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.shared import materialise
from tidewatch.operators.ranking import quantiles

#: Bins of a column at most; parts of a gradient; trees between two writes of the scores; least curvature of a leaf.
BINS, UNIT, REFRESH, CURVATURE = 64, 1 << 30, 20, 1e-3


@dataclass(frozen=True)
class Settings:
    rate: float = 0.05
    rounds: int = 200
    leaves: int = 15
    rows_in_leaf: int = 50
    penalty: float = 1.0


@dataclass
class Node:
    """A leaf, or a split: rows whose bin of ``column`` is at most ``bin`` go left."""

    column: int = -1
    bin: int = -1
    left: int = -1
    right: int = -1
    value: float = 0.0
    gain: float = 0.0
    rows: int = 0


@dataclass
class Trees:
    """A fitted model: the columns' cuts, the log odds of the mean, and the trees."""

    columns: list[str]
    cuts: list[list[float]]
    start: float
    trees: list[list[Node]] = field(default_factory=list)

    def to_json(self) -> str:
        """The model as text."""
        return json.dumps({"columns": self.columns, "cuts": self.cuts, "start": self.start, "trees": [[list(vars(n).values()) for n in t] for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Trees:
        """The model that ``to_json`` wrote."""
        found = json.loads(text)
        return Trees(found["columns"], found["cuts"], found["start"], [[Node(*n) for n in t] for t in found["trees"]])


def cut_points(rows: DataFrame, columns: list[str], bins: int = BINS) -> list[list[float]]:
    """The distinct quantiles that part each column into at most ``bins`` bins."""
    at = [k / bins for k in range(1, bins)]
    found = {r["column_name"]: sorted({r[f"q{i}"] for i in range(len(at))}) for r in quantiles(rows, columns, at).collect()}  # a row for each column
    return [found.get(c, []) for c in columns]


def bin_of(value: Column, cuts: list[float]) -> Column:
    """How many cuts lie below a value."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.lit(cuts), lambda c: c < value))


def binned(rows: DataFrame, columns: list[str], cuts: list[list[float]]) -> DataFrame:
    """``rows`` with ``bins``, a byte for each column."""
    edges = [np.array(c) for c in cuts]
    keep = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("bins", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.zeros((batch.num_rows, len(columns)), np.uint8)
            for j, (c, e) in enumerate(zip(columns, edges, strict=True)):
                made[:, j] = np.searchsorted(e, batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False), side="left")
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array([r.tobytes() for r in made], pa.binary())], names=[*keep, "bins"])

    return rows.mapInArrow(run, schema)


def _reached(bins: np.ndarray, tree: list[Node]) -> np.ndarray:
    """The leaf that each row reaches."""
    at = np.zeros(len(bins), np.int32)
    for i, node in enumerate(tree):  # children come after their parent
        if node.column >= 0:
            here = np.flatnonzero(at == i)
            at[here] = np.where(bins[here, node.column] <= node.bin, node.left, node.right)
    return at


def _raw(bins: np.ndarray, score: np.ndarray, trees: list[list[Node]]) -> np.ndarray:
    for tree in trees:
        score = score + np.array([n.value for n in tree])[_reached(bins, tree)]
    return score


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column("bins")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, width)


def gradients(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the log loss, in whole parts of ``UNIT``."""
    p = 1 / (1 + np.exp(-score))
    return np.rint((p - label) * UNIT).astype(np.int64), np.rint(p * (1 - p) * UNIT).astype(np.int64)


def _histograms(rows: DataFrame, trees: list[list[Node]], growing: list[Node], wanted: list[int], sizes: list[int]) -> dict[int, np.ndarray]:
    """Of each wanted leaf of the growing tree, the sums (gradient, curvature, rows) by column and bin."""
    width, deep = len(sizes), max(sizes)
    slot = {leaf: k for k, leaf in enumerate(wanted)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(wanted) * width * deep), np.int64)
        index = np.full(len(growing), -1)
        index[list(slot)] = list(slot.values())
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _matrix(batch, width)
            g, h = gradients(_raw(bins, batch.column("score").to_numpy(), trees), batch.column("label").to_numpy())
            n = batch.column("n").to_numpy()
            at = index[_reached(bins, growing)]
            here = at >= 0
            cell = ((at[here, None] * width + np.arange(width)) * deep + bins[here]).ravel()
            for k, v in enumerate(((g * n)[here], (h * n)[here], n[here])):
                np.add.at(total[k], cell, np.repeat(v, width))
        cells = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(cells), *(pa.array(t[cells]) for t in total)], names=["cell", "g", "h", "n"])

    sums = rows.select("label", "score", "bins", "n").mapInArrow(run, "cell long, g long, h long, n long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    found = sums.toArrow()  # leaves x columns x bins
    total = np.zeros((3, len(wanted) * width * deep), np.int64)
    for k, name in enumerate("ghn"):
        total[k, found["cell"].to_numpy()] = found[name].to_numpy()
    total = total.reshape(3, len(wanted), width, deep)
    return {leaf: total[:, k] for leaf, k in slot.items()}


def best_split(histogram: np.ndarray, s: Settings) -> tuple[float, int, int]:
    """Gain, column and bin of a leaf's best split; the gain is 0 where none is allowed."""
    g, h, n = np.cumsum(histogram, axis=2)
    all_g, all_h, all_n = (x[:, -1:] for x in (g, h, n))
    worth = lambda a, b: (a / UNIT) ** 2 / (b / UNIT + s.penalty)
    gain = worth(g, h) + worth(all_g - g, all_h - h) - worth(all_g, all_h)
    allowed = (n >= s.rows_in_leaf) & (all_n - n >= s.rows_in_leaf) & (h >= CURVATURE * UNIT) & (all_h - h >= CURVATURE * UNIT)
    gain = np.where(allowed, gain, 0.0)
    column, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[column, cut]), int(column), int(cut)


def grow(histograms, s: Settings) -> list[Node]:
    """One tree; ``histograms(tree, leaves)`` gives the histograms of leaves of a tree."""
    # The drawn tree also has the children of leaves that may never be split; the grown one is cut out of it.
    drawn, known, splits = [Node()], {}, {}

    def ask(leaves: list[int]) -> None:
        known.update(histograms(drawn, leaves))
        for leaf in leaves:
            splits[leaf] = best_split(known[leaf], s)

    def children(leaf: int) -> None:
        gain, column, cut = splits[leaf]
        drawn.extend([Node(), Node()])
        drawn[leaf] = Node(column, cut, len(drawn) - 2, len(drawn) - 1, gain=gain)

    ask([0])
    queue, final = [(-splits[0][0], 0)], []
    while queue and len(queue) + len(final) < s.leaves:
        gain, leaf = heapq.heappop(queue)
        if gain >= 0:
            final.append(leaf)
            continue
        if drawn[leaf].column < 0 or drawn[leaf].left not in splits:
            waiting = [x for g, x in [(gain, leaf), *queue] if g < 0 and drawn[x].column < 0]
            for x in waiting:
                children(x)
            ask([c for x in waiting for c in (drawn[x].left, drawn[x].right)])
        for c in (drawn[leaf].left, drawn[leaf].right):
            heapq.heappush(queue, (-splits[c][0], c))
    leaves = {*final, *(x for _, x in queue)}
    tree: list[Node] = []

    def keep(i: int) -> int:
        at = len(tree)
        tree.append(Node())
        g, h, n = (int(x) for x in known[i][:, 0].sum(axis=1))
        if i in leaves:
            tree[at] = Node(value=-s.rate * (g / UNIT) / (h / UNIT + s.penalty), rows=n)
        else:
            made = drawn[i]
            tree[at] = Node(made.column, made.bin, keep(made.left), keep(made.right), gain=made.gain, rows=n)
        return at

    keep(0)
    return tree


def fit(rows: DataFrame, label: str, columns: list[str], settings: Settings | None = None, bins: int = BINS) -> Trees:
    """Trees fitted on the rows that have a label."""
    s = settings or Settings()
    labelled = rows.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in columns))
    cuts = cut_points(labelled, columns, bins)
    sizes = [len(c) + 1 for c in cuts]
    mean = labelled.agg(F.avg("label")).first()[0]
    if mean is None:
        raise ValueError("no row has a label")
    held = min(max(mean, 1e-12), 1 - 1e-12)
    model = Trees(columns, cuts, math.log(held / (1 - held)))
    width = len(columns)
    table = materialise(_counted(binned(labelled, columns, cuts)).withColumn("score", F.lit(model.start)), "boosting-rows")
    since = 0
    for done in range(s.rounds):
        late = model.trees[since:]
        model.trees.append(grow(lambda tree, leaves, late=late, table=table: _histograms(table, late, tree, leaves, sizes), s))
        if (done + 1) % REFRESH == 0 and done + 1 < s.rounds:
            table = materialise(_scored(table, model.trees[since:], width), "boosting-rows")
            since = len(model.trees)
    return model


def _counted(rows: DataFrame) -> DataFrame:
    """``label``, ``bins`` and their number of rows ``n``."""
    return rows.groupBy("label", "bins").agg(F.count("*").alias("n"))


def _scored(table: DataFrame, trees: list[list[Node]], width: int) -> DataFrame:
    """``table`` with the trees added to ``score``."""
    names = table.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = _raw(_matrix(batch, width), batch.column("score").to_numpy(), trees)
                yield pa.RecordBatch.from_arrays([pa.array(score) if c == "score" else batch.column(c) for c in names], names=names)

    return table.mapInArrow(run, table.schema)


def predict(model: Trees, rows: DataFrame, name: str = "risk_probability") -> DataFrame:
    """``rows`` with the probability of the positive class."""
    inputs = [f"#x{i}" for i in range(len(model.columns))]
    given = rows.withColumns({x: F.col(c).cast("double") for x, c in zip(inputs, model.columns, strict=True)}).withColumn("score", F.lit(model.start))
    found = _scored(binned(given, inputs, model.cuts).drop(*inputs), model.trees, len(inputs))
    return found.withColumn(name, 1 / (1 + F.exp(-F.col("score")))).select(*rows.columns, name)


def first_gains(rows: DataFrame, label: str, columns: list[str], settings: Settings | None = None, bins: int = BINS) -> DataFrame:
    """A row for each column: its bins, and the bin and the gain of its best split of all rows before any tree."""
    s = settings or Settings()
    labelled = rows.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in columns))
    cuts = cut_points(labelled, columns, bins)
    sizes = [len(c) + 1 for c in cuts]
    mean = labelled.agg(F.avg("label")).first()[0]
    table = _counted(binned(labelled, columns, cuts)).withColumn("score", F.lit(math.log(mean / (1 - mean))))
    found = _histograms(table, [], [Node()], [0], sizes)[0]
    made = [(c, sizes[j], *best_split(found[:, j : j + 1], s)[::2]) for j, c in enumerate(columns)]
    return rows.sparkSession.createDataFrame([(c, n, cut if gain > 0 else None, gain) for c, n, gain, cut in made], "column_name string, bins long, bin long, gain double")
