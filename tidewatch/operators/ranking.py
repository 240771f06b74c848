"""Running sums, ranks and quantiles of whole tables without a single-task sort."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.shared import materialise


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds running sums in ``order``, each row's own value included; ``order`` has to end with a unique key.

    Rows are dealt by ranges of the whole order, ties of the leading column included, and
    summed in each range; the ranges' totals (a row for each range) give the offsets.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).withColumn("#part", F.spark_partition_id())
    dealt = materialise(dealt, "ranges")
    totals = dealt.groupBy("#part").agg(*(F.sum(c).alias(f"#t {name}") for name, c in sums.items()))
    before = W.orderBy("#part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("#part", *(F.coalesce(F.sum(f"#t {name}").over(before), F.lit(0)).alias(f"#o {name}") for name in sums))
    within = W.partitionBy("#part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    summed = dealt.withColumns({f"#s {name}": F.sum(c).over(within) for name, c in sums.items()})
    # At most as many rows as shuffle partitions.
    joined = summed.join(F.broadcast(offsets), "#part")
    made = {name: F.col(f"#s {name}") + F.col(f"#o {name}") for name in sums}
    return joined.withColumns(made).drop("#part", *(f"{k} {name}" for k in ("#s", "#o") for name in sums))


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds the 1-based rank of every row in ``order``, which has to end with a unique key."""
    return running(df, order, {name: F.lit(1)}).withColumn(name, F.col(name).cast("long"))


#: Cells of values that a doubling has, and distinct values of a cell that are looked at at once.
CELLS, VALUES = 64, 100_000


#: What a task sends: how many values of a column (and of its stretch ``i``) a cell has, their least and greatest.
COUNTED = "column int, i int, cell double, n long, low double, high double"
#: Rows that are counted at once.
ROWS = 100_000


def _cells(value: np.ndarray) -> np.ndarray:
    """A number that doesn't fall as values rise: one doubling of the magnitude is ``CELLS`` cells; NaN comes last."""
    size = np.floor(np.log2(np.clip(np.abs(value), 1e-300, 1e300)) * CELLS) + 2_000 * CELLS
    return np.where(np.isnan(value), 4_000.0 * CELLS, np.sign(value) * size)


def _within(of: dict[int, list[tuple[int, float, float]]], split: set[tuple[int, int]]) -> Callable[[int, np.ndarray], list[tuple[int, np.ndarray, np.ndarray]]]:
    """The values of a column that lie in its stretches, each a cell of its own or, in those of ``split``, one of ``VALUES`` equal parts."""

    def cut(k: int, v: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        out = []
        for i, lo, hi in of.get(k, []):
            # NaN is greater than all numbers.
            inside = v[((v >= lo) | np.isnan(v)) & ((v <= hi) | np.isnan(hi))]
            out.append((i, inside, np.minimum(np.floor((inside - lo) / (hi - lo) * VALUES), VALUES - 1) if (k, i) in split else inside))
        return out

    return cut


def _counting(width: int, cut: Callable[[int, np.ndarray], list[tuple[int, np.ndarray, np.ndarray]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the cells to which ``cut`` deals a column's values, from arrays of ``width`` numbers."""

    def counts(matrix: np.ndarray, there: np.ndarray) -> pa.RecordBatch:
        made: list[list[np.ndarray]] = [[np.zeros(0)] for _ in range(6)]
        for k in range(width):
            for i, values, cells in cut(k, matrix[there[:, k], k]):
                if len(values):
                    order = np.lexsort((values, cells))
                    values, cells = values[order], cells[order]
                    same = (cells[1:] == cells[:-1]) | (np.isnan(cells[1:]) & np.isnan(cells[:-1]))
                    first = np.flatnonzero(np.concatenate([[True], ~same]))
                    ends = np.append(first[1:], len(values))
                    for x, column in zip((np.full(len(first), k), np.full(len(first), i), cells[first], ends - first, values[first], values[ends - 1]), made, strict=True):
                        column.append(x)
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.float64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(t.to_pandas_dtype())) for x, t in zip(made, kinds, strict=True)], names=["column", "i", "cell", "n", "low", "high"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            flat = batch["values"].flatten()
            waiting.append((flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, width), flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width)))
            rows += len(batch)
            if rows >= ROWS:
                yield counts(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting, rows = [], 0
        if waiting:
            yield counts(*map(np.concatenate, zip(*waiting, strict=True)))

    return count


def quantiles(df: DataFrame, columns: list[str], at: list[float]) -> DataFrame:
    """A row for each column with values: ``column_name`` and ``q0``, ``q1``, ..., its exact quantiles, interpolated between neighbours.

    One scan counts values by cell; a second one looks only at cells that hold a wanted rank, and counts their
    distinct values. A cell with over ``VALUES`` distinct values is cut in equal parts and looked at again. Nothing is
    sorted or written; the driver gets the counts of cells and of those values.
    """
    spark = df.sparkSession
    # Columns go by their places: a row is one array of numbers, and each batch sends counts, not values.
    rows = df.select(F.array(*(F.col(f"`{c}`").cast("double") for c in columns)).alias("values"))
    found = rows.mapInArrow(_counting(len(columns), lambda k, v: [(0, v, _cells(v))]), COUNTED).filter("n > 0")
    cells = found.groupBy("column", "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    held: dict[int, list[tuple[float, float, int]]] = {}  # of each column: least and greatest value and rows of stretches, in order
    for r in cells.collect():
        held.setdefault(r["column"], []).append((r["low"], r["high"], r["n"]))
    wanted: dict[int, set[int]] = {}
    for k, found in held.items():
        found.sort()
        n = sum(x[2] for x in found)
        wanted[k] = {r for q in at for r in (int(q * (n - 1)), -int(-q * (n - 1) // 1))}
    while True:
        open_ = [(k, i, lo, hi) for k, found in held.items() for i, (lo, hi) in _holding(found, wanted[k]) if lo < hi]
        if not open_:
            break
        of: dict[int, list[tuple[int, float, float]]] = {}  # at most two stretches for each quantile
        for k, i, lo, hi in open_:
            of.setdefault(k, []).append((i, lo, hi))
        few: dict[tuple[int, int], int] = {}
        if sum(_rows(held[k][i]) for k, i, *_ in open_) > VALUES:
            distinct = rows.mapInArrow(_counting(len(columns), _within(of, set())), COUNTED)
            few = {(r["column"], r["i"]): r["n"] for r in distinct.groupBy("column", "i").agg(F.approx_count_distinct("low").alias("n")).collect()}
        split = {x[:2] for x in open_ if few.get(x[:2], 0) > VALUES // 2}
        counted = rows.mapInArrow(_counting(len(columns), _within(of, split)), COUNTED)
        parts = counted.groupBy("column", "i", "cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        finer: dict[tuple[int, int], list[tuple[float, float, int]]] = {}
        for r in parts.collect():
            finer.setdefault((r["column"], r["i"]), []).append((r["low"], r["high"], r["n"]))
        for k, found in held.items():
            held[k] = [y for i, x in enumerate(found) for y in sorted(finer.get((k, i), [x]))]
    out = []
    for k, found in held.items():
        n = sum(x[2] for x in found)
        value = {r: lo for r, (lo, _) in _ranked(found, wanted[k])}
        made = []
        for q in at:
            place = q * (n - 1)
            low, high = value[int(place)], value[-int(-place // 1)]
            made.append(low + (place - int(place)) * (high - low) if low != high else low)
        out.append((columns[k], *made))
    return spark.createDataFrame(out, f"column_name string{''.join(f', q{i} double' for i in range(len(at)))}")


def _rows(stretch: tuple[float, float, int]) -> int:
    return stretch[2]


def _ranked(found: list[tuple[float, float, int]], ranks: set[int]) -> list[tuple[int, tuple[float, float]]]:
    """The bounds of the stretch that holds each rank."""
    out, before, at = [], 0, 0
    for r in sorted(ranks):
        while r >= before + found[at][2]:
            before += found[at][2]
            at += 1
        out.append((r, found[at][:2]))
    return out


def _holding(found: list[tuple[float, float, int]], ranks: set[int]) -> list[tuple[int, tuple[float, float]]]:
    """The numbers and bounds of the stretches that hold a rank."""
    out, before = [], 0
    for i, (lo, hi, n) in enumerate(found):
        if any(before <= r < before + n for r in ranks):
            out.append((i, (lo, hi)))
        before += n
    return out


def tile(rank: Column, n: Column, tiles: int) -> Column:
    """NTILE in closed form from a rank and the number of rows."""
    q, m = F.floor(n / tiles), n % tiles
    long = m * (q + 1)
    small = F.floor((rank - long - 1) / F.greatest(q, F.lit(1))) + m + 1
    return F.when(rank <= long, F.floor((rank - 1) / (q + 1)) + 1).otherwise(small).cast("long")


def with_tiles(df: DataFrame, order: list[Column], tiles: int, name: str) -> DataFrame:
    """Adds NTILE(tiles) in ``order``."""
    total = df.agg(F.count("*").alias("#total"))
    ranked = global_rank(df, order, "#rank").crossJoin(F.broadcast(total))  # one row
    return ranked.withColumn(name, tile(F.col("#rank"), F.col("#total"), tiles)).drop("#rank", "#total")
