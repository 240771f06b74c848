"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of an Arrow batch, so that a task's memory doesn't depend on the length of texts.
ARROW_BYTES = 4 << 20

#: Python types of the columns that operators add: Spark type, Arrow type.
LONG = (T.LongType(), pa.int64())
INT = (T.IntegerType(), pa.int32())
DOUBLE = (T.DoubleType(), pa.float64())
STRING = (T.StringType(), pa.string())
BOOLEAN = (T.BooleanType(), pa.bool_())
BINARY = (T.BinaryType(), pa.binary())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the Python stages by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of doc_id as text, mod ``modulus``; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path under the folder that driver and executors share (spark.checkpoint.dir).

    A temporary folder is taken only where that setting is unset and Spark runs in one process, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def threshold(share: float) -> int:
    """Up to which the ``share`` of all 63-bit hashes lies."""
    return min(int(share * (1 << 63)), (1 << 63) - 1)


def hash63(*columns: str) -> Column:
    """A 63-bit hash of columns."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in columns)).bitwiseAND(F.lit((1 << 63) - 1))


def cuts(keys: DataFrame, most: int) -> DataFrame:
    """For each ``group`` of ``keys`` (group, hash): the ``cut`` up to which its ``most`` smallest hashes reach, how many rows have that hash, and how many of these count.

    Rows are first counted by the magnitude of their hash; only the magnitudes that hold the cut are counted by hash.
    """
    size = F.floor(F.log2(F.col("hash").cast("double") + 1)).cast("int")
    running = lambda by: F.sum("n").over(W.partitionBy("group").orderBy(by).rowsBetween(W.unboundedPreceding, 0))
    sizes = keys.groupBy("group", size.alias("size")).agg(F.count("*").alias("n")).withColumn("upto", running("size"))
    reached = stored(sizes.filter(F.col("upto") - F.col("n") < most).groupBy("group").agg(F.max("size").alias("size")), "sample-sizes")
    near = keys.join(reached, "group").filter(size <= F.col("size")).groupBy("group", "hash").agg(F.count("*").alias("n")).withColumn("upto", running("hash"))
    near = near.filter(F.col("upto") - F.col("n") < most)
    last = near.groupBy("group").agg(F.max(F.struct("hash", "n", "upto")).alias("x"))
    return last.select("group", F.col("x.hash").alias("cut"), F.col("x.n").alias("n"), F.least(F.col("x.n"), most - F.col("x.upto") + F.col("x.n")).alias("count"))


def drawn(df: DataFrame, by: list[str], most: int, within: str | None = None, groups: int = 10_000, hashed: str | None = None) -> DataFrame:
    """The ``most`` rows of ``df`` (of each value of ``within``) whose columns ``by`` have the smallest hashes; all rows if there are no more.

    Exactly so many, however often rows repeat: of the rows at the last hash as many count as are wanted, one of them
    standing for the others. ``hash`` is the column by which rows were drawn; ``hashed`` names it where it was made before,
    say below a join, which then moves no texts of rows that aren't drawn. Only hashes are ranked, never rows. More
    than ``groups`` values of ``within`` are an error; rows without one are left out.
    """
    spark = df.sparkSession
    keyed = df.withColumns({"hash": F.col(f"`{hashed}`") if hashed else hash63(*by), "group": F.lit("") if within is None else F.col(f"`{within}`").cast("string")})
    keys = stored(keyed.select("group", "hash"), "sample-keys")
    found = cuts(keys, most).limit(groups + 1).collect()
    if len(found) > groups:
        raise ValueError(f"over {groups} values of {within}")
    if within is None:  # as numbers the bounds reach the scan
        near = keyed.withColumns({"cut": F.lit(found[0]["cut"]), "count": F.lit(found[0]["count"])}) if found else keyed.withColumns({"cut": F.lit(0), "count": F.lit(0)})
    else:
        at = spark.createDataFrame([(r["group"], r["cut"], r["count"]) for r in found], "group string, cut long, count long")
        near = keyed.join(F.broadcast(at), "group")  # a row for each group
    spread = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 64)
    columns = [*(c for c in df.columns if c != hashed), "hash"]
    if all(r["n"] == r["count"] for r in found):
        return near.filter(F.col("hash") <= F.col("cut")).select(columns).repartition(spread, "hash")
    once = near.filter(F.col("hash") == F.col("cut")).groupBy("group", "count").agg(F.first(F.struct(*columns)).alias("row"))
    copies = once.select("row.*", F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("#copy"))
    below = near.filter(F.col("hash") < F.col("cut")).select(*columns, F.lit(0).cast("long").alias("#copy"))
    return below.unionByName(copies).repartition(spread, "hash", "#copy").drop("#copy")


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again: it cuts the lineage."""
    path = shared_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sealed(df: DataFrame, keep: list[str], made: dict[str, Column]) -> DataFrame:
    """The columns ``keep`` and ``made``, so that filters on ``made`` stay above their evaluation.

    Pushed below it, a filter would repeat nested array expressions inside their own lambdas,
    for each element again; a generator of one row is a step that no filter passes.
    """
    one = F.array(F.struct(*(c.alias(n) for n, c in made.items())))
    return df.select(*(F.col(f"`{c}`") for c in keep), F.inline(one))


def with_columns(
    df: DataFrame,
    text_col: str,
    new: dict[str, tuple[T.DataType, pa.DataType]],
    start: Callable[[], Callable[[list], list]],
    kind: str = "string",
) -> DataFrame:
    """Append columns that a Python function computes from whole texts, batch by batch.

    ``start()`` runs once in each task and returns the function from a list of texts to
    one list for each new column; ``kind`` is the Spark type that the function reads. Rows keep their other columns; an input column of the
    same name as a new one is replaced.
    """
    bounded_batches(df.sparkSession)
    keep = [c for c in df.columns if c not in new]
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(k, v[0]) for k, v in new.items())])
    arrow = [v[1] for v in new.values()]
    names = [*keep, *new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = start()
        for batch in batches:
            made = apply(batch.column("#text").to_pylist())
            columns = [batch.column(c) for c in keep] + [pa.array(m, type=a) for m, a in zip(made, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").cast(kind).alias("#text")).mapInArrow(run, schema)
