"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path under spark.checkpoint.dir, which driver and executors share.

    A temporary folder is taken only where that setting is unset and Spark runs in one process, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


#: Bytes of files, and rows, that make one task once they are dealt by a key; well compressed files have many rows.
PART_BYTES, PART_ROWS = 8 << 20, 250_000


def parts(stored: DataFrame) -> int:
    """Partitions that keep a task's rows in memory: one for each ``PART_BYTES`` of the files of ``stored`` and for each ``PART_ROWS`` of its rows (which the files' footers tell), the configured number at least."""
    size = int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES), -(-stored.count() // PART_ROWS))


def materialise(df: DataFrame, what: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written as Parquet under spark.checkpoint.dir and read again; it cuts the lineage. Columns ``by`` become folders, so that rows of one value are read alone."""
    path = shared_path(df.sparkSession, what)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*(f"`{c}`" for c in df.columns))


def compiled(spark: SparkSession) -> None:
    """Let wide plans run as compiled code.

    The JVM leaves methods of over 8,000 bytes uncompiled, and one generated for a whole stage of many columns is longer. Above this bound Spark runs
    the stage operator by operator, whose code it splits.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
