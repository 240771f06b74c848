"""Sinks: verified writes, and insert-only loads into partitioned tables.

Plain Parquet tables have no transaction over two tables. A load into catalog tables therefore asserts first,
appends the decisions next and the run's row last; that row is the commit marker, and
readers join with it. A load that stopped half-way is completed by running it again. ``ledger`` commits both at once.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import differs
from tidewatch.functions.shared import materialise, parts, shared_path
from tidewatch.operators import constraints
from tidewatch.sources import contracts

#: Partitions of a source by which a target is narrowed; of more, it is read whole.
MOST_PARTITIONS = 10_000
INGESTED = T.StructField("ingested_at", T.TimestampType())


class ConflictError(ValueError):
    """An immutable key is already stored with other values."""


def distinct_paths(*paths: str) -> None:
    """An error if an output is written over an input or another output."""
    plain = [p.rstrip("/") for p in paths]
    if len(set(plain)) < len(plain):
        raise ValueError("paths have to be distinct")
    for a in plain:
        if any(b.startswith(a + "/") for b in plain):
            raise ValueError(f"{a} holds another path")


def _files(spark: SparkSession, path: str):
    """The file system of a path, and Hadoop's constructor of paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def recover(spark: SparkSession, path: str) -> None:
    """Undo what a writer that died while it published has left: if ``path`` is missing, its last version comes back."""
    files, make = _files(spark, path)
    target = make(path.rstrip("/"))
    kept = sorted(s.getPath().toString() for s in files.globStatus(make(f"{target.toString()}.previous-*")) or [])
    if files.exists(target):
        for old in kept:
            files.delete(make(old), True)
    elif kept and not files.rename(make(kept[-1]), target):
        raise OSError(f"{path} can't be recovered")


def write_verified(df: DataFrame, path: str, verify: Callable[[DataFrame], None], partition_by: list[str] | None = None) -> str:
    """Write Parquet beside ``path``, verify what was written, then publish it by a rename.

    An older version is moved aside first and deleted last, so one whole version exists at any
    time: after a crash between the two renames ``recover`` (which every call begins with) puts
    it back. On object stores a rename copies.
    """
    spark = df.sparkSession
    recover(spark, path)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(staging)
    verify(spark.read.parquet(staging))
    publish(spark, staging, path)
    return path


def write_observed(df: DataFrame, path: str, rules: list[constraints.Rule], partition_by: list[str] | None = None) -> dict[str, int]:
    """As ``write_verified``, but the rules are counted while the rows are written; the row count and what each rule found.

    What was written is read again for the row counts in the files' footers only, and for the columns of unique keys, which
    can't be counted on the way.
    """
    spark = df.sparkSession
    recover(spark, path)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    seen, on_the_way = Observation(), [r for r in rules if not r.key]
    # A session that has observed can't send out fitted models any more, so another one writes.
    view = f"observed_{uuid.uuid4().hex}"
    df.createGlobalTempView(view)
    try:
        rows = spark.newSession().table(f"global_temp.{view}")
        observed = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *(r.violations.cast("long").alias(f"v{i}") for i, r in enumerate(on_the_way)))
        observed.write.partitionBy(*(partition_by or [])).parquet(staging)
    finally:
        spark.catalog.dropGlobalTempView(view)
    found = {"rows": seen.get["rows"]} | {r.name: seen.get[f"v{i}"] for i, r in enumerate(on_the_way)}
    written = spark.read.schema(df.schema).parquet(staging)
    keys = {r.name: r.key for r in rules if r.key}
    if keys:
        found |= {r["constraint_name"]: r["violations"] for r in constraints.repeats(written, keys).collect()}  # a row for each rule
    if written.count() != found["rows"]:
        raise contracts.ContractError(f"{path}: other rows were written than were counted")
    broken = sorted(n for n, v in found.items() if n != "rows" and v)
    if broken:
        _files(spark, staging)[0].delete(_files(spark, staging)[1](staging), True)
        raise constraints.ConstraintError(f"failed: {', '.join(broken)}")
    publish(spark, staging, path)
    return found


def publish(spark: SparkSession, staging: str, path: str) -> None:
    """Put a written folder in the place of ``path``."""
    files, make = _files(spark, path)
    source, target, old = make(staging), make(path), make(f"{path.rstrip('/')}.previous-{uuid.uuid4().hex}")
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"{path} can't be moved aside")
    if not files.rename(source, target):
        if replaced:
            files.rename(old, target)
        raise OSError(f"{path} can't be published")
    if replaced:
        files.delete(old, True)


def export(df: DataFrame, directory: str, order: list[str] | None = None) -> tuple[str, str]:
    """The dataset as Parquet and as CSV, sorted if asked; both have the same rows, and the order is verified after the write."""
    pq, text = f"{directory}/parquet", f"{directory}/csv"
    rows = df.orderBy(*order) if order else df
    rows.write.mode("overwrite").parquet(pq)
    stored = df.sparkSession.read.schema(df.schema).parquet(pq)
    (stored.orderBy(*order) if order else stored).write.mode("overwrite").option("header", True).csv(text)
    copy = df.sparkSession.read.schema(df.schema).csv(text, header=True)
    if constraints.differences(stored, copy).limit(1).count():
        raise contracts.ContractError("the CSV copy differs")
    if order and out_of_order(df.sparkSession, pq, order).limit(1).count():
        raise contracts.ContractError("the written rows aren't in order")
    return pq, text


def out_of_order(spark: SparkSession, path: str, order: list[str]) -> DataFrame:
    """Rows of a Parquet folder that stand before their predecessor in ``order``; files count in the order of their names.

    Rows are compared within their file, and the files' first and last rows with each other.
    """
    place = F.struct(*order)
    rows = spark.read.parquet(path).select(place.alias("at"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    inside = rows.withColumn("before", F.lag("at").over(W.partitionBy("file").orderBy("row")))
    ends = rows.groupBy("file").agg(F.min("at").alias("at"), F.max("at").alias("last"))  # a row for each file
    between = ends.withColumn("before", F.lag("last").over(W.orderBy("file")))
    return inside.select("at", "before").unionByName(between.select("at", "before")).filter(F.col("at") < F.col("before"))


def write_metadata(row: DataFrame, path: str) -> str:
    """A one-row table as JSON, keys sorted, nulls kept."""
    row.select(*sorted(row.columns)).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def freeze(row: DataFrame, path: str) -> DataFrame:
    """A one-row record that is written once: later calls with the same values read it, others are errors."""
    spark = row.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        row.coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    if constraints.differences(stored, row).limit(1).count():
        raise ConflictError(f"{path} holds another record")
    return stored


def save_table(df: DataFrame, name: str, comment: str, path: str | None = None) -> None:
    """Create or replace a table with a comment; ``path`` is where its files go, by default the warehouse."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(39) * 2)}'")


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Create or replace a persisted view."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def ensure_table(spark: SparkSession, name: str, contract: T.StructType, partition: T.StructField | None = None, path: str | None = None, cluster_by: list[str] | None = None, buckets: int = 8) -> None:
    """Create the table if it is missing, partitioned and clustered (in sorted buckets) if asked; add columns that it lacks."""
    fields = [*contract.fields, INGESTED, *([partition] if partition else [])]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        by = f" PARTITIONED BY ({partition.name})" if partition else ""
        keys = ", ".join(cluster_by or [])
        clustered = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS" if keys else ""
        at = f" LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{by}{clustered}{at}")
        return
    have = set(spark.table(name).columns)
    lacking = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name not in have)
    if lacking:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({lacking})")


def staging_name(table: str, run_id: str) -> str:
    """The name of a run's own staging table."""
    if not re.fullmatch(r"[0-9a-z_]{1,64}", run_id):
        raise ValueError("run_id has to be lower-case letters, digits and underscores")
    return f"{table}_stage_{run_id}"


@contextmanager
def staged_load(df: DataFrame, table: str, run_id: str, contract: T.StructType) -> Iterator[DataFrame]:
    """``df`` in a run's staging table of exactly these columns, which is emptied first and dropped in the end."""
    spark, name = df.sparkSession, staging_name(table, run_id)
    try:
        path = shared_path(spark, "stage")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        contracts.conform(df, contract).write.mode("overwrite").option("path", path).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def conflicts(source: DataFrame, target: DataFrame, key: list[str], ignore: tuple[str, ...] = ("ingested_at",)) -> DataFrame:
    """Source rows whose key is stored with any other value."""
    compared = [c for c in source.columns if c not in key and c not in ignore]
    stored = target.select(*key, *(F.col(c).alias(f"#{c}") for c in compared))
    changed = F.lit(False)
    for c in compared:
        changed |= differs(F.col(c), F.col(f"#{c}"))
    return source.join(stored, key).filter(changed).select(*source.columns)


def new_rows(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Source rows whose key isn't stored yet."""
    return source.join(target.select(*key), key, "left_anti")


def touched(target: DataFrame, source: DataFrame, partition: str | None) -> DataFrame:
    """The rows of ``target`` in the partitions that ``source`` has rows in: the scan reads no others."""
    if not partition:
        return target
    values = [r[0] for r in source.select(partition).distinct().limit(MOST_PARTITIONS + 1).collect()]
    if len(values) > MOST_PARTITIONS or None in values:
        return target
    return target.filter(F.col(partition).isin(values))


def merge_insert_only(source: DataFrame, name: str, key: list[str], ingested_at: datetime, cluster_by: list[str] | None = None, partition: str | None = None) -> None:
    """Append the source's new keys; an error, and no row, if the source repeats a key or a stored key differs.

    The source is written once, so that what is checked is what is stored, and the target is read once: only the partitions
    that the source has rows in, if ``partition`` names a partition column that follows from the key. One writer at a time:
    plain Parquet tables don't keep two writers from inserting the same key; ``ledger`` does.
    """
    spark = source.sparkSession
    source = materialise(source, "merge")
    constraints.enforce(source, [constraints.unique(*key), constraints.required(*key)])
    target = spark.table(name)
    compared = [c for c in source.columns if c not in key and c != "ingested_at"]
    changed = F.lit(False)
    for c in compared:
        changed |= differs(F.col(c), F.col(f"#{c}"))
    n = parts(source)  # both sides are dealt to as many tasks as the source's size asks for
    stored = touched(target, source, partition).select(*key, *(F.col(c).alias(f"#{c}") for c in compared), F.lit(True).alias("#held"))
    both = source.repartition(n, *key).join(stored.repartition(n, *key), key, "left").withColumn("#changed", F.col("#held").isNotNull() & changed)
    both = materialise(both.select(*source.columns, "#held", "#changed"), "merge")
    if not both.filter("`#changed`").isEmpty():
        raise ConflictError(f"{name}: a stored key has other values")
    stamped = both.filter("`#held` is null").select(*source.columns).withColumn("ingested_at", F.lit(ingested_at.astimezone(UTC)).cast("timestamp"))
    fresh = stamped.select(*(F.col(f.name).cast(f.dataType) if f.name in stamped.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema))
    if cluster_by:
        fresh = fresh.sortWithinPartitions(*cluster_by)
    fresh.write.mode("append").insertInto(name)


def load_run(spark: SparkSession, run: DataFrame, decisions: DataFrame, runs_table: str, decisions_table: str, ingested_at: datetime, path: str | None = None, by_month: bool = False) -> None:
    """Load a run through its staging tables: all assertions, then the decisions, then the run's row as commit marker.

    Decisions are partitioned by their prediction's day, or its month.
    """
    at = lambda x: f"{path}/{x}" if path else None
    ensure_table(spark, runs_table, contracts.RUNS, T.StructField("decision_date", T.DateType()), at("runs"))
    month = T.StructField("prediction_month", T.DateType())
    without = T.StructType([f for f in contracts.DECISIONS if by_month or f.name != "prediction_date"])
    clustered = ["run_id", "outcome", "member_id"]
    ensure_table(spark, decisions_table, without, month if by_month else contracts.DECISIONS["prediction_date"], at("decisions"), clustered)
    run_id = contracts.conform(run, contracts.RUNS).select("run_id").first()["run_id"]
    with staged_load(run, runs_table, run_id, contracts.RUNS) as one, staged_load(decisions, decisions_table, run_id, contracts.DECISIONS) as rows:
        one = one.withColumn("decision_date", F.to_date("decision_timestamp"))
        row = one.first()
        total = sum(row[c] for c in ("superseded_count", "below_threshold_count", "excluded_count", "suppressed_count", "eligible_count"))
        if total != row["source_row_count"] or rows.count() != total:
            raise contracts.ContractError("the run's counts don't add up to its decisions")
        if conflicts(one, spark.table(runs_table), ["run_id"]).limit(1).count():
            raise ConflictError(f"{runs_table}: a stored key has other values")
        if by_month:
            rows = rows.withColumn(month.name, F.trunc("prediction_date", "month"))
        merge_insert_only(rows, decisions_table, ["run_id", "member_id", "prediction_date"], ingested_at, clustered, month.name if by_month else "prediction_date")
        merge_insert_only(one, runs_table, ["run_id"], ingested_at)


def committed(spark: SparkSession, runs_table: str, decisions_table: str) -> DataFrame:
    """Decisions of runs whose commit marker is stored."""
    return spark.table(decisions_table).join(spark.table(runs_table).select("run_id"), "run_id", "left_semi")
