"""Readers: typed scans, and scans that verify what they read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import row_digest
from tidewatch.operators import constraints
from tidewatch.operators.asof import NOT_PREDICTORS
from tidewatch.sources import contracts


def parquet(spark: SparkSession, path: str, contract: T.StructType | None = None, columns: list[str] | None = None) -> DataFrame:
    """A Parquet dataset, checked against its contract and pruned to ``columns``."""
    df = spark.read.parquet(path)
    if contract is not None:
        contracts.check(df, contract)
    return df.select(*columns) if columns else df


def csv(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """A CSV dataset with header; types come from the contract, malformed rows are errors."""
    return spark.read.schema(contract).csv(path, header=True, mode="FAILFAST")


def json_rows(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """JSON rows; malformed ones are errors."""
    return spark.read.schema(contract).json(path, mode="FAILFAST")


def metadata(spark: SparkSession, path: str, keys: set[str]) -> dict:
    """A one-row JSON file with exactly these keys."""
    rows = spark.read.json(path).limit(2).collect()
    if len(rows) != 1:
        raise contracts.ContractError("metadata has to be one row")
    found = rows[0].asDict()
    contracts.check_keys(found, keys)
    return found


def table(spark: SparkSession, name: str, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """A catalog table's projection, ordered if asked."""
    df = spark.table(name).select(*columns)
    return df.orderBy(*order) if order else df


def positions(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder's rows with ``position``, from 1, in the order in which they stand; files count in the order of their names."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("#file"), F.col("_metadata.row_index").alias("#row"))
    sizes = rows.groupBy("#file").agg(F.count("*").alias("#n"))  # a row for each file
    before = F.coalesce(F.sum("#n").over(W.orderBy("#file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.join(sizes.select("#file", before.alias("#before")), "#file").withColumn("position", F.col("#before") + F.col("#row") + 1).drop("#file", "#row", "#before")


def model_frame(table: DataFrame, label: str, categorical: list[str], numeric: list[str]) -> DataFrame:
    """The model's columns only: keys, split, label and approved predictors; a predictor that models must not see is an error."""
    if leaks := sorted({*categorical, *numeric} & {*NOT_PREDICTORS, label}):
        raise contracts.ContractError(f"no predictors: {', '.join(leaks)}")
    return table.select("member_id", "prediction_date", "dataset_split", label, *categorical, *(F.col(c).cast("double").alias(c) for c in numeric))


def digest(df: DataFrame) -> str:
    """SHA-256 of a dataset's rows as a multiset, whatever their order and files."""
    return digest_row(df).first()["digest"]


def digest_row(df: DataFrame) -> DataFrame:
    """One row: the number of rows and their digest. Rows are hashed, and the hashes' 32-bit words summed, by the tasks."""
    hashed = df.select(row_digest(df.columns).alias("h"))
    words = [F.sum(F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("decimal(38,0)")).alias(f"w{i}") for i in range(8)]
    total = hashed.agg(F.count("*").alias("n"), *words)
    return total.select(F.col("n").alias("row_count"), F.sha2(F.concat_ws(",", "n", *(f"w{i}" for i in range(8))), 256).alias("digest"))


def verified_scores(spark: SparkSession, path: str, expected_digest: str | None = None) -> DataFrame:
    """A scoring output that meets its contract, its rules and, if given, its digest."""
    df = constraints.enforce(parquet(spark, path, contracts.PREDICTIONS), constraints.score_rules())
    if expected_digest is not None and digest(df) != expected_digest:
        raise contracts.ContractError("the scores' digest differs")
    return df


def verified_context(spark: SparkSession, path: str, decision_timestamp, expected_digest: str | None = None) -> DataFrame:
    """A contact-context snapshot that meets its contract, its rules and isn't from the future."""
    at = F.lit(decision_timestamp).cast("timestamp")
    rules = [*constraints.context_rules(), constraints.where("snapshot_in_future", F.col("context_as_of") > at)]
    df = constraints.enforce(parquet(spark, path, contracts.CONTEXT), rules)
    if expected_digest is not None and digest(df) != expected_digest:
        raise contracts.ContractError("the context's digest differs")
    return df
