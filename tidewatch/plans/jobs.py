"""End-to-end jobs: scoring, decisions and the warehouse load."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidewatch.operators import activation, constraints, evaluation, ml
from tidewatch.sources import contracts, ledger, readers, sinks


def score(spark: SparkSession, scoring: DataFrame, model_path: str, model_metadata: dict, model_name: str, threshold: float, out: str) -> DataFrame:
    """Score a split with a stored model and write verified predictions with their summary."""
    model, imputation = ml.load(model_path, model_metadata, spark)
    predictions = contracts.conform(ml.score(model, scoring, imputation, model_name, threshold), contracts.PREDICTIONS)
    sinks.write_verified(predictions, f"{out}/predictions", lambda df: constraints.enforce(contracts.check(df, contracts.PREDICTIONS), constraints.score_rules()))
    written = readers.parquet(spark, f"{out}/predictions", contracts.PREDICTIONS)
    sinks.write_metadata(evaluation.score_summary(written), f"{out}/summary")
    return written


def activate(spark: SparkSession, scores_path: str, context_path: str, policy: activation.Policy, decision_timestamp: datetime, out: str, lineage: dict[str, object]) -> str:
    """Verify both inputs, decide, and write decisions, run row and review queue; the run id."""
    sinks.distinct_paths(scores_path, context_path, out)
    scores, contexts = readers.verified_scores(spark, scores_path), readers.verified_context(spark, context_path, decision_timestamp)
    activation.check_inputs(scores, contexts, decision_timestamp)
    activation.check_contacts(activation.classify(scores, contexts, policy, decision_timestamp))
    first = scores.select("model_name", "threshold").first()
    digests = {"scoring_artifact_sha256": readers.digest(scores), "contact_context_artifact_sha256": readers.digest(contexts)}
    run = activation.run_id(policy, first["model_name"], first["threshold"], *digests.values(), decision_timestamp)
    decided = activation.decide(scores, contexts, policy, decision_timestamp, run)
    rules = activation.decision_rules(policy.maximum_activations_per_run)
    sinks.write_verified(contracts.conform(decided, contracts.DECISIONS), f"{out}/decisions", lambda df: constraints.enforce(df, rules))
    decisions = readers.parquet(spark, f"{out}/decisions", contracts.DECISIONS)
    as_of = contexts.select("context_as_of").first()["context_as_of"]
    extra = {"scoring_artifact_path": scores_path, "contact_context_artifact_path": context_path, "contact_context_snapshot_timestamp": as_of, **digests, **lineage}
    sinks.write_metadata(contracts.conform(activation.run_row(decisions, policy, extra), contracts.RUNS), f"{out}/run")
    queue = contracts.conform(activation.review_queue(decisions), contracts.REVIEW_QUEUE)
    sinks.write_verified(queue, f"{out}/review_queue", lambda df: _same(df, queue))
    return run


def _same(written: DataFrame, expected: DataFrame) -> None:
    contracts.check(written, contracts.REVIEW_QUEUE)
    if constraints.differences(written, expected).limit(1).count():
        raise contracts.ContractError("the review queue differs from the decisions")


def load_warehouse(spark: SparkSession, out: str, runs_table: str, decisions_table: str, ingested_at: datetime) -> None:
    """Load what ``activate`` wrote into the partitioned tables; running it again changes nothing."""
    decisions = readers.parquet(spark, f"{out}/decisions", contracts.DECISIONS)
    run = readers.json_rows(spark, f"{out}/run", contracts.RUNS).select(*contracts.RUNS.names)
    sinks.load_run(spark, run, decisions, runs_table, decisions_table, ingested_at)


def load_ledger(spark: SparkSession, out: str, books: ledger.Ledger, ingested_at: datetime) -> int:
    """Commit what ``activate`` wrote to a ledger, run and decisions at once; the version. Running it again changes nothing."""
    decisions = readers.parquet(spark, f"{out}/decisions", contracts.DECISIONS)
    run = readers.json_rows(spark, f"{out}/run", contracts.RUNS).select(*contracts.RUNS.names)
    return ledger.load_run(books, run, decisions, ingested_at)
