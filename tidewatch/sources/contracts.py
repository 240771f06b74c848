"""Table contracts: exact column names, order and types."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class ContractError(ValueError):
    """A table isn't what its contract says."""


TYPES = {"string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "bigint": T.LongType()}


def schema(fields: str) -> T.StructType:
    """A schema from "name type" pairs; unlike Spark's parser it needs no session."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in (f.split() for f in fields.split(","))])


PREDICTIONS = schema("member_id string, prediction_date date, risk_probability double, is_high_risk boolean, model_name string, threshold double")
CONTEXT = schema("member_id string, contact_allowed boolean, opted_out boolean, active_case_open boolean, last_contacted_at timestamp, interventions_last_28d bigint, context_as_of timestamp")
DECISIONS = schema(
    "run_id string, policy_version string, member_id string, prediction_date date, decision_timestamp timestamp, outcome string, reason_code string, "
    "risk_probability double, model_name string, threshold double, intervention_category string, priority_rank bigint"
)
RUNS = schema(
    "artifact_version bigint, run_id string, policy_version string, policy_fingerprint string, model_name string, threshold double, scoring_artifact_path string, "
    "scoring_artifact_sha256 string, contact_context_artifact_path string, contact_context_artifact_sha256 string, contact_context_source_name string, "
    "contact_context_source_snapshot_reference string, contact_context_source_query_sha256 string, contact_context_snapshot_timestamp timestamp, decision_timestamp timestamp, "
    "capacity_limit bigint, source_row_count bigint, source_member_count bigint, superseded_count bigint, below_threshold_count bigint, excluded_count bigint, "
    "suppressed_count bigint, eligible_count bigint, capacity_not_selected_count bigint, selected_count bigint"
)
REVIEW_QUEUE = schema(
    "run_id string, policy_version string, member_id string, prediction_date date, decision_timestamp timestamp, risk_probability double, model_name string, "
    "threshold double, intervention_category string, priority_rank bigint, review_status string"
)


def check(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``df`` itself, or an error that tells the first difference. No job runs."""
    have, want = [(f.name, f.dataType.simpleString()) for f in df.schema], [(f.name, f.dataType.simpleString()) for f in contract]
    for i, (h, w) in enumerate(zip(have, want, strict=False)):
        if h != w:
            raise ContractError(f"column {i} is {h}, the contract says {w}")
    if len(have) != len(want):
        raise ContractError(f"{len(have)} columns, the contract has {len(want)}")
    return df


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns in its order and types."""
    if missing := sorted(set(contract.names) - set(df.columns)):
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df.select(*(df[f.name].cast(f.dataType).alias(f.name) for f in contract))


def fingerprint(contract: T.StructType) -> str:
    """SHA-256 of names, order and types."""
    return hashlib.sha256(json.dumps([(f.name, f.dataType.simpleString()) for f in contract]).encode()).hexdigest()


def check_keys(found: dict, wanted: set[str]) -> None:
    """An error unless metadata has exactly the wanted keys."""
    if set(found) != wanted:
        raise ContractError(f"metadata keys differ: {sorted(set(found) ^ wanted)}")
