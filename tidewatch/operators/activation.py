"""Governed decisions: which scored rows a human reviews, and why the others are not.

Every scored row gets exactly one decision. The rules apply in a fixed order, the first that
holds decides, and only rows that pass all are ranked against the capacity.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.operators import constraints
from tidewatch.operators.constraints import Rule, where
from tidewatch.operators.ranking import global_rank

#: Places that are ranked in one task and broadcast.
MOST_PLACES = 100_000
#: Fixed values of the decision contract: outcomes with their reasons.
REASONS = {
    "no_contact_superseded": ("superseded_by_latest_prediction",),
    "no_contact_below_threshold": ("below_frozen_threshold",),
    "no_contact_excluded": ("missing_activation_context", "contact_not_permitted", "member_opted_out"),
    "no_contact_suppressed": ("prediction_too_old", "active_case_open", "contact_cooldown_active", "prior_intervention_limit_reached"),
    "no_contact_capacity": ("capacity_limit_reached",),
    "selected_for_review": ("selected_for_human_review",),
}
CATEGORIES = ("supportive_check_in", "goal_planning", "activity_reminder", "rewards_education")
DECISION_COLUMNS = (
    "run_id", "policy_version", "member_id", "prediction_date", "decision_timestamp", "outcome", "reason_code",
    "risk_probability", "model_name", "threshold", "intervention_category", "priority_rank",
)
REVIEW_STATUS = "pending_human_review"


@dataclass(frozen=True)
class Policy:
    """Controls of one run."""

    policy_version: str = "v1"
    high_risk_only: bool = True
    maximum_prediction_age_days: int = 7
    contact_cooldown_days: int = 7
    maximum_interventions_per_member_28d: int = 2
    maximum_activations_per_run: int = 100
    allowed_intervention_categories: tuple[str, ...] = CATEGORIES
    human_review_required: bool = True
    supportive_use_only: bool = True

    def __post_init__(self) -> None:
        known = self.allowed_intervention_categories
        bad = {
            "policy_version is blank": not self.policy_version.strip(),
            "high_risk_only is off": not self.high_risk_only,
            "human review is off": not self.human_review_required,
            "supportive use is off": not self.supportive_use_only,
            "a number of days is negative": min(self.maximum_prediction_age_days, self.contact_cooldown_days) < 0,
            "a limit is under one": min(self.maximum_interventions_per_member_28d, self.maximum_activations_per_run) < 1,
            "categories are missing, unknown or repeated": not known or len(set(known)) < len(known) or not set(known) <= set(CATEGORIES),
        }
        if found := [k for k, v in bad.items() if v]:
            raise ValueError("; ".join(found))


def _digest(payload: dict) -> str:
    return hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def policy_fingerprint(policy: Policy) -> str:
    """SHA-256 of the policy's canonical JSON."""
    return _digest(asdict(policy))


def run_id(policy: Policy, model_name: str, threshold: float, score_digest: str, context_digest: str, decision_timestamp: datetime) -> str:
    """24 hexadecimal digits that the same inputs always give; the time counts in UTC."""
    if decision_timestamp.tzinfo is None:
        raise ValueError("decision_timestamp needs a zone")
    if not model_name.strip() or not math.isfinite(threshold) or not 0 <= threshold <= 1:
        raise ValueError("model_name or threshold is out of bounds")
    at = decision_timestamp.astimezone(UTC).isoformat(timespec="microseconds")
    return _digest({"policy": policy_fingerprint(policy), "model": model_name, "threshold": threshold, "scores": score_digest, "context": context_digest, "at": at})[:24]


def check_inputs(scores: DataFrame, contexts: DataFrame, decision_timestamp: datetime) -> None:
    """Errors for what must not reach the rules."""
    day = F.lit(decision_timestamp.astimezone(UTC).date())
    constraints.enforce(
        scores,
        [
            Rule("rows", (F.count("*") == 0).cast("long")),
            constraints.unique("member_id", "prediction_date"),
            constraints.constant("model_name"),
            constraints.constant("threshold"),
            where("prediction_in_future", F.col("prediction_date") > day),
        ],
    )
    constraints.enforce(contexts, [constraints.unique("member_id")])


def classify(scores: DataFrame, contexts: DataFrame, policy: Policy, decision_timestamp: datetime) -> DataFrame:
    """Adds ``outcome``, ``reason_code`` and ``suppression_until``; null outcome: eligible.

    ``contact_in_future`` marks rows that reach the cooldown rule with a later contact.
    """
    at = F.lit(decision_timestamp.astimezone(UTC)).cast("timestamp")
    context = contexts.select("member_id", "contact_allowed", "opted_out", "active_case_open", "last_contacted_at", "interventions_last_28d", F.lit(True).alias("#known"))
    newest = F.max("prediction_date").over(W.partitionBy("member_id"))
    rows = scores.withColumn("#newest", newest).join(context, "member_id", "left")
    c = F.col
    until = c("last_contacted_at") + F.make_dt_interval(F.lit(policy.contact_cooldown_days))
    rules = [
        (c("prediction_date") < c("#newest"), "superseded_by_latest_prediction"),
        (~c("is_high_risk"), "below_frozen_threshold"),
        (c("#known").isNull(), "missing_activation_context"),
        (~c("contact_allowed"), "contact_not_permitted"),
        (c("opted_out"), "member_opted_out"),
        (F.datediff(F.to_date(at), "prediction_date") > policy.maximum_prediction_age_days, "prediction_too_old"),
        (c("active_case_open"), "active_case_open"),
        (c("last_contacted_at").isNotNull() & (at < until), "contact_cooldown_active"),
        (c("interventions_last_28d") >= policy.maximum_interventions_per_member_28d, "prior_intervention_limit_reached"),
    ]
    reason = F.when(*[(rules[0][0]), F.lit(rules[0][1])])
    for condition, name in rules[1:]:
        reason = reason.when(condition, F.lit(name))
    outcomes = {r: o for o, rs in REASONS.items() for r in rs}
    rows = rows.withColumn("reason_code", reason)
    rows = rows.withColumn("outcome", F.create_map(*(F.lit(x) for pair in outcomes.items() for x in pair))[F.col("reason_code")])
    cooling = c("reason_code") == "contact_cooldown_active"
    rows = rows.withColumns({"suppression_until": F.when(cooling, F.to_date(until)), "contact_in_future": F.coalesce(cooling & (c("last_contacted_at") > at), F.lit(False))})
    return rows.select(*scores.columns, "outcome", "reason_code", "suppression_until", "contact_in_future")


def first_ranks(eligible: DataFrame, capacity: int) -> DataFrame:
    """member_id, prediction_date and ``#rank`` of the ``capacity`` rows that come first.

    Tasks keep their first rows, and of these the first are taken, so nothing else is sorted or written. They are broadcast:
    as many as the policy allows. A capacity of over ``MOST_PLACES`` is ranked by ranges instead.
    """
    order = [F.desc("risk_probability"), F.desc("prediction_date"), F.asc("member_id")]
    if capacity > MOST_PLACES:
        return global_rank(eligible, order, "#rank").filter(F.col("#rank") <= capacity).select("member_id", "prediction_date", "#rank")
    first = eligible.orderBy(*order).limit(capacity)
    return F.broadcast(first.select("member_id", "prediction_date", F.row_number().over(W.orderBy(*order)).cast("long").alias("#rank")))


def decide(scores: DataFrame, contexts: DataFrame, policy: Policy, decision_timestamp: datetime, run: str) -> DataFrame:
    """One decision for each scored row, in the contract's columns and ``suppression_until``."""
    rows = classify(scores, contexts, policy, decision_timestamp)
    eligible = rows.filter(F.col("outcome").isNull()).select("member_id", "prediction_date", "risk_probability")
    ranks = first_ranks(eligible, policy.maximum_activations_per_run)
    ranked = rows.join(ranks, ["member_id", "prediction_date"], "left")
    chosen = F.col("#rank") <= policy.maximum_activations_per_run
    c = F.col
    return ranked.select(
        F.lit(run).alias("run_id"),
        F.lit(policy.policy_version).alias("policy_version"),
        "member_id",
        "prediction_date",
        F.lit(decision_timestamp.astimezone(UTC)).cast("timestamp").alias("decision_timestamp"),
        F.coalesce("outcome", F.when(chosen, "selected_for_review").otherwise("no_contact_capacity")).alias("outcome"),
        F.coalesce("reason_code", F.when(chosen, "selected_for_human_review").otherwise("capacity_limit_reached")).alias("reason_code"),
        "risk_probability",
        "model_name",
        "threshold",
        F.when(chosen, F.lit(policy.allowed_intervention_categories[0])).alias("intervention_category"),
        F.when(chosen, c("#rank")).alias("priority_rank"),
        "suppression_until",
    )


def check_contacts(classified: DataFrame) -> None:
    """An error if a row that reached the cooldown rule was contacted after the decision."""
    constraints.enforce(classified, [where("contact_in_future", F.col("contact_in_future"))])


def _counts() -> list[Column]:
    n = lambda *outcomes: F.count_if(F.col("outcome").isin(*outcomes))
    return [
        F.count("*").alias("source_row_count"),
        F.count_distinct("member_id").alias("source_member_count"),
        n("no_contact_superseded").alias("superseded_count"),
        n("no_contact_below_threshold").alias("below_threshold_count"),
        n("no_contact_excluded").alias("excluded_count"),
        n("no_contact_suppressed").alias("suppressed_count"),
        n("selected_for_review", "no_contact_capacity").alias("eligible_count"),
        n("no_contact_capacity").alias("capacity_not_selected_count"),
        n("selected_for_review").alias("selected_count"),
    ]


def run_counts(decisions: DataFrame) -> DataFrame:
    """One row: source rows and members, and the rows of each class; eligible = selected + capacity."""
    return decisions.agg(*_counts())


def run_row(decisions: DataFrame, policy: Policy, lineage: dict[str, object]) -> DataFrame:
    """The run's one row: identity, lineage and counts that add up to the decisions."""
    extra = {"artifact_version": 1, "policy_fingerprint": policy_fingerprint(policy), "capacity_limit": policy.maximum_activations_per_run, **lineage}
    ids = [F.first(c).alias(c) for c in ("run_id", "policy_version", "model_name", "threshold", "decision_timestamp")]
    return decisions.agg(*ids, *_counts()).select("*", *(F.lit(v).alias(k) for k, v in extra.items()))


def review_queue(decisions: DataFrame) -> DataFrame:
    """The selected rows with the fixed review status, in the order of their rank."""
    chosen = decisions.filter(F.col("outcome") == "selected_for_review")
    return chosen.select(*(c for c in DECISION_COLUMNS if c not in ("outcome", "reason_code")), F.lit(REVIEW_STATUS).alias("review_status")).orderBy("priority_rank")


def audit(decisions: DataFrame) -> DataFrame:
    """All decisions in the order of member and day."""
    return decisions.orderBy("member_id", "prediction_date")


def queue_row(queue: DataFrame, sources: dict[str, str]) -> DataFrame:
    """The queue's one row of metadata: its run, its size and the digests of what it was made from."""
    row = queue.agg(F.first("run_id").alias("run_id"), F.count("*").alias("row_count"), F.max("priority_rank").alias("last_rank"))
    return row.select("*", *(F.lit(v).alias(k) for k, v in sorted(sources.items())))


def decision_rules(capacity: int) -> list[Rule]:
    """Rules of a decision table."""
    c = F.col
    pairs = F.array(*(F.lit(f"{o}/{r}") for o, rs in REASONS.items() for r in rs))
    selected = c("outcome") == "selected_for_review"
    return [
        constraints.unique("member_id", "prediction_date"),
        constraints.constant("run_id"),
        constraints.domain("outcome", *REASONS),
        where("outcome_and_reason", ~F.array_contains(pairs, F.concat_ws("/", "outcome", "reason_code"))),
        where("selected_has_rank", selected != c("priority_rank").isNotNull()),
        where("selected_has_category", selected != c("intervention_category").isNotNull()),
        Rule("ranks_contiguous", F.abs(F.count("priority_rank") - F.coalesce(F.max("priority_rank"), F.lit(0))) + F.count("priority_rank") - F.count_distinct("priority_rank")),
        Rule("capacity", F.greatest(F.count("priority_rank") - capacity, F.lit(0))),
    ]
