"""Decisions, rule by rule, and the job around them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import activation, constraints
from tidewatch.plans import jobs
from tidewatch.sources import contracts, sinks

NOW = dt.datetime(2025, 3, 10, 12, tzinfo=dt.UTC)
TODAY = NOW.date()


def scores(spark, rows):
    return spark.createDataFrame([(m, TODAY - dt.timedelta(days=age), p, p >= 0.5, "model", 0.5) for m, age, p in rows], contracts.PREDICTIONS)


def context(spark, rows):
    base = {"contact_allowed": True, "opted_out": False, "active_case_open": False, "last_contacted_at": None, "interventions_last_28d": 0}
    out = []
    for member, changes in rows:
        r = base | changes
        last = r["last_contacted_at"]
        out.append((member, r["contact_allowed"], r["opted_out"], r["active_case_open"], NOW - dt.timedelta(days=last) if last is not None else None, r["interventions_last_28d"], NOW))
    return spark.createDataFrame(out, contracts.CONTEXT)


CASES = {
    "below": ({}, 1, 0.4, "below_frozen_threshold"),
    "denied": ({"contact_allowed": False, "opted_out": True}, 1, 0.9, "contact_not_permitted"),
    "left": ({"opted_out": True}, 9, 0.9, "member_opted_out"),
    "old": ({"active_case_open": True}, 8, 0.9, "prediction_too_old"),
    "case": ({"active_case_open": True, "last_contacted_at": 1}, 7, 0.9, "active_case_open"),
    "cooling": ({"last_contacted_at": 6, "interventions_last_28d": 5}, 1, 0.9, "contact_cooldown_active"),
    "limit": ({"last_contacted_at": 7, "interventions_last_28d": 2}, 1, 0.9, "prior_intervention_limit_reached"),
    "good": ({"last_contacted_at": 7, "interventions_last_28d": 1}, 0, 0.9, "selected_for_human_review"),
}


def test_rules_in_their_order(spark):
    s = scores(spark, [(k, v[1], v[2]) for k, v in CASES.items()] + [("absent", 1, 0.9), ("good", 3, 0.95)])
    out = activation.decide(s, context(spark, [(k, v[0]) for k, v in CASES.items()]), activation.Policy(), NOW, "r").collect()
    found = {(r["member_id"], r["prediction_date"]): r for r in out}
    assert len(out) == 10
    for k, (_, age, _, reason) in CASES.items():
        assert found[k, TODAY - dt.timedelta(days=age)]["reason_code"] == reason
    assert found["absent", TODAY - dt.timedelta(days=1)]["reason_code"] == "missing_activation_context"
    assert found["good", TODAY - dt.timedelta(days=3)]["outcome"] == "no_contact_superseded"
    assert found["cooling", TODAY - dt.timedelta(days=1)]["suppression_until"] == TODAY + dt.timedelta(days=1)


def test_capacity_and_ties(spark):
    names = ["c", "a", "b", "d"]
    s = scores(spark, [("c", 0, 0.9), ("a", 1, 0.9), ("b", 0, 0.9), ("d", 0, 0.95)])
    out = activation.decide(s, context(spark, [(n, {}) for n in names]), activation.Policy(maximum_activations_per_run=3), NOW, "r")
    ranks = {r["member_id"]: r["priority_rank"] for r in out.collect()}
    assert ranks == {"d": 1, "b": 2, "c": 3, "a": None}
    assert all(r["passed"] for r in constraints.run(out, activation.decision_rules(3)).collect())
    counts = activation.run_counts(out).first()
    assert (counts["eligible_count"], counts["selected_count"], counts["capacity_not_selected_count"]) == (4, 3, 1)


def test_refused_inputs(spark):
    good = context(spark, [("a", {})])
    for rows in ([("a", -1, 0.9)], [("a", 0, 0.9), ("a", 0, 0.8)], []):
        with pytest.raises(constraints.ConstraintError):
            activation.check_inputs(scores(spark, rows), good, NOW)
    with pytest.raises(constraints.ConstraintError):
        activation.check_inputs(scores(spark, [("a", 0, 0.9)]), good.union(good), NOW)
    late = activation.classify(scores(spark, [("a", 0, 0.9)]), context(spark, [("a", {"last_contacted_at": -1})]), activation.Policy(), NOW)
    with pytest.raises(constraints.ConstraintError):
        activation.check_contacts(late)


def test_policy_and_run_id():
    for bad in ({"policy_version": " "}, {"contact_cooldown_days": -1}, {"maximum_activations_per_run": 0}, {"allowed_intervention_categories": ()}, {"human_review_required": False}):
        with pytest.raises(ValueError):
            activation.Policy(**bad)
    one = activation.run_id(activation.Policy(), "m", 0.5, "s", "c", NOW)
    assert one == activation.run_id(activation.Policy(), "m", 0.5, "s", "c", NOW.astimezone(dt.timezone(dt.timedelta(hours=8)))) and len(one) == 24
    assert one != activation.run_id(activation.Policy(contact_cooldown_days=8), "m", 0.5, "s", "c", NOW)


def test_job_and_warehouse(spark, tmp_path):
    s, c, out = (f"{tmp_path}/{x}" for x in ("scores", "context", "out"))
    scores(spark, [("a", 0, 0.9), ("b", 0, 0.2), ("c", 0, 0.8)]).write.parquet(s)
    context(spark, [("a", {}), ("c", {"opted_out": True, "contact_allowed": False})]).write.parquet(c)
    lineage = {"contact_context_source_name": "crm", "contact_context_source_snapshot_reference": "x", "contact_context_source_query_sha256": "0"}
    run = jobs.activate(spark, s, c, activation.Policy(), NOW, out, lineage)
    for _ in range(2):  # the second load changes nothing
        jobs.load_warehouse(spark, out, "runs_t", "decisions_t", NOW)
        assert spark.table("runs_t").count() == 1 and sinks.committed(spark, "runs_t", "decisions_t").count() == 3
    assert spark.table("runs_t").first()["run_id"] == run
    altered = spark.read.parquet(f"{out}/decisions").withColumn("risk_probability", F.lit(0.1))
    with pytest.raises(sinks.ConflictError):
        sinks.load_run(spark, spark.read.schema(contracts.RUNS).json(f"{out}/run").select(*contracts.RUNS.names), altered, "runs_t", "decisions_t", NOW)
    assert [r["member_id"] for r in spark.read.parquet(f"{out}/review_queue").collect()] == ["a"]
    for t in ("runs_t", "decisions_t"):
        spark.sql(f"DROP TABLE {t}")


def test_tampered_context_stops_the_job(spark, tmp_path):
    s, c, out = (f"{tmp_path}/{x}" for x in ("scores", "context", "out"))
    scores(spark, [("a", 0, 0.9)]).write.parquet(s)
    context(spark, [("a", {"opted_out": True})]).write.parquet(c)
    with pytest.raises(constraints.ConstraintError, match="opted_out_but_allowed"):
        jobs.activate(spark, s, c, activation.Policy(), NOW, out, {})
    assert not (tmp_path / "out").exists()
