"""Registered queries of the core library: each operator over whole given tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions import columns as fn
from tidewatch.functions.shared import materialise, shared_path
from tidewatch.operators import activation, asof, boosting, constraints, evaluation, ml, panel, profile, splits
from tidewatch.plans import fixtures, jobs
from tidewatch.plans.oracles import ORACLE_SQL
from tidewatch.sources import contracts, ledger, readers, sinks

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

DECISION_TIME = datetime(2001, 8, 2, tzinfo=UTC)
POLICY = activation.Policy(maximum_prediction_age_days=365)
CUTS = splits.Cuts(validation="1999-01-01", test="2000-01-01", scoring="2001-01-01")
T_FROZEN = fixtures.THRESHOLD


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query; its days come out as ISO text."""

    @functools.wraps(f)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = f(spark, sf)
        return df.select(*(F.col(c).cast("string").alias(c) if t == "date" else F.col(c) for c, t in df.dtypes))

    QUERIES[f.__name__] = run
    return f


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places."""
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def raw_panel(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.build(spark, sf, fixtures.RAW_PANEL)


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """The staged panel: labels from clean values first, then flags.

    Lines are dealt by supplier before they are added up: their days and all windows of the panel are then where the lines are.
    """
    out = panel.goal_metrics(fixtures.build(spark, sf, fixtures.RAW_PANEL, deal={"lineitem": "l_suppkey"}))
    out = panel.recency(out, "member_id", "activity_date", "app_sessions")
    return panel.category_changed(panel.quality_flags(out), "member_id", "activity_date", "activity_level")


def user_days(spark: SparkSession, sf: str) -> DataFrame:
    days = fixtures.build(spark, sf, fixtures.USER_DAY)
    zero = dict.fromkeys(("active_minutes", "app_sessions", "rewards_viewed", "rewards_redeemed"), 0)
    first, last = days.agg(F.min("activity_date"), F.max("activity_date")).first()
    return panel.densify(days, "entity_id", "activity_date", {**zero, "weekly_goal": F.max("weekly_goal")}, F.lit(first), F.lit(last))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.build(spark, sf, fixtures.SCORED)


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions; orders are dealt by customer first, in tasks of bounded size, so a customer's rows are where later steps want them."""
    rows = fixtures.build(spark, sf, fixtures.SCORED, deal={"orders": "o_custkey"}).select("member_id", "prediction_date", F.col("p").alias("risk_probability"))
    return evaluation.classify(rows, "risk_probability", T_FROZEN, "logistic")


def contexts(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.build(spark, sf, fixtures.CONTEXT)
    at = F.lit(DECISION_TIME).cast("timestamp")
    last = at - F.make_dt_interval(F.col("days_since_contact"))
    return rows.select("member_id", "contact_allowed", "opted_out", "active_case_open", last.alias("last_contacted_at"), "interventions_last_28d", at.alias("context_as_of"))


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    return activation.decide(predictions(spark, sf), contexts(spark, sf), POLICY, DECISION_TIME, "run")


@query
def staging_supplier_day(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(panel.stage(raw_panel(spark, sf).withColumnRenamed("activity_date", "date").withColumn("date", F.col("date").cast("timestamp"))))


@query
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = panel.quality_flags(raw_panel(spark, sf))
    return flags.select("member_id", "activity_date", "sleep_hours_missing", "app_sessions_missing", "is_step_outlier", "is_late_record", "available_date")


@query
def constraint_report(spark: SparkSession, sf: str) -> DataFrame:
    return constraints.run(staged(spark, sf), constraints.panel_rules())


@query
def context_constraints(spark: SparkSession, sf: str) -> DataFrame:
    return constraints.run(contexts(spark, sf), constraints.context_rules())


@query
def prediction_constraints(spark: SparkSession, sf: str) -> DataFrame:
    return constraints.run(predictions(spark, sf), constraints.score_rules())


@query
def features_28d(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(asof.features(staged(spark, sf)))


@query
def leak_audit(spark: SparkSession, sf: str) -> DataFrame:
    return asof.leak_audit(asof.features(staged(spark, sf)))


@query
def densify_user_day(spark: SparkSession, sf: str) -> DataFrame:
    return user_days(spark, sf)


@query
def weekly_progress(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.weekly_progress(user_days(spark, sf), "entity_id", "activity_date", "active_minutes", "weekly_goal")
    return out.select("entity_id", "activity_date", "week_start", "weekly_active_minutes_so_far", "goal_completion_percentage")


@query
def goal_streak_failures(spark: SparkSession, sf: str) -> DataFrame:
    return panel.goal_history(user_days(spark, sf), "entity_id", "activity_date", "active_minutes", "weekly_goal")


@query
def future7_label(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.future_total(user_days(spark, sf), "entity_id", "activity_date", "active_minutes", "weekly_goal")
    return out.select("entity_id", "activity_date", "future_7_day_active_minutes", "next_week_goal_completed", "will_miss_goal_next_7_days")


@query
def label_tail(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.future_total(user_days(spark, sf), "entity_id", "activity_date", "active_minutes", "weekly_goal")
    return constraints.label_tail(out, "activity_date", "will_miss_goal_next_7_days")


@query
def recency_days(spark: SparkSession, sf: str) -> DataFrame:
    return panel.recency(user_days(spark, sf), "entity_id", "activity_date", "app_sessions").select("entity_id", "activity_date", "days_since_last_app_session")


@query
def category_change_flag(spark: SparkSession, sf: str) -> DataFrame:
    out = panel.category_changed(raw_panel(spark, sf), "member_id", "activity_date", "activity_level")
    return out.select("member_id", "activity_date", "activity_level", "activity_level_changed")


@query
def edge_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = raw_panel(spark, sf).select("member_id", "activity_date", "active_minutes")
    first = panel.edge_rows(rows, "member_id", "activity_date", 7).withColumn("edge", F.lit("first"))
    return first.unionByName(panel.edge_rows(rows, "member_id", "activity_date", 7, last=True).withColumn("edge", F.lit("last")))


@query
def chronological_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.assign(raw_panel(spark, sf).select("member_id", "activity_date"), "activity_date", CUTS)


@query
def split_report(spark: SparkSession, sf: str) -> DataFrame:
    return splits.report(splits.assign(staged(spark, sf), "activity_date", CUTS), "activity_date", "member_id", "will_miss_goal_next_7_days")


@query
def split_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    return splits.overlaps(split_report(spark, sf)).select("dataset_split", "first_day", "previous_last_day")


@query
def threshold_sweep_1001(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.sweep(scored(spark, sf), "actual_label", "p"))


@query
def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.best_threshold(evaluation.sweep(scored(spark, sf), "actual_label", "p")))


@query
def confusion_at_frozen(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.confusion(scored(spark, sf), "actual_label", "p", T_FROZEN))


@query
def macro_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.macro(scored(spark, sf), "actual_label", "p", T_FROZEN))


@query
def calibration_ntile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.calibration_count(scored(spark, sf), "actual_label", "p", "k"))


@query
def calibration_equal_width(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.calibration_width(scored(spark, sf), "actual_label", "p"))


@query
def ece_max_gap(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.calibration_error(evaluation.calibration_width(scored(spark, sf), "actual_label", "p")))


@query
def top_decile_ntile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.top_tile(scored(spark, sf), "actual_label", "p", "k"))


@query
def top_decile_ceil(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.top_fraction(scored(spark, sf), "actual_label", "p", "k"))


@query
def ranking_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.ranking_metrics(scored(spark, sf), "actual_label", "p"))


@query
def pr_auc_grid(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.pr_auc_grid(evaluation.sweep(scored(spark, sf), "actual_label", "p")))


@query
def probability_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.probability_metrics(scored(spark, sf), "actual_label", "p"))


@query
def validation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.summary(scored(spark, sf), "actual_label", "p", "k", T_FROZEN))


@query
def metric_constraints(spark: SparkSession, sf: str) -> DataFrame:
    return constraints.run(evaluation.summary(scored(spark, sf), "actual_label", "p", "k", T_FROZEN), constraints.metric_rules())


@query
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Two scores of the same rows; the one of higher PR area is chosen."""
    rows = scored(spark, sf)
    other = rows.withColumn("p", (F.col("p") + (F.col("k") % 10) / 10.0) / 2)
    found = {"boosted": evaluation.ranking_metrics(other, "actual_label", "p"), "logistic": evaluation.ranking_metrics(rows, "actual_label", "p")}
    return rounded(evaluation.compare(found))


@query
def score_classify(spark: SparkSession, sf: str) -> DataFrame:
    return predictions(spark, sf)


@query
def score_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.score_summary(predictions(spark, sf)))


@query
def activation_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return decisions(spark, sf).select("member_id", "prediction_date", "outcome", "reason_code", "risk_probability", "intervention_category", "priority_rank", "suppression_until")


@query
def activation_run_counts(spark: SparkSession, sf: str) -> DataFrame:
    return activation.run_counts(decisions(spark, sf))


@query
def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    return activation.review_queue(decisions(spark, sf)).select("member_id", "prediction_date", "risk_probability", "intervention_category", "priority_rank", "review_status")


@query
def decision_constraints(spark: SparkSession, sf: str) -> DataFrame:
    return constraints.run(decisions(spark, sf), activation.decision_rules(POLICY.maximum_activations_per_run))


@query
def null_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.null_rates(raw_panel(spark, sf)))


@query
def describe_panel(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.describe(raw_panel(spark, sf), ["daily_steps", "active_minutes", "sleep_hours", "app_sessions"]))


@query
def value_shares(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.value_shares(profile.one_for_each(raw_panel(spark, sf), "member_id", "activity_date"), "age_band"))


@query
def rate_by_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    return rounded(profile.rate_by(rows, "lang", "quality"))


@query
def flag_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.flag_rates(raw_panel(spark, sf), ["intervention_received", "intervention_opened", "intervention_clicked"], within="intervention_received"))


@query
def rows_for_each_entity(spark: SparkSession, sf: str) -> DataFrame:
    return profile.rows_for_each(raw_panel(spark, sf), "member_id")


@query
def event_property(spark: SparkSession, sf: str) -> DataFrame:
    """JSON properties under a schema; malformed ones fail."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    parsed = events.select("event_type", F.from_json("props", "k bigint", {"mode": "FAILFAST"})["k"].alias("k"))
    return parsed.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("total"), F.min("k").alias("least"), F.max("k").alias("most"))


@query
def conflict_finder(spark: SparkSession, sf: str) -> DataFrame:
    """Stored scores against scores that differ for some days."""
    now = predictions(spark, sf).select("member_id", "prediction_date", "risk_probability")
    then = now.withColumn("risk_probability", F.when(F.col("member_id") % 7 == 0, F.lit(None)).otherwise(F.col("risk_probability")))
    return sinks.conflicts(now, then, ["member_id", "prediction_date"])


@query
def insert_only_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that an insert-only merge would add to a table that holds the earlier dates."""
    now = predictions(spark, sf).select("member_id", "prediction_date", "risk_probability")
    return sinks.new_rows(now, now.filter(F.col("prediction_date") < F.lit("2000-01-01").cast("date")), ["member_id", "prediction_date"])


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.conform(spark.read.parquet(f"{sf}/orders.parquet"), contracts.schema("o_orderkey bigint, o_custkey bigint, o_orderstatus string"))


@query
def dataset_digest_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A digest of every order, by the canonical row text that dataset digests add up."""
    orders = _orders(spark, sf)
    return orders.select("o_orderkey", fn.row_digest(orders.columns).alias("digest"))


@query
def dataset_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The digest of all orders, whatever their order and files."""
    return readers.digest_row(_orders(spark, sf))


LABEL = "label_will_miss_goal_next_7_days"
CATEGORICAL = ["age_band_as_of", "activity_level_as_of", "reward_profile_as_of"]


def _lazy_frame(spark: SparkSession, sf: str, whole: bool = True) -> tuple[DataFrame, list[str], list[str], str]:
    """The model's table; unless ``whole``, by windows of which only those of the columns used are computed."""
    table = splits.assign((asof.whole_features if whole else asof.features)(staged(spark, sf)), "prediction_date", CUTS)
    numeric = [c for c in asof.predictors(table) if c not in CATEGORICAL]
    return readers.model_frame(table, LABEL, CATEGORICAL, numeric), CATEGORICAL, numeric, LABEL


def _model_frame(spark: SparkSession, sf: str, kept: tuple[str, ...], columns: list[str] | None = None) -> tuple[DataFrame, list[str], list[str], str]:
    """The rows of the splits ``kept``, in all columns of the model or in ``columns``, written once: what isn't asked for isn't computed."""
    frame, categorical, numeric, label = _lazy_frame(spark, sf, columns is None)
    rows = frame.filter(F.col("dataset_split").isin(*kept)).select(*(columns or frame.columns))
    return materialise(rows, "model-frame", ("dataset_split",) if "dataset_split" in rows.columns else ()), categorical, numeric, label


def _logistic(train: DataFrame, label: str, categorical: list[str], numeric: list[str]) -> tuple[PipelineModel, ml.Imputation]:
    imputation = ml.fit_imputation(train, categorical, numeric)
    rows = train.filter(F.col(label).isNotNull()).count()
    return ml.fit(ml.logistic_pipeline(rows, categorical, numeric), train, label, imputation), imputation


@query
def risk_model_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic regression fitted on train, threshold chosen on validation, applied to scoring."""
    frame, categorical, numeric, label = _model_frame(spark, sf, ("train", "validation", "scoring"))
    train = frame.filter("dataset_split = 'train'")
    model, imputation = _logistic(train, label, categorical, numeric)
    validation = ml.positive_probability(model, frame.filter(f"dataset_split = 'validation' and {label} is not null"), imputation)
    chosen = evaluation.best_threshold(evaluation.sweep(validation, label, "risk_probability")).first()["threshold"]
    return ml.score(model, frame.filter("dataset_split = 'scoring'"), imputation, "logistic", chosen)


# Queries that write to the shared folder, read back and verify.


def _name(what: str) -> str:
    """A table name of its own for each call."""
    return f"tidewatch_{what}_{uuid.uuid4().hex}"


@query
def csv_export(spark: SparkSession, sf: str) -> DataFrame:
    """The raw panel exported as Parquet and CSV in verified order; the rows of the CSV copy."""
    rows = raw_panel(spark, sf).select("member_id", "activity_date", "age_band", "active_minutes", "sleep_hours", "intervention_received")
    _, text = sinks.export(rows, shared_path(spark, "export"), ["activity_date", "member_id"])
    return readers.csv(spark, text, rows.schema)


@query
def export_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Parity of the two exported copies."""
    rows = raw_panel(spark, sf).select("member_id", "activity_date", "active_minutes", "sleep_hours")
    pq, text = sinks.export(rows, shared_path(spark, "export"))
    return profile.parity(readers.parquet(spark, pq, rows.schema), readers.csv(spark, text, rows.schema))


@query
def table_projection(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table with a comment, projected in order."""
    name = _name("panel")
    sinks.save_table(raw_panel(spark, sf), name, "Member's days", shared_path(spark, name))
    return readers.table(spark, name, ["activity_date", "member_id", "daily_steps"], ["activity_date", "member_id"]).withColumn("comment", F.lit(spark.catalog.getTable(name).description))


@query
def split_views(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of each split by the persisted views of a stored table."""
    name = _name("split")
    sinks.save_table(splits.assign(raw_panel(spark, sf), "activity_date", CUTS), name, "Splits", shared_path(spark, name))
    counts = [spark.table(v).agg(F.count("*").alias("row_count"), F.min("activity_date").alias("first_day"), F.max("activity_date").alias("last_day")).withColumn("dataset_split", F.lit(s)) for s, v in zip(splits.SPLITS, splits.create_views(spark, name), strict=True)]
    return functools.reduce(DataFrame.unionByName, counts)


@query
def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Customers merged into a clustered table, half of them before it had a column for the balance."""
    name, rows = _name("customer"), spark.read.parquet(f"{sf}/customer.parquet")
    first, second = contracts.schema("c_custkey bigint, c_name string"), contracts.schema("c_custkey bigint, c_name string, c_acctbal double")
    sinks.ensure_table(spark, name, first, path=shared_path(spark, name), cluster_by=["c_custkey"], buckets=4)
    sinks.merge_insert_only(contracts.conform(rows.filter("c_custkey % 2 = 0"), first), name, ["c_custkey"], DECISION_TIME)
    sinks.ensure_table(spark, name, second)
    for _ in range(2):  # the second time nothing is new
        sinks.merge_insert_only(contracts.conform(rows.filter("c_custkey % 2 = 1"), second), name, ["c_custkey"], DECISION_TIME)
    return spark.table(name).drop("ingested_at")


@query
def staged_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions loaded twice into a run's staging table, which is emptied first and dropped in the end."""
    rows, name = contracts.conform(predictions(spark, sf), contracts.PREDICTIONS), _name("predictions")
    for _ in range(2):
        with sinks.staged_load(rows, name, "run", contracts.PREDICTIONS) as stage:
            out = materialise(stage.groupBy("prediction_date").agg(F.count("*").alias("row_count"), F.count_if("is_high_risk").alias("high_risk_count")), "staged")
    return out


@query
def verified_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions written, verified and published, then read against contract, rules and digest."""
    rows = contracts.conform(predictions(spark, sf), contracts.PREDICTIONS)
    path = sinks.write_verified(rows, shared_path(spark, "scores"), lambda df: constraints.enforce(contracts.check(df, contracts.PREDICTIONS), constraints.score_rules()))
    return readers.verified_scores(spark, path, readers.digest(rows))


@query
def verified_context(spark: SparkSession, sf: str) -> DataFrame:
    """The contact contexts that break no rule, written and verified as a snapshot."""
    rows = contracts.conform(contexts(spark, sf).filter("not (opted_out and contact_allowed)"), contracts.CONTEXT)
    path = sinks.write_verified(rows, shared_path(spark, "context"), lambda df: contracts.check(df, contracts.CONTEXT))
    found = readers.verified_context(spark, path, DECISION_TIME, readers.digest(rows))
    return found.select("member_id", "contact_allowed", "opted_out", "active_case_open", F.unix_timestamp("last_contacted_at").alias("last_contacted_at"), "interventions_last_28d")


def _run(decided: DataFrame) -> DataFrame:
    lineage = {"scoring_artifact_path": "scores", "contact_context_artifact_path": "contexts", "scoring_artifact_sha256": "a", "contact_context_artifact_sha256": "b", "contact_context_source_name": "crm"}
    lineage |= {"contact_context_source_snapshot_reference": "snapshot", "contact_context_source_query_sha256": "c", "contact_context_snapshot_timestamp": DECISION_TIME}
    return contracts.conform(activation.run_row(decided, POLICY, lineage), contracts.RUNS)


@query
def warehouse_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions loaded twice, committed by their run's row; the second load changes nothing."""
    decided, runs, rows = materialise(decisions(spark, sf), "decided"), _name("runs"), _name("decisions")
    path = shared_path(spark, "warehouse")
    for _ in range(2):
        # These scores span years, so a partition for each day would be mostly empty files.
        sinks.load_run(spark, _run(decided), decided, runs, rows, DECISION_TIME, path, by_month=True)
    found = sinks.committed(spark, runs, rows)
    return found.select("run_id", "member_id", "prediction_date", "outcome", "reason_code", "risk_probability", "priority_rank", F.unix_timestamp("ingested_at").alias("ingested_at"))


@query
def run_record(spark: SparkSession, sf: str) -> DataFrame:
    """A run's row: identity, policy fingerprint and counts that add up."""
    row = _run(decisions(spark, sf))
    return row.select("run_id", "policy_version", "policy_fingerprint", "model_name", "threshold", "capacity_limit", *(c for c in row.columns if c.endswith("_count")))


@query
def queue_record(spark: SparkSession, sf: str) -> DataFrame:
    """The review queue's row of metadata."""
    return activation.queue_row(activation.review_queue(decisions(spark, sf)), {"source": "decisions"})


def _placed(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = shared_path(spark, "ordered")
    df.write.parquet(path)
    return readers.positions(spark, path).select("member_id", "prediction_date", "outcome" if "outcome" in df.columns else "priority_rank", "position")


@query
def queue_order(spark: SparkSession, sf: str) -> DataFrame:
    """Where each row of the review queue stands once it is written."""
    return _placed(spark, activation.review_queue(decisions(spark, sf)))


@query
def audit_order(spark: SparkSession, sf: str) -> DataFrame:
    """Where each decision stands in the written audit."""
    return _placed(spark, activation.audit(decisions(spark, sf)))


@query
def metadata_record(spark: SparkSession, sf: str) -> DataFrame:
    """A summary row written as JSON with sorted keys, read with exactly these keys and types."""
    row = evaluation.score_summary(predictions(spark, sf))
    path = sinks.write_metadata(row, shared_path(spark, "summary"))
    readers.metadata(spark, path, set(row.columns))
    return rounded(readers.json_rows(spark, path, row.schema))


@query
def record_fields(spark: SparkSession, sf: str) -> DataFrame:
    """A stored summary's counts against those of the rows that are left without the first years."""
    rows = predictions(spark, sf)
    counts = lambda df: evaluation.score_summary(df).select("row_count", "member_count", "high_risk_count", F.col("maximum_prediction_date").cast("string").alias("maximum_prediction_date"))
    path = sinks.write_metadata(counts(rows), shared_path(spark, "counts"))
    stored = readers.json_rows(spark, path, counts(rows).schema)
    return constraints.same_fields(stored, counts(rows.filter(F.col("prediction_date") >= F.lit("1997-01-01").cast("date"))))


@query
def key_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Members with a context but no score, and those with a score but no context."""
    return constraints.same_keys(contexts(spark, sf), predictions(spark, sf), ["member_id"])


@query
def table_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of two versions of the scores that the other lacks."""
    now = predictions(spark, sf).select("member_id", "prediction_date", "risk_probability")
    then = now.filter("member_id % 5 <> 0").withColumn("risk_probability", F.when(F.col("member_id") % 7 == 0, F.lit(None)).otherwise(F.col("risk_probability")))
    return constraints.differences(now, then)


@query
def panel_counts(spark: SparkSession, sf: str) -> DataFrame:
    """By how much row count, members and date range differ from what was announced."""
    return constraints.run(raw_panel(spark, sf), [constraints.row_count(5_000), constraints.value_count("member_id", 10), constraints.range_is("activity_date", "1992-01-02", "1998-12-01")])


@query
def rate_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Rates of the staged panel within their bands."""
    c = F.col
    return constraints.run(staged(spark, sf), [
        constraints.rate_between("misses", c("will_miss_goal_next_7_days"), 0.12, 0.30),
        constraints.rate_between("sleep_missing", c("sleep_hours_missing"), 0.02, 0.20),
        constraints.rate_between("outliers", c("is_step_outlier"), 0.0, 0.001),
        constraints.rate_between("late", c("is_late_record"), 0.0, 0.5),
    ])


@query
def feature_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Features without any value."""
    table = asof.features(staged(spark, sf)).withColumn("never", F.lit(None).cast("double"))
    return constraints.run(table, constraints.not_all_null("avg_daily_steps_28d", "reward_redemption_rate_28d", "stddev_active_minutes_28d", "never"))


@query
def evaluation_input(spark: SparkSession, sf: str) -> DataFrame:
    """Rules of rows to be evaluated, over rows of which some have no label."""
    rows = scored(spark, sf).withColumn("actual_label", F.when(F.col("k") % 100 != 0, F.col("actual_label")))
    return constraints.run(rows, constraints.label_rules("actual_label"))


@query
def split_overlaps_found(spark: SparkSession, sf: str) -> DataFrame:
    """Splits by the member's number, whose days overlap."""
    named = F.when(F.col("member_id") % 3 == 0, "train").when(F.col("member_id") % 3 == 1, "validation").otherwise("test")
    rows = staged(spark, sf).withColumn("activity_date", F.date_add("activity_date", (F.col("member_id") % 3).cast("int"))).withColumn("dataset_split", named)
    return splits.overlaps(splits.report(rows, "activity_date", "member_id", "will_miss_goal_next_7_days")).select("dataset_split", "first_day", "previous_last_day")


@query
def selection_record(spark: SparkSession, sf: str) -> DataFrame:
    """The threshold chosen on validation rows, as a record that is written once."""
    record = evaluation.selection(scored(spark, sf), "actual_label", "p", "prediction_date", "logistic")
    path = shared_path(spark, "selection")
    sinks.freeze(record, path)
    return rounded(sinks.freeze(record, path))


@query
def frozen_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The summary at a frozen record's threshold."""
    rows = scored(spark, sf)
    record = sinks.freeze(evaluation.selection(rows, "actual_label", "p", "prediction_date", "logistic"), shared_path(spark, "selection"))
    return rounded(evaluation.frozen_summary(rows, "actual_label", "p", "k", record))


@query
def model_frame(spark: SparkSession, sf: str) -> DataFrame:
    """The training split in the model's columns."""
    frame, *_ = _lazy_frame(spark, sf)
    return rounded(splits.partition(frame, "label_will_miss_goal_next_7_days")["train"].drop("dataset_split"))


@query
def imputation_values(spark: SparkSession, sf: str) -> DataFrame:
    """What nulls become: modes and medians of the training split."""
    frame, categorical, numeric, _ = _model_frame(spark, sf, ("train",))
    found = ml.fit_imputation(frame, categorical, numeric)
    rows = [(c, v, None) for c, v in found.categorical.items()] + [(c, None, v) for c, v in found.numeric.items()]
    return rounded(spark.createDataFrame(rows, "column_name string, category string, number double"))


@query
def encoded_features(spark: SparkSession, sf: str) -> DataFrame:
    """The training split, imputed, one-hot encoded and standardised."""
    numeric = ["avg_daily_steps_28d", "avg_sleep_hours_7d", "sum_app_sessions_28d"]
    train, categorical, _, _ = _model_frame(spark, sf, ("train",), ["member_id", "prediction_date", *CATEGORICAL, *numeric])
    imputation = ml.fit_imputation(train, categorical, numeric)
    out = ml.encode(ml.fit_encoding(train, categorical, numeric, imputation, train.count()), train, imputation)
    n = F.size("features") - len(numeric)
    levels = F.array_join(F.transform(F.slice("features", F.lit(1), n), lambda x: x.cast("int")), "")
    return out.select("member_id", "prediction_date", levels.alias("levels"), *(F.round(F.get("features", n + i), 4).alias(c) for i, c in enumerate(numeric)))


@query
def logistic_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted logistic regression is the optimum of its penalised loss: no slope is left in any coefficient."""
    train, categorical, numeric, label = _model_frame(spark, sf, ("train",))
    model, imputation = _logistic(train, label, categorical, numeric)
    slopes = ml.gradient(model, train, label, imputation).agg(F.round(F.max(F.abs("slope")), 3).alias("largest_slope"))
    return train.agg(F.count(label).alias("labelled_rows"), F.count_if(label).alias("positives")).crossJoin(F.broadcast(slopes))  # one row each


@query
def stored_model(spark: SparkSession, sf: str) -> DataFrame:
    """A model stored with its metadata, checked, loaded and applied: scores that differ from those of the fitted one."""
    frame, categorical, numeric, label = _model_frame(spark, sf, ("train", "scoring"))
    train, scoring = frame.filter("dataset_split = 'train'"), frame.filter("dataset_split = 'scoring'")
    model, imputation = _logistic(train, label, categorical, numeric)
    selection = {"model_name": "logistic", "threshold": T_FROZEN, "selection_split": "validation", "selection_metric": "positive_f1", "validation_start_date": CUTS.validation, "validation_end_date": CUTS.test}
    metadata, path = ml.model_metadata(selection, (CUTS.first, CUTS.validation), categorical, numeric), shared_path(spark, "model")
    ml.save(model, imputation, path, metadata, spark)
    ml.check_metadata(ml.load_metadata(spark, path), selection, categorical, numeric)
    again, same = ml.load(path, metadata, spark)
    fresh = ml.score(model, scoring, imputation, "logistic", T_FROZEN).select("member_id", "prediction_date", F.col("risk_probability").alias("p"))
    both = ml.score(again, scoring, same, "logistic", T_FROZEN).join(fresh, ["member_id", "prediction_date"])
    return both.agg(F.count("*").alias("row_count"), F.count_if(F.abs(F.col("p") - F.col("risk_probability")) > 1e-12).alias("differing"), F.count_if(~fn.is_probability(F.col("risk_probability"))).alias("invalid"))


@query
def scalar_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Text to booleans and instants, and named values of arrays of structs, over all events."""
    u = F.col("user_id")
    spelt = F.element_at(F.array(F.lit("true"), F.lit("FALSE"), F.lit("1"), F.lit("no")), (u % 4 + 1).cast("int"))
    day = F.lpad((1 + u % 28).cast("string"), 2, "0")
    stamp = F.concat(F.lit("2024-01-"), day, F.when(u % 3 == 0, "T10:00:00+02:00").when(u % 3 == 1, "T10:00:00").otherwise("T10:00:00Z"))
    entries = F.array(F.struct(F.lit("view").alias("label"), u.alias("value")), F.struct(F.lit("click").alias("label"), (u * 2).alias("value")))
    rows = spark.read.parquet(f"{sf}/events.parquet").select(
        "event_type", fn.safe_bool(spelt).alias("flag"), F.unix_timestamp(fn.utc_timestamp(stamp)).alias("at"), fn.named_value(entries, "label", F.col("event_type"), "value").alias("value")
    )
    return rows.groupBy("event_type").agg(F.count_if("flag").alias("yes"), F.count_if(~F.col("flag")).alias("no"), F.count("at").alias("stamped"), F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.sum("value").alias("total"))


@query
def text_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Blank, matching and prefixed texts of all documents."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cut = F.when(F.col("doc_id") % 5 == 0, F.lit(" \t ")).when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("text"))
    return docs.groupBy("lang").agg(F.count_if(fn.blank(cut)).alias("blank"), F.count_if(F.col("text").rlike("^[A-Z][a-z]+ [a-z]")).alias("opens"), F.count_if(F.startswith("source", F.lit("src1"))).alias("prefixed"))


# Increments, boosted trees, coefficients, commits of two tables, whole jobs and profiles.


@query
def features_increment(spark: SparkSession, sf: str) -> DataFrame:
    """Features of the last three days, each from the states of the day before and that day's own effects."""
    whole = staged(spark, sf)
    last = whole.agg(F.max("activity_date")).first()[0]
    days = [(last - timedelta(days=k)).isoformat() for k in (3, 2, 1, 0)]
    # Rows that left their last window before the first of these days have effects that add up to nothing by then.
    first = F.min("activity_date").over(W.partitionBy("member_id"))
    counting = F.col("activity_date") >= F.date_sub(F.lit(days[0]).cast("date"), asof.WINDOW_DAYS)
    rows = materialise(whole.withColumn("first_day", first).filter(counting), "staged")
    path = shared_path(spark, "effects")
    # In the order of their days, so a day's effects are found by the files' statistics.
    asof.effects(rows).repartitionByRange("day").sortWithinPartitions("day").write.parquet(path)
    effects = spark.read.parquet(path)
    points = asof.anchors(rows, "member_id", "activity_date", keep=("will_miss_goal_next_7_days",), first=F.col("first_day"))
    state, made = materialise(asof.state(effects, days[0]), "state"), []
    for day in days[1:]:
        state = materialise(asof.state(effects, day, before=state), "state")
        made.append(asof.features_on(state, points.filter(F.col("prediction_date") == F.lit(day).cast("date"))))
    return rounded(functools.reduce(DataFrame.unionByName, made))


BOOSTED = ["avg_daily_steps_28d", "sum_app_sessions_28d", "weekly_active_minutes_so_far_as_of", "goal_completion_percentage_as_of"]


def _boosted_frame(spark: SparkSession, sf: str, *kept: str) -> tuple[DataFrame, str]:
    frame, _, _, label = _model_frame(spark, sf, kept, ["member_id", "prediction_date", "dataset_split", LABEL, *BOOSTED])
    return frame.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in BOOSTED}), label


@query
def boosted_first_gains(spark: SparkSession, sf: str) -> DataFrame:
    """Bins of each column of the training split, and what its best split gains before any tree is grown."""
    frame, label = _boosted_frame(spark, sf, "train")
    found = boosting.first_gains(frame.filter("dataset_split = 'train'"), label, BOOSTED)
    return found.select("column_name", "bins", "bin", F.round("gain", 4).alias("gain"))


@query
def boosted_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The challenger of 15 leaves and an L2 penalty, after ten rounds on train, applied to scoring."""
    frame, label = _boosted_frame(spark, sf, "train", "scoring")
    model = boosting.fit(frame.filter("dataset_split = 'train'"), label, BOOSTED, boosting.Settings(rounds=10))
    scored = boosting.predict(model, frame.filter("dataset_split = 'scoring'").select("member_id", "prediction_date", *BOOSTED))
    return scored.select("member_id", "prediction_date", "risk_probability")


@query
def coefficient_table(spark: SparkSession, sf: str) -> DataFrame:
    """Coefficients of the plain logistic regression on a dummy-coded column: log odds against the last level."""
    frame, _, _, label = _model_frame(spark, sf, ("train",), ["age_band_as_of", LABEL])
    train = frame.dropna()
    imputation = ml.fit_imputation(train, ["age_band_as_of"], [])
    model = ml.fit_levels(train, label, ["age_band_as_of"], imputation, 1000, 1e-12)
    out = ml.coefficients(model, train, imputation)
    return out.select("feature", "source_feature", F.round("coefficient", 3).alias("coefficient"), F.round("odds_ratio", 3).alias("odds_ratio"), "direction", "rank")


@query
def plain_logistic_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Mean prediction of the plain logistic regression in each level of a dummy-coded column: the level's own rate."""
    frame, categorical, _, label = _model_frame(spark, sf, ("train",), [*CATEGORICAL, LABEL])
    train = frame.dropna()
    imputation = ml.fit_imputation(train, categorical, [])
    model = ml.fit_levels(train, label, categorical, imputation, 1000, 1e-12)
    scored = ml.positive_probability(model, train, imputation)
    return scored.groupBy(F.col("reward_profile_as_of").alias("level")).agg(F.count("*").alias("row_count"), F.round(F.avg("risk_probability"), 4).alias("mean_prediction"))


@query
def ledger_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Runs and decisions committed together in a ledger, twice; the second load changes nothing."""
    decided = materialise(decisions(spark, sf), "decided")
    books = ledger.warehouse(spark, shared_path(spark, "ledger"))
    for _ in range(2):
        version = ledger.load_run(books, _run(decided), decided, DECISION_TIME)
    found = books.read("decisions", version).join(books.read("runs", version).select("run_id"), "run_id", "left_semi")
    return found.select("run_id", "member_id", "prediction_date", "outcome", "reason_code", "risk_probability", "priority_rank", F.unix_timestamp("ingested_at").alias("ingested_at"))


@query
def ledger_months(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions loaded month by month of a quarter, each load a commit; rows of every version."""
    decided = decisions(spark, sf).filter(F.col("prediction_date").between(F.lit("2001-01-01").cast("date"), F.lit("2001-03-31").cast("date")))
    rows = materialise(contracts.conform(decided, contracts.DECISIONS).withColumn("prediction_month", F.trunc("prediction_date", "month")), "months")
    books, counts = ledger.warehouse(spark, shared_path(spark, "ledger")), []
    for month in ("2001-01-01", "2001-02-01", "2001-03-01"):
        version = books.commit({"decisions": rows.filter(F.col("prediction_month") <= F.lit(month).cast("date"))}, DECISION_TIME)
        counts.append(books.read("decisions", version).agg(F.lit(version).cast("long").alias("version"), F.count("*").alias("row_count"), F.count_distinct("prediction_month").alias("months")))
    return functools.reduce(DataFrame.unionByName, counts)


@query
def activation_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole decision job: inputs written and verified, decisions, run, review queue, and the load of both tables."""
    scores = sinks.write_verified(contracts.conform(predictions(spark, sf), contracts.PREDICTIONS), shared_path(spark, "scores"), lambda df: contracts.check(df, contracts.PREDICTIONS))
    known = contracts.conform(contexts(spark, sf).filter("not (opted_out and contact_allowed)"), contracts.CONTEXT)
    context = sinks.write_verified(known, shared_path(spark, "context"), lambda df: contracts.check(df, contracts.CONTEXT))
    out = shared_path(spark, "job")
    lineage = {"contact_context_source_name": "crm", "contact_context_source_snapshot_reference": "snapshot", "contact_context_source_query_sha256": "c"}
    run = jobs.activate(spark, scores, context, POLICY, DECISION_TIME, out, lineage)
    books = ledger.warehouse(spark, f"{out}/ledger")
    jobs.load_ledger(spark, out, books, DECISION_TIME)
    return books.read("decisions").filter(F.col("run_id") == run).select("member_id", "prediction_date", "outcome", "reason_code", "risk_probability", "intervention_category", "priority_rank")


@query
def observed_write(spark: SparkSession, sf: str) -> DataFrame:
    """What the rules of scores found while these were written."""
    found = sinks.write_observed(predictions(spark, sf), shared_path(spark, "observed"), [constraints.unique("member_id", "prediction_date"), constraints.required("risk_probability"), constraints.where("above_one", F.col("risk_probability") > 1)])
    return spark.createDataFrame(list(found.items()), "counted string, found long")


@query
def several_unique_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Rows beyond the first of several keys of the order lines, in one pass."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    return constraints.run(lines, [constraints.unique("l_orderkey", "l_linenumber"), constraints.unique("l_orderkey"), constraints.unique("l_partkey", "l_suppkey"), constraints.where("discount", F.col("l_discount") > 0.1)])


@query
def profile_report(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of the staged panel as one table."""
    rows = staged(spark, sf).select("member_id", "activity_date", "age_band", "reward_profile", "daily_steps", "sleep_hours", "intervention_received", "intervention_opened", "will_miss_goal_next_7_days")
    return rounded(profile.report(rows, "member_id", "activity_date", "will_miss_goal_next_7_days", ["daily_steps", "sleep_hours"], ["age_band", "reward_profile"], ["intervention_received", "intervention_opened"]))


@query
def column_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of the raw panel against those of a contract."""
    return constraints.column_differences(raw_panel(spark, sf), ["member_id", "activity_date", "daily_steps", "heart_rate", "weight"])


@query
def clashing_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers' output folders that are, hold or lie in the folder of their nation's part."""
    rows = spark.read.parquet(f"{sf}/supplier.parquet")
    mine = F.concat(F.lit("/out/"), F.col("s_nationkey").cast("string"), F.when(F.col("s_suppkey") % 3 == 0, "/").when(F.col("s_suppkey") % 3 == 1, "/part").otherwise("0"))
    theirs = F.concat(F.lit("/out/"), (F.col("s_suppkey") % 25).cast("string"))
    return rows.select("s_nationkey", fn.paths_clash(mine, theirs).alias("clash")).groupBy("s_nationkey").agg(F.count("*").alias("suppliers"), F.count_if("clash").alias("clashes"))


@query
def known_history(spark: SparkSession, sf: str) -> DataFrame:
    """What was known of the 28 days before each of a member's days, row by row: a band join of both time axes."""
    rows = panel.quality_flags(raw_panel(spark, sf)).select("member_id", "activity_date", "available_date", "daily_steps", "activity_level")
    points = rows.select("member_id", F.col("activity_date").alias("prediction_date"))
    met = asof.band_join(points, rows, "member_id", "prediction_date", "activity_date", "available_date")
    return met.groupBy("member_id", "prediction_date").agg(
        F.count("h_activity_date").alias("known_days"), F.sum("h_daily_steps").alias("known_steps"), fn.last_known(F.col("h_activity_level"), F.col("h_activity_date")).alias("latest_level")
    )
