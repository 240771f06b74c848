"""Declarative data-quality constraints, checked in one pass.

A rule is a name and an aggregate that counts violations. ``run`` gives a row for each rule:
name, violations, passed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import is_probability
from tidewatch.functions.shared import materialise


class ConstraintError(ValueError):
    """Some constraints failed; the message names them."""


@dataclass(frozen=True)
class Rule:
    name: str
    violations: Column
    #: The key, if the rule is that it be unique.
    key: tuple[str, ...] = ()


def where(name: str, broken: Column) -> Rule:
    """Rows on which ``broken`` is true."""
    return Rule(name, F.count_if(F.coalesce(broken, F.lit(False))))


def required(*columns: str) -> Rule:
    """Rows with a null in any of the columns."""
    any_null = F.lit(False)
    for c in columns:
        any_null |= F.col(c).isNull()
    return where(f"required_{'_'.join(columns)}", any_null)


def unique(*keys: str) -> Rule:
    """Rows beyond the first of each key; nulls are values."""
    return Rule(f"unique_{'_'.join(keys)}", F.count("*") - F.count_distinct(F.struct(*keys)), keys)


def repeats(df: DataFrame, keys: dict[str, tuple[str, ...]]) -> DataFrame:
    """A row for each named key: ``constraint_name`` and ``violations``, the rows beyond the first of each value.

    Values are counted by their hash, all keys in one pass; only rows whose hash was met twice are compared by value.
    """
    hashes = F.array(*(F.struct(F.lit(n).alias("name"), F.xxhash64(F.lit(n), *k).alias("hash")) for n, k in keys.items()))
    twice = df.select(F.inline(hashes)).groupBy("name", "hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash")
    twice = materialise(twice, "repeats")
    values = F.array(*(F.struct(F.lit(n).alias("name"), F.xxhash64(F.lit(n), *k).alias("hash"), F.to_json(F.struct(*k), {"ignoreNullFields": "false"}).alias("value")) for n, k in keys.items()))
    met = df.select(F.inline(values)).join(twice, "hash", "left_semi").groupBy("name", "value").agg((F.count("*") - 1).alias("over")).groupBy("name").agg(F.sum("over").alias("violations"))
    names = df.sparkSession.createDataFrame([(n,) for n in keys], "name string")
    return names.join(met, "name", "left").select(F.col("name").alias("constraint_name"), F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


def domain(column: str, *values) -> Rule:
    """Rows whose value is null or not among ``values``."""
    return where(f"domain_{column}", ~F.col(column).isin(*values) | F.col(column).isNull())


def flag_matches(flag: str, condition: Column) -> Rule:
    """Rows whose flag isn't exactly the condition."""
    return where(f"flag_{flag}", ~F.col(flag).eqNullSafe(condition))


def co_null(*columns: str) -> Rule:
    """Rows on which some, but not all, of the columns are null."""
    nulls = sum((F.col(c).isNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNull().cast("int"))
    return where(f"co_null_{'_'.join(columns)}", ~nulls.isin(0, len(columns)))


def rate_between(name: str, flag: Column, low: float, high: float) -> Rule:
    """1 if the mean of the flag (nulls ignored) is outside the band or undefined."""
    return Rule(name, F.coalesce((~F.avg(flag.cast("double")).between(low, high)).cast("long"), F.lit(1)))


def row_count(expected: int) -> Rule:
    """By how much the row count differs."""
    return Rule("row_count", F.abs(F.count("*") - expected))


def value_count(column: str, expected: int) -> Rule:
    """By how much the number of distinct values differs."""
    return Rule(f"distinct_{column}", F.abs(F.count_distinct(column) - expected))


def range_is(column: str, low, high) -> Rule:
    """1 if the least or the greatest value isn't the given one."""
    same = F.min(column).eqNullSafe(F.lit(low).cast("date")) & F.max(column).eqNullSafe(F.lit(high).cast("date"))
    return Rule(f"range_{column}", (~same).cast("long"))


def not_all_null(*columns: str) -> list[Rule]:
    """For each column, 1 if it has no value at all."""
    return [Rule(f"not_all_null_{c}", (F.count(c) == 0).cast("long")) for c in columns]


def constant(column: str) -> Rule:
    """Distinct values beyond one; nulls count as a value."""
    return Rule(f"constant_{column}", F.greatest(F.count_distinct(F.struct(column)) - 1, F.lit(0)))


def run(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """A row for each rule, from one aggregate over ``df``; two unique keys or more are checked beside it, so that they don't multiply its rows."""
    keys = {r.name: r.key for r in rules if r.key}
    if len(keys) > 1:
        found = repeats(df, keys).withColumn("passed", F.col("violations") == 0)
        rest = [r for r in rules if not r.key]
        return run(df, rest).unionByName(found) if rest else found
    one = df.agg(*(r.violations.cast("long").alias(f"v{i}") for i, r in enumerate(rules)))
    entries = F.array(*(F.struct(F.lit(r.name).alias("constraint_name"), F.col(f"v{i}").alias("violations")) for i, r in enumerate(rules)))
    return one.select(F.inline(entries)).withColumn("passed", F.col("violations") == 0)


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` itself, or an error that names the failed rules."""
    failed = [f"{r['constraint_name']} ({r['violations']})" for r in run(df, rules).filter("not passed").collect()]  # a row for each rule
    if failed:
        raise ConstraintError(", ".join(failed))
    return df


def panel_rules() -> list[Rule]:
    """Rules of a staged panel."""
    c = F.col
    delay = c("record_delay_days")
    late = (delay < 0) | (delay > 3) | ~delay.eqNullSafe(F.datediff("available_date", "activity_date")) | ~c("is_late_record").eqNullSafe(delay > 0)
    return [
        unique("member_id", "activity_date"),
        required("member_id", "activity_date", "active_minutes", "weekly_goal"),
        domain("activity_level", "low", "moderate", "high"),
        domain("reward_profile", "low", "medium", "high"),
        domain("intervention_profile", "low", "medium", "high"),
        flag_matches("sleep_hours_missing", c("sleep_hours").isNull()),
        flag_matches("app_sessions_missing", c("app_sessions").isNull()),
        flag_matches("is_step_outlier", F.coalesce(c("daily_steps") > 35_000, F.lit(False))),
        where("late_flag_and_delay", late),
        co_null("future_7_day_active_minutes", "next_week_goal_completed", "will_miss_goal_next_7_days"),
        where("outcome_recomputed", ~c("next_week_goal_completed").eqNullSafe(c("future_7_day_active_minutes") >= c("weekly_goal"))),
        where("miss_is_not_completed", ~c("will_miss_goal_next_7_days").eqNullSafe(~c("next_week_goal_completed"))),
        where("clicked_was_opened", c("intervention_clicked") & ~F.coalesce(c("intervention_opened"), F.lit(False))),
        where("opened_was_received", c("intervention_opened") & ~F.coalesce(c("intervention_received"), F.lit(False))),
        where("redeemed_was_viewed", c("rewards_redeemed") > c("rewards_viewed")),
        where("viewed_within_sessions", c("rewards_viewed") > c("app_sessions")),
    ]


def label_tail(panel: DataFrame, day: str, label: str, horizon: int = 7) -> DataFrame:
    """One row: rows whose label isn't null exactly in the last ``horizon`` days of the table."""
    last = panel.agg(F.max(day).alias("#last"))
    joined = panel.crossJoin(F.broadcast(last))  # one row
    bad = ~(F.col(day) > F.date_sub("#last", horizon)).eqNullSafe(F.col(label).isNull())
    return joined.agg(F.count_if(bad).alias("violations"))


def score_rules() -> list[Rule]:
    """Rules of a scoring output."""
    c = F.col
    return [
        unique("member_id", "prediction_date"),
        required("member_id", "prediction_date", "risk_probability", "is_high_risk", "model_name", "threshold"),
        where("probability", ~is_probability(c("risk_probability"))),
        flag_matches("is_high_risk", c("risk_probability") >= c("threshold")),
        constant("model_name"),
        constant("threshold"),
    ]


def metric_rules() -> list[Rule]:
    """Rules of a one-row summary of metrics."""
    c = F.col
    total = c("true_positives") + c("false_positives") + c("true_negatives") + c("false_negatives")
    return [
        where("roc_auc", ~c("roc_auc").between(0.5, 1.0)),
        where("pr_auc_above_base_rate", c("pr_auc") <= c("base_positive_rate")),
        where("brier_score", ~c("brier_score").between(0.0, 0.25)),
        where("lift_above_one", c("top_decile_lift") <= 1),
        where("calibration_error", ~c("expected_calibration_error").between(0.0, 0.1)),
        where("confusion_total", total != c("row_count")),
    ]


def context_rules() -> list[Rule]:
    """Rules of a contact-context snapshot."""
    c = F.col
    return [
        unique("member_id"),
        required("member_id", "contact_allowed", "opted_out", "active_case_open", "interventions_last_28d", "context_as_of"),
        where("opted_out_but_allowed", c("opted_out") & c("contact_allowed")),
        where("negative_interventions", c("interventions_last_28d") < 0),
        where("contact_after_snapshot", c("last_contacted_at") > c("context_as_of")),
        constant("context_as_of"),
    ]


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks (as multisets), with ``side``; none if they are equal.

    One count over both tables: those of the one count up, those of the other down.
    """
    names = list(a.columns)
    sides = a.withColumn("#n", F.lit(1).cast("long")).union(b.withColumn("#n", F.lit(-1).cast("long")))
    left = sides.groupBy(*(F.col(f"`{c}`") for c in names)).agg(F.sum("#n").alias("#n")).filter("`#n` <> 0")
    side = F.when(F.col("#n") > 0, "left").otherwise("right").alias("side")
    return left.select(*(F.col(f"`{c}`") for c in names), side, F.explode(F.array_repeat(F.lit(0), F.abs("#n").cast("int"))).alias("#")).drop("#")


def outside(df: DataFrame, keys: list[str], allowed: DataFrame) -> DataFrame:
    """Rows whose key isn't among the allowed ones."""
    return df.join(allowed, keys, "left_anti")


def column_differences(df: DataFrame, needed: list[str]) -> DataFrame:
    """A row for each needed column that the table lacks (``missing``) and for each other one that it has (``unexpected``), with the rows that have a value there."""
    missing, more = missing_columns(df, needed), sorted(set(df.columns) - set(needed))
    one = df.agg(F.count("*").alias("#n"), *(F.count(F.col(f"`{c}`")).alias(f"#{c}") for c in more))
    entries = [F.struct(F.lit(c).alias("column_name"), F.lit("missing").alias("difference"), F.lit(0).cast("long").alias("filled")) for c in missing]
    entries += [F.struct(F.lit(c).alias("column_name"), F.lit("unexpected").alias("difference"), F.col(f"`#{c}`").alias("filled")) for c in more]
    empty = F.array().cast("array<struct<column_name:string,difference:string,filled:bigint>>")
    return one.select(F.inline(F.array(*entries) if entries else empty))


def missing_columns(df: DataFrame, needed: list[str]) -> list[str]:
    """Needed columns that the table lacks, sorted."""
    return sorted(set(needed) - set(df.columns))


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """One row: keys of either table that the other lacks; 0 and 0 if their sets are equal."""
    left, right = a.select(*keys).distinct(), b.select(*keys).distinct()
    return outside(left, keys, right).agg(F.count("*").alias("only_left")).crossJoin(F.broadcast(outside(right, keys, left).agg(F.count("*").alias("only_right"))))  # one row each


def same_fields(stored: DataFrame, recomputed: DataFrame) -> DataFrame:
    """A row for each field of a stored one-row record: its value, the recomputed one, and whether they agree."""
    fields = sorted(set(stored.columns) | set(recomputed.columns))
    text = lambda df, side: df.select(*((F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(f"{side}{c}") for c in fields))
    both = text(stored, "s ").crossJoin(F.broadcast(text(recomputed, "r ")))  # one row each
    entries = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"s {c}").alias("stored"), F.col(f"r {c}").alias("recomputed")) for c in fields))
    return both.select(F.inline(entries)).withColumn("same", F.col("stored").eqNullSafe(F.col("recomputed")))


def label_rules(label: str) -> list[Rule]:
    """Rules of rows to be evaluated: there are some, all labelled, of both classes."""
    return [Rule("rows", (F.count("*") == 0).cast("long")), where("unlabelled", F.col(label).isNull()), Rule("both_classes", (F.count_distinct(label) != 2).cast("long"))]

