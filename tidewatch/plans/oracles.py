"""DuckDB SQL for the registered queries of the core library."""

from __future__ import annotations

from tidewatch.operators.asof import AS_OF
from tidewatch.plans import fixtures

_T = fixtures.THRESHOLD

#: Goal metrics and flags over the raw panel.
_STAGED = f"""
raw as ({fixtures.RAW_PANEL}),
ws as (select *, activity_date - cast(isodow(activity_date) - 1 as integer) as week_start from raw),
progress as (
  select *, cast(sum(active_minutes) over (partition by member_id, week_start order by activity_date) as bigint) as weekly_active_minutes_so_far,
         cast(sum(active_minutes) over ahead as double) as fut, count(active_minutes) over ahead as nfut
  from ws window ahead as (partition by member_id order by activity_date rows between 1 following and 7 following)),
weeks as (select member_id, week_start, sum(active_minutes) >= arg_min(weekly_goal, activity_date) as done from ws group by all),
runs as (select *, sum(case when done then 0 else 1 end) over (partition by member_id order by week_start) as run from weeks),
streaks as (select *, sum(case when done then 1 else 0 end) over (partition by member_id, run order by week_start) as streak from runs),
history as (
  select member_id, week_start, cast(coalesce(lag(streak) over (partition by member_id order by week_start), 0) as bigint) as previous_goal_streak,
         cast(run - case when done then 0 else 1 end as bigint) as previous_failed_goals
  from streaks),
active as (
  select *, sum(case when app_sessions > 0 then 1 else 0 end) over (partition by member_id order by activity_date rows unbounded preceding) as arun from progress),
staged as (
  select a.* exclude (fut, nfut, arun),
         round_even(weekly_active_minutes_so_far * cast(100 as double) / weekly_goal, 1) as goal_completion_percentage,
         previous_goal_streak, previous_failed_goals,
         case when nfut = 7 then fut end as future_7_day_active_minutes,
         case when nfut = 7 then fut >= weekly_goal end as next_week_goal_completed,
         case when nfut = 7 then not fut >= weekly_goal end as will_miss_goal_next_7_days,
         cast(row_number() over (partition by member_id, arun order by activity_date) - case when arun > 0 then 1 else 0 end as bigint) as days_since_last_app_session,
         sleep_hours is null as sleep_hours_missing, app_sessions is null as app_sessions_missing,
         coalesce(daily_steps > 35000, false) as is_step_outlier, record_delay_days > 0 as is_late_record,
         activity_date + record_delay_days as available_date,
         coalesce(activity_level <> lag(activity_level) over (partition by member_id order by activity_date), false) as activity_level_changed
  from active a join history using (member_id, week_start))
"""

_as_of = ",\n".join(f"  arg_max(h.{c}, h.activity_date) filter (where h.{c} is not null) as {c}_as_of" for c in AS_OF)
_week = lambda c: f"round(avg(h.{c}) filter (where h.activity_date >= a.prediction_date - 7), 6)"
_prior = lambda c: f"round(avg(h.{c}) filter (where h.activity_date between a.prediction_date - 14 and a.prediction_date - 8), 6)"
_exact = lambda c: f"avg(h.{c}) filter (where h.activity_date >= a.prediction_date - 7) - avg(h.{c}) filter (where h.activity_date between a.prediction_date - 14 and a.prediction_date - 8)"
_flag = lambda c: f"cast(count(*) filter (where h.{c}) as bigint)"

_FEATURES = f"""
with {_STAGED},
anchors as (
  select member_id, activity_date as prediction_date, will_miss_goal_next_7_days from staged
  qualify activity_date >= min(activity_date) over (partition by member_id) + 28)
select a.member_id, a.prediction_date, a.will_miss_goal_next_7_days as label_will_miss_goal_next_7_days,
  a.prediction_date - 28 as feature_window_start, a.prediction_date - 1 as feature_window_end,
{_as_of},
  count(h.activity_date) as available_day_count_28d, 28 - count(h.activity_date) as unavailable_day_count_28d,
  max(h.activity_date) as max_source_activity_date, max(h.available_date) as max_source_available_date,
  round(avg(h.daily_steps), 6) as avg_daily_steps_28d, round(stddev_samp(h.daily_steps), 6) as stddev_daily_steps_28d,
  {_week("daily_steps")} as avg_daily_steps_7d, {_prior("daily_steps")} as avg_daily_steps_prior_7d,
  cast(sum(h.active_minutes) as bigint) as sum_active_minutes_28d, round(avg(h.active_minutes), 6) as avg_active_minutes_28d,
  round(stddev_samp(h.active_minutes), 6) as stddev_active_minutes_28d,
  {_week("active_minutes")} as avg_active_minutes_7d, {_prior("active_minutes")} as avg_active_minutes_prior_7d,
  cast(count(*) filter (where h.active_minutes > 0) as bigint) as active_day_count_28d,
  round(avg(h.sleep_hours), 6) as avg_sleep_hours_28d, {_week("sleep_hours")} as avg_sleep_hours_7d,
  count(h.sleep_hours) as sleep_observation_count_28d, {_flag("sleep_hours_missing")} as sleep_missing_day_count_28d,
  cast(sum(h.app_sessions) as bigint) as sum_app_sessions_28d, round(avg(h.app_sessions), 6) as avg_app_sessions_28d,
  {_week("app_sessions")} as avg_app_sessions_7d, {_prior("app_sessions")} as avg_app_sessions_prior_7d,
  count(h.app_sessions) as app_session_observation_count_28d, {_flag("app_sessions_missing")} as app_sessions_missing_day_count_28d,
  cast(sum(h.rewards_viewed) as bigint) as rewards_viewed_28d, cast(sum(h.rewards_redeemed) as bigint) as rewards_redeemed_28d,
  {_flag("intervention_received")} as interventions_received_28d, {_flag("intervention_opened")} as interventions_opened_28d,
  {_flag("intervention_clicked")} as interventions_clicked_28d, {_flag("is_step_outlier")} as step_outlier_day_count_28d,
  {_flag("is_late_record")} as late_record_count_28d, {_flag("activity_level_changed")} as activity_level_change_count_28d,
  round(avg(h.goal_completion_percentage), 6) as avg_goal_completion_percentage_28d,
  round(sum(h.rewards_redeemed) / nullif(cast(sum(h.rewards_viewed) as double), 0), 6) as reward_redemption_rate_28d,
  round(count(*) filter (where h.intervention_opened) / nullif(cast(count(*) filter (where h.intervention_received) as double), 0), 6) as intervention_open_rate_28d,
  round(count(*) filter (where h.intervention_clicked) / nullif(cast(count(*) filter (where h.intervention_received) as double), 0), 6) as intervention_click_rate_28d,
  round({_exact("daily_steps")}, 6) as daily_steps_trend_7d, round({_exact("active_minutes")}, 6) as active_minutes_trend_7d,
  round({_exact("app_sessions")}, 6) as app_sessions_trend_7d
from anchors a left join staged h
  on a.member_id = h.member_id and h.activity_date between a.prediction_date - 28 and a.prediction_date - 1 and h.available_date <= a.prediction_date
group by a.member_id, a.prediction_date, a.will_miss_goal_next_7_days
"""

_USER = f"""
days as ({fixtures.USER_DAY}),
cells as (
  select entity_id, goal, cast(d as date) as activity_date
  from (select entity_id, max(weekly_goal) as goal from days group by 1), (select unnest(generate_series(min(activity_date), max(activity_date), interval 1 day)) as d from days)),
dense as (
  select entity_id, activity_date, coalesce(active_minutes, 0) as active_minutes, coalesce(app_sessions, 0) as app_sessions,
         coalesce(rewards_viewed, 0) as rewards_viewed, coalesce(rewards_redeemed, 0) as rewards_redeemed, coalesce(weekly_goal, goal) as weekly_goal
  from cells left join days using (entity_id, activity_date)),
dw as (select *, activity_date - cast(isodow(activity_date) - 1 as integer) as week_start from dense)
"""
_FUTURE = f"""
with {_USER},
f as (
  select entity_id, activity_date, weekly_goal,
         case when count(active_minutes) over ahead = 7 then cast(sum(active_minutes) over ahead as double) end as future_7_day_active_minutes
  from dense window ahead as (partition by entity_id order by activity_date rows between 1 following and 7 following))
"""

_SCORED = f"s as ({fixtures.SCORED})"
_PREDICTIONS = f"{_SCORED}, pr as (select member_id, prediction_date, p as risk_probability, p >= {_T} as is_high_risk, 'logistic' as model_name, cast({_T} as double) as threshold from s)"

_CONFUSION = f"""
c as (
  select count(*) filter (where p >= {_T} and actual_label) as tp, count(*) filter (where p >= {_T} and not actual_label) as fp,
         count(*) filter (where p < {_T} and not actual_label) as tn, count(*) filter (where p < {_T} and actual_label) as fn
  from s)
"""
_z = lambda a, b: f"coalesce(({a}) / nullif(cast({b} as double), 0), 0)"
_n = lambda a, b: f"({a}) / nullif(cast({b} as double), 0)"


def _rates(d) -> str:
    return f"""
  round({d("tp", "(tp + fp)")}, 6) as precision, round({d("tp", "(tp + fn)")}, 6) as recall, round({d("tn", "(tn + fp)")}, 6) as specificity,
  round({d("tp + tn", "(tp + fp + tn + fn)")}, 6) as accuracy, round({d("2 * tp", "(2 * tp + fp + fn)")}, 6) as f1_score"""


_SWEEP = f"""
{_SCORED},
t as (select unnest(range(1001)) as step),
sw as (
  select step / cast(1000 as double) as threshold, count(*) filter (where p >= step / cast(1000 as double) and actual_label) as tp,
         count(*) filter (where p >= step / cast(1000 as double) and not actual_label) as fp, count(*) filter (where p < step / cast(1000 as double) and not actual_label) as tn,
         count(*) filter (where p < step / cast(1000 as double) and actual_label) as fn
  from s cross join t group by step)
"""
_COUNTS = "tp as true_positives, fp as false_positives, tn as true_negatives, fn as false_negatives"
_SWEPT = f"select threshold, {_COUNTS}, {_rates(_n)} from sw"
_GRID = """
pts as (select threshold, coalesce(tp / nullif(cast(tp + fn as double), 0), 0) as r, coalesce(tp / nullif(cast(tp + fp as double), 0), 1) as q from sw),
steps as (
  select r - lag(r, 1, 0) over (order by threshold desc) as dr, (q + lag(q, 1, 1) over (order by threshold desc)) / 2 as h from pts),
grid as (select sum(dr * h) as approximate_pr_auc from steps)
"""
_CURVE = """
pts1 as (select p, count(*) filter (where actual_label) as pos, count(*) filter (where not actual_label) as neg from s group by p),
pts2 as (select *, cast(sum(pos) over (order by p desc) as double) as tp, cast(sum(neg) over (order by p desc) as double) as fp from pts1),
curve as (
  select sum(neg * (tp + tp - pos) / 2) / (cast(sum(pos) as double) * cast(sum(neg) as double)) as roc_auc,
         sum(pos * (tp / (tp + fp) + case when tp - pos + fp - neg = 0 then 1 else (tp - pos) / (tp - pos + fp - neg) end) / 2) / sum(pos) as pr_auc,
         sum(pos * tp / (tp + fp)) / sum(pos) as average_precision
  from pts2)
"""
_PROB = """
prob as (
  select count(*) as row_count, avg(cast(actual_label as int)) as base_positive_rate, avg(p) as mean_predicted_probability,
         avg(-ln(least(greatest(case when actual_label then p else 1 - p end, 2.220446049250313e-16), 1 - 2.220446049250313e-16))) as log_loss,
         avg(power(p - cast(actual_label as int), 2)) as brier_score
  from s)
"""
_BINS = """
  count(*) as row_count, min(p) as minimum_probability, max(p) as maximum_probability, avg(p) as mean_probability, avg(cast(actual_label as int)) as observed_rate
"""
_NTILE = f"nt as (select b as calibration_bin, {_BINS} from (select *, ntile(10) over (order by p, k) as b from s) group by b)"
_WIDTH = f"wd as (select cast(least(floor(p * 10), 9) as bigint) as calibration_bin, {_BINS} from s group by 1)"
_BIN_OUT = """
  calibration_bin, row_count, round(minimum_probability, 6) as minimum_probability, round(maximum_probability, 6) as maximum_probability, round(mean_probability, 6) as mean_probability,
  round(observed_rate, 6) as observed_rate, round(observed_rate - mean_probability, 6) as calibration_difference, round(abs(observed_rate - mean_probability), 6) as absolute_calibration_difference
"""
_TOP = """
  count(*) filter (where top) as top_row_count,
  count(*) filter (where top and actual_label) / nullif(cast(count(*) filter (where actual_label) as double), 0) as top_decile_recall,
  count(*) filter (where top and actual_label) / nullif(cast(count(*) filter (where top) as double), 0) as top_decile_precision,
  (count(*) filter (where top and actual_label) / nullif(cast(count(*) filter (where top) as double), 0)) / (count(*) filter (where actual_label) / cast(count(*) as double)) as top_decile_lift
"""
_TOPTILE = f"tt as (select {_TOP} from (select *, ntile(10) over (order by p desc, k) = 1 as top from s))"
_TOP_OUT = "top_row_count, round(top_decile_recall, 6) as top_decile_recall, round(top_decile_precision, 6) as top_decile_precision, round(top_decile_lift, 6) as top_decile_lift"
_ECE = "round(sum(row_count * abs(observed_rate - mean_probability)) / sum(row_count), 6) as expected_calibration_error, round(max(abs(observed_rate - mean_probability)), 6) as maximum_calibration_gap"


def _macro(t: float) -> str:
    return f"""
  select ({_z("tp", "(tp + fp)")} + {_z("tn", "(tn + fn)")}) / 2 as macro_precision, ({_z("tp", "(tp + fn)")} + {_z("tn", "(tn + fp)")}) / 2 as macro_recall,
         ({_z("2 * tp", "(2 * tp + fp + fn)")} + {_z("2 * tn", "(2 * tn + fp + fn)")}) / 2 as macro_f1, {_z("tp + tn", "(tp + fp + tn + fn)")} as accuracy
  from (select count(*) filter (where p >= {t} and actual_label) as tp, count(*) filter (where p >= {t} and not actual_label) as fp,
               count(*) filter (where p < {t} and not actual_label) as tn, count(*) filter (where p < {t} and actual_label) as fn from s)"""


_AT = "timestamp '2001-08-02'"
_CTX = f"""
x as ({fixtures.CONTEXT}),
ctx as (select *, {_AT} - to_days(days_since_contact) as last_contacted_at from x)
"""
_DECIDED = f"""
{_PREDICTIONS}, {_CTX},
r as (
  select pr.*, case
    when prediction_date < max(prediction_date) over (partition by pr.member_id) then 'superseded_by_latest_prediction'
    when not is_high_risk then 'below_frozen_threshold'
    when ctx.member_id is null then 'missing_activation_context'
    when not contact_allowed then 'contact_not_permitted'
    when opted_out then 'member_opted_out'
    when date_diff('day', prediction_date, date '2001-08-02') > 365 then 'prediction_too_old'
    when active_case_open then 'active_case_open'
    when last_contacted_at is not null and {_AT} < last_contacted_at + interval 7 day then 'contact_cooldown_active'
    when interventions_last_28d >= 2 then 'prior_intervention_limit_reached' end as reason,
    last_contacted_at
  from pr left join ctx on pr.member_id = ctx.member_id),
ranked as (
  select *, case when reason is null then row_number() over (partition by reason is null order by risk_probability desc, prediction_date desc, member_id) end as rk from r),
decided as (
  select member_id, prediction_date,
    case when reason = 'superseded_by_latest_prediction' then 'no_contact_superseded' when reason = 'below_frozen_threshold' then 'no_contact_below_threshold'
         when reason in ('missing_activation_context', 'contact_not_permitted', 'member_opted_out') then 'no_contact_excluded'
         when reason is not null then 'no_contact_suppressed' when rk <= 100 then 'selected_for_review' else 'no_contact_capacity' end as outcome,
    coalesce(reason, case when rk <= 100 then 'selected_for_human_review' else 'capacity_limit_reached' end) as reason_code,
    risk_probability, case when rk <= 100 then 'supportive_check_in' end as intervention_category, case when rk <= 100 then rk end as priority_rank,
    case when reason = 'contact_cooldown_active' then cast(last_contacted_at + interval 7 day as date) end as suppression_until
  from ranked)
"""


def _report(source: str, checks: dict[str, str]) -> str:
    rows = " union all ".join(f"select '{k}' as constraint_name, cast(({v}) as bigint) as violations from {source}" for k, v in checks.items())
    return f"select *, violations = 0 as passed from ({rows})"


def _bad(condition: str) -> str:
    return f"count(*) filter (where {condition})"


def _uniq(*keys: str) -> str:
    return f"count(*) - count(distinct ({', '.join(keys)}))" if len(keys) > 1 else f"count(*) - count(distinct {keys[0]})"


_PANEL_CHECKS = {
    "unique_member_id_activity_date": _uniq("member_id", "activity_date"),
    "required_member_id_activity_date_active_minutes_weekly_goal": _bad("member_id is null or activity_date is null or active_minutes is null or weekly_goal is null"),
    "domain_activity_level": _bad("activity_level is null or activity_level not in ('low', 'moderate', 'high')"),
    "domain_reward_profile": _bad("reward_profile is null or reward_profile not in ('low', 'medium', 'high')"),
    "domain_intervention_profile": _bad("intervention_profile is null or intervention_profile not in ('low', 'medium', 'high')"),
    "flag_sleep_hours_missing": _bad("sleep_hours_missing is distinct from (sleep_hours is null)"),
    "flag_app_sessions_missing": _bad("app_sessions_missing is distinct from (app_sessions is null)"),
    "flag_is_step_outlier": _bad("is_step_outlier is distinct from coalesce(daily_steps > 35000, false)"),
    "late_flag_and_delay": _bad("record_delay_days < 0 or record_delay_days > 3 or record_delay_days is distinct from date_diff('day', activity_date, available_date) or is_late_record is distinct from (record_delay_days > 0)"),
    "co_null_future_7_day_active_minutes_next_week_goal_completed_will_miss_goal_next_7_days": _bad(
        "cast(future_7_day_active_minutes is null as int) + cast(next_week_goal_completed is null as int) + cast(will_miss_goal_next_7_days is null as int) not in (0, 3)"
    ),
    "outcome_recomputed": _bad("next_week_goal_completed is distinct from (future_7_day_active_minutes >= weekly_goal)"),
    "miss_is_not_completed": _bad("will_miss_goal_next_7_days is distinct from (not next_week_goal_completed)"),
    "clicked_was_opened": _bad("intervention_clicked and not coalesce(intervention_opened, false)"),
    "opened_was_received": _bad("intervention_opened and not coalesce(intervention_received, false)"),
    "redeemed_was_viewed": _bad("rewards_redeemed > rewards_viewed"),
    "viewed_within_sessions": _bad("rewards_viewed > app_sessions"),
}
_CONTEXT_CHECKS = {
    "unique_member_id": _uniq("member_id"),
    "required_member_id_contact_allowed_opted_out_active_case_open_interventions_last_28d_context_as_of": _bad(
        "member_id is null or contact_allowed is null or opted_out is null or active_case_open is null or interventions_last_28d is null"
    ),
    "opted_out_but_allowed": _bad("opted_out and contact_allowed"),
    "negative_interventions": _bad("interventions_last_28d < 0"),
    "contact_after_snapshot": _bad(f"last_contacted_at > {_AT}"),
    "constant_context_as_of": "0 * count(*)",
}
_PREDICTION_CHECKS = {
    "unique_member_id_prediction_date": _uniq("member_id", "prediction_date"),
    "required_member_id_prediction_date_risk_probability_is_high_risk_model_name_threshold": _bad(
        "member_id is null or prediction_date is null or risk_probability is null or is_high_risk is null or model_name is null or threshold is null"
    ),
    "probability": _bad("not coalesce(risk_probability between 0 and 1, false)"),
    "flag_is_high_risk": _bad("is_high_risk is distinct from (risk_probability >= threshold)"),
    "constant_model_name": "greatest(count(distinct model_name) - 1, 0)",
    "constant_threshold": "greatest(count(distinct threshold) - 1, 0)",
}
_DECISION_CHECKS = {
    "unique_member_id_prediction_date": _uniq("member_id", "prediction_date"),
    "constant_run_id": "0 * count(*)",
    "domain_outcome": _bad("outcome is null or outcome not in ('selected_for_review', 'no_contact_superseded', 'no_contact_below_threshold', 'no_contact_excluded', 'no_contact_suppressed', 'no_contact_capacity')"),
    "outcome_and_reason": _bad("(outcome = 'selected_for_review') <> (reason_code = 'selected_for_human_review')"),
    "selected_has_rank": _bad("(outcome = 'selected_for_review') <> (priority_rank is not null)"),
    "selected_has_category": _bad("(outcome = 'selected_for_review') <> (intervention_category is not null)"),
    "ranks_contiguous": "abs(count(priority_rank) - coalesce(max(priority_rank), 0)) + count(priority_rank) - count(distinct priority_rank)",
    "capacity": "greatest(count(priority_rank) - 100, 0)",
}
_METRIC_CHECKS = {
    "roc_auc": _bad("not roc_auc between 0.5 and 1"),
    "pr_auc_above_base_rate": _bad("pr_auc <= base_positive_rate"),
    "brier_score": _bad("not brier_score between 0 and 0.25"),
    "lift_above_one": _bad("top_decile_lift <= 1"),
    "calibration_error": _bad("not expected_calibration_error between 0 and 0.1"),
    "confusion_total": _bad("true_positives + false_positives + true_negatives + false_negatives <> row_count"),
}
_OTHER = (
    "other as (select actual_label, (p + (k % 10) / cast(10 as double)) / 2 as p from s), "
    + _CURVE.strip().replace("from s ", "from other ").replace("pts1", "other1").replace("pts2", "other2").replace("curve as", "other_curve as")
)
_SPLIT = "case when {d} < date '1999-01-01' then 'train' when {d} < date '2000-01-01' then 'validation' when {d} < date '2001-01-01' then 'test' else 'scoring' end"
_REPORT = f"""
with {_STAGED}
select {_SPLIT.format(d="activity_date")} as dataset_split, count(*) as row_count, count(distinct member_id) as entity_count, min(activity_date) as first_day,
       max(activity_date) as last_day, count(*) filter (where will_miss_goal_next_7_days) as positives, count(*) filter (where will_miss_goal_next_7_days is null) as unlabelled
from staged group by 1
"""
_SUMMARY = f"""
with {_SWEEP}, {_GRID}, {_CURVE}, {_PROB}, {_NTILE}, {_TOPTILE}, {_CONFUSION}, half as ({_macro(0.5)}), cal as (select {_ECE} from nt)
select round(macro_precision, 6) as macro_precision_at_0_5, round(macro_recall, 6) as macro_recall_at_0_5, round(macro_f1, 6) as macro_f1_at_0_5, round(half.accuracy, 6) as accuracy_at_0_5,
  row_count, round(base_positive_rate, 6) as base_positive_rate, round(mean_predicted_probability, 6) as mean_predicted_probability, round(log_loss, 6) as log_loss, round(brier_score, 6) as brier_score,
  round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc, round(average_precision, 6) as average_precision, round(approximate_pr_auc, 6) as approximate_pr_auc,
  round(top_decile_recall, 6) as top_decile_recall, round(top_decile_precision, 6) as top_decile_precision, round(top_decile_lift, 6) as top_decile_lift,
  expected_calibration_error, maximum_calibration_gap, cast({_T} as double) as selected_threshold,
  c.tp as true_positives, c.fp as false_positives, c.tn as true_negatives, c.fn as false_negatives,
  round({_z("c.tp", "(c.tp + c.fp)")}, 6) as selected_threshold_precision, round({_z("c.tp", "(c.tp + c.fn)")}, 6) as selected_threshold_recall,
  round({_z("c.tn", "(c.tn + c.fp)")}, 6) as selected_threshold_specificity, round({_z("c.tp + c.tn", "(c.tp + c.fp + c.tn + c.fn)")}, 6) as selected_threshold_accuracy,
  round({_z("2 * c.tp", "(2 * c.tp + c.fp + c.fn)")}, 6) as selected_threshold_f1_score
from half, prob, curve, grid, tt, cal, c
"""

_describe = " union all ".join(
    f"""select '{c}' as column_name, count({c}) as value_count, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as standard_deviation, cast(min({c}) as double) as minimum,
    round(quantile_cont({c}, 0.01), 6) as p01, round(quantile_cont({c}, 0.5), 6) as p50, round(quantile_cont({c}, 0.99), 6) as p99, cast(max({c}) as double) as maximum from raw"""
    for c in ("daily_steps", "active_minutes", "sleep_hours", "app_sessions")
)
_FLAGS = ("intervention_received", "intervention_opened", "intervention_clicked")
_flag_rates = ", ".join(
    [f"round(avg(cast(coalesce({f}, false) as int)), 6) as {f}_rate" for f in _FLAGS]
    + [f"round(avg(cast(coalesce({f}, false) as int)) filter (where coalesce(intervention_received, false)), 6) as {f}_rate_within" for f in _FLAGS[1:]]
)

#: The canonical row text of an order, hashed.
_DIGEST = """sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}')"""
_BEST = f"best as (select threshold, f from (select *, {_n('2 * tp', '(2 * tp + fp + fn)')} as f, {_n('tp', '(tp + fn)')} as rec from sw) order by coalesce(f, -1) desc, coalesce(rec, -1) desc, threshold limit 1)"
_CATEGORIES = ("age_band", "activity_level", "reward_profile")
_NUMERIC = (
    *(f"{c}_as_of" for c in AS_OF if c not in (*_CATEGORIES, "intervention_profile")),
    "available_day_count_28d", "unavailable_day_count_28d", "avg_daily_steps_28d", "stddev_daily_steps_28d", "avg_daily_steps_7d", "avg_daily_steps_prior_7d",
    "sum_active_minutes_28d", "avg_active_minutes_28d", "stddev_active_minutes_28d", "avg_active_minutes_7d", "avg_active_minutes_prior_7d", "active_day_count_28d",
    "avg_sleep_hours_28d", "avg_sleep_hours_7d", "sleep_observation_count_28d", "sleep_missing_day_count_28d",
    "sum_app_sessions_28d", "avg_app_sessions_28d", "avg_app_sessions_7d", "avg_app_sessions_prior_7d", "app_session_observation_count_28d", "app_sessions_missing_day_count_28d",
    "rewards_viewed_28d", "rewards_redeemed_28d", "interventions_received_28d", "interventions_opened_28d", "interventions_clicked_28d",
    "step_outlier_day_count_28d", "late_record_count_28d", "activity_level_change_count_28d", "avg_goal_completion_percentage_28d",
    "reward_redemption_rate_28d", "intervention_open_rate_28d", "intervention_click_rate_28d", "daily_steps_trend_7d", "active_minutes_trend_7d", "app_sessions_trend_7d",
)
#: Features that the encoding is compared on.
_ENCODED = ("avg_daily_steps_28d", "avg_sleep_hours_7d", "sum_app_sessions_28d")
_TRAIN = f"select * from ({_FEATURES}) where prediction_date < date '1999-01-01'"
#: The canonical text of the decisions' policy.
POLICY_JSON = (
    '{"allowed_intervention_categories":["supportive_check_in","goal_planning","activity_reminder","rewards_education"],"contact_cooldown_days":7,"high_risk_only":true,"human_review_required":true,'
    '"maximum_activations_per_run":100,"maximum_interventions_per_member_28d":2,"maximum_prediction_age_days":365,"policy_version":"v1","supportive_use_only":true}'
)

ORACLE_SQL: dict[str, str] = {
    "staging_supplier_day": fixtures.RAW_PANEL,
    "quality_flags": f"with {_STAGED} select member_id, activity_date, sleep_hours_missing, app_sessions_missing, is_step_outlier, is_late_record, available_date from staged",
    "constraint_report": f"with {_STAGED} {_report('staged', _PANEL_CHECKS)}",
    "context_constraints": f"with {_CTX} {_report('ctx', _CONTEXT_CHECKS)}",
    "prediction_constraints": f"with {_PREDICTIONS} {_report('pr', _PREDICTION_CHECKS)}",
    "decision_constraints": f"with {_DECIDED} {_report('decided', _DECISION_CHECKS)}",
    "features_28d": _FEATURES,
    "leak_audit": f"""
select count(*) as row_count, {_bad("max_source_activity_date > feature_window_end")} as after_window, {_bad("max_source_activity_date < feature_window_start")} as before_window,
  {_bad("max_source_available_date > prediction_date")} as not_yet_available, {_bad("available_day_count_28d + unavailable_day_count_28d <> 28")} as day_accounting,
  {", ".join(f'{_bad(f"not {r}_28d between 0 and 1")} as {r}_out_of_range' for r in ("reward_redemption_rate", "intervention_open_rate", "intervention_click_rate"))},
  {", ".join(f'{_bad(f"abs({x}_trend_7d - (avg_{x}_7d - avg_{x}_prior_7d)) > 1e-3 or (avg_{x}_7d is null or avg_{x}_prior_7d is null) <> ({x}_trend_7d is null)")} as {x}_trend_mismatch' for x in ("daily_steps", "active_minutes", "app_sessions"))}
from ({_FEATURES})""",
    "densify_user_day": f"with {_USER} select * from dense",
    "weekly_progress": f"""with {_USER},
w as (select *, cast(sum(active_minutes) over (partition by entity_id, week_start order by activity_date) as bigint) as weekly_active_minutes_so_far from dw)
select entity_id, activity_date, week_start, weekly_active_minutes_so_far, round_even(weekly_active_minutes_so_far * cast(100 as double) / weekly_goal, 1) as goal_completion_percentage from w""",
    "goal_streak_failures": f"""with {_USER},
weeks as (select entity_id, week_start, cast(sum(active_minutes) as bigint) as weekly_active_minutes, arg_min(weekly_goal, activity_date) as weekly_goal from dw group by all),
runs as (select *, weekly_active_minutes >= weekly_goal as weekly_goal_completed, sum(case when weekly_active_minutes >= weekly_goal then 0 else 1 end) over (partition by entity_id order by week_start) as run from weeks),
streaks as (select *, sum(case when weekly_goal_completed then 1 else 0 end) over (partition by entity_id, run order by week_start) as streak from runs)
select entity_id, week_start, weekly_active_minutes, weekly_goal, weekly_goal_completed,
  cast(coalesce(lag(streak) over (partition by entity_id order by week_start), 0) as bigint) as previous_goal_streak,
  cast(run - case when weekly_goal_completed then 0 else 1 end as bigint) as previous_failed_goals from streaks""",
    "future7_label": f"""{_FUTURE}
select entity_id, activity_date, future_7_day_active_minutes, future_7_day_active_minutes >= weekly_goal as next_week_goal_completed,
  not (future_7_day_active_minutes >= weekly_goal) as will_miss_goal_next_7_days from f""",
    "label_tail": f"{_FUTURE} select count(*) filter (where (activity_date > m - 7) <> (future_7_day_active_minutes is null)) as violations from f, (select max(activity_date) as m from f)",
    "recency_days": f"""with {_USER},
a as (select *, sum(case when app_sessions > 0 then 1 else 0 end) over (partition by entity_id order by activity_date rows unbounded preceding) as run from dense)
select entity_id, activity_date, cast(row_number() over (partition by entity_id, run order by activity_date) - case when run > 0 then 1 else 0 end as bigint) as days_since_last_app_session from a""",
    "category_change_flag": f"with {_STAGED} select member_id, activity_date, activity_level, activity_level_changed from staged",
    "edge_rows": f"""with raw as ({fixtures.RAW_PANEL}),
n as (select member_id, activity_date, active_minutes, row_number() over (partition by member_id order by activity_date) as f, row_number() over (partition by member_id order by activity_date desc) as l from raw)
select member_id, activity_date, active_minutes, 'first' as edge from n where f <= 7 union all select member_id, activity_date, active_minutes, 'last' from n where l <= 7""",
    "chronological_split": f"with raw as ({fixtures.RAW_PANEL}) select member_id, activity_date, {_SPLIT.format(d='activity_date')} as dataset_split from raw",
    "split_report": _REPORT,
    "split_overlaps": f"select * from (select dataset_split, first_day, lag(last_day) over (order by first_day) as previous_last_day from ({_REPORT})) where first_day <= previous_last_day",
    "threshold_sweep_1001": f"with {_SWEEP} {_SWEPT}",
    "best_threshold": f"with {_SWEEP}, o as (select *, {_n('2 * tp', '(2 * tp + fp + fn)')} as f, {_n('tp', '(tp + fn)')} as rec from sw) "
    f"select threshold, {_COUNTS}, {_rates(_n)} from o order by coalesce(f, -1) desc, coalesce(rec, -1) desc, threshold limit 1",
    "confusion_at_frozen": f"with {_SCORED}, {_CONFUSION} select cast({_T} as double) as threshold, {_COUNTS}, {_rates(_z)} from c",
    "macro_metrics": f"with {_SCORED}, m as ({_macro(_T)}) select round(macro_precision, 6) as macro_precision, round(macro_recall, 6) as macro_recall, round(macro_f1, 6) as macro_f1, round(accuracy, 6) as accuracy from m",
    "calibration_ntile": f"with {_SCORED}, {_NTILE} select {_BIN_OUT} from nt",
    "calibration_equal_width": f"with {_SCORED}, {_WIDTH} select {_BIN_OUT} from wd",
    "ece_max_gap": f"with {_SCORED}, {_WIDTH} select {_ECE} from wd",
    "top_decile_ntile": f"with {_SCORED}, {_TOPTILE} select {_TOP_OUT} from tt",
    "top_decile_ceil": f"with {_SCORED}, tt as (select {_TOP} from (select *, row_number() over (order by p desc, k) <= greatest(1, ceil(count(*) over () * cast(0.1 as double))) as top from s)) select {_TOP_OUT} from tt",
    "ranking_metrics": f"with {_SCORED}, {_CURVE} select round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc, round(average_precision, 6) as average_precision from curve",
    "pr_auc_grid": f"with {_SWEEP}, {_GRID} select round(approximate_pr_auc, 6) as approximate_pr_auc from grid",
    "probability_metrics": f"with {_SCORED}, {_PROB} select row_count, round(base_positive_rate, 6) as base_positive_rate, round(mean_predicted_probability, 6) as mean_predicted_probability, round(log_loss, 6) as log_loss, round(brier_score, 6) as brier_score from prob",
    "validation_summary": _SUMMARY,
    "metric_constraints": f"with m as ({_SUMMARY}) {_report('m', _METRIC_CHECKS)}",
    "model_comparison": f"""with s as ({fixtures.SCORED}), {_CURVE}, {_OTHER},
pair as (select 'logistic' as model_name, * from curve union all select 'boosted', * from other_curve)
select round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc, round(average_precision, 6) as average_precision, model_name,
  row_number() over (order by pr_auc desc, model_name) = 1 as is_chosen from pair""",
    "score_classify": f"with {_PREDICTIONS} select * from pr",
    "score_summary": f"""with {_PREDICTIONS}
select count(*) as row_count, count(distinct member_id) as member_count, min(prediction_date) as minimum_prediction_date, max(prediction_date) as maximum_prediction_date,
  count(*) filter (where is_high_risk) as high_risk_count, round(avg(cast(is_high_risk as int)), 6) as high_risk_rate, round(min(risk_probability), 6) as minimum_probability,
  round(max(risk_probability), 6) as maximum_probability, round(avg(risk_probability), 6) as mean_probability from pr""",
    "activation_decisions": f"with {_DECIDED} select * from decided",
    "activation_run_counts": f"""with {_DECIDED}
select count(*) as source_row_count, count(distinct member_id) as source_member_count, {_bad("outcome = 'no_contact_superseded'")} as superseded_count,
  {_bad("outcome = 'no_contact_below_threshold'")} as below_threshold_count, {_bad("outcome = 'no_contact_excluded'")} as excluded_count, {_bad("outcome = 'no_contact_suppressed'")} as suppressed_count,
  {_bad("outcome in ('selected_for_review', 'no_contact_capacity')")} as eligible_count, {_bad("outcome = 'no_contact_capacity'")} as capacity_not_selected_count,
  {_bad("outcome = 'selected_for_review'")} as selected_count from decided""",
    "review_queue": f"with {_DECIDED} select member_id, prediction_date, risk_probability, intervention_category, priority_rank, 'pending_human_review' as review_status from decided where outcome = 'selected_for_review'",
    "null_rates": f"""with raw as ({fixtures.RAW_PANEL}), n as (
  select 'sleep_hours' as column_name, avg(cast(sleep_hours is null as int)) as null_rate from raw union all select 'app_sessions', avg(cast(app_sessions is null as int)) from raw
  union all select 'intervention_opened', avg(cast(intervention_opened is null as int)) from raw union all select 'intervention_clicked', avg(cast(intervention_clicked is null as int)) from raw)
select column_name, round(null_rate, 6) as null_rate from n where null_rate > 0""",
    "describe_panel": f"with raw as ({fixtures.RAW_PANEL}) {_describe}",
    "value_shares": f"""with raw as ({fixtures.RAW_PANEL}), one as (select member_id, arg_min(age_band, activity_date) as value from raw group by 1)
select value, count(*) as row_count, round(count(*) / cast(sum(count(*)) over () as double), 6) as share from one group by value""",
    "rate_by_group": "select lang as group_value, count(*) as row_count, round(avg(quality), 6) as rate from documents join labels using (doc_id) group by lang",
    "flag_rates": f"with raw as ({fixtures.RAW_PANEL}) select {_flag_rates} from raw",
    "rows_for_each_entity": f"with raw as ({fixtures.RAW_PANEL}), c as (select member_id, count(*) as n from raw group by 1) select count(*) as entity_count, min(n) as minimum_rows, max(n) as maximum_rows from c",
    "event_property": """with e as (select event_type, cast(json_extract(props, '$.k') as bigint) as k from events)
select event_type, count(k) as n, cast(sum(k) as bigint) as total, min(k) as least, max(k) as most from e group by event_type""",
    "conflict_finder": f"with {_PREDICTIONS} select member_id, prediction_date, risk_probability from pr where member_id % 7 = 0",
    "insert_only_rows": f"with {_PREDICTIONS} select member_id, prediction_date, risk_probability from pr where prediction_date >= date '2000-01-01'",
    "dataset_digest_rows": f"select cast(o_orderkey as bigint) as o_orderkey, {_DIGEST} as digest from orders",
    "dataset_digest": f"""with h as (select {_DIGEST} as h from orders)
select count(*) as row_count, sha256(concat_ws(',', count(*), {", ".join(f"sum(cast('0x' || substr(h, {8 * i + 1}, 8) as bigint))" for i in range(8))})) as digest from h""",
    "csv_export": f"with raw as ({fixtures.RAW_PANEL}) select member_id, activity_date, age_band, active_minutes, sleep_hours, intervention_received from raw",
    "export_parity": f"with raw as ({fixtures.RAW_PANEL}) select unnest(['row_count', 'columns', 'rows']) as check_name, case when count(*) > 0 then 'PASS' end as status from raw",
    "table_projection": f"with raw as ({fixtures.RAW_PANEL}) select activity_date, member_id, daily_steps, 'Member''s days' as comment from raw",
    "split_views": f"with raw as ({fixtures.RAW_PANEL}) select count(*) as row_count, min(activity_date) as first_day, max(activity_date) as last_day, {_SPLIT.format(d='activity_date')} as dataset_split from raw group by all",
    "schema_evolution": "select cast(c_custkey as bigint) as c_custkey, c_name, case when c_custkey % 2 = 1 then cast(c_acctbal as double) end as c_acctbal from customer",
    "staged_predictions": f"with {_PREDICTIONS} select prediction_date, count(*) as row_count, {_bad('is_high_risk')} as high_risk_count from pr group by 1",
    "verified_scores": f"with {_PREDICTIONS} select * replace (cast(member_id as varchar) as member_id) from pr",
    "verified_context": f"""with {_CTX} select cast(member_id as varchar) as member_id, contact_allowed, opted_out, active_case_open, cast(epoch(last_contacted_at) as bigint) as last_contacted_at, interventions_last_28d
from ctx where not (opted_out and contact_allowed)""",
    "warehouse_decisions": f"""with {_DECIDED} select 'run' as run_id, cast(member_id as varchar) as member_id, prediction_date, outcome, reason_code, risk_probability, priority_rank,
  cast(epoch({_AT}) as bigint) as ingested_at from decided""",
    "queue_record": f"with {_DECIDED} select 'run' as run_id, count(priority_rank) as row_count, max(priority_rank) as last_rank, 'decisions' as source from decided",
    "queue_order": f"with {_DECIDED} select member_id, prediction_date, priority_rank, priority_rank as position from decided where priority_rank is not null",
    "audit_order": f"with {_DECIDED} select member_id, prediction_date, outcome, row_number() over (order by member_id, prediction_date) as position from decided",
    "key_sets": f"""with {_PREDICTIONS}, {_CTX} select (select count(*) from (select member_id from ctx except select member_id from pr)) as only_left,
  (select count(*) from (select member_id from pr except select member_id from ctx)) as only_right""",
    "table_differences": f"""with {_PREDICTIONS}, a as (select member_id, prediction_date, risk_probability from pr),
b as (select member_id, prediction_date, case when member_id % 7 <> 0 then risk_probability end as risk_probability from a where member_id % 5 <> 0)
select *, 'left' as side from (select * from a except all select * from b) union all select *, 'right' from (select * from b except all select * from a)""",
    "panel_counts": f"""with raw as ({fixtures.RAW_PANEL}) {_report('raw', {
        "row_count": "abs(count(*) - 5000)", "distinct_member_id": "abs(count(distinct member_id) - 10)",
        "range_activity_date": "case when min(activity_date) = date '1992-01-02' and max(activity_date) = date '1998-12-01' then 0 else 1 end"})}""",
    "rate_bands": f"with {_STAGED} {_report('staged', {n: f'coalesce(cast(not avg(cast({c} as int)) between {a} and {b} as int), 1)' for n, c, a, b in (('misses', 'will_miss_goal_next_7_days', 0.12, 0.30), ('sleep_missing', 'sleep_hours_missing', 0.02, 0.20), ('outliers', 'is_step_outlier', 0.0, 0.001), ('late', 'is_late_record', 0.0, 0.5))})}",
    "feature_nulls": f"with f as (select *, null as never from ({_FEATURES})) {_report('f', {f'not_all_null_{c}': f'cast(count({c}) = 0 as int)' for c in ('avg_daily_steps_28d', 'reward_redemption_rate_28d', 'stddev_active_minutes_28d', 'never')})}",
    "evaluation_input": f"""with {_SCORED}, e as (select case when k % 100 <> 0 then actual_label end as y from s)
{_report('e', {"rows": "cast(count(*) = 0 as int)", "unlabelled": _bad("y is null"), "both_classes": "cast(count(distinct y) <> 2 as int)"})}""",
    "split_overlaps_found": f"""with {_STAGED},
r as (select case member_id % 3 when 0 then 'train' when 1 then 'validation' else 'test' end as dataset_split, min(activity_date + cast(member_id % 3 as int)) as first_day, max(activity_date + cast(member_id % 3 as int)) as last_day from staged group by 1)
select * from (select dataset_split, first_day, lag(last_day) over (order by first_day) as previous_last_day from r) where first_day <= previous_last_day""",
    "selection_record": f"""with {_SWEEP}, {_BEST}
select 'logistic' as model_name, 'validation' as selection_split, 'positive_f1' as selection_metric, threshold, round(f, 6) as validation_positive_f1, cast(d1 as varchar) as validation_start_date,
  cast(d2 as varchar) as validation_end_date, n as validation_row_count, pos as validation_positive_count
from best, (select min(prediction_date) as d1, max(prediction_date) as d2, count(*) as n, {_bad("actual_label")} as pos from s)""",
    "frozen_summary": f"select *, 'logistic' as model_name from ({_SUMMARY.replace(str(_T), '(select threshold from best)').replace(_SWEEP, f'{_SWEEP}, {_BEST}')})",
    "model_frame": f"""select member_id, prediction_date, label_will_miss_goal_next_7_days, {", ".join(f"{c}_as_of" for c in _CATEGORIES)}, {", ".join(f"cast({c} as double) as {c}" for c in _NUMERIC)}
from ({_FEATURES}) where prediction_date < date '1999-01-01'""",
    "imputation_values": f"with f as ({_TRAIN}) "
    + " union all ".join(
        [f"select '{c}_as_of' as column_name, (select {c}_as_of from f where {c}_as_of is not null group by 1 order by count(*) desc, 1 limit 1) as category, cast(null as double) as number" for c in _CATEGORIES]
        + [f"select '{c}', null, round(coalesce(median(cast({c} as double)), 0), 6) from f" for c in _NUMERIC]
    ),
    "encoded_features": f"""with f as ({_TRAIN}),
i as (select member_id, prediction_date, {", ".join(f"coalesce({c}_as_of, (select {c}_as_of from f where {c}_as_of is not null group by 1 order by count(*) desc, 1 limit 1)) as {c}" for c in _CATEGORIES)},
  {", ".join(f"coalesce({c}, median({c}) over ()) as {c}" for c in _ENCODED)} from f),
l as (select {", ".join(f"(select list(distinct {c} order by {c}) from i) as l_{c}" for c in _CATEGORIES)})
select member_id, prediction_date, {" || ".join(f"array_to_string(list_transform(l_{c}, lambda x: cast(x = {c} as int)), '')" for c in _CATEGORIES)} as levels,
  {", ".join(f"round(coalesce(({c} - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0), 0), 4) as {c}" for c in _ENCODED)}
from i, l""",
    "logistic_optimum": f"with f as ({_TRAIN}) select count(label_will_miss_goal_next_7_days) as labelled_rows, {_bad('label_will_miss_goal_next_7_days')} as positives, cast(0 as double) as largest_slope from f",
    "stored_model": f"select count(*) as row_count, cast(0 as bigint) as differing, cast(0 as bigint) as invalid from ({_FEATURES}) where prediction_date >= date '2001-01-01'",
    "scalar_forms": """with e as (
  select event_type, case user_id % 4 when 0 then true when 1 then false end as flag,
         case user_id % 3 when 0 then 8 when 2 then 10 end * 3600 + cast(epoch(timestamp '2024-01-01') as bigint) + (user_id % 28) * 86400 as stamp,
         case event_type when 'view' then user_id when 'click' then user_id * 2 end as value from events)
select event_type, count(*) filter (where flag) as yes, count(*) filter (where not flag) as no, count(stamp) as stamped, cast(min(stamp) as bigint) as first_at, cast(max(stamp) as bigint) as last_at, cast(sum(value) as bigint) as total
from e group by 1""",
    "text_forms": """select lang, count(*) filter (where doc_id % 5 = 0 or doc_id % 7 = 0 or text is null or not regexp_matches(text, '[^\\s]')) as blank, count(*) filter (where regexp_matches(text, '^[A-Z][a-z]+ [a-z]')) as opens,
  count(*) filter (where starts_with(source, 'src1')) as prefixed from documents group by 1""",
}
_record = lambda where: f"select count(*) as row_count, count(distinct member_id) as member_count, {_bad('is_high_risk')} as high_risk_count, max(prediction_date) as maximum_prediction_date from pr {where}"
ORACLE_SQL["metadata_record"] = ORACLE_SQL["score_summary"]
ORACLE_SQL["record_fields"] = f"""with {_PREDICTIONS}, a as ({_record("")}), b as ({_record("where prediction_date >= date '1997-01-01'")}), fields as (
""" + " union all ".join(f"select '{c}' as field, cast(a.{c} as varchar) as stored, cast(b.{c} as varchar) as recomputed from a, b" for c in ("row_count", "member_count", "high_risk_count", "maximum_prediction_date")) + """)
select *, stored is not distinct from recomputed as same from fields"""
ORACLE_SQL["run_record"] = f"""select 'run' as run_id, 'v1' as policy_version, sha256('{POLICY_JSON}') as policy_fingerprint, 'logistic' as model_name, cast({_T} as double) as threshold, cast(100 as bigint) as capacity_limit, *
from ({ORACLE_SQL["activation_run_counts"]})"""

_BOOSTED = ("avg_daily_steps_28d", "sum_app_sessions_28d", "weekly_active_minutes_so_far_as_of", "goal_completion_percentage_as_of")
_worth = lambda g, h: f"power(({g}) / power(cast(2 as double), 30), 2) / (({h}) / power(cast(2 as double), 30) + 1)"
ORACLE_SQL |= {
    "features_increment": f"select * from ({_FEATURES}) where prediction_date > (select max(cast(l_shipdate as date)) from lineitem) - 3",
    "boosted_first_gains": f"""with f as ({_TRAIN}),
t as (select will_miss_y as y, {", ".join(f"coalesce(cast({c} as double), 0) as {c}" for c in _BOOSTED)} from (select *, cast(label_will_miss_goal_next_7_days as int) as will_miss_y from f) where will_miss_y is not null),
m as (select avg(cast(y as double)) as p from t),
l as ({" union all ".join(f"select '{c}' as name, {c} as x, y from t" for c in _BOOSTED)}),
cuts as (select name, list_distinct(quantile_cont(x, [{", ".join(f"{k / 64!r}" for k in range(1, 64))}])) as c from l group by name),
b as (select name, len(list_filter(c, lambda v: v < x)) as bin, round((p - y) * power(cast(2 as double), 30)) as g, round(p * (1 - p) * power(cast(2 as double), 30)) as h from l join cuts using (name), m),
hist as (select name, bin, sum(g) as g, sum(h) as h, count(*) as n from b group by all),
cum as (select name, bin, sum(g) over w as g, sum(h) over w as h, sum(n) over w as n, sum(g) over a as ag, sum(h) over a as ah, sum(n) over a as an from hist
  window w as (partition by name order by bin), a as (partition by name)),
gains as (select name, bin, {_worth("g", "h")} + {_worth("ag - g", "ah - h")} - {_worth("ag", "ah")} as gain from cum where n >= 50 and an - n >= 50)
select name as column_name, len(c) + 1 as bins, arg_max(bin, gain) filter (where gain > 0) as bin, round(coalesce(max(gain) filter (where gain > 0), 0), 4) as gain from cuts left join gains using (name) group by name, c""",
    "coefficient_table": f"""with f as ({_TRAIN}), o as (
  select age_band_as_of as v, ln(avg(cast(label_will_miss_goal_next_7_days as int)) / (1 - avg(cast(label_will_miss_goal_next_7_days as int)))) as x from f where label_will_miss_goal_next_7_days is not null and age_band_as_of is not null group by 1),
c as (select v, x - (select x from o order by v desc limit 1) as c from o qualify v < max(v) over ())
select 'age_band_as_of=' || v as feature, 'age_band_as_of' as source_feature, round(c, 3) as coefficient, round(exp(c), 3) as odds_ratio,
  case when c > 0 then 'raises_risk' when c < 0 then 'lowers_risk' else 'none' end as direction, row_number() over (order by abs(c) desc, v) as rank from c""",
    "plain_logistic_rates": f"""with f as ({_TRAIN}) select reward_profile_as_of as level, count(*) as row_count, round(avg(cast(label_will_miss_goal_next_7_days as int)), 4) as mean_prediction
from f where label_will_miss_goal_next_7_days is not null and {" and ".join(f"{c}_as_of is not null" for c in _CATEGORIES)} group by 1""",
    "known_history": f"""with raw as ({fixtures.RAW_PANEL}), h as (select *, activity_date + record_delay_days as available_date from raw)
select a.member_id, a.activity_date as prediction_date, count(h.activity_date) as known_days, cast(sum(h.daily_steps) as bigint) as known_steps,
  arg_max(h.activity_level, h.activity_date) filter (where h.activity_level is not null) as latest_level
from raw a left join h on a.member_id = h.member_id and h.activity_date between a.activity_date - 28 and a.activity_date - 1 and h.available_date <= a.activity_date group by 1, 2""",
    "ledger_decisions": ORACLE_SQL["warehouse_decisions"],
    "ledger_months": f"""with {_DECIDED}, q as (select date_trunc('month', prediction_date) as m from decided where prediction_date between date '2001-01-01' and date '2001-03-31')
select cast(v as bigint) as version, count(*) as row_count, count(distinct m) as months from q, range(1, 4) as r(v) where month(m) <= v group by v""",
    "activation_job": f"with {_DECIDED.replace(fixtures.CONTEXT, f'select * from ({fixtures.CONTEXT}) where not (opted_out and contact_allowed)')} select * exclude (suppression_until) replace (cast(member_id as varchar) as member_id) from decided",
    "observed_write": f"with {_PREDICTIONS} select unnest(['rows', 'required_risk_probability', 'above_one', 'unique_member_id_prediction_date']) as counted, unnest([count(*), count(*) filter (where risk_probability is null), count(*) filter (where risk_probability > 1), count(*) - count(distinct (member_id, prediction_date))]) as found from pr",
    "several_unique_keys": _report("lineitem", {
        "unique_l_orderkey_l_linenumber": "count(*) - count(distinct (l_orderkey, l_linenumber))", "unique_l_orderkey": "count(*) - count(distinct l_orderkey)",
        "unique_l_partkey_l_suppkey": "count(*) - count(distinct (l_partkey, l_suppkey))", "discount": _bad("l_discount > cast(0.1 as double)")}),
    "profile_report": f"""with {_STAGED}, first as (select member_id, count(*) as n, arg_min(age_band, activity_date) as age_band, arg_min(reward_profile, activity_date) as reward_profile from staged group by 1),
r as (
  select 'shape' as section, 'rows' as item, count(*) as row_count, cast(null as double) as value from staged
  union all select 'shape', 'first_day', null, date_diff('day', date '1970-01-01', min(activity_date)) from staged union all select 'shape', 'last_day', null, date_diff('day', date '1970-01-01', max(activity_date)) from staged
  union all select 'shape', 'entities', count(*), null from first union all select 'rows_of_entity', 'minimum', min(n), null from first union all select 'rows_of_entity', 'maximum', max(n), null from first
  union all select 'label', 'all', count(*), avg(cast(will_miss_goal_next_7_days as int)) from staged
""" + "".join(f"  union all select 'null_rate', '{c}', null, avg(cast({c} is null as int)) from staged" for c in ("member_id", "activity_date", "age_band", "reward_profile", "daily_steps", "sleep_hours", "intervention_received", "intervention_opened", "will_miss_goal_next_7_days"))
    + "".join(f"  union all select 'flag_rate', '{c}', null, avg(cast(coalesce({c}, false) as int)) from staged" for c in ("intervention_received", "intervention_opened"))
    + "".join(f"  union all select '{k}', '{c}', count({c}), {f}({c}) from staged" for c in ("daily_steps", "sleep_hours") for k, f in (("mean", "avg"), ("standard_deviation", "stddev_samp"), ("minimum", "min"), ("maximum", "max")))
    + "".join(f"  union all select 'label_by_{c}', {c}, count(*), avg(cast(will_miss_goal_next_7_days as int)) from staged group by {c} union all select 'entities_by_{c}', {c}, count(*), null from first group by {c}" for c in ("age_band", "reward_profile"))
    + ") select section, item, row_count, round(value, 6) as value from r",
    "column_differences": f"""with raw as ({fixtures.RAW_PANEL}) select unnest(['heart_rate', 'weight']) as column_name, 'missing' as difference, 0 as filled
""" + "".join(f" union all select '{c}', 'unexpected', count({c}) from raw" for c in ("age_band", "membership_months", "activity_level", "reward_profile", "intervention_profile", "active_minutes", "sleep_hours", "weekly_goal", "app_sessions", "rewards_viewed", "rewards_redeemed", "intervention_received", "intervention_opened", "intervention_clicked", "record_delay_days")),
    "clashing_paths": """with p as (select s_nationkey, '/out/' || s_nationkey || case s_suppkey % 3 when 0 then '' when 1 then '/part' else '0' end || '/' as a, '/out/' || (s_suppkey % 25) || '/' as b from supplier)
select s_nationkey, count(*) as suppliers, count(*) filter (where starts_with(a, b) or starts_with(b, a)) as clashes from p group by 1""",
}
#: Date columns of each result; results give days as ISO text, which compares alike everywhere.
DATES: dict[str, tuple[str, ...]] = {
    "staging_supplier_day": ("activity_date",),
    "quality_flags": ("activity_date", "available_date"),
    "features_28d": ("prediction_date", "feature_window_start", "feature_window_end", "max_source_activity_date", "max_source_available_date"),
    "densify_user_day": ("activity_date",),
    "weekly_progress": ("activity_date", "week_start"),
    "goal_streak_failures": ("week_start",),
    "future7_label": ("activity_date",),
    "recency_days": ("activity_date",),
    "category_change_flag": ("activity_date",),
    "edge_rows": ("activity_date",),
    "chronological_split": ("activity_date",),
    "split_report": ("first_day", "last_day"),
    "split_overlaps": ("first_day", "previous_last_day"),
    "score_classify": ("prediction_date",),
    "score_summary": ("minimum_prediction_date", "maximum_prediction_date"),
    "activation_decisions": ("prediction_date", "suppression_until"),
    "review_queue": ("prediction_date",),
    "conflict_finder": ("prediction_date",),
    "insert_only_rows": ("prediction_date",),
    "csv_export": ("activity_date",),
    "table_projection": ("activity_date",),
    "split_views": ("first_day", "last_day"),
    "staged_predictions": ("prediction_date",),
    "verified_scores": ("prediction_date",),
    "warehouse_decisions": ("prediction_date",),
    "queue_order": ("prediction_date",),
    "audit_order": ("prediction_date",),
    "table_differences": ("prediction_date",),
    "split_overlaps_found": ("first_day", "previous_last_day"),
    "metadata_record": ("minimum_prediction_date", "maximum_prediction_date"),
    "model_frame": ("prediction_date",),
    "encoded_features": ("prediction_date",),
    "features_increment": ("prediction_date", "feature_window_start", "feature_window_end", "max_source_activity_date", "max_source_available_date"),
    "known_history": ("prediction_date",),
    "ledger_decisions": ("prediction_date",),
    "activation_job": ("prediction_date",),
}
for _name, _days in DATES.items():
    _as_text = ", ".join(f"cast({d} as varchar) as {d}" for d in _days)
    ORACLE_SQL[_name] = f"select * replace ({_as_text}) from ({ORACLE_SQL[_name]})"
