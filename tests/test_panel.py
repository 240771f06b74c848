"""Panel operators on hand-checked cases."""

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators import panel

MONDAY = dt.date(2025, 1, 6)


def days(values, start=MONDAY, entity="a", goal=100):
    return [(entity, start + dt.timedelta(days=i), v, goal) for i, v in enumerate(values)]


SCHEMA = "e string, d date, amount long, goal long"


def test_progress_starts_again_on_monday(spark):
    out = panel.weekly_progress(spark.createDataFrame(days([10] * 10), SCHEMA), "e", "d", "amount", "goal").orderBy("d").collect()
    assert [out[i]["weekly_active_minutes_so_far"] for i in (0, 6, 7)] == [10, 70, 10]
    assert out[0]["goal_completion_percentage"] == 10.0


def test_streak_and_failures(spark):
    rows = days([x for week in (140, 105, 35, 140) for x in [week // 7] * 7])
    out = panel.goal_history(spark.createDataFrame(rows, SCHEMA), "e", "d", "amount", "goal").orderBy("week_start").collect()
    assert [r["previous_goal_streak"] for r in out] == [0, 1, 2, 0]
    assert [r["previous_failed_goals"] for r in out] == [0, 0, 0, 1]


def test_recency_counts_from_one_before_the_first_activity(spark):
    rows = days([0, 0, 2, 0, None, 1, 0])
    out = panel.recency(spark.createDataFrame(rows, SCHEMA), "e", "d", "amount").orderBy("d").collect()
    assert [r["days_since_last_app_session"] for r in out] == [1, 2, 0, 1, 2, 0, 1]


def test_future_needs_all_rows(spark):
    out = panel.future_total(spark.createDataFrame(days([20] * 9), SCHEMA), "e", "d", "amount", "goal").orderBy("d").collect()
    assert [r["future_7_day_active_minutes"] for r in out] == [140.0, 140.0] + [None] * 7
    assert [r["will_miss_goal_next_7_days"] for r in out] == [False, False] + [None] * 7


def test_densify(spark):
    rows = [("a", MONDAY, 5, 100), ("a", MONDAY + dt.timedelta(days=2), 7, 100), ("b", MONDAY, 1, 50)]
    out = panel.densify(spark.createDataFrame(rows, SCHEMA), "e", "d", {"amount": 0, "goal": F.max("goal")}).orderBy("e", "d").collect()
    assert [(r["e"], r["amount"], r["goal"]) for r in out] == [("a", 5, 100), ("a", 0, 100), ("a", 7, 100), ("b", 1, 50)]


def test_category_change_and_edges(spark):
    rows = [("a", MONDAY + dt.timedelta(days=i), x, 1) for i, x in enumerate([1, 1, 2, None, 2])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = panel.category_changed(df, "e", "d", "amount").orderBy("d").collect()
    assert [r["activity_level_changed"] for r in out] == [False, False, True, False, False]
    assert [r["amount"] for r in panel.edge_rows(df, "e", "d", 2).orderBy("d").collect()] == [1, 1]
    assert panel.edge_rows(df, "e", "d", 2, last=True).count() == 2


def test_empty_panel(spark):
    assert panel.goal_metrics(spark.createDataFrame([], SCHEMA), "e", "d", "amount", "goal").count() == 0
