"""What grows with the data: shuffles, widths of rows and numbers of them."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidewatch.functions import shared
from tidewatch.operators import asof, constraints, panel
from tidewatch.plans import registry

MONDAY = dt.date(2025, 1, 6)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_features_move_rows_once(spark):
    plan = _plan(asof.features(registry.staged(spark, "/root/testdata/sf0.001")))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_goal_metrics_are_those_of_the_history(spark):
    rng = random.Random(3)
    maybe = lambda v: v if rng.random() < 0.8 else None
    rows = [(e, MONDAY + dt.timedelta(days=i), maybe(rng.randrange(60)), maybe(rng.choice([0, 40, 90]))) for e in (*range(5), None) for i in range(150) if rng.random() < (0.7 if e != 4 else 0.04)]
    df = spark.createDataFrame(rows, "e int, d date, amount long, goal long")
    got = panel.goal_metrics(df, "e", "d", "amount", "goal").select("e", "d", "previous_goal_streak", "previous_failed_goals")
    history = panel.goal_history(df, "e", "d", "amount", "goal").select("e", "week_start", "previous_goal_streak", "previous_failed_goals")
    want = panel.weekly_progress(df, "e", "d", "amount", "goal").join(history, ["e", "week_start"], "left").select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert want.agg(F.max("previous_goal_streak")).first()[0] > 2


def test_differences_count_both_tables_once(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (1, "x"), (2, None), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, None)], "k int, v string")
    found = constraints.differences(a, b)
    assert _plan(found).count("Exchange") == 1
    assert sorted((tuple(r) for r in found.collect()), key=str) == [(1, "x", "left"), (1, "x", "left"), (2, None, "right"), (3, "y", "left"), (4, None, "right")]


def test_tasks_grow_with_the_files(spark, tmp_path, monkeypatch):
    spark.range(200_000).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    assert shared.parts(rows) == 4
    monkeypatch.setattr(shared, "PART_BYTES", 10_000)
    assert shared.parts(rows) > 50
    assert rows.repartition(shared.parts(rows), "id").rdd.getNumPartitions() > 50


def test_increments_need_no_rows_of_before_their_windows(spark, monkeypatch):
    met = []
    real = asof.effects
    monkeypatch.setattr(asof, "effects", lambda rows, *a: met.append(rows.agg(F.min("activity_date"), F.max("activity_date")).first()) or real(rows, *a))
    found = registry.QUERIES["features_increment"](spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and (met[0][1] - met[0][0]).days <= 31


def test_tasks_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """Rows that compress to next to nothing still fill tasks."""
    spark.range(200_000).select((F.col("id") % 2).alias("id")).coalesce(1).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    monkeypatch.setattr(shared, "PART_ROWS", 10_000)
    assert shared.parts(rows) == 20
