"""The band join against a plain range join."""

import datetime as dt
import random
import statistics

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import asof

D0 = dt.date(2024, 1, 1)


def test_band_join_is_the_range_join(spark):
    rng = random.Random(1)
    rows = [(e, D0 + dt.timedelta(days=i), D0 + dt.timedelta(days=i + rng.choice([0, 0, 0, 1, 3])), rng.random()) for e in range(4) for i in range(120) if rng.random() < 0.6]
    history = spark.createDataFrame(rows, "e int, d date, known date, x double")
    points = history.select("e", F.col("d").alias("at"))
    got = asof.band_join(points, history, "e", "at", "d", "known").groupBy("e", "at").agg(F.count("h_d").alias("n"), F.round(F.sum("h_x"), 9).alias("s"))
    h = history.select(F.col("e").alias("he"), "d", "known", "x")
    inside = (F.col("e") == F.col("he")) & F.col("d").between(F.date_sub("at", 28), F.date_sub("at", 1)) & (F.col("known") <= F.col("at"))
    want = points.join(h, inside, "left").groupBy("e", "at").agg(F.count("d").alias("n"), F.round(F.sum("x"), 9).alias("s"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_edges_of_the_window(spark):
    at = D0 + dt.timedelta(days=40)
    day = lambda k: at - dt.timedelta(days=k)
    history = spark.createDataFrame([(1, day(k), day(k) + dt.timedelta(days=late)) for k, late in ((0, 0), (1, 0), (1, 2), (28, 0), (29, 0), (14, 14), (14, 15))], "e int, d date, known date")
    points = spark.createDataFrame([(1, at), (2, at)], "e int, at date")
    out = {r["e"]: r["n"] for r in asof.band_join(points, history, "e", "at", "d", "known").groupBy("e").agg(F.count("h_d").alias("n")).collect()}
    assert out == {1: 3, 2: 0}


def test_features_explode_no_history(spark):
    plan = asof.features(panel(spark))._jdf.queryExecution().executedPlan().toString()
    # One stream of each member's days, sorted once, gives all windows.
    assert plan.count("Exchange") == 1 and not any(x in plan for x in ("Join", "Aggregate"))


def panel(spark, seed=5):
    """Days of a few members, some known late, with gaps, doubles and nulls."""
    rng = random.Random(seed)
    rows = []
    for e in range(6):
        for i in range(90):
            if rng.random() < 0.75:
                late = rng.choice([0, 0, 0, 1, 2, 3, 7, 8, 9, 13, 14, 15, 27, 28, 29, 40])
                known = None if rng.random() < 0.03 else D0 + dt.timedelta(days=i + late)
                maybe = lambda v: v if rng.random() < 0.8 else None
                rows.append((e, D0 + dt.timedelta(days=i), known, *(maybe(rng.choice("xyz")) for _ in range(4)), *(maybe(rng.randrange(9000)) for _ in range(11)), maybe(rng.random() * 9), maybe(rng.random() * 99), *(maybe(rng.random() < 0.4) for _ in range(8)), maybe(rng.random() < 0.5)))
    text = ["age_band", "activity_level", "reward_profile", "intervention_profile"]
    numbers = ["membership_months", "weekly_goal", "weekly_active_minutes_so_far", "previous_goal_streak", "previous_failed_goals", "days_since_last_app_session", "daily_steps", "active_minutes", "app_sessions", "rewards_viewed", "rewards_redeemed"]
    flags = ["sleep_hours_missing", "app_sessions_missing", "intervention_received", "intervention_opened", "intervention_clicked", "is_step_outlier", "is_late_record", "activity_level_changed"]
    columns = ["member_id int", "activity_date date", "available_date date", *(f"{c} string" for c in text), *(f"{c} long" for c in numbers), "sleep_hours double", "goal_completion_percentage double", *(f"{c} boolean" for c in flags), "will_miss_goal_next_7_days boolean"]
    return spark.createDataFrame(rows, ", ".join(columns))


def plain(df):
    """A few features of every anchor, by going through all rows."""
    rows, out = df.collect(), {}
    first = {}
    for r in rows:
        first[r["member_id"]] = min(first.get(r["member_id"], r["activity_date"]), r["activity_date"])
    for p in rows:
        at = p["activity_date"]
        if (at - first[p["member_id"]]).days < 28:
            continue
        inside = [h for h in rows if h["member_id"] == p["member_id"] and 1 <= (at - h["activity_date"]).days <= 28 and h["available_date"] is not None and h["available_date"] <= at]
        age = lambda h: (at - h["activity_date"]).days
        values = lambda c, lo, hi: [h[c] for h in inside if lo <= age(h) <= hi and h[c] is not None]
        mean = lambda v: sum(v) / len(v) if v else None
        steps = values("daily_steps", 1, 28)
        newest = lambda c: next((h[c] for h in sorted(inside, key=age) if h[c] is not None), None)
        out[p["member_id"], at] = {
            "available_day_count_28d": len(inside),
            "max_source_activity_date": max((h["activity_date"] for h in inside), default=None),
            "max_source_available_date": max((h["available_date"] for h in inside), default=None),
            "stddev_daily_steps_28d": statistics.stdev(steps) if len(steps) > 1 else None,
            "avg_daily_steps_7d": mean(values("daily_steps", 1, 7)),
            "avg_active_minutes_prior_7d": mean(values("active_minutes", 8, 14)),
            "avg_sleep_hours_7d": mean(values("sleep_hours", 1, 7)),
            "avg_goal_completion_percentage_28d": mean(values("goal_completion_percentage", 1, 28)),
            "sum_app_sessions_28d": sum(values("app_sessions", 1, 28)) if values("app_sessions", 1, 28) else None,
            "late_record_count_28d": sum(values("is_late_record", 1, 28)),
            "age_band_as_of": newest("age_band"),
            "weekly_goal_as_of": newest("weekly_goal"),
            "goal_completion_percentage_as_of": newest("goal_completion_percentage"),
        }
    return out


def same(found, want):
    assert len(found) == len(want)
    for r in found:
        for c, v in want[r["member_id"], r["prediction_date"]].items():
            assert r[c] == (pytest.approx(v, abs=1e-6) if isinstance(v, float) else v), (c, r["member_id"], r["prediction_date"])


def test_features_are_those_of_all_rows(spark):
    df = panel(spark)
    want = plain(df)
    assert len(want) > 200
    same(asof.features(df).collect(), want)


def test_a_new_day_needs_only_its_own_effects(spark, tmp_path):
    df = panel(spark, 8)
    want = plain(df)
    asof.effects(df).write.partitionBy("day").parquet(f"{tmp_path}/effects")
    effects = spark.read.parquet(f"{tmp_path}/effects")
    before = asof.state(effects, "2024-02-20")
    for day in (dt.date(2024, 2, 21), dt.date(2024, 2, 22), dt.date(2024, 2, 25)):
        now = asof.state(effects, day.isoformat(), before=before)
        points = df.filter(F.col("activity_date") == F.lit(day)).select("member_id", F.col("activity_date").alias("prediction_date"), "will_miss_goal_next_7_days")
        same(asof.features_on(now, points).collect(), {k: v for k, v in want.items() if k[1] == day})
        now.write.parquet(f"{tmp_path}/state-{day}")
        before = spark.read.parquet(f"{tmp_path}/state-{day}")
    read = asof.state(effects, "2024-02-26", before=before)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def _rows(df):
    """Rows as text, with doubles to six places."""
    return sorted(str([round(x, 6) + 0.0 if isinstance(x, float) else x for x in r]) for r in df.collect())


@pytest.mark.parametrize(("seed", "together"), [(5, 30_000), (8, 100), (13, 10)])
def test_whole_features_are_the_same(spark, seed, together, monkeypatch):
    monkeypatch.setattr(asof, "_TOGETHER", together)
    df = panel(spark, seed)
    found = asof.whole_features(df)
    same(found.collect(), plain(df))
    windows = asof.features(df)
    assert found.dtypes == windows.dtypes and _rows(found) == _rows(windows)
    plan = asof.whole_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and not any(x in plan for x in ("Join", "Aggregate"))


def test_whole_features_of_days_met_twice_and_members_without_history(spark):
    df = panel(spark)
    twice = df.unionByName(df.filter("day(activity_date) % 3 = 0").withColumns({"age_band": F.lit("y"), "weekly_goal": F.lit(77).cast("long"), "daily_steps": F.lit(5).cast("long")}))
    odd = twice.unionByName(df.filter("member_id = 2").withColumns({"member_id": F.lit(50), "available_date": F.lit(None).cast("date")})).unionByName(df.limit(1).withColumn("member_id", F.lit(51)))
    odd = odd.unionByName(df.filter("member_id = 3").withColumn("member_id", F.lit(None).cast("int")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        held = asof._begins([pa.table({"e": [None, None, 1, 1, 2]})], "e")[1].tolist()
        found = asof.whole_features(odd).persist()
        assert held == [0, 2, 4] and found.count() > 200
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert _rows(found) == _rows(asof.features(odd)) and found.filter("member_id = 50").count() > 0
