"""Operators on entity-by-day panels: one row for each entity and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.columns import week_start

OUTLIER_STEPS = 35_000


def densify(df: DataFrame, entity: str, day: str, fill: dict[str, object], first: Column | None = None, last: Column | None = None) -> DataFrame:
    """A row for every day of every entity, from ``first`` to ``last`` (its own days by default).

    Columns of ``fill`` get their value on days without a row; a Column of ``fill`` is an
    aggregate over the entity's rows.
    """
    constant = {c: v for c, v in fill.items() if isinstance(v, Column)}
    spans = df.groupBy(entity).agg(
        (F.min(day) if first is None else F.first(first)).alias("#first"), (F.max(day) if last is None else F.first(last)).alias("#last"), *(v.alias(f"#{c}") for c, v in constant.items())
    )
    cells = spans.select(entity, *(f"#{c}" for c in constant), F.explode(F.sequence("#first", "#last", F.expr("interval 1 day"))).alias(day))
    out = cells.join(df, [entity, day], "left")
    made = {c: F.coalesce(F.col(c), F.col(f"#{c}") if c in constant else F.lit(v)) for c, v in fill.items()}
    return out.withColumns(made).drop(*(f"#{c}" for c in constant))


def weekly_progress(df: DataFrame, entity: str, day: str, amount: str, goal: str) -> DataFrame:
    """Adds week_start, weekly_active_minutes_so_far and goal_completion_percentage."""
    w = W.partitionBy(entity, "week_start").orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    out = df.withColumn("week_start", week_start(F.col(day)))
    out = out.withColumn("weekly_active_minutes_so_far", F.sum(amount).over(w))
    return out.withColumn("goal_completion_percentage", F.bround(F.col("weekly_active_minutes_so_far") * 100.0 / F.col(goal), 1))


def goal_history(df: DataFrame, entity: str, day: str, amount: str, goal: str) -> DataFrame:
    """A row for each entity and week: the streak and the failures of the weeks before it."""
    weeks = df.groupBy(entity, week_start(F.col(day)).alias("week_start")).agg(F.sum(amount).alias("weekly_active_minutes"), F.min_by(goal, day).alias("weekly_goal"))
    done = F.coalesce((F.col("weekly_active_minutes") >= F.col("weekly_goal")).cast("int"), F.lit(0))
    order = W.partitionBy(entity).orderBy("week_start")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    weeks = weeks.withColumn("#done", done).withColumn("#run", F.sum(1 - F.col("#done")).over(upto))
    # A failure opens a new run, so the sum within a run is the streak that ends here.
    within = W.partitionBy(entity, "#run").orderBy("week_start").rowsBetween(W.unboundedPreceding, 0)
    weeks = weeks.withColumn("#streak", F.sum("#done").over(within))
    return weeks.select(
        entity,
        "week_start",
        "weekly_active_minutes",
        "weekly_goal",
        F.col("#done").cast("boolean").alias("weekly_goal_completed"),
        F.coalesce(F.lag("#streak").over(order), F.lit(0)).cast("long").alias("previous_goal_streak"),
        (F.col("#run") - 1 + F.col("#done")).cast("long").alias("previous_failed_goals"),
    )


def future_total(df: DataFrame, entity: str, day: str, amount: str, goal: str, horizon: int = 7) -> DataFrame:
    """Adds the sum of the next ``horizon`` rows and the labels; null unless all those rows exist."""
    ahead = W.partitionBy(entity).orderBy(day).rowsBetween(1, horizon)
    total = F.when(F.count(amount).over(ahead) == horizon, F.sum(amount).over(ahead)).cast("double")
    out = df.withColumn("future_7_day_active_minutes", total)
    out = out.withColumn("next_week_goal_completed", F.col("future_7_day_active_minutes") >= F.col(goal))
    return out.withColumn("will_miss_goal_next_7_days", ~F.col("next_week_goal_completed"))


def goal_metrics(df: DataFrame, entity: str = "member_id", day: str = "activity_date", amount: str = "active_minutes", goal: str = "weekly_goal") -> DataFrame:
    """Weekly progress, goal history and forward-looking labels of every row.

    The history is that of ``goal_history``, but told on the first row of each week, where the week before has ended; all windows are
    of the entity's rows by day or of one of its weeks, so rows that lie by entity aren't moved again and nothing is joined.
    """
    rows = weekly_progress(df, entity, day, amount, goal)
    rows = rows.withColumn("#goal", F.first(goal).over(W.partitionBy(entity, "week_start").orderBy(day).rowsBetween(W.unboundedPreceding, 0)))
    order = W.partitionBy(entity).orderBy(day)
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    before = lambda c: F.lag(c).over(order)
    ended = before("week_start") != F.col("week_start")
    done = F.when(ended, F.coalesce((before("weekly_active_minutes_so_far") >= before("#goal")).cast("int"), F.lit(0)))
    rows = rows.withColumn("#done", done)
    rows = rows.withColumns({"#wins": F.coalesce(F.sum("#done").over(upto), F.lit(0)), "#losses": F.coalesce(F.sum(1 - F.col("#done")).over(upto), F.lit(0))})
    # The wins since the last loss are the streak.
    streak = F.col("#wins") - F.coalesce(F.max(F.when(F.col("#done") == 0, F.col("#wins"))).over(upto), F.lit(0))
    known = F.col(entity).isNotNull() & F.col("week_start").isNotNull()
    rows = rows.withColumns({"previous_goal_streak": F.when(known, streak).cast("long"), "previous_failed_goals": F.when(known, F.col("#losses")).cast("long")})
    return future_total(rows.drop("#goal", "#done", "#wins", "#losses"), entity, day, amount, goal)


def recency(df: DataFrame, entity: str, day: str, activity: str, name: str = "days_since_last_app_session") -> DataFrame:
    """Adds rows since the last activity: 0 on activity, from 1 before the first; null counts as none."""
    active = F.coalesce(F.col(activity) > 0, F.lit(False))
    upto = W.partitionBy(entity).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    out = df.withColumn("#row", F.row_number().over(W.partitionBy(entity).orderBy(day)))
    last = F.max(F.when(active, F.col("#row"))).over(upto)
    return out.withColumn(name, (F.col("#row") - F.coalesce(last, F.lit(0))).cast("long")).drop("#row")


def quality_flags(df: DataFrame, day: str = "activity_date", delay: str = "record_delay_days") -> DataFrame:
    """Adds the flags of missing, outlying and late values, and the day a row became available."""
    return df.withColumns(
        {
            "sleep_hours_missing": F.col("sleep_hours").isNull(),
            "app_sessions_missing": F.col("app_sessions").isNull(),
            "is_step_outlier": F.coalesce(F.col("daily_steps") > OUTLIER_STEPS, F.lit(False)),
            "is_late_record": F.col(delay) > 0,
            "available_date": F.date_add(F.col(day), F.col(delay)),
        }
    )


def category_changed(df: DataFrame, entity: str, day: str, category: str, name: str = "activity_level_changed") -> DataFrame:
    """Adds whether the category differs from that of the entity's row before; false on the first."""
    before = F.lag(category).over(W.partitionBy(entity).orderBy(day))
    return df.withColumn(name, F.coalesce(F.col(category) != before, F.lit(False)))


def edge_rows(df: DataFrame, entity: str, day: str, k: int, last: bool = False) -> DataFrame:
    """The first (or last) k rows of every entity."""
    order = F.col(day).desc() if last else F.col(day).asc()
    return df.withColumn("#r", F.row_number().over(W.partitionBy(entity).orderBy(order))).filter(F.col("#r") <= k).drop("#r")


def stage(raw: DataFrame) -> DataFrame:
    """Typed staging: the date column gets its name, dates lose their time, nothing is imputed."""
    renamed = raw.withColumnRenamed("date", "activity_date")
    dates = [c for c in ("activity_date", "week_start", "available_date") if c in renamed.columns]
    return renamed.withColumns({c: F.to_date(c) for c in dates})
