"""As-of features over a trailing window, of rows that were available by then.

Windows of all anchors are differences of running sums (``features``). For one new day at a time each row of history has a few effects
on later days (``effects``); effects and states add up, so a new day needs the states of the day before and its own effects only (``state``, ``features_on``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.columns import ratio
from tidewatch.functions.shared import compiled

WINDOW_DAYS = 28

#: Columns carried as of the prediction date.
AS_OF = (
    "age_band", "membership_months", "activity_level", "reward_profile", "intervention_profile", "weekly_goal",
    "weekly_active_minutes_so_far", "goal_completion_percentage", "previous_goal_streak", "previous_failed_goals", "days_since_last_app_session",
)


def anchors(panel: DataFrame, entity: str, day: str, window_days: int = WINDOW_DAYS, keep: tuple[str, ...] = (), first: Column | None = None) -> DataFrame:
    """The panel's rows with at least ``window_days`` of history, as ``prediction_date``; ``first`` is the entity's first day where the panel lacks its first rows."""
    first = F.min(day).over(W.partitionBy(entity)) if first is None else first
    rows = panel.select(entity, F.col(day).alias("prediction_date"), *keep, F.date_add(first, window_days).alias("#from"))
    return rows.filter(F.col("prediction_date") >= F.col("#from")).drop("#from")


def band_join(points: DataFrame, history: DataFrame, entity: str, at: str, day: str, known: str, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Left join: history of the entity from ``at`` - window to ``at`` - 1 that was known by ``at``.

    Both sides carry a bucket of ``window_days`` days; a point's window touches two buckets at
    most, so each history row is posted under its bucket and the next. The join is an equi
    join on (entity, bucket) with the exact range as residual: no pair outside two windows is
    formed, and a long history is spread over many keys.
    """
    width = F.lit(window_days)
    bucket = lambda c: F.unix_date(F.col(c)) - F.pmod(F.unix_date(F.col(c)), width)  # noqa: E731  its first day
    right = history.select(*(F.col(c).alias(f"h_{c}") for c in history.columns))
    right = right.filter(F.col(f"h_{known}").isNotNull()).withColumn("#hb", F.explode(F.array(bucket(f"h_{day}"), bucket(f"h_{day}") + width)))
    left = points.withColumn("#b", bucket(at))
    on = (
        (F.col(entity) == F.col(f"h_{entity}"))
        & (F.col("#b") == F.col("#hb"))
        & F.col(f"h_{day}").between(F.date_sub(F.col(at), window_days), F.date_sub(F.col(at), 1))
        & (F.col(f"h_{known}") <= F.col(at))
    )
    return left.join(right, on, "left").drop("#b", "#hb")


#: What a row of history adds to a window while it is in it: name of the sum, and the value (null adds nothing).
_C = F.col


def _one(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def _number(c: str) -> tuple[tuple[str, Column], ...]:
    """Sum and count of a column's values."""
    return ((f"{c}_sum", F.coalesce(_C(c), F.lit(0))), (f"{c}_n", _one(_C(c).isNotNull())))


def _measures() -> dict[str, dict[str, Column]]:
    """The sums of each window: of the last 28 days, the last 7, and the 7 before."""
    recent = [*_number("daily_steps"), *_number("active_minutes"), *_number("app_sessions")]
    square = lambda c: F.coalesce(_C(c) * _C(c), F.lit(0))
    whole = [
        *recent, *_number("sleep_hours"), *_number("rewards_viewed"), *_number("rewards_redeemed"), *_number("goal_completion_percentage"),
        ("rows", F.lit(1)), ("daily_steps_squares", square("daily_steps")), ("active_minutes_squares", square("active_minutes")), ("active_days", _one(_C("active_minutes") > 0)),
        *((c, _one(_C(c))) for c in (
            "sleep_hours_missing", "app_sessions_missing", "intervention_received", "intervention_opened", "intervention_clicked", "is_step_outlier", "is_late_record", "activity_level_changed",
        )),
    ]
    return {"w28": dict(whole), "w7": dict([*recent, *_number("sleep_hours")]), "p7": dict(recent)}


def effects(history: DataFrame, entity: str = "member_id") -> DataFrame:
    """What each row of history changes, and on which day: partial states by entity and day, which add up.

    A row counts from the day after its own, or from the day it was known if that is later, and
    leaves the window of 28 days (of 7, of the 7 before) on a fixed day. So it has at most four effects, whatever the length of the windows. Rows known
    later than on the next day also have one effect for each day on which they count: the latest day on which
    anything in the window was known can't be told from sums.
    """
    day, known = F.unix_date("activity_date"), F.unix_date("available_date")
    rows = history.withColumns({"#d": day, "#k": known, "#e": F.greatest(day + 1, known)})
    d, e = _C("#d"), _C("#e")
    in7, direct = e <= d + 7, (e >= d + 8) & (e <= d + 14)
    event = lambda at, w28, w7, p7, enters: F.struct(at.alias("day"), F.lit(w28).alias("w28"), w7.alias("w7"), p7.alias("p7"), F.lit(enters).alias("enters"), F.lit(None).cast("int").alias("late"))
    none, kind = F.lit(0), "array<struct<day:int,w28:int,w7:int,p7:int,enters:boolean,late:int>>"
    changes = F.array(
        event(e, 1, F.when(in7, 1).otherwise(0), F.when(direct, 1).otherwise(0), True),
        event(d + 8, 0, F.when(in7, -1).otherwise(0), F.when(in7, 1).otherwise(0), False),
        event(d + 15, 0, none, F.when(e <= d + 14, -1).otherwise(0), False),
        event(d + 1 + WINDOW_DAYS, -1, none, none, False),
    )
    own = lambda at: F.struct(at.alias("day"), none.alias("w28"), none.alias("w7"), none.alias("p7"), F.lit(False).alias("enters"), _C("#k").alias("late"))
    late = F.when(e > d + 1, F.transform(F.sequence(e, d + WINDOW_DAYS), own)).otherwise(F.array().cast(kind))
    # Rows whose knowing isn't known, or came after all windows, have no effect.
    rows = rows.filter(known.isNotNull() & (e <= d + WINDOW_DAYS)).withColumn("#x", F.explode(F.concat(changes, late)))
    return rows.select(entity, *(_C(f"#x.{c}").alias(c) for c in ("day", "w28", "w7", "p7", "enters", "late")), d.alias("of"), known.alias("known"), *(c for c in history.columns if c in _VALUES))


def _partial() -> dict[str, Column]:
    """The aggregates of effects that make a state: sums of each window, and the newest days with their values.

    Days that have left the window are told by their number.
    """
    enters, of = _C("enters"), _C("of")
    made = {f"{w} {name}": F.sum(_C(w) * value) for w, values in _measures().items() for name, value in values.items()}
    made |= {f"last {c}": F.max(F.when(enters & _C(c).isNotNull(), F.struct(of.alias("day"), _C(c).alias("value")))) for c in AS_OF}
    return made | {"last day": F.max(F.when(enters, of)), "last known": F.max(F.when(enters & (_C("known") <= of + 1), _C("known")))}


def _stated(states: DataFrame, entity: str, label: str) -> DataFrame:
    """The feature columns of anchors (entity, ``day``, label) with their states."""
    n = lambda w, c: _C(f"{w} {c}")
    total = lambda w, c: F.when(n(w, f"{c}_n") > 0, n(w, f"{c}_sum"))
    mean = lambda w, c: ratio(n(w, f"{c}_sum"), n(w, f"{c}_n"))

    def deviation(c: str) -> Column:
        k = n("w28", f"{c}_n")
        return F.when(k > 1, F.sqrt((k * n("w28", f"{c}_squares") - n("w28", f"{c}_sum") * n("w28", f"{c}_sum")) / (k * (k - 1))))

    at, count = F.date_from_unix_date("day"), lambda c: F.coalesce(n("w28", c), F.lit(0)).cast("long")
    first = _C("day") - WINDOW_DAYS
    inside = count("rows") > 0
    c = F.col
    out = states.select(
        entity, at.alias("prediction_date"), c(label).alias(f"label_{label}"),
        *(F.when(c(f"last {x}.day") >= first, c(f"last {x}.value")).alias(f"{x}_as_of") for x in AS_OF),
        count("rows").alias("available_day_count_28d"),
        (F.lit(WINDOW_DAYS) - count("rows")).alias("unavailable_day_count_28d"),
        F.date_from_unix_date(F.when(inside, c("last day"))).alias("max_source_activity_date"),
        # On time, the newest is the one known last; what was known late is listed for each day.
        F.date_from_unix_date(F.when(inside, F.greatest(F.when(c("last known") >= first, c("last known")), "late"))).alias("max_source_available_date"),
        mean("w28", "daily_steps").alias("avg_daily_steps_28d"),
        deviation("daily_steps").alias("stddev_daily_steps_28d"),
        mean("w7", "daily_steps").alias("avg_daily_steps_7d"),
        mean("p7", "daily_steps").alias("avg_daily_steps_prior_7d"),
        total("w28", "active_minutes").alias("sum_active_minutes_28d"),
        mean("w28", "active_minutes").alias("avg_active_minutes_28d"),
        deviation("active_minutes").alias("stddev_active_minutes_28d"),
        mean("w7", "active_minutes").alias("avg_active_minutes_7d"),
        mean("p7", "active_minutes").alias("avg_active_minutes_prior_7d"),
        count("active_days").alias("active_day_count_28d"),
        mean("w28", "sleep_hours").alias("avg_sleep_hours_28d"),
        mean("w7", "sleep_hours").alias("avg_sleep_hours_7d"),
        count("sleep_hours_n").alias("sleep_observation_count_28d"),
        count("sleep_hours_missing").alias("sleep_missing_day_count_28d"),
        total("w28", "app_sessions").alias("sum_app_sessions_28d"),
        mean("w28", "app_sessions").alias("avg_app_sessions_28d"),
        mean("w7", "app_sessions").alias("avg_app_sessions_7d"),
        mean("p7", "app_sessions").alias("avg_app_sessions_prior_7d"),
        count("app_sessions_n").alias("app_session_observation_count_28d"),
        count("app_sessions_missing").alias("app_sessions_missing_day_count_28d"),
        total("w28", "rewards_viewed").alias("rewards_viewed_28d"),
        total("w28", "rewards_redeemed").alias("rewards_redeemed_28d"),
        count("intervention_received").alias("interventions_received_28d"),
        count("intervention_opened").alias("interventions_opened_28d"),
        count("intervention_clicked").alias("interventions_clicked_28d"),
        count("is_step_outlier").alias("step_outlier_day_count_28d"),
        count("is_late_record").alias("late_record_count_28d"),
        count("activity_level_changed").alias("activity_level_change_count_28d"),
        mean("w28", "goal_completion_percentage").alias("avg_goal_completion_percentage_28d"),
    )
    at = c("prediction_date")
    return out.withColumns(
        {
            "feature_window_start": F.date_sub(at, WINDOW_DAYS),
            "feature_window_end": F.date_sub(at, 1),
            "reward_redemption_rate_28d": ratio(c("rewards_redeemed_28d"), c("rewards_viewed_28d")),
            "intervention_open_rate_28d": ratio(c("interventions_opened_28d"), c("interventions_received_28d")),
            "intervention_click_rate_28d": ratio(c("interventions_clicked_28d"), c("interventions_received_28d")),
            "daily_steps_trend_7d": c("avg_daily_steps_7d") - c("avg_daily_steps_prior_7d"),
            "active_minutes_trend_7d": c("avg_active_minutes_7d") - c("avg_active_minutes_prior_7d"),
            "app_sessions_trend_7d": c("avg_app_sessions_7d") - c("avg_app_sessions_prior_7d"),
        }
    )


#: First and last day before the anchor of each window; rows that are worked on at once, and all of a member's.
_SPANS = {"w28": (1, WINDOW_DAYS), "w7": (1, 7), "p7": (8, 14)}
_TOGETHER = 30_000


def _members(batches: Iterator[pa.RecordBatch], entity: str, together: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole members, whose rows follow each other, and where in them each member begins."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(map(len, held)) >= together:
            table, begins = _begins(held, entity)
            if begins[-1]:
                yield table[: begins[-1]], begins[:-1]
            held = [table[begins[-1] :]]
    if sum(map(len, held)):
        yield _begins(held, entity)


def _begins(held: list[pa.Table], entity: str) -> tuple[pa.Table, np.ndarray]:
    table = pa.concat_tables(held).combine_chunks()
    number = pa.compute.dictionary_encode(table[entity].combine_chunks(), null_encoding="encode").indices.to_numpy()
    return table, np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return column.to_numpy().astype(kind, copy=False)


def whole_features(staging: DataFrame, entity: str = "member_id", label: str = "will_miss_goal_next_7_days") -> DataFrame:
    """The rows of ``features`` with all sums made at once, as arrays over some members' days; for tables that need most columns, as none is left out.

    A row counts from the day after its own, or from the day it was known if that is later, to the last day of each window: a window's sum is
    that of all rows that have come by the anchor less that of those that have gone. Members before have come and gone.
    """
    compiled(staging.sparkSession)
    measures, together = _measures(), _TOGETHER
    values = measures["w28"]
    used = [c for c in staging.columns if c in _USED or c in (entity, label)]
    # The first day needs a member's rows together; they are then put in order where they are.
    rows = staging.select(*used, F.unix_date("activity_date").alias("of"), F.unix_date("available_date").alias("known"))
    rows = rows.withColumn("first", F.min("of").over(W.partitionBy(entity))).filter("of is not null")
    made = rows.select(entity, label, "of", "known", "first", *(v.alias(f"w28 {c}") for c, v in values.items()), *(F.col(c).alias(f"last {c}") for c in AS_OF))
    real = [c for c in values if made.schema[f"w28 {c}"].dataType.simpleString() in ("float", "double")]
    whole = [c for c in values if c not in real]
    made = made.withColumns({f"w28 {c}": F.col(f"w28 {c}").cast("double" if c in real else "long") for c in values})
    sums = [(w, c) for w, of in measures.items() for c in of]
    names = [entity, "day", label, *(f"{w} {c}" for w, c in sums), *(f"last {c}" for c in AS_OF), "last day", "late"]
    kinds = dict(made.dtypes) | {"day": "int", "last day": "int", "late": "int"} | {f"{w} {c}": "double" if c in real else "bigint" for w, c in sums}
    spans = {w: (lo, hi, [c for c in whole if c in measures[w]], [c for c in real if c in measures[w]]) for w, (lo, hi) in _SPANS.items()}

    def state(table: pa.Table, begins: np.ndarray) -> pa.RecordBatch:
        day, held = _numbers(table["of"], np.int64), ~table["known"].is_null().to_numpy()
        known, number = _numbers(table["known"].fill_null(0), np.int64), np.zeros(len(day), np.int64)
        number[begins[1:]] = 1
        number = np.cumsum(number)
        # Days of one member after those of another, with room for the windows between.
        shift = number * (day.max() - day.min() + 100) - day.min()
        anchor = np.flatnonzero(day >= _numbers(table["first"], np.int64) + WINDOW_DAYS)
        day, known = day + shift, known + shift
        at, whose = day[anchor], pa.array(anchor)
        out = {entity: table[entity].take(whose), "day": pa.array(at - shift[anchor], pa.int32()), label: table[label].take(whose)}
        of = {c: _numbers(table[f"w28 {c}"], np.int64) for c in whole} | {c: _numbers(table[f"w28 {c}"], np.longdouble) for c in real}
        for w, (lo, hi, *both) in spans.items():
            counts = np.flatnonzero(held & (known <= day + hi))
            comes = np.maximum(day[counts] + lo, known[counts])
            order = np.argsort(comes, kind="stable")
            come, gone = np.searchsorted(comes[order], at, "right"), np.searchsorted(day[counts] + hi, at, "left")
            for c in (*both[0], *both[1]):
                x = of[c][counts]
                total = np.append(0, np.cumsum(x[order]))[come] - np.append(0, np.cumsum(x))[gone]
                out[f"{w} {c}"] = pa.array(total.astype(np.float64 if c in real else np.int64))
        counts = np.flatnonzero(held & (known <= day + WINDOW_DAYS))
        comes = np.maximum(day[counts] + 1, known[counts])
        order = counts[np.argsort(comes, kind="stable")]
        come, least = np.searchsorted(np.sort(comes), at, "right"), begins[number[anchor]]
        # The newest row by the anchor is the last in order of all that have come; one of a member before is none.
        so_far = lambda place: np.append(-1, np.maximum.accumulate(place[order]) if len(order) else place[:0])[come]
        place = np.arange(len(day))
        doubled = (np.diff(day) == 0).any()
        for c in AS_OF:
            column, by = table[f"last {c}"], place
            if doubled:
                # Of several rows of a day the greatest value counts.
                by = pa.compute.sort_indices(pa.table({"day": day, "value": column}), [("day", "ascending"), ("value", "ascending")]).to_numpy().astype(np.int64)
            newest = so_far(np.where(column.is_null().to_numpy(), -1, np.argsort(by) if doubled else place))
            row = by[newest]
            out[f"last {c}"] = column.take(pa.array(row, mask=(newest < least) | (day[row] < at - WINDOW_DAYS)))
        newest = so_far(place)
        out["last day"] = pa.array((day - shift)[newest], pa.int32(), mask=newest < least)
        latest, by = np.full(len(at), -1), counts[np.argsort(known[counts], kind="stable")]
        for lo, hi, row in zip(np.searchsorted(at, np.maximum(day[by] + 1, known[by])).tolist(), np.searchsorted(at, day[by] + WINDOW_DAYS, "right").tolist(), by.tolist(), strict=True):
            latest[lo:hi] = row
        out["late"] = pa.array((known - shift)[latest], pa.int32(), mask=latest < 0)
        return pa.table([out[c] for c in names], names=names).combine_chunks()

    def states_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _members(batches, entity, together):
            yield from state(table, begins).to_batches()

    states = made.sortWithinPartitions(entity, "of").mapInArrow(states_of, ", ".join(f"`{c}` {kinds[c]}" for c in names))
    # What has left the window was dropped, so the anchor's day stands for the value's.
    carried = {f"last {c}": F.when(F.col(f"last {c}").isNotNull(), F.struct("day", F.col(f"last {c}").alias("value"))) for c in AS_OF}
    return _stated(states.withColumns(carried | {"last known": F.lit(None).cast("int")}), entity, label)


def features(staging: DataFrame, entity: str = "member_id", label: str = "will_miss_goal_next_7_days") -> DataFrame:
    """The 55 feature columns for every anchor of a staged panel.

    A window's sum is a running sum up to its last day less one up to the day before its first, so each row is met once for
    each bound of a window and not once for each anchor that it counts for. Rows known later than on the next
    day enter a window when they are known and leave it with their day; they stand in the stream of their entity once for each.
    Anchors without any available history keep a row with counts of 0. Rows are moved and sorted as they are; the values of all
    sums, many times as wide, are made afterwards.
    """
    used = [c for c in staging.columns if c in _USED or c in (entity, label)]
    day, known = F.unix_date("activity_date"), F.unix_date("available_date")
    rows = staging.select(*used, F.min(day).over(W.partitionBy(entity)).alias("first")).withColumns({"of": day, "known": known})
    of, a = _C("of"), _C("known")
    late = a > of + 1
    # Which windows a row enters or leaves where it stands: i28 and i7 at their last day, o28, o7 and o14 before their first, i14 at the last day of the 7 before.
    at = lambda where, anchor, **on: F.struct(where.alias("day"), F.lit(anchor).alias("anchor"), *(on.get(c, F.lit(False)).alias(c) for c in _BOUNDS))
    counts = a.isNotNull() & (a <= of + WINDOW_DAYS)
    in7, in14 = a <= of + 7, a <= of + 14
    on_time = at(of, True, **dict.fromkeys(_BOUNDS, a.isNotNull()))
    leaving = at(of, True, o28=counts, o7=counts & in7, i14=counts & (a <= of + 8), o14=counts & in14)
    entering = at(a - 1, False, i28=F.lit(True), i7=in7)
    again = at(a - 8, False, i14=F.lit(True))
    places = F.when(~F.coalesce(late, F.lit(False)), F.array(on_time)).when(~counts, F.array(leaving)).when((a > of + 8) & in14, F.array(leaving, entering, again)).otherwise(F.array(leaving, entering))
    stream = rows.select("*", F.inline(places)).sortWithinPartitions(entity, "day")
    order = W.partitionBy(entity).orderBy("day")
    before = lambda days: order.rangeBetween(W.unboundedPreceding, -days)
    summed = lambda flag, value, days: F.coalesce(F.sum(F.when(_C(flag), value)).over(before(days)), F.lit(0))
    bounds = {"w28": (("i28", 1), ("o28", WINDOW_DAYS + 1)), "w7": (("i7", 1), ("o7", 8)), "p7": (("i14", 8), ("o14", 15))}
    made = {f"{w} {name}": summed(bounds[w][0][0], value, bounds[w][0][1]) - summed(bounds[w][1][0], value, bounds[w][1][1]) for w, values in _measures().items() for name, value in values.items()}
    here = _C("i28")
    made |= {f"last {c}": F.max(F.when(here & _C(c).isNotNull(), F.struct(of.alias("day"), _C(c).alias("value")))).over(before(1)) for c in AS_OF}
    made |= {"last day": F.max(F.when(here, of)).over(before(1)), "last known": F.max(F.when(here & ~late, a)).over(before(1))}
    made["lates"] = F.collect_list(F.when(here & late, F.struct(a.alias("known"), of.alias("of")))).over(order.rangeBetween(-WINDOW_DAYS, -1))
    states = stream.select(entity, "day", label, "anchor", "first", *(v.alias(c) for c, v in made.items())).filter(F.col("anchor") & (F.col("day") >= F.col("first") + WINDOW_DAYS))
    newest = F.array_max(F.transform(F.filter("lates", lambda x: x["of"] >= F.col("day") - WINDOW_DAYS), lambda x: x["known"]))
    return _stated(states.withColumn("late", newest), entity, label)


def state(found: DataFrame, day: str, entity: str = "member_id", before: DataFrame | None = None) -> DataFrame:
    """The state of every entity as of a day, from its effects; with the state ``before`` of an earlier day only later effects are read."""
    upto = F.unix_date(F.lit(day).cast("date"))
    rows = found.filter(F.col("day") <= upto)
    if before is not None:
        rows = rows.filter(F.col("day") > F.unix_date(F.lit(before.select("as_of").first()["as_of"])))
    made = rows.groupBy(entity).agg(*(v.alias(c) for c, v in _partial().items()), F.max(F.when(F.col("day") == upto, F.col("late"))).alias("late"))
    if before is not None:
        both = made.unionByName(before.drop("as_of").withColumn("late", F.lit(None).cast("int")))
        made = both.groupBy(entity).agg(*((F.sum(c) if c.startswith(("w28 ", "w7 ", "p7 ")) else F.max(c)).alias(c) for c in both.columns if c != entity))
    return made.withColumn("as_of", F.lit(day).cast("date"))


def features_on(states: DataFrame, points: DataFrame, entity: str = "member_id", label: str = "will_miss_goal_next_7_days") -> DataFrame:
    """The feature columns of one day's anchors (entity, prediction_date, label) from the states as of that day."""
    rows = points.select(entity, F.unix_date("prediction_date").alias("day"), label).join(states.drop("as_of"), entity, "left")
    return _stated(rows, entity, label)


#: Columns of the staged panel that features are made of.
_VALUES = (
    *AS_OF, "daily_steps", "active_minutes", "sleep_hours", "app_sessions", "rewards_viewed", "rewards_redeemed", "sleep_hours_missing",
    "app_sessions_missing", "intervention_received", "intervention_opened", "intervention_clicked", "is_step_outlier", "is_late_record", "activity_level_changed",
)
_BOUNDS = ("i28", "i7", "i14", "o28", "o7", "o14")
_USED = frozenset((*_VALUES, "activity_date", "available_date"))


#: Columns that are no predictors: keys, window bounds, label, audit dates and the excluded profile.
NOT_PREDICTORS = (
    "member_id", "prediction_date", "feature_window_start", "feature_window_end", "label_will_miss_goal_next_7_days",
    "max_source_activity_date", "max_source_available_date", "intervention_profile_as_of", "dataset_split",
)


def predictors(features_table: DataFrame) -> list[str]:
    """The columns a model may see."""
    return [c for c in features_table.columns if c not in NOT_PREDICTORS]


def leak_audit(features_table: DataFrame, window_days: int = WINDOW_DAYS) -> DataFrame:
    """One row: violations of the window, of day accounting, of availability, and of every rate and trend."""
    c = F.col
    bad = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    return features_table.agg(
        F.count("*").alias("row_count"),
        bad(c("max_source_activity_date") > c("feature_window_end")).alias("after_window"),
        bad(c("max_source_activity_date") < c("feature_window_start")).alias("before_window"),
        bad(c("max_source_available_date") > c("prediction_date")).alias("not_yet_available"),
        bad(c("available_day_count_28d") + c("unavailable_day_count_28d") != window_days).alias("day_accounting"),
        *(bad(~c(f"{rate}_28d").between(0, 1)).alias(f"{rate}_out_of_range") for rate in ("reward_redemption_rate", "intervention_open_rate", "intervention_click_rate")),
        *(bad(~c(f"{x}_trend_7d").eqNullSafe(c(f"avg_{x}_7d") - c(f"avg_{x}_prior_7d"))).alias(f"{x}_trend_mismatch") for x in ("daily_steps", "active_minutes", "app_sessions")),
    )
