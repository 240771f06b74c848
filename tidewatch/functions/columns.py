"""Column functions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def ratio_or_zero(a: Column, b: Column) -> Column:
    """a / b, zero where b is zero."""
    return F.coalesce(ratio(a, b), F.lit(0.0))


def last_known(value: Column, at: Column) -> Column:
    """Aggregate: the value of the greatest ``at`` at which it isn't null."""
    return F.max_by(value, F.when(value.isNotNull(), at))


def week_start(day: Column) -> Column:
    """The Monday of a day's week."""
    return F.date_sub(day, F.weekday(day))


def is_probability(p: Column) -> Column:
    """Whether p is a finite number from 0 to 1; false for null."""
    return F.coalesce(p.isNotNull() & ~F.isnan(p) & p.between(0.0, 1.0), F.lit(False))


def equal_width_bin(p: Column, bins: int) -> Column:
    """The bin of p in [0, 1]; 1 falls in the last bin."""
    return F.least(F.floor(p * bins), F.lit(bins - 1)).cast("long")


def grid_step(p: Column, steps: int) -> Column:
    """The greatest k with k / steps <= p, exact in doubles."""
    k = F.floor(p * steps)
    at = lambda x: x.cast("double") / F.lit(float(steps))
    return F.when(at(k) > p, k - 1).when(at(k + 1) <= p, k + 1).otherwise(k).cast("long")


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality."""
    return ~a.eqNullSafe(b)


def false_if_null(flag: Column) -> Column:
    """A flag whose null counts as false."""
    return F.coalesce(flag, F.lit(False))


def blank(text: Column) -> Column:
    """Whether a text is null or has white space only."""
    return text.isNull() | (F.regexp_replace(text, r"\s+", "") == "")


def safe_bool(text: Column) -> Column:
    """The boolean that a text spells as true or false, in any case; null for other texts."""
    word = F.lower(text.cast("string"))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def utc_timestamp(text: Column) -> Column:
    """An ISO timestamp with a mandatory zone offset; null for other texts."""
    zoned = text.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:?\d\d)$")
    return F.when(zoned, F.try_to_timestamp(text))


def named_value(entries: Column, name_field: str, name: str, value_field: str) -> Column:
    """The value of the first entry of that name in an array of structs, null without one."""
    return F.get(F.filter(entries, lambda x: x[name_field] == name), 0)[value_field]


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row's canonical JSON, with nulls."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def paths_clash(a: Column, b: Column) -> Column:
    """Whether one path is the other one or holds it."""
    folder = lambda p: F.concat(F.regexp_replace(p, "/+$", ""), F.lit("/"))
    return F.startswith(folder(a), folder(b)) | F.startswith(folder(b), folder(a))
