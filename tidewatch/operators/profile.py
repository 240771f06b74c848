"""Profile of a dataset, section by section."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import false_if_null
from tidewatch.operators.panel import edge_rows
from tidewatch.operators.ranking import quantiles


def null_rates(df: DataFrame) -> DataFrame:
    """Columns with nulls: name and rate, highest first. One pass."""
    one = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns))
    entries = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rate")) for c in df.columns))
    return one.select(F.inline(entries)).filter("null_rate > 0").orderBy(F.desc("null_rate"), "column_name")


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Values of a column with count and share."""
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("#total"))
    return counts.crossJoin(F.broadcast(total)).select("value", "row_count", (F.col("row_count") / F.col("#total")).alias("share"))


def describe(df: DataFrame, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """A row for each numeric column: count, mean, deviation, least, 1st, 50th and 99th percentile, greatest.

    Percentiles are exact, by ranks over ranges of values; with ``accuracy``, sketches of that
    size are merged instead.
    """
    at = lambda c, q: (F.lit(None) if accuracy is None else F.percentile_approx(c, q, accuracy)).cast("double")
    one = df.agg(
        *(
            F.struct(
                F.lit(c).alias("column_name"), F.count(c).alias("value_count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("standard_deviation"), F.min(c).cast("double").alias("minimum"),
                at(c, 0.01).alias("p01"), at(c, 0.5).alias("p50"), at(c, 0.99).alias("p99"), F.max(c).cast("double").alias("maximum"),
            ).alias(c)
            for c in columns
        )
    )
    rows = one.select(F.inline(F.array(*columns)))
    if accuracy is not None:
        return rows
    exact = quantiles(df, columns, [0.01, 0.5, 0.99]).toDF("column_name", "p01", "p50", "p99")
    return rows.drop("p01", "p50", "p99").join(exact, "column_name", "left").select(*rows.columns)


def rate_by(df: DataFrame, group: str, flag: str) -> DataFrame:
    """Rows and mean of a flag in each group; rows without the flag don't count in the mean."""
    return df.groupBy(F.col(group).cast("string").alias("group_value")).agg(F.count("*").alias("row_count"), F.avg(F.col(flag).cast("double")).alias("rate"))


def flag_rates(df: DataFrame, flags: list[str], within: str | None = None) -> DataFrame:
    """One row: the rate of each flag (null as false), and of each among rows with ``within``."""
    value = lambda f: false_if_null(F.col(f)).cast("double")
    made = [F.avg(value(f)).alias(f"{f}_rate") for f in flags]
    if within:
        made += [F.avg(F.when(false_if_null(F.col(within)), value(f))).alias(f"{f}_rate_within") for f in flags if f != within]
    return df.agg(*made)


def rows_for_each(df: DataFrame, entity: str) -> DataFrame:
    """One row: entities, and the least and most rows of one."""
    return df.groupBy(entity).count().agg(F.count("*").alias("entity_count"), F.min("count").alias("minimum_rows"), F.max("count").alias("maximum_rows"))


def one_for_each(df: DataFrame, entity: str, day: str) -> DataFrame:
    """The first row of every entity."""
    return edge_rows(df, entity, day, 1)


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """PASS or FAIL for equal row counts, columns and rows of two copies of a dataset."""
    spark, same = a.sparkSession, a.columns == b.columns
    counts = a.agg(F.count("*").alias("x")).crossJoin(b.agg(F.count("*").alias("y"))).select((F.col("x") == F.col("y")).alias("ok"), F.lit("row_count").alias("check_name"))
    columns = spark.range(1).select(F.lit(same).alias("ok"), F.lit("columns").alias("check_name"))
    out = counts.unionByName(columns)
    if same:
        differing = a.exceptAll(b).limit(1).unionByName(b.exceptAll(a).limit(1))
        out = out.unionByName(differing.agg((F.count("*") == 0).alias("ok")).withColumn("check_name", F.lit("rows")))
    return out.select("check_name", F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("status"))


def report(df: DataFrame, entity: str, day: str, label: str, numeric: list[str], categories: list[str], flags: list[str]) -> DataFrame:
    """A whole profile as one table: section, item, row_count and value.

    Two aggregates of grouping sets make it, one over the rows and one over the entities, whose first row tells their categories.
    """
    entry = lambda section, item, n, value: F.struct(F.lit(section).alias("section"), item.cast("string").alias("item"), n.cast("long").alias("row_count"), value.cast("double").alias("value"))
    none, c = F.lit(None), F.col
    named = [f"#{x}" for x in categories]
    sets = [[], *([x] for x in named)]
    rows = df.withColumns({f"#{x}": F.col(x).cast("string") for x in categories})
    rate = F.avg(c(label).cast("double"))
    stats = {"mean": F.avg, "standard_deviation": F.stddev_samp, "minimum": F.min, "maximum": F.max}
    made = {f"null {x}": F.avg(c(x).isNull().cast("double")) for x in df.columns} | {f"flag {f}": F.avg(false_if_null(c(f)).cast("double")) for f in flags}
    made |= {f"{k} {x}": f(x).cast("double") for x in numeric for k, f in stats.items()} | {f"count {x}": F.count(x) for x in numeric}
    made |= {"first": F.unix_date(F.min(day)), "last": F.unix_date(F.max(day))}
    by = rows.groupingSets(sets, *named).agg(F.grouping_id().alias("#id"), F.count("*").alias("#n"), rate.alias("#rate"), *(v.alias(k) for k, v in made.items()))
    whole = F.array(
        entry("shape", F.lit("rows"), c("#n"), none), entry("shape", F.lit("first_day"), none, c("first")), entry("shape", F.lit("last_day"), none, c("last")), entry("label", F.lit("all"), c("#n"), c("#rate")),
        *(entry("null_rate", F.lit(x), none, c(f"null {x}")) for x in df.columns), *(entry("flag_rate", F.lit(f), none, c(f"flag {f}")) for f in flags),
        *(entry(k, F.lit(x), c(f"count {x}"), c(f"{k} {x}")) for x in numeric for k in stats),
    )
    # A set's number has a bit for each category that it lacks.
    everything = (1 << len(named)) - 1
    own = lambda i: everything - (1 << (len(named) - 1 - i))
    of = lambda section, value: [F.when(c("#id") == own(i), F.array(entry(f"{section}{x}", c(f"#{x}"), c("#n"), value))) for i, x in enumerate(categories)]
    first = rows.groupBy(entity).agg(F.count("*").alias("#rows"), F.min_by(F.struct(F.lit(0).alias("#0"), *named), day).alias("#first")).select("#rows", *(F.col(f"#first.{x}").alias(x) for x in named))
    entities = first.groupingSets(sets, *named).agg(F.grouping_id().alias("#id"), F.count("*").alias("#n"), F.min("#rows").alias("least"), F.max("#rows").alias("most"))
    each = F.array(entry("shape", F.lit("entities"), c("#n"), none), entry("rows_of_entity", F.lit("minimum"), c("least"), none), entry("rows_of_entity", F.lit("maximum"), c("most"), none))
    tables = [by.select(F.inline(F.coalesce(*of("label_by_", c("#rate")), whole))), entities.select(F.inline(F.coalesce(*of("entities_by_", none), each)))]
    return tables[0].unionByName(tables[1])
