"""Evaluation of scored rows: a label and a probability each.

Threshold sweeps work on a histogram of the grid steps, curves on distinct scores, so their
windows run over rows that were aggregated before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.columns import equal_width_bin, grid_step, is_probability, ratio, ratio_or_zero
from tidewatch.functions.shared import materialise
from tidewatch.operators.ranking import global_rank, running, with_tiles

STEPS = 1_000
EPSILON = 2.220446049250313e-16
COUNTS = ("true_positives", "false_positives", "true_negatives", "false_negatives")


def _counts(label: str, predicted: Column) -> dict[str, Column]:
    y = F.col(label)
    return {
        "true_positives": F.count_if(predicted & y),
        "false_positives": F.count_if(predicted & ~y),
        "true_negatives": F.count_if(~predicted & ~y),
        "false_negatives": F.count_if(~predicted & y),
    }


def _rates(divide) -> dict[str, Column]:
    tp, fp, tn, fn = (F.col(c) for c in ("true_positives", "false_positives", "true_negatives", "false_negatives"))
    return {
        "precision": divide(tp, tp + fp),
        "recall": divide(tp, tp + fn),
        "specificity": divide(tn, tn + fp),
        "accuracy": divide(tp + tn, tp + fp + tn + fn),
        "f1_score": divide(2 * tp, 2 * tp + fp + fn),
    }


def _confused(threshold: float) -> list[Column]:
    """Threshold, counts and rates (zero on empty denominators) of a row of counts."""
    return [F.lit(threshold).alias("threshold"), *(F.col(n) for n in COUNTS), *(c.alias(n) for n, c in _rates(ratio_or_zero).items())]


def confusion(df: DataFrame, label: str, p: str, threshold: float) -> DataFrame:
    """One row: the confusion counts at a threshold and their rates (zero on empty denominators)."""
    counts = df.agg(*(c.alias(n) for n, c in _counts(label, F.col(p) >= F.lit(threshold)).items()))
    return counts.select(*_confused(threshold))


def _macro(prefix: str = "") -> dict[str, Column]:
    tp, fp, tn, fn = (F.col(prefix + c) for c in COUNTS)
    mean = lambda a, b: (a + b) / 2
    return {
        "macro_precision": mean(ratio_or_zero(tp, tp + fp), ratio_or_zero(tn, tn + fn)),
        "macro_recall": mean(ratio_or_zero(tp, tp + fn), ratio_or_zero(tn, tn + fp)),
        "macro_f1": mean(ratio_or_zero(2 * tp, 2 * tp + fp + fn), ratio_or_zero(2 * tn, 2 * tn + fp + fn)),
        "accuracy": ratio_or_zero(tp + tn, tp + fp + tn + fn),
    }


def macro(df: DataFrame, label: str, p: str, threshold: float) -> DataFrame:
    """One row: precision, recall and F1 averaged over both classes, and accuracy."""
    counts = df.agg(*(c.alias(n) for n, c in _counts(label, F.col(p) >= F.lit(threshold)).items()))
    return counts.select(*(c.alias(n) for n, c in _macro().items()))


def distinct_scores(df: DataFrame, label: str, p: str) -> DataFrame:
    """``score``, ``pos`` and ``neg``: positives and negatives at each distinct score. A score that is no probability is an error."""
    y = F.col(label)
    score = F.when(is_probability(F.col(p)), F.col(p)).otherwise(F.raise_error(F.lit(f"{p} has to be from 0 to 1")).cast("double"))
    return df.groupBy(score.alias("score")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def sweep(df: DataFrame, label: str, p: str, steps: int = STEPS) -> DataFrame:
    """Counts and rates at every threshold k / steps; rates are null on empty denominators.

    One histogram of ``steps`` + 1 rows and its reverse running sums replace a join of all
    rows with all thresholds. A score that is no probability is an error.
    """
    return sweep_scores(distinct_scores(df, label, p), steps)


def sweep_scores(scores: DataFrame, steps: int = STEPS) -> DataFrame:
    """``sweep`` of counted distinct scores."""
    found = scores.groupBy(grid_step(F.col("score"), steps).alias("k")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    grid = scores.sparkSession.range(steps + 1).withColumnRenamed("id", "k").join(found, "k", "left").fillna(0, ["pos", "neg"])
    down = W.orderBy(F.desc("k")).rowsBetween(W.unboundedPreceding, 0)
    everything = W.orderBy(F.desc("k")).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    counted = grid.select(
        "k",
        F.sum("pos").over(down).alias("true_positives"),
        F.sum("neg").over(down).alias("false_positives"),
        F.sum("pos").over(everything).alias("#pos"),
        F.sum("neg").over(everything).alias("#neg"),
    )
    counted = counted.withColumns({"true_negatives": F.col("#neg") - F.col("false_positives"), "false_negatives": F.col("#pos") - F.col("true_positives")})
    return counted.select((F.col("k") / F.lit(float(steps))).alias("threshold"), *COUNTS, *(c.alias(n) for n, c in _rates(ratio).items()))


def best_threshold(swept: DataFrame) -> DataFrame:
    """The row of the best F1; ties go to the higher recall, then to the lower threshold."""
    c = F.coalesce
    return swept.orderBy(c("f1_score", F.lit(-1.0)).desc(), c("recall", F.lit(-1.0)).desc(), "threshold").limit(1)


def pr_auc_grid(swept: DataFrame) -> DataFrame:
    """One row: the trapezoid over the grid's points by falling threshold, empty precision as 1."""
    order = W.orderBy(F.desc("threshold"))
    points = swept.select("threshold", F.coalesce("recall", F.lit(0.0)).alias("r"), F.coalesce("precision", F.lit(1.0)).alias("q"))
    steps = points.select((F.col("r") - F.lag("r", 1, 0.0).over(order)).alias("dr"), ((F.col("q") + F.lag("q", 1, 1.0).over(order)) / 2).alias("h"))
    return steps.agg(F.sum(F.col("dr") * F.col("h")).alias("approximate_pr_auc"))


def curve(df: DataFrame, label: str, p: str) -> DataFrame:
    """A row for each distinct score: positives and negatives at it, and running sums from the top."""
    return curve_scores(distinct_scores(df, label, p))


def curve_scores(scores: DataFrame) -> DataFrame:
    """``curve`` of counted distinct scores, whose sums run over ranges of scores."""
    return running(scores, [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")})


def ranking_metrics(df: DataFrame, label: str, p: str) -> DataFrame:
    """One row: exact ROC area, trapezoid PR area anchored at (0, 1), average precision."""
    return ranking_of_scores(distinct_scores(df, label, p))


def ranking_of_scores(scores: DataFrame) -> DataFrame:
    """``ranking_metrics`` of counted distinct scores."""
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    previous = F.when(before_tp + before_fp == 0, F.lit(1.0)).otherwise(ratio(before_tp, before_tp + before_fp))
    # Each point's neighbour above has the counts before its own.
    sums = curve_scores(scores).agg(
        F.sum("pos").alias("#P"),
        F.sum("neg").alias("#N"),
        F.sum(F.col("neg") * (F.col("tp") + before_tp) / 2).alias("#roc"),
        F.sum(F.col("pos") * (precision + previous) / 2).alias("#pr"),
        F.sum(F.col("pos") * precision).alias("#ap"),
    )
    area = ratio(F.col("#roc"), F.col("#P").cast("double") * F.col("#N"))
    return sums.select(area.alias("roc_auc"), ratio(F.col("#pr"), F.col("#P")).alias("pr_auc"), ratio(F.col("#ap"), F.col("#P")).alias("average_precision"))


def _probability(label: str, p: str) -> dict[str, Column]:
    y = F.col(label).cast("double")
    right = F.when(F.col(label), F.col(p)).otherwise(1 - F.col(p))
    return {
        "row_count": F.count("*"),
        "base_positive_rate": F.avg(y),
        "mean_predicted_probability": F.avg(p),
        "log_loss": F.avg(-F.log(F.least(F.greatest(right, F.lit(EPSILON)), F.lit(1 - EPSILON)))),
        "brier_score": F.avg(F.pow(F.col(p) - y, 2)),
    }


def probability_metrics(df: DataFrame, label: str, p: str) -> DataFrame:
    """One row: rows, base rate, mean prediction, log loss (clipped) and Brier score."""
    return df.agg(*(c.alias(n) for n, c in _probability(label, p).items()))


def _bins(df: DataFrame, by: str, label: str, p: str) -> DataFrame:
    out = df.groupBy(by).agg(F.count("*").alias("row_count"), F.min(p).alias("minimum_probability"), F.max(p).alias("maximum_probability"), F.avg(p).alias("mean_probability"), F.avg(F.col(label).cast("double")).alias("observed_rate"))
    out = out.withColumn("calibration_difference", F.col("observed_rate") - F.col("mean_probability"))
    return out.withColumn("absolute_calibration_difference", F.abs("calibration_difference"))


def calibration_count(df: DataFrame, label: str, p: str, key: str, tiles: int = 10) -> DataFrame:
    """Bins of equal row counts by rising probability, ties by the unique key."""
    return _bins(with_tiles(df, [F.col(p).asc(), F.col(key).asc()], tiles, "calibration_bin"), "calibration_bin", label, p)


def calibration_width(df: DataFrame, label: str, p: str, bins: int = 10) -> DataFrame:
    """Bins of equal width; empty bins are absent."""
    return _bins(df.withColumn("calibration_bin", equal_width_bin(F.col(p), bins)), "calibration_bin", label, p)


def calibration_error(bins: DataFrame) -> DataFrame:
    """One row: the row-weighted mean and the maximum of the bins' gaps. Only bins of one kind compare."""
    gap, n = F.col("absolute_calibration_difference"), F.col("row_count")
    return bins.agg(ratio(F.sum(n * gap), F.sum(n)).alias("expected_calibration_error"), F.max(gap).alias("maximum_calibration_gap"))


def _top(df: DataFrame, top: Column, label: str) -> DataFrame:
    y = F.col(label)
    counts = df.agg(F.count("*").alias("n"), F.count_if(y).alias("pos"), F.count_if(top).alias("k"), F.count_if(top & y).alias("hit"))
    c = F.col
    return counts.select(
        c("k").alias("top_row_count"),
        ratio(c("hit"), c("pos")).alias("top_decile_recall"),
        ratio(c("hit"), c("k")).alias("top_decile_precision"),
        ratio(ratio(c("hit"), c("k")), ratio(c("pos"), c("n"))).alias("top_decile_lift"),
    )


def top_tile(df: DataFrame, label: str, p: str, key: str, tiles: int = 10) -> DataFrame:
    """One row: recall, precision and lift of the first of ``tiles`` by falling probability."""
    return _top(with_tiles(df, [F.col(p).desc(), F.col(key).asc()], tiles, "risk_decile"), F.col("risk_decile") == 1, label)


def top_fraction(df: DataFrame, label: str, p: str, key: str, fraction: float = 0.1) -> DataFrame:
    """One row: the same of the max(1, ceil(fraction * n)) rows of highest probability."""
    total = df.agg(F.greatest(F.lit(1), F.ceil(F.count("*") * F.lit(fraction))).alias("#k"))
    ranked = global_rank(df, [F.col(p).desc(), F.col(key).asc()], "#rank").crossJoin(F.broadcast(total))  # one row
    return _top(ranked, F.col("#rank") <= F.col("#k"), label)


def summary(df: DataFrame, label: str, p: str, key: str, threshold: float) -> DataFrame:
    """One row: all of the above at a threshold that was chosen before.

    The rows are written once; counts and probability metrics come from one aggregate over
    them, curves and the sweep from their counted distinct scores.
    """
    rows = materialise(df.select(label, p, key), "scored")
    scores = materialise(distinct_scores(rows, label, p), "scores")
    at_half, chosen = _counts(label, F.col(p) >= F.lit(0.5)), _counts(label, F.col(p) >= F.lit(threshold))
    out = rows.agg(*(c.alias(f"#half_{n}") for n, c in at_half.items()), *(c.alias(n) for n, c in chosen.items()), *(c.alias(n) for n, c in _probability(label, p).items()))
    parts = [
        ranking_of_scores(scores),
        pr_auc_grid(sweep_scores(scores)),
        top_tile(rows, label, p, key).drop("top_row_count"),
        calibration_error(calibration_count(rows, label, p, key)),
    ]
    for part in parts:
        out = out.crossJoin(F.broadcast(part))  # one row each
    return out.select(
        *(c.alias(f"{n}_at_0_5") for n, c in _macro("#half_").items()),
        *_probability(label, p),
        *(c for part in parts for c in part.columns),
        F.lit(threshold).alias("selected_threshold"),
        *COUNTS,
        *(c.alias(f"selected_threshold_{n}") for n, c in _rates(ratio_or_zero).items()),
    )


def selection(df: DataFrame, label: str, p: str, day: str, model_name: str) -> DataFrame:
    """One row: the threshold of the best F1 on validation rows and what it was chosen on, to be frozen."""
    about = df.agg(F.min(day).cast("string").alias("validation_start_date"), F.max(day).cast("string").alias("validation_end_date"), F.count("*").alias("validation_row_count"), F.count_if(label).alias("validation_positive_count"))
    best = best_threshold(sweep(df, label, p)).select("threshold", F.col("f1_score").alias("validation_positive_f1"))
    named = [F.lit(model_name).alias("model_name"), F.lit("validation").alias("selection_split"), F.lit("positive_f1").alias("selection_metric")]
    return about.crossJoin(F.broadcast(best)).select(*named, *best.columns, *about.columns)  # one row each


def frozen_summary(df: DataFrame, label: str, p: str, key: str, record: DataFrame) -> DataFrame:
    """``summary`` at the threshold of a frozen record (see ``sinks.freeze``), which is never chosen again; adds the record's model name."""
    found = record.select("model_name", "threshold").limit(2).collect()  # one row
    if len(found) != 1:
        raise ValueError("a frozen record has one row")
    return summary(df, label, p, key, found[0]["threshold"]).withColumn("model_name", F.lit(found[0]["model_name"]))


def classify(df: DataFrame, p: str, threshold: float, model_name: str) -> DataFrame:
    """Adds is_high_risk, model_name and threshold."""
    return df.withColumns({"is_high_risk": F.col(p) >= F.lit(threshold), "model_name": F.lit(model_name), "threshold": F.lit(threshold)})


def score_summary(scored: DataFrame, entity: str = "member_id", day: str = "prediction_date", p: str = "risk_probability") -> DataFrame:
    """One row that describes a scoring output."""
    return scored.agg(
        F.count("*").alias("row_count"),
        F.count_distinct(entity).alias("member_count"),
        F.min(day).alias("minimum_prediction_date"),
        F.max(day).alias("maximum_prediction_date"),
        F.count_if("is_high_risk").alias("high_risk_count"),
        F.avg(F.col("is_high_risk").cast("double")).alias("high_risk_rate"),
        F.min(p).alias("minimum_probability"),
        F.max(p).alias("maximum_probability"),
        F.avg(p).alias("mean_probability"),
    )


def compare(summaries: dict[str, DataFrame], by: str = "pr_auc") -> DataFrame:
    """A row for each model, and whether it has the highest ``by`` (ties: the name that comes first)."""
    rows = None
    for name, row in sorted(summaries.items()):
        named = row.withColumn("model_name", F.lit(name))
        rows = named if rows is None else rows.unionByName(named)
    order = W.orderBy(F.desc(by), "model_name")  # a row for each model
    return rows.withColumn("is_chosen", F.row_number().over(order) == 1)
