"""Evaluation on hand-checked cases and against plain forms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import evaluation, ranking

SCHEMA = "y boolean, p double, k long"


def frame(spark, pairs):
    return spark.createDataFrame([(bool(y), float(p), i) for i, (y, p) in enumerate(pairs)], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return frame(spark, [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)])


@pytest.fixture(scope="module")
def random_pairs():
    rng = random.Random(7)
    return [(rng.random() < 0.3, round(rng.random(), 2)) for _ in range(500)] + [(1, 1.0), (0, 0.0)]


def test_confusion(small):
    row = evaluation.confusion(small, "y", "p", 0.5).first()
    assert [row[c] for c in ("true_negatives", "false_positives", "false_negatives", "true_positives")] == [2, 0, 1, 1]
    assert row["f1_score"] == pytest.approx(2 / 3)


def test_best_threshold_prefers_the_lower_on_ties(small):
    row = evaluation.best_threshold(evaluation.sweep(small, "y", "p")).first()
    assert (row["threshold"], row["f1_score"]) == (pytest.approx(0.101), pytest.approx(0.8))


def test_sweep_is_the_cross_join(spark, random_pairs):
    df = frame(spark, random_pairs)
    rows = evaluation.sweep(df, "y", "p").collect()
    assert len(rows) == 1001
    for r in rows[::50]:
        t = r["threshold"]
        assert r["true_positives"] == sum(1 for y, p in random_pairs if y and p >= t)
        assert r["false_positives"] == sum(1 for y, p in random_pairs if not y and p >= t)


def test_roc_area_counts_pairs(spark, random_pairs):
    pos, neg = [p for y, p in random_pairs if y], [p for y, p in random_pairs if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert evaluation.ranking_metrics(frame(spark, random_pairs), "y", "p").first()["roc_auc"] == pytest.approx(want)


def test_pr_area_is_anchored(spark):
    row = evaluation.ranking_metrics(frame(spark, [(1, 0.9), (0, 0.9), (1, 0.2), (0, 0.2)]), "y", "p").first()
    assert row["pr_auc"] == pytest.approx(0.625)
    assert row["average_precision"] == pytest.approx(0.5)


def test_top_decile(spark):
    df = frame(spark, [(i >= 16, i / 20) for i in range(20)])
    row = evaluation.top_fraction(df, "y", "p", "k").first()
    assert (row["top_row_count"], row["top_decile_recall"], row["top_decile_lift"]) == (2, 0.5, 5.0)


def test_calibration(spark):
    df = frame(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)])
    row = evaluation.calibration_error(evaluation.calibration_width(df, "y", "p", 2)).first()
    assert row["expected_calibration_error"] == pytest.approx(0.15)
    assert row["maximum_calibration_gap"] == pytest.approx(0.15)


def test_log_loss_is_clipped(spark):
    row = evaluation.probability_metrics(frame(spark, [(1, 0.0), (0, 0.5)]), "y", "p").first()
    assert row["log_loss"] == pytest.approx((-math.log(2.220446049250313e-16) + math.log(2)) / 2)


@pytest.mark.parametrize("n", [3, 10, 23, 100])
def test_tiles_are_ntile(spark, n):
    from pyspark.sql import Window as W

    df = spark.range(n).withColumn("v", F.col("id") % 7)
    want = df.withColumn("t", F.ntile(10).over(W.orderBy("v", "id"))).select("id", "t")
    got = ranking.with_tiles(df, [F.col("v").asc(), F.col("id").asc()], 10, "t").select("id", F.col("t").cast("int").alias("t"))
    assert got.exceptAll(want).count() == 0 and got.count() == n


def test_scores_that_are_no_probabilities_are_errors(spark):
    for p in (1.2, -0.1, float("nan")):
        with pytest.raises(Exception, match="from 0 to 1"):
            evaluation.sweep(frame(spark, [(1, 0.5), (0, p)]), "y", "p").collect()


def test_quantiles_are_exact(spark, random_pairs):
    df = frame(spark, random_pairs).withColumn("q", F.when(F.col("k") % 3 == 0, F.col("k")))
    want = df.agg(*(F.percentile(c, F.lit(q)).alias(f"{c}{i}") for c in ("p", "q") for i, q in enumerate((0.01, 0.5, 0.99)))).first()
    for r in ranking.quantiles(df.withColumn("none", F.lit(None).cast("double")), ["q", "p", "none"], [0.01, 0.5, 0.99]).collect():
        assert [r[f"q{i}"] for i in range(3)] == [pytest.approx(want[f"{r['column_name']}{i}"]) for i in range(3)]


def test_frozen_summary_takes_the_record(spark, random_pairs):
    df = frame(spark, random_pairs)
    record = spark.createDataFrame([("m", 0.25)], "model_name string, threshold double")
    row = evaluation.frozen_summary(df, "y", "p", "k", record).first()
    assert row["selected_threshold"] == 0.25 and row["model_name"] == "m"
    want = evaluation.confusion(df, "y", "p", 0.25).first()
    assert row["true_positives"] == want["true_positives"] and row["selected_threshold_precision"] == want["precision"]
    with pytest.raises(ValueError):
        evaluation.frozen_summary(df, "y", "p", "k", record.limit(0))
