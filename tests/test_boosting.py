"""Boosted trees against trees grown on all rows by plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import boosting, evaluation


def plain_tree(bins, g, h, s):
    """Best-first growth on the rows themselves."""
    worth = lambda r: (g[r].sum() / boosting.UNIT) ** 2 / (h[r].sum() / boosting.UNIT + s.penalty)

    def best(rows):
        found = (0.0, None, None)
        for j in range(bins.shape[1]):
            for b in range(int(bins[:, j].max())):
                left, right = rows[bins[rows, j] <= b], rows[bins[rows, j] > b]
                if min(len(left), len(right)) < s.rows_in_leaf or min(h[left].sum(), h[right].sum()) < boosting.CURVATURE * boosting.UNIT:
                    continue
                gain = worth(left) + worth(right) - worth(rows)
                if gain > found[0] * (1 + 1e-12):
                    found = (gain, j, b)
        return found

    leaves = [(np.arange(len(bins)), best(np.arange(len(bins))))]
    while len(leaves) < s.leaves and max(f[0] for _, f in leaves) > 0:
        k = max(range(len(leaves)), key=lambda i: leaves[i][1][0])
        rows, (_, j, b) = leaves.pop(k)
        for part in (rows[bins[rows, j] <= b], rows[bins[rows, j] > b]):
            leaves.append((part, best(part)))
    value = np.zeros(len(bins))
    for rows, _ in leaves:
        value[rows] = -s.rate * (g[rows].sum() / boosting.UNIT) / (h[rows].sum() / boosting.UNIT + s.penalty)
    return value, len(leaves)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    made = []
    for i in range(1500):
        x, z, w = rng.gauss(0, 1), rng.choice([0.0, 1.0]), rng.randrange(6)
        made.append((i, x, z, float(w), 7.0, (x > 0.2) ^ (w > 3 and z > 0) if rng.random() < 0.9 else rng.random() < 0.5))
    return spark.createDataFrame([*made, (9000, 0.0, 0.0, 0.0, 7.0, None)], "i long, x double, z double, w double, k double, y boolean").repartition(5)


def test_same_trees_as_plain(spark, rows, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    s = boosting.Settings(rate=0.3, rounds=5, leaves=7, rows_in_leaf=40)
    columns = ["x", "z", "w", "k"]
    model = boosting.fit(rows, "y", columns, s, bins=16)
    assert [len(c) for c in model.cuts][3] == 1 and len(model.trees) == 5
    data = rows.filter("y is not null").orderBy("i").toPandas()
    bins = np.stack([np.searchsorted(c, data[name].to_numpy(), side="left") for name, c in zip(columns, model.cuts, strict=True)], axis=1)
    score = np.full(len(data), math.log(data["y"].astype(float).mean() / (1 - data["y"].astype(float).mean())))
    for tree in model.trees:
        value, leaves = plain_tree(bins, *boosting.gradients(score, data["y"].to_numpy(float)), s)
        assert sum(n.column < 0 for n in tree) == leaves <= 7
        assert all(n.rows >= 40 for n in tree)
        score = score + value
    got = boosting.predict(boosting.Trees.from_json(model.to_json()), rows, "p").filter("y is not null").orderBy("i").toPandas()
    assert list(got.columns) == ["i", "x", "z", "w", "k", "y", "p"]
    assert np.allclose(got["p"], 1 / (1 + np.exp(-score)), atol=1e-12)
    assert evaluation.ranking_metrics(boosting.predict(model, rows, "p").filter("y is not null"), "y", "p").first()["roc_auc"] > 0.85


def test_partitions_do_not_matter(rows):
    s = boosting.Settings(rounds=2)
    one, other = (boosting.fit(rows.repartition(n), "y", ["x", "w"], s).to_json() for n in (1, 7))
    assert one == other


def test_one_label_and_none(rows):
    only = rows.withColumn("y", F.lit(True))
    model = boosting.fit(only, "y", ["x"], boosting.Settings(rounds=2))
    assert [len(t) for t in model.trees] == [1, 1]
    assert boosting.predict(model, only, "p").agg(F.min("p")).first()[0] > 0.999
    with pytest.raises(ValueError):
        boosting.fit(rows.withColumn("y", F.lit(None).cast("boolean")), "y", ["x"])


def test_equal_rows_stand_as_one(spark, rows):
    held = boosting.binned(rows.filter("y is not null").select(F.col("y").cast("double").alias("label"), "w", "z"), ["w", "z"], [[0.0, 2.0], [0.0]])
    found = boosting._counted(held).toPandas()
    assert len(found) <= 12 and found["n"].sum() == 1500
