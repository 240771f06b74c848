"""Profiles of a small dataset."""

import datetime as dt
import random

import numpy as np
import pytest

from tidewatch.operators import profile, ranking

D = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def df(spark):
    rows = [("a", D, 1.0, True, "x"), ("a", D + dt.timedelta(days=1), None, None, "y"), ("b", D, 3.0, False, None)]
    return spark.createDataFrame(rows, "e string, d date, v double, f boolean, c string")


def test_sections(df):
    made = profile.report(df, "e", "d", "f", ["v"], ["c"], ["f"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 2
    out = {(r["section"], r["item"]): (r["row_count"], r["value"]) for r in made.collect()}
    assert len(out) == made.count()
    day = (D - dt.date(1970, 1, 1)).days
    assert (out["shape", "rows"], out["shape", "entities"], out["shape", "first_day"], out["shape", "last_day"]) == ((3, None), (2, None), (None, day), (None, day + 1))
    assert (out["rows_of_entity", "minimum"], out["rows_of_entity", "maximum"]) == ((1, None), (2, None))
    assert [round(out["null_rate", c][1], 3) for c in "edvfc"] == [0, 0, 0.333, 0.333, 0.333]
    assert (out["flag_rate", "f"], out["label", "all"], out["mean", "v"], out["maximum", "v"]) == ((None, pytest.approx(1 / 3)), (3, 0.5), (2, 2.0), (2, 3.0))
    assert (out["entities_by_c", "x"], out["entities_by_c", None], out["label_by_c", "x"], out["label_by_c", None]) == ((1, None), (1, None), (1, 1.0), (1, 0.0))


def test_quantiles_by_refinement(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(rng.gauss(0, 1e6), float(rng.randrange(3)), rng.choice([None, -7.5]), rng.lognormvariate(0, 8) * rng.choice([-1, 1]), None, 1.0 + i * 1e-9) for i in range(3000)]
    names = ["a", "b", "c", "d", "none", "near"]
    df = spark.createDataFrame([*rows, (0.0, 0.0, 0.0, -0.0, None, 1.0)], ", ".join(f"{c} double" for c in names)).repartition(4)
    at = [0.0, 0.01, 0.25, 0.5, 1 / 3, 0.99, 1.0]
    for values in (100_000, 50):  # the second time cells are cut again and again
        monkeypatch.setattr(ranking, "VALUES", values)
        found = {r["column_name"]: list(r)[1:] for r in ranking.quantiles(df, names, at).collect()}
        assert set(found) == set(names) - {"none"}
        for i, c in enumerate(names):
            if c != "none":
                have = [r[i] for r in [*rows, (0.0, 0.0, 0.0, -0.0, None, 1.0)] if r[i] is not None]
                assert found[c] == pytest.approx(np.quantile(have, at).tolist(), rel=1e-12)
    assert ranking.quantiles(df.limit(0), names, at).count() == 0


def test_percentiles(spark):
    values = spark.range(1, 101).toDF("v")
    exact = profile.describe(values, ["v"]).first()
    assert (exact["p01"], exact["p50"], exact["p99"]) == pytest.approx((1.99, 50.5, 99.01))
    near = profile.describe(values, ["v"], accuracy=1000).first()
    assert abs(near["p50"] - 50.5) <= 1
