"""Contracts, readers, sinks, splits and profiles."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import columns as fn
from tidewatch.functions.shared import shared_path
from tidewatch.operators import constraints, profile, splits
from tidewatch.sources import contracts, readers, sinks

NOW = dt.datetime(2025, 1, 1, tzinfo=dt.UTC)


def test_contract(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y bigint")
    want = contracts.schema("x string, y bigint")
    assert contracts.check(df, want) is df
    for other in ("y bigint, x string", "x string", "x string, y double"):
        with pytest.raises(contracts.ContractError):
            contracts.check(df, contracts.schema(other))
    assert contracts.fingerprint(want) != contracts.fingerprint(contracts.schema("y bigint, x string"))


def test_export_and_digest(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 0.5), (2, None, None), (2, None, None)], "i long, s string, d double")
    pq, text = sinks.export(df, str(tmp_path))
    back = readers.parquet(spark, pq, df.schema)
    assert readers.digest(back.repartition(3)) == readers.digest(df) != readers.digest(df.distinct())
    assert {r["status"] for r in profile.parity(back, readers.csv(spark, text, df.schema)).collect()} == {"PASS"}
    assert "FAIL" in {r["status"] for r in profile.parity(back, df.distinct()).collect()}


def test_metadata(spark, tmp_path):
    sinks.write_metadata(spark.createDataFrame([(1, None)], "b long, a string"), f"{tmp_path}/m")
    assert readers.metadata(spark, f"{tmp_path}/m", {"a", "b"}) == {"a": None, "b": 1}
    with pytest.raises(contracts.ContractError):
        readers.metadata(spark, f"{tmp_path}/m", {"a"})


def test_verified_write_publishes_nothing_on_failure(spark, tmp_path):
    def refuse(_):
        raise ValueError

    with pytest.raises(ValueError):
        sinks.write_verified(spark.range(3).toDF("i"), f"{tmp_path}/t", refuse)
    assert not (tmp_path / "t").exists()
    sinks.write_verified(spark.range(3).toDF("i"), f"{tmp_path}/t", lambda df: None)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3


def test_a_crash_while_publishing_loses_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_verified(spark.range(3).toDF("i"), path, lambda df: None)
    # The writer died after it had moved the old version aside.
    (tmp_path / "t").rename(tmp_path / "t.previous-x")
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    # It died before it deleted the old version.
    (tmp_path / "t.previous-y").mkdir()
    sinks.write_verified(spark.range(5).toDF("i"), path, lambda df: None)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if "previous" in p.name or "staging" in p.name] == []


def test_order_is_verified(spark, tmp_path):
    df = spark.range(40).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).repartition(3)
    pq, _ = sinks.export(df, f"{tmp_path}/sorted", ["a", "b"])
    assert [r["b"] for r in readers.positions(spark, pq).orderBy("position").collect()] == [r["b"] for r in df.orderBy("a", "b").collect()]
    df.write.parquet(f"{tmp_path}/plain")
    assert sinks.out_of_order(spark, f"{tmp_path}/plain", ["a", "b"]).count() > 0


def test_staging_tables(spark):
    contract = contracts.schema("k bigint, v string")
    with pytest.raises(ZeroDivisionError), sinks.staged_load(spark.createDataFrame([(1, "a")], contract), "load_t", "run_1", contract) as stage:
        assert stage.count() == 1
        raise ZeroDivisionError
    assert not spark.catalog.tableExists("load_t_stage_run_1")
    for bad in ("", "a b", "x;drop"):
        with pytest.raises(ValueError):
            sinks.staging_name("t", bad)


def test_a_shared_folder_is_needed_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default, set=lambda key, value: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_path(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")), "x")
    assert shared_path(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="local[2]")), "x")


def test_paths():
    sinks.distinct_paths("/a/b", "/a/c")
    for bad in (("/a", "/a/"), ("/a", "/a/b")):
        with pytest.raises(ValueError):
            sinks.distinct_paths(*bad)


def test_merge_and_evolution(spark):
    first, second = contracts.schema("k bigint, v string"), contracts.schema("k bigint, v string, w double")
    sinks.ensure_table(spark, "grow_t", first)
    sinks.merge_insert_only(spark.createDataFrame([(1, "a"), (2, "b")], first), "grow_t", ["k"], NOW)
    sinks.ensure_table(spark, "grow_t", second)
    sinks.merge_insert_only(spark.createDataFrame([(3, "c", 1.0)], second), "grow_t", ["k"], NOW)
    sinks.merge_insert_only(spark.createDataFrame([(2, "b")], first), "grow_t", ["k"], NOW)
    assert sorted((r["k"], r["w"]) for r in spark.table("grow_t").collect()) == [(1, None), (2, None), (3, 1.0)]
    with pytest.raises(sinks.ConflictError):
        sinks.merge_insert_only(spark.createDataFrame([(2, None)], first), "grow_t", ["k"], NOW)
    with pytest.raises(constraints.ConstraintError):
        sinks.merge_insert_only(spark.createDataFrame([(9, "x"), (9, "x")], first), "grow_t", ["k"], NOW)
    spark.sql("DROP TABLE grow_t")


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a", True), (1, "z", None), (None, None, False)], "k long, c string, f boolean")
    rules = [constraints.unique("k"), constraints.required("k", "c"), constraints.domain("c", "a"), constraints.flag_matches("f", F.col("c") == "a"), constraints.rate_between("rate", F.col("f"), 0.4, 0.6), *constraints.not_all_null("k", "c")]
    assert [r["violations"] for r in constraints.run(df, rules).collect()] == [1, 1, 2, 2, 0, 0, 0]
    with pytest.raises(constraints.ConstraintError, match="unique_k"):
        constraints.enforce(df, rules)
    assert constraints.differences(df, df).count() == 0 and constraints.missing_columns(df, ["k", "q"]) == ["q"]


def test_splits(spark):
    rows = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i), i % 2 == 0) for i in range(40)]
    cuts = splits.Cuts("2024-01-11", "2024-01-21", "2024-01-31", last="2024-02-05")
    df = splits.assign(spark.createDataFrame(rows, "e int, d date, y boolean"), "d", cuts)
    counts = {r["dataset_split"]: r["row_count"] for r in splits.report(df, "d", "e", "y").collect()}
    assert counts == {"train": 10, "validation": 10, "test": 10, "scoring": 6, "unassigned": 4}
    parts = splits.partition(df, "y")
    assert "y" not in parts["scoring"].columns and parts["train"].count() == 10
    assert splits.overlaps(splits.report(df, "d", "e", "y")).count() == 0


def test_safe_bool_and_blank(spark):
    df = spark.createDataFrame([("TRUE",), ("false",), ("1",), (" \t",), (None,)], "t string")
    out = df.select(fn.safe_bool(F.col("t")).alias("b"), fn.blank(F.col("t")).alias("e")).collect()
    assert [(r["b"], r["e"]) for r in out] == [(True, False), (False, False), (None, False), (None, True), (None, True)]


def test_records_and_keys(spark):
    a, b = spark.createDataFrame([(1, None)], "n long, s string"), spark.createDataFrame([(1, "x")], "n long, s string")
    assert [(r["field"], r["same"]) for r in constraints.same_fields(a, b).collect()] == [("n", True), ("s", False)]
    keys = constraints.same_keys(spark.range(5).toDF("k"), spark.range(3, 9).toDF("k"), ["k"]).first()
    assert tuple(keys) == (3, 4)
    with pytest.raises(contracts.ContractError):
        readers.model_frame(spark.createDataFrame([(1, 2)], "member_id long, y long"), "y", [], ["y"])


def test_scalars(spark):
    df = spark.createDataFrame([(0.3, "2024-01-01T00:00:00+08:00"), (float("nan"), "2024-01-01T00:00:00"), (1.0, "x")], "p double, t string")
    out = df.select(fn.is_probability(F.col("p")).alias("ok"), fn.equal_width_bin(F.col("p"), 10).alias("b"), fn.utc_timestamp(F.col("t")).isNotNull().alias("t"), fn.grid_step(F.col("p"), 10).alias("k")).collect()
    assert [r["ok"] for r in out] == [True, False, True] and [r["t"] for r in out] == [True, False, False]
    assert (out[0]["b"], out[2]["b"], out[0]["k"], out[2]["k"]) == (3, 9, 3, 10)
    arr = spark.sql("select array(named_struct('label', 'true', 'prob', 0.7D)) as a").select(fn.named_value(F.col("a"), "label", "true", "prob").alias("x"), fn.named_value(F.col("a"), "label", "no", "prob").alias("y")).first()
    assert (arr["x"], arr["y"]) == (0.7, None)


def test_freeze(spark, tmp_path):
    row = spark.createDataFrame([("m", 0.4)], "model_name string, threshold double")
    assert sinks.freeze(row, f"{tmp_path}/f").first()["threshold"] == 0.4
    assert sinks.freeze(row, f"{tmp_path}/f").count() == 1
    with pytest.raises(sinks.ConflictError):
        sinks.freeze(row.withColumn("threshold", F.lit(0.5)), f"{tmp_path}/f")


def test_rules_are_counted_while_writing(spark, tmp_path):
    rows = [(1, "a", 0.5), (2, "b", 1.0), (None, "b", 0.1)]
    df = spark.createDataFrame(rows, "k long, g string, p double")
    rules = [constraints.where("p_over_one", F.col("p") > 1), constraints.domain("g", "a", "b"), constraints.unique("k"), constraints.unique("g", "p")]
    path = f"{tmp_path}/t"
    assert sinks.write_observed(df, path, rules) == {"rows": 3, "p_over_one": 0, "domain_g": 0, "unique_k": 0, "unique_g_p": 0}
    for bad, name in (((4, "z", 0.2), "domain_g"), ((1, "a", 0.3), "unique_k")):
        with pytest.raises(constraints.ConstraintError, match=name):
            sinks.write_observed(df.unionByName(spark.createDataFrame([bad], df.schema)), path, rules)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_several_unique_keys_multiply_no_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", None), (2, "b", 1), (2, "b", 1)], "k long, g string, x long")
    rules = [constraints.unique("k"), constraints.unique("k", "g"), constraints.unique("x"), constraints.required("g")]
    found = constraints.run(df, rules)
    assert {r["constraint_name"]: (r["violations"], r["passed"]) for r in found.collect()} == {"unique_k": (2, False), "unique_k_g": (1, False), "unique_x": (2, False), "required_g": (0, True)}
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_merge_reads_touched_partitions(spark, tmp_path):
    contract = contracts.schema("day date, k bigint, v string")
    field = contracts.schema("day date")["day"]
    sinks.ensure_table(spark, "parted_t", contracts.schema("k bigint, v string"), field, f"{tmp_path}/parted")
    for d in (1, 2, 3):
        sinks.merge_insert_only(spark.createDataFrame([(dt.date(2024, 1, d), d, "v")], contract), "parted_t", ["day", "k"], NOW, partition="day")
    one = sinks.touched(spark.table("parted_t"), spark.createDataFrame([(dt.date(2024, 1, 2), 2, "v")], contract), "day")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and all("day=2024-01-02" in f for f in one.inputFiles())
    with pytest.raises(sinks.ConflictError):
        sinks.merge_insert_only(spark.createDataFrame([(dt.date(2024, 1, 2), 2, "w")], contract), "parted_t", ["day", "k"], NOW, partition="day")
    spark.sql("DROP TABLE parted_t")


def test_columns_and_paths(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert sorted(map(tuple, constraints.column_differences(df, ["a", "z"]).collect())) == [("b", "unexpected", 1), ("z", "missing", 0)]
    assert constraints.column_differences(df, ["a", "b"]).count() == 0
    pairs = spark.createDataFrame([("/a", "/a/"), ("/a", "/a/b"), ("/a/b", "/a"), ("/a", "/ab"), ("/x", "/y")], "p string, q string")
    assert [r[0] for r in pairs.select(fn.paths_clash(F.col("p"), F.col("q"))).collect()] == [True, True, True, False, False]
