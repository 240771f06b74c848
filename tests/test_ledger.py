"""Commits of several tables and of several writers."""

import datetime as dt
import threading

import pytest

from tidewatch.operators import constraints
from tidewatch.sources import contracts, ledger, sinks

NOW = dt.datetime(2024, 1, 2, tzinfo=dt.UTC)
A = contracts.schema("day date, k bigint, v string")
B = contracts.schema("run string, n bigint")


def made(spark, root):
    return ledger.Ledger(spark, str(root), {"a": ledger.Spec(A, ("day", "k"), "day"), "b": ledger.Spec(B, ("run",))})


def rows_a(spark, *rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), k, v) for d, k, v in rows], A)


def rows_b(spark, *rows):
    return spark.createDataFrame(list(rows), B)


def test_two_tables_one_version(spark, tmp_path):
    one = made(spark, tmp_path)
    assert one.version() == 0 and one.read("a").count() == 0
    assert one.commit({"a": rows_a(spark, (1, 1, "x"), (2, 1, None)), "b": rows_b(spark, ("r1", 2))}, NOW) == 1
    assert one.commit({"a": rows_a(spark, (1, 1, "x"), (3, 9, "z")), "b": rows_b(spark, ("r2", 1))}, NOW) == 2
    assert one.commit({"a": rows_a(spark, (3, 9, "z"))}, NOW) == 2  # nothing new
    seen = lambda v=None: sorted((r["day"].day, r["k"], r["v"]) for r in one.read("a", v).collect())
    assert seen(1) == [(1, 1, "x"), (2, 1, None)] and seen() == [(1, 1, "x"), (2, 1, None), (3, 9, "z")]
    assert {r["run"] for r in one.read("b").collect()} == {"r1", "r2"} and one.read("b", 1).count() == 1
    with pytest.raises(sinks.ConflictError):
        one.commit({"b": rows_b(spark, ("r3", 1)), "a": rows_a(spark, (2, 1, "now known"))}, NOW)
    with pytest.raises(constraints.ConstraintError):
        one.commit({"b": rows_b(spark, ("r3", 1), ("r3", 1))}, NOW)
    assert one.version() == 2 and one.read("b").count() == 2


def test_only_touched_partitions_are_read(spark, tmp_path):
    one = made(spark, tmp_path)
    for d in (1, 2, 3):
        one.commit({"a": rows_a(spark, *((d, k, "v") for k in range(20)))}, NOW)
    part = one.read("a", partitions=["2024-01-02"])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan
    assert len(part.inputFiles()) < len(one.read("a").inputFiles()) and all("day=2024-01-02" in f for f in part.inputFiles())
    assert part.count() == 20


def test_two_writers_one_wins(spark, tmp_path):
    won, lost = [], []

    def write(value):
        try:
            won.append(made(spark, tmp_path).commit({"a": rows_a(spark, (1, 1, value)), "b": rows_b(spark, (value, 1))}, NOW))
        except sinks.ConflictError:
            lost.append(value)

    threads = [threading.Thread(target=write, args=(v,)) for v in ("x", "y", "z")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    one = made(spark, tmp_path)
    assert len(won) == 1 and len(lost) == 2 and one.version() == 1
    assert one.read("a").count() == 1 and one.read("b").first()["run"] == one.read("a").first()["v"]


def test_writers_of_other_keys_all_commit(spark, tmp_path):
    threads = [threading.Thread(target=lambda k=k: made(spark, tmp_path).commit({"a": rows_a(spark, (k % 2 + 1, k, "v"))}, NOW)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    one = made(spark, tmp_path)
    assert one.version() == 4 and one.read("a").count() == 4


def test_crash_between_tables_shows_nothing(spark, tmp_path, monkeypatch):
    one = made(spark, tmp_path)
    one.commit({"b": rows_b(spark, ("r1", 1))}, NOW)
    real = ledger.Ledger._written

    def dies(self, table, rows, at):
        if table == "b":
            raise OSError("lost")
        return real(self, table, rows, at)

    monkeypatch.setattr(ledger.Ledger, "_written", dies)
    with pytest.raises(OSError, match="lost"):
        one.commit({"a": rows_a(spark, (1, 1, "x")), "b": rows_b(spark, ("r2", 1))}, NOW)
    monkeypatch.undo()
    assert one.version() == 1 and one.read("a").count() == 0 and one.read("b").count() == 1
    assert one.vacuum(3600) == [] and len(one.vacuum(-3600)) == 1
    assert one.commit({"a": rows_a(spark, (1, 1, "x")), "b": rows_b(spark, ("r2", 1))}, NOW) == 2
    assert one.vacuum(-3600) == [] and one.read("a").count() == 1


def test_summaries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "SUMMARY", 2)
    one = made(spark, tmp_path)
    for k in range(5):
        one.commit({"b": rows_b(spark, (f"r{k}", k))}, NOW)
    assert [one.read("b", v).count() for v in (1, 2, 3, 4, 5)] == [1, 2, 3, 4, 5]
    reads = []
    real = ledger.Ledger._read
    monkeypatch.setattr(ledger.Ledger, "_read", lambda self, v: reads.append(v) or real(self, v))
    assert len(one.parts()) == 5 and reads == [5, 4]
