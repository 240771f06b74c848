"""Insert-only tables whose changes are committed together, by several writers.

A ledger is a folder with a log and a folder of Parquet files for each table. A commit first writes its rows of every table to new
folders, which nobody reads yet, and then one entry of the log that names them all. The entry of the next number is created
only if it doesn't exist, as one step: of two writers that see the same version exactly one commits, and the other
looks at what came in between and tries again (stores whose rename isn't one step need another such step). Readers take a version's entries and read the folders these
name, so they see all tables as of one commit or of another, never one table ahead of the other. What a writer that died has left is read by nobody; ``vacuum`` deletes it.

Inserting a stored key again is no change if all its values are equal, else an error, whoever stored it. A source is compared
only with the partitions that its own rows fall in, and only with commits that touched these: entries list
their partitions, and folders are partitioned. A table's partition column therefore has to follow from its key.

The driver reads the log (an entry for each commit; every ``SUMMARY`` entries one of them lists all before it) and a source's distinct partitions, at most ``PARTITIONS``.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import differs
from tidewatch.functions.shared import materialise
from tidewatch.operators import constraints
from tidewatch.sources import contracts
from tidewatch.sources.sinks import INGESTED, ConflictError, _files

#: Partitions of one source at most, commits between two summaries, and tries of a commit.
PARTITIONS, SUMMARY, TRIES = 10_000, 50, 100


@dataclass(frozen=True)
class Spec:
    """A table: its columns, its key and the column that parts it, which follows from the key."""

    columns: T.StructType
    key: tuple[str, ...]
    partition: str | None = None

    @property
    def stored(self) -> T.StructType:
        """The columns as stored."""
        return T.StructType([*self.columns.fields, INGESTED])


@dataclass(frozen=True)
class Part:
    """The rows that one commit added to one table."""

    table: str
    folder: str
    partitions: tuple[str, ...]
    rows: int


class Ledger:
    """The tables ``specs`` under ``root``."""

    def __init__(self, spark: SparkSession, root: str, specs: dict[str, Spec]) -> None:
        self.spark, self.root, self.specs = spark, root.rstrip("/"), specs

    # The log.

    def _entry(self, version: int) -> str:
        return f"{self.root}/log/{version:020d}.json"

    def _numbers(self) -> list[int]:
        files, make = _files(self.spark, self.root)
        names = [s.getPath().getName() for s in files.globStatus(make(f"{self.root}/log/*.json")) or []]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _read(self, version: int) -> dict:
        files, make = _files(self.spark, self.root)
        stream = files.open(make(self._entry(version)))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _create(self, version: int, entry: dict) -> bool:
        """Create an entry whole, as one step; false if that number is taken."""
        files, make = _files(self.spark, self.root)
        draft = make(f"{self.root}/log/.{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
        stream.close()
        target = make(self._entry(version))
        try:
            if files.getScheme() == "file":
                # A local rename would replace the target; a link doesn't.
                os.link(draft.toUri().getPath(), target.toUri().getPath())
                return True
            return bool(files.rename(draft, target))
        except FileExistsError:
            return False
        finally:
            files.delete(draft, False)

    def version(self) -> int:
        """The number of the last commit; 0 before the first."""
        return max(self._numbers(), default=0)

    def parts(self, version: int | None = None) -> list[Part]:
        """What the tables consist of as of a version."""
        upto = self.version() if version is None else version
        found: list[Part] = []
        for n in range(upto, 0, -1):
            entry = self._read(n)
            found += [Part(p["table"], p["folder"], tuple(p["partitions"]), p["rows"]) for p in entry["parts"]]
            if "before" in entry:
                found += [Part(p["table"], p["folder"], tuple(p["partitions"]), p["rows"]) for p in entry["before"]]
                break
        return found

    # Reading.

    def read(self, table: str, version: int | None = None, partitions: list[str] | None = None, parts: list[Part] | None = None) -> DataFrame:
        """A table as of a version, or only the given partitions of it."""
        spec = self.specs[table]
        own = [p for p in (self.parts(version) if parts is None else parts) if p.table == table and p.rows]
        if partitions is not None and spec.partition:
            own = [p for p in own if set(p.partitions) & set(partitions)]
        if not own:
            return self.spark.createDataFrame([], spec.stored)
        reader = self.spark.read.schema(T.StructType([f for f in spec.stored if f.name != spec.partition] + ([spec.columns[spec.partition]] if spec.partition else [])))
        rows = reader.option("basePath", f"{self.root}/{table}").parquet(*sorted(f"{self.root}/{table}/commit={p.folder}" for p in own))
        if partitions is not None and spec.partition:
            kind = spec.columns[spec.partition].dataType
            rows = rows.filter(F.col(spec.partition).isin([F.lit(p).cast(kind) for p in partitions]))
        return rows.select(*spec.stored.names)

    # Writing.

    def _partitions(self, table: str, rows: DataFrame) -> list[str]:
        column = self.specs[table].partition
        if not column:
            return []
        found = [r[0] for r in rows.select(F.col(column).cast("string")).distinct().limit(PARTITIONS + 1).collect()]
        if len(found) > PARTITIONS or None in found:
            raise contracts.ContractError(f"{table}: {column} has nulls or over {PARTITIONS} values in one commit")
        return sorted(found)

    def _fresh(self, table: str, source: DataFrame, touched: list[str], parts: list[Part]) -> DataFrame:
        """The source's rows whose keys none of ``parts`` holds; an error if one is held with other values. The target is read once."""
        spec = self.specs[table]
        target = self.read(table, partitions=touched if spec.partition else None, parts=parts)
        compared = [c for c in spec.columns.names if c not in spec.key]
        held = target.select(*spec.key, *(F.col(c).alias(f"#{c}") for c in compared), F.lit(True).alias("#held"))
        changed = F.lit(False)
        for c in compared:
            changed |= differs(F.col(c), F.col(f"#{c}"))
        both = source.join(held, list(spec.key), "left").withColumns({"#changed": F.col("#held").isNotNull() & changed})
        both = materialise(both.select(*spec.columns.names, "#held", "#changed"), "ledger-rows")
        if not both.filter("`#changed`").isEmpty():
            raise ConflictError(f"{table}: a stored key has other values")
        return both.filter("`#held` is null").select(*spec.columns.names)

    def _written(self, table: str, rows: DataFrame, ingested_at: datetime) -> Part:
        spec, folder = self.specs[table], uuid.uuid4().hex
        stamped = rows.withColumn("ingested_at", F.lit(ingested_at.astimezone(UTC)).cast("timestamp")).select(*spec.stored.names)
        path = f"{self.root}/{table}/commit={folder}"
        # A partition's rows come together, and large ones are split by size.
        writer = (stamped.hint("rebalance", spec.partition) if spec.partition else stamped).write
        (writer.partitionBy(spec.partition) if spec.partition else writer).parquet(path)
        back = self.spark.read.schema(spec.stored).parquet(path)
        return Part(table, folder, tuple(self._partitions(table, back)), back.count())

    def commit(self, rows: dict[str, DataFrame], ingested_at: datetime, info: dict[str, str] | None = None) -> int:
        """Insert rows of one or more tables in one commit; the version that has them.

        Nothing is committed if no row is new. Sources are written once, so that what is checked is what is stored.
        """
        sources = {t: materialise(contracts.conform(df, self.specs[t].columns), "ledger-source") for t, df in rows.items()}
        touched = {}
        for t, df in sources.items():
            constraints.enforce(df, [constraints.unique(*self.specs[t].key), constraints.required(*self.specs[t].key)])
            touched[t] = self._partitions(t, df)
        base, known = 0, []
        for _ in range(TRIES):
            version = self.version()
            if version > base:
                parts = self.parts(version)
                later = [p for p in parts if p not in known]
                # What was new before is compared with what came in between only.
                sources = {t: self._fresh(t, df, touched[t], later) for t, df in sources.items()}
                base, known = version, parts
            written = [p for p in (self._written(t, df, ingested_at) for t, df in sources.items()) if p.rows]
            if not written:
                return version
            entry = {"parts": [vars(p) for p in written], "info": info or {}, "committed_at": time.time()}
            if (version + 1) % SUMMARY == 0:
                entry["before"] = [vars(p) for p in known]
            self._made()
            if self._create(version + 1, entry):
                return version + 1
        raise OSError(f"{self.root}: no commit in {TRIES} tries")

    def _made(self) -> None:
        files, make = _files(self.spark, self.root)
        files.mkdirs(make(f"{self.root}/log"))

    def vacuum(self, older_than_seconds: float) -> list[str]:
        """Delete folders that no entry names and that are older than any commit under way; which ones."""
        files, make = _files(self.spark, self.root)
        named = {(p.table, p.folder) for p in self.parts()}
        gone = []
        for t in self.specs:
            for s in files.globStatus(make(f"{self.root}/{t}/commit=*")) or []:
                folder = s.getPath().getName().removeprefix("commit=")
                if (t, folder) not in named and s.getModificationTime() / 1000 < time.time() - older_than_seconds:
                    files.delete(s.getPath(), True)
                    gone.append(f"{t}/{folder}")
        return gone


def warehouse(spark: SparkSession, root: str) -> Ledger:
    """The ledger of runs and of their decisions, these parted by the month of their day."""
    month = T.StructField("prediction_month", T.DateType())
    return Ledger(spark, root, {
        "runs": Spec(contracts.RUNS, ("run_id",)),
        "decisions": Spec(T.StructType([*contracts.DECISIONS.fields, month]), ("run_id", "member_id", "prediction_date"), "prediction_month"),
    })


def load_run(ledger: Ledger, run: DataFrame, decisions: DataFrame, ingested_at: datetime) -> int:
    """Commit a run's row and its decisions together; an error unless the counts add up. Loading a run again changes nothing."""
    one = contracts.conform(run, contracts.RUNS)
    rows = materialise(contracts.conform(decisions, contracts.DECISIONS).withColumn("prediction_month", F.trunc("prediction_date", "month")), "ledger-decisions")
    row = one.first()
    total = sum(row[c] for c in ("superseded_count", "below_threshold_count", "excluded_count", "suppressed_count", "eligible_count"))
    if total != row["source_row_count"] or rows.count() != total:
        raise contracts.ContractError("the run's counts don't add up to its decisions")
    return ledger.commit({"decisions": rows, "runs": one}, ingested_at, {"run_id": row["run_id"]})
