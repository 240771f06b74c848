"""Conflict-constrained best-fit packing.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt by hash to shards of
about ``shard_items``, so that one source or one group of copies is spread over all shards (rows that
are equal in everything are numbered first, so they are spread too),
and each shard is packed on its own, longest piece first. A shard's bins are ordered by
residual and carry bitmaps of the sources and duplicate clusters they hold; the search goes
from the smallest sufficient residual upwards until a bin without conflict is found, else a
bin is opened. No bin holds two pieces of one source or of one cluster (pieces of full
capacity fill bins of their own).

Cases: a null source or cluster conflicts with none; a null or negative length counts as 0,
and such pieces are packed like others; pieces of equal length are packed in the order of id,
piece, source and cluster; very long documents fill bins of their own and leave a last piece; repeated rows are packed as several pieces; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

CAPACITY = 2_048
SHARD_ITEMS = 4_096
#: Equal rows that one task numbers.
COPIES = 4_096


def pack(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each piece; pieces come longest first."""
    number: dict = {}
    bit = lambda kind, x: 0 if x is None else 1 << number.setdefault((kind, x), len(number))
    residual, held = [], []
    by_residual: dict[int, list[int]] = defaultdict(list)
    present = 0  # a bit for each residual that some bin has
    chosen = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        own = bit("source", source) | bit("cluster", cluster)
        found, above = -1, present >> length
        at = length
        while above:
            low = (above & -above).bit_length() - 1
            at, above = at + low, above >> low
            found = next((b for b in by_residual[at] if not held[b] & own), -1)
            if found >= 0:
                break
            at, above = at + 1, above >> 1
        if found < 0:
            found, at = len(residual), capacity
            residual.append(capacity)
            held.append(0)
        else:
            by_residual[at].remove(found)
            if not by_residual[at]:
                present ^= 1 << at
        residual[found] = at - length
        held[found] |= own
        by_residual[at - length].append(found)
        present |= 1 << (at - length)
        chosen.append(found)
    return chosen


def pack_documents(
    df: DataFrame, id_col: str, length_col: str, source_col: str, cluster_col: str, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS
) -> DataFrame:
    """One row for each piece: id, piece, start, length, source, bin_id, bin_position, bin_used."""
    length = F.greatest(F.coalesce(F.col(length_col).cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))
    items = df.select(F.col(id_col).alias("id"), length.alias("total"), F.col(source_col).alias("source"), F.col(cluster_col).alias("cluster"))
    # Equal rows are counted, then numbered in blocks that are dealt out, however many there are.
    items = stored(items.groupBy("id", "total", "source", "cluster").agg(F.count("*").alias("n")), "packing-items")
    last = F.greatest(F.floor((F.col("total") - 1) / capacity), F.lit(0)).cast("long")
    shards = max(1, -(-(items.agg(F.sum((last + 1) * F.col("n"))).first()[0] or 0) // shard_items))
    once = items.filter("n = 1").select("*", F.lit(0).cast("long").alias("copy"))
    more = items.filter("n > 1").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))).alias("block"))
    more = more.repartition("id", "source", "cluster", "block").select("*", F.explode(F.sequence(F.col("block") * COPIES, F.least((F.col("block") + 1) * COPIES, F.col("n")) - 1)).alias("copy"))
    items = once.unionByName(more.drop("block")).select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * capacity
    items = items.select("id", "piece", start.alias("start"), F.least(F.lit(capacity).cast("long"), F.col("total") - start).alias("length"), "source", "cluster", "copy")
    items = items.withColumn("shard", F.pmod(F.xxhash64("id", "piece", "source", "length", "cluster", "copy"), F.lit(shards)).cast("long")).drop("copy")

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("id", "ascending"), ("piece", "ascending"), ("source", "ascending"), ("cluster", "ascending")])
        lengths = rows["length"].to_pylist()
        bins = pack(lengths, rows["source"].to_pylist(), rows["cluster"].to_pylist(), capacity)
        used, position = [0] * len(bins), []
        count = [0] * len(bins)
        for b, n in zip(bins, lengths, strict=True):
            position.append(count[b])
            count[b] += 1
            used[b] += n
        first = rows["shard"][0].as_py() << 32
        made = {"bin_id": [first + b for b in bins], "bin_position": position, "bin_used": [used[b] for b in bins]}
        for name, values in made.items():
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        return rows.select(["id", "piece", "start", "length", "source", *made])

    types = {f.name: f.dataType.simpleString() for f in items.schema}
    schema = f"id {types['id']}, piece long, start long, length long, source {types['source']}, bin_id long, bin_position long, bin_used long"
    return items.groupBy("shard").applyInArrow(run, schema).withColumnRenamed("id", id_col)
