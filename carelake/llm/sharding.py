"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A ring of ``CELLS`` cells carries ``vnodes`` virtual nodes per shard.  A key
hashes to a cell and belongs to the first virtual node at or after it; a shard
takes at most its capacity, and keys that find it full continue clockwise to
the next virtual node whose shard has room.  Capacities are the row count
divided by the shards, the remainder going to the first shards, so counts are
at most one apart (law ``rows``) and only overflowing keys leave their home.

The walk is decided on counts per cell (at most ``CELLS`` numbers, whatever
the input), not on rows.  A row's place is its rank among the rows of its
cell: a window per cell over hashed keys, never over one hot key, because
equal rows are counted first and expanded at the end.

Defined results: a null key hashes like any value; a null text has size 8 and
a null checksum; equal rows get neighbouring slots; an empty table gives no
rows; other columns of the input are ignored.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut, explode_count, prepare, table
from .registry import register

CELLS = 1 << 16


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells and shards of the virtual nodes, clockwise."""
    at = []
    for s in range(shards):
        for v in range(vnodes):
            h = int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big")
            at.append((h % CELLS, h, s))
    at.sort()
    return np.array([x[0] for x in at]), np.array([x[2] for x in at])


def assign(cells: np.ndarray, counts: np.ndarray, shards: int, vnodes: int) -> pd.DataFrame:
    """Where the rows of each cell go: (cell, lo, hi, shard, slot) says that the
    rows with ranks [lo, hi) in the cell take the slots from ``slot`` on.

    ``cells``/``counts`` are the non-empty cells; the result has at most one
    row more per (virtual node, shard) than there are cells."""
    at, owner = ring(shards, vnodes)
    arc = np.searchsorted(at, cells) % len(at)
    # cells past the last virtual node wrap to the first one and come first there
    order = np.lexsort((cells, (cells <= at[-1]).astype(int), arc))
    cells, counts, arc = cells[order], counts[order], arc[order]
    total = int(counts.sum())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    load = [0] * shards
    left = np.bincount(arc, weights=counts, minlength=len(at)).astype(np.int64)
    done = [0] * len(at)
    pieces: dict[int, list] = {}
    waiting, hop = [int(a) for a in np.flatnonzero(left)], 0
    while waiting:
        still = []
        for a in waiting:
            s = int(owner[(a + hop) % len(at)])
            n = min(int(left[a]), room[s] - load[s])
            if n > 0:
                pieces.setdefault(a, []).append((done[a], done[a] + n, s, load[s]))
                done[a] += n
                load[s] += n
                left[a] -= n
            if left[a]:
                still.append(a)
        waiting, hop = still, hop + 1
    rows, base, k = [], {}, {}
    for c, n, a in zip(cells.tolist(), counts.tolist(), arc.tolist()):
        lo = base.get(a, 0)
        i, mine = k.get(a, 0), pieces[a]
        while i < len(mine) and mine[i][0] < lo + n:
            p0, p1, s, slot = mine[i]
            f, t = max(p0, lo), min(p1, lo + n)
            rows.append((c, f - lo, t - lo, s, slot + f - p0))
            if p1 > lo + n:
                break
            i += 1
        base[a], k[a] = lo + n, i
    return pd.DataFrame(rows, columns=["cell", "lo", "hi", "shard", "slot0"])


def ring_shards(rows: DataFrame, keys: list[str], by: list[str], shards: int, vnodes: int = 128) -> DataFrame:
    """``keys`` + ``by`` of every row, with ``shard`` int and ``slot`` long
    (gapless from 0 in a shard).  ``keys`` decide the place on the ring."""
    spark = rows.sparkSession
    cols = [*keys, *[c for c in by if c not in keys]]
    groups = (rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_rows"))
              .withColumn("_at", F.xxhash64(*keys))
              .withColumn("_cell", F.pmod(F.col("_at"), F.lit(CELLS)).cast("int")))
    groups = cut(groups)
    counts = groups.groupBy("_cell").agg(F.sum("_rows").alias("n")).toPandas()  # at most CELLS rows
    plan = assign(counts["_cell"].to_numpy(np.int64), counts["n"].to_numpy(np.int64), shards, vnodes)
    pieces = F.broadcast(spark.createDataFrame(  # bounded by CELLS, not by the input
        plan, "cell int, lo long, hi long, shard int, slot0 long"))
    w = (Window.partitionBy("_cell").orderBy("_at", *[F.col(c).asc_nulls_first() for c in cols])
         .rowsBetween(Window.unboundedPreceding, 0))
    ranked = groups.withColumn("_to", F.sum("_rows").over(w)).withColumn("_from", F.col("_to") - F.col("_rows"))
    hit = (ranked.join(pieces, F.col("_cell") == F.col("cell"))
           .where("_from < hi and lo < _to")
           .withColumn("_f", F.greatest("_from", "lo")).withColumn("_t", F.least("_to", "hi")))
    return (explode_count(hit, F.col("_t") - F.col("_f"), "_i")
            .select(*cols, "shard", (F.col("slot0") + F.col("_f") - F.col("lo") + F.col("_i")).alias("slot")))


@register("op1_ring_shards")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    return ring_shards(rows, ["doc_id"], ["size", "text_crc32"], 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
