"""Helpers shared by the operators: session preparation, row identity,
lineage cuts, counted explosion and connected components.

* ``prepare`` reads ``spark.checkpoint.dir`` (through the library's session
  helper), ships the package to executors, bounds an Arrow batch by rows and
  has shuffle files removed with the job that wrote them.
* ``cut`` cuts lineage with an eager ``checkpoint()`` in that shared folder.
* ``components`` labels every node with the smallest node reachable.
"""
from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.session import configure, ship_package

#: Rows per Arrow batch: documents may be long, so a batch is kept small.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Shuffle files go when the job that wrote them has ended: what later jobs need is checkpointed or written.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Word characters of all contracts: everything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession, batch_rows: int = BATCH_ROWS) -> SparkSession:
    configure(spark)
    ship_package(spark)
    if int(spark.conf.get(_BATCH)) > batch_rows:
        spark.conf.set(_BATCH, str(batch_rows))
    spark.conf.set(_CLEAN, "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A file for so many bytes of text or edges of a graph is enough; fewer files than FEWEST are not asked for.
FILE_BYTES, FILE_EDGES, FEWEST = 8 << 20, 50_000, 16


def files_for(docs: DataFrame) -> int:
    """How many files what is derived from ``docs`` (with text) needs at most.

    A shuffle may have many more partitions than its rows need.  In a folder
    without native Hadoop an executor starts a program for every file that it
    writes, and until that program runs its memory counts as the executor's
    once more, so files are not made without need."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(FEWEST, -(-size // FILE_BYTES))


def cut(df: DataFrame, files: int | None = None) -> DataFrame:
    """The rows of ``df``, written once to the shared checkpoint folder, in at
    most ``files`` files."""
    configure(df.sparkSession)
    return (df.coalesce(files) if files else df).checkpoint(eager=True)


def release() -> None:
    """Give freed memory back to the system.  Spark keeps a Python worker for a
    minute after its task, beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function of a task's batches, that gives its memory back at the end."""
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()
    return wrapped


def small(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """``df`` (already cut, narrow rows) with a broadcast hint if it has at
    most ``max_rows`` rows; unchanged, for a shuffle join, beyond that."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def explode_count(df: DataFrame, n: Column, name: str, chunk: int = 4096) -> DataFrame:
    """One row per i in [0, n), as column ``name``.  The numbers are made in
    two steps, so no array is longer than ``chunk`` or n / ``chunk``."""
    n = n.cast("long")
    return (df.withColumn("_n", n).where(F.col("_n") > 0)
            .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {chunk}"))))
            .withColumn(name, F.explode(F.expr(
                f"sequence(_c * {chunk}, least(_n, (_c + 1) * {chunk}) - 1)")))
            .drop("_n", "_c"))


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest connected node) of the graph with edges a-b."""
    nodes, idx = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = idx[:len(a)], idx[len(a):]
    root = np.arange(len(nodes))
    while True:
        m = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], m)
        np.minimum.at(new, root[y], m)
        new = np.minimum(new, new[new])
        while True:
            hop = new[new]
            if np.array_equal(hop, new):
                break
            new = hop
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


#: Edges contracted at once.
AT_ONCE = 200_000


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars around their smallest nodes, AT_ONCE at a time."""
    def stars(held: list) -> pa.RecordBatch:
        node, top = local_roots(*(np.concatenate([h.column(c).to_numpy() for h in held]) for c in "ab"))
        keep = node != top
        return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(top[keep])], names=["a", "b"])

    held: list = []
    for b in batches:
        held.append(b)
        if sum(h.num_rows for h in held) >= AT_ONCE:
            yield stars(held)
            held = []
    if any(h.num_rows for h in held):
        yield stars(held)


def components(edges: DataFrame, max_rounds: int = 60, contracted: bool = False, files: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long, no
    nulls); component is the smallest node reachable.

    Edges are first contracted inside each task, unless the Python function
    that made them did so (a second one would keep a second worker), then alternating
    large-star and small-star rounds run until the edges are stars around
    their minimum.  The minimum of a node is a map-side combined aggregate and
    comes back by a join, so a node with a third of all edges is split by the
    skewed-join rule instead of being gathered.  Each round is written once to
    the checkpoint folder, in no more files than its edges need.  Edges that are no stars after ``max_rounds`` are an
    error, never a result."""
    e = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    e = cut((e if contracted else e.mapInArrow(contract, "a long, b long")).dropDuplicates(["a", "b"]), files)

    def signature(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    seen = signature(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        few = -(-seen[0] // FILE_EDGES)
        e = e.coalesce(few)
        # large star: every larger neighbour of a node moves to the smallest of the neighbourhood
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), few)
        large = (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").dropDuplicates(["a", "b"]))
        # small star: a node and its smaller neighbours move to the smallest of them (now b < a always)
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        nxt = large.join(low2, "a")
        nxt = (nxt.select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(low2.select("a", F.col("m").alias("b")))
               .where("a <> b").dropDuplicates(["a", "b"]))
        e = cut(nxt, few)
        now = signature(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: edges are no stars yet after {max_rounds} rounds")
    tops = e.groupBy("a").agg(F.min("b").alias("component"))
    return (tops.select(F.col("a").alias("node"), "component")
            .union(tops.select(F.col("component").alias("node"), "component")).dropDuplicates(["node"]))
