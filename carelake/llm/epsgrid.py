"""Near-duplicate vectors by an epsilon grid order join.

Within a label, vectors of unit length are projected on the leading principal
dimensions of all vectors and sorted by the cells of an epsilon grid there
(epsilon: the distance of two unit vectors at the least cosine).  The sorted
sequence is cut into intervals; two intervals are joined only if the boxes of
their projections are within epsilon, and the join halves both recursively,
skipping pairs of halves that are provably distant, down to small leaves
where cosines are computed in double precision.

Equal vectors of a label are one node with a count.  The order is a range
partitioning on (label, cells, node), so a cell or label with a third of all
vectors is still spread over tasks.  A pair of intervals sends on one row per
linked vector: how many vectors it links to and the smallest one it is
connected with, never the pairs.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components, and all vectors without a label, link with nothing;
shorter vectors are zero in the dimensions they lack; component_id is the
smallest non-null vec_id reachable; kept says that it is the row's own id
(rows without id that link with nothing are kept); an empty table gives no
rows; other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, local_roots, prepare, table
from .registry import register

COSINE = 0.93
#: Leading dimensions of the grid, vectors of an interval and of a leaf.
DIMS, BLOCK, LEAF = 6, 512, 64
_SHIFT = 10


def _vectors(col: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as a matrix, zero where a row ends early."""
    sizes = np.diff(col.offsets.to_numpy())
    row = np.repeat(np.arange(len(col)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(col), dims))
    out[row, at] = col.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal(vectors: DataFrame, dims: int, leading: int) -> np.ndarray:
    """Leading principal axes (dims x leading) of the unit vectors; only sums
    over all vectors, one per pair of dimensions, come to the driver."""
    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for b in batches:
            if b.num_rows:
                x = np.column_stack([_unit(_vectors(b.column(0), dims)), np.ones(b.num_rows)])
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "x"])

    sums = vectors.select("v").mapInArrow(moments, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas()
    m = np.zeros((dims + 1) ** 2)
    m[sums["at"].to_numpy()] = sums["x"].to_numpy()
    m = m.reshape(dims + 1, dims + 1)
    n = max(m[-1, -1], 1.0)
    mean = m[-1, :-1] / n
    return np.linalg.eigh(m[:-1, :-1] / n - np.outer(mean, mean))[1][:, ::-1][:, :leading]


def _far(a: tuple, b: tuple, eps: float) -> bool:
    gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    return float(gap @ gap) > eps * eps


def _join(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, at: int, to: int, least: float,
          eps: float, out: list) -> None:
    """Positions (i, j) of linked vectors of two sequence intervals, into ``out``."""
    if _far((pa_.min(0), pa_.max(0)), (pb.min(0), pb.max(0)), eps):
        return
    if max(len(a), len(b)) <= LEAF:
        i, j = np.nonzero(a @ b.T >= least)
        out.append((i + at, j + to))
        return
    m, n = (len(a) + 1) // 2, (len(b) + 1) // 2
    for x, y in ((0, m), (m, len(a))):
        for u, v in ((0, n), (n, len(b))):
            if x < y and u < v:
                _join(a[x:y], b[u:v], pa_[x:y], pb[u:v], at + x, to + u, least, eps, out)


def vector_links(vectors: DataFrame, least: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """(blocks, links) of ``vectors`` (label, k1, k2, v; one row per distinct
    vector of a label, with ``rows`` and ``first``): blocks hold the vectors in
    grid order, links (node, links, root) say what a node was linked with in
    one pair of blocks."""
    dims = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    axes = principal(vectors, dims, min(DIMS, dims))
    eps = math.sqrt(2 - 2 * least) * (1 + 1e-9) + 1e-9
    lead = axes.shape[1]
    cells = [f"c{i}" for i in range(lead)]

    def grid(batches):
        for b in batches:
            c = np.floor(_unit(_vectors(b.column("v"), dims)) @ axes / eps).astype(np.int32) if b.num_rows else np.zeros((0, lead), np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c[:, i]) for i in range(lead))],
                                             names=[*b.schema.names, *cells])

    base = vectors.select("label", "k1", "k2", "rows", "v")
    schema = "label string, k1 long, k2 long, rows long, v array<double>"
    keys = ["label", *cells, "k1", "k2"]
    ordered = (base.mapInArrow(grid, schema + "".join(f", {c} int" for c in cells))
               .repartitionByRange(*keys).sortWithinPartitions(*keys)
               .withColumn("task", F.spark_partition_id()))

    def pack(batches):
        held, done = None, 0
        for last, b in _ended(batches):
            t = held if b is None else (pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])]))
            if t is None:
                return
            rows, at = [], 0
            label = t["label"].combine_chunks()
            change = np.flatnonzero(np.asarray(pc.not_equal(label[1:], label[:-1]))) + 1 if len(label) > 1 else []
            for end in [*change, t.num_rows]:
                final = last or end < t.num_rows
                while end - at >= BLOCK or final and at < end:
                    n = min(BLOCK, end - at)
                    part = t.slice(at, n)
                    x = _vectors(part["v"].combine_chunks(), dims)
                    p = _unit(x) @ axes
                    rows.append(((int(part["task"][0].as_py()) << 32) + done, part["label"][0].as_py(), n,
                                 part["k1"].to_numpy().tolist(), part["k2"].to_numpy().tolist(),
                                 part["rows"].to_numpy().tolist(), x.astype(np.float64).tobytes(),
                                 p.min(0).tolist(), p.max(0).tolist()))
                    done, at = done + 1, at + n
            held = t.slice(at)
            cols = list(zip(*rows)) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                                                       pa.list_(pa.int64()), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())))],
                names=["block", "label", "n", "k1", "k2", "rows", "x", "lo", "hi"])

    blocks = cut(ordered.mapInArrow(pack, "block long, label string, n int, k1 array<long>, k2 array<long>, "
                                          "rows array<long>, x binary, lo array<double>, hi array<double>"))

    # blocks whose boxes are within epsilon, met on the first dimension's cells
    meta = (blocks.select("block", "label", "lo", "hi")
            .withColumn("from", F.floor(F.col("lo")[0] / eps)).withColumn("to", F.floor(F.col("hi")[0] / eps)))
    a = meta.select(F.col("block").alias("a"), "label", F.col("lo").alias("alo"), F.col("hi").alias("ahi"),
                    F.explode(F.sequence("from", "to")).alias("cell"))
    b = meta.select(F.col("block").alias("b"), "label", F.col("lo").alias("blo"), F.col("hi").alias("bhi"),
                    F.explode(F.sequence(F.col("from") - 1, F.col("to") + 1)).alias("cell"))
    gap = sum((F.pow(F.greatest(F.lit(0.0), F.col("alo")[i] - F.col("bhi")[i], F.col("blo")[i] - F.col("ahi")[i]), 2)
               for i in range(lead)), F.lit(0.0))
    pairs = a.join(b, ["label", "cell"]).where("a <= b").where(gap <= eps * eps).select("a", "b").dropDuplicates()
    left = blocks.select(F.col("block").alias("a"), F.col("rows").alias("arows"), F.col("x").alias("ax"))
    right = blocks.select(F.col("block").alias("b"), F.col("rows").alias("brows"), F.col("x").alias("bx"))
    both = pairs.join(left, "a").join(right, "b").select("a", "arows", "ax", "b", "brows", "bx")

    def link(batches):
        for t in batches:
            node, links, root = [], [], []
            for r in t.to_pylist():
                x, y = (np.frombuffer(r[k]).reshape(-1, dims) for k in ("ax", "bx"))
                x, y = _unit(x), _unit(y)
                found: list = []
                _join(x, y, x @ axes, y @ axes, 0, 0, least, eps, found)
                i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
                if r["a"] == r["b"]:
                    i, j = i[i != j], j[i != j]
                if not len(i):
                    continue
                na, nb = (r["a"] << _SHIFT) + i, (r["b"] << _SHIFT) + j
                ids, top = local_roots(na, nb)
                many = np.zeros(len(ids), np.int64)
                np.add.at(many, np.searchsorted(ids, na), np.array(r["brows"])[j])
                if r["a"] != r["b"]:
                    np.add.at(many, np.searchsorted(ids, nb), np.array(r["arows"])[i])
                node.append(ids)
                links.append(many)
                root.append(top)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (node, links, root)],
                                             names=["node", "links", "root"])

    return blocks, cut(both.mapInArrow(link, "node long, links long, root long"))


def _ended(batches):
    for b in batches:
        if b.num_rows:
            yield False, b
    yield True, None


def near_vectors(df: DataFrame, least: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``df`` (vec_id,
    embedding, label)."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = df.select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), v.alias("v"))
    fine = (F.col("label").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0))
    rows = (rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
            .withColumn("k1", F.when(F.col("fine"), F.xxhash64("label", "v")))
            .withColumn("k2", F.when(F.col("fine"), F.xxhash64("v", "label"))))
    slim = rows.select("vec_id", "k1", "k2")
    distinct = cut(rows.where("fine").groupBy("label", "k1", "k2").agg(
        F.first("v").alias("v"), F.count(F.lit(1)).alias("rows"), F.min("vec_id").alias("first")))
    slim = slim.withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    blocks, links = vector_links(distinct, least)
    nodes = (blocks.select("block", F.posexplode(F.arrays_zip("k1", "k2")).alias("i", "k"))
             .select((F.shiftleft("block", _SHIFT) + F.col("i")).alias("node"),
                     F.col("k.k1").alias("n1"), F.col("k.k2").alias("n2")))
    comp = components(links.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "_n")
    nodes = nodes.join(comp, nodes.node == comp._n, "left").withColumn("component", F.coalesce("component", "node"))
    many = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = distinct.select(*(F.col(c).alias(f"d_{c}") for c in ("k1", "k2", "rows", "first")))  # names of their own
    classes = (known.join(nodes, (F.col("d_k1") == F.col("n1")) & (F.col("d_k2") == F.col("n2")))
               .join(many.withColumnRenamed("node", "_m"), F.col("node") == F.col("_m"), "left"))
    classes = cut(classes.select("d_k1", "d_k2", "d_first", "component",
                                 (F.coalesce("links", F.lit(0)) + F.col("d_rows") - 1).alias("n_links")))
    first = classes.groupBy(F.col("component").alias("_c")).agg(F.min("d_first").alias("component_id"))
    classes = classes.join(first, F.col("component") == F.col("_c"))
    out = slim.join(classes, (F.col("_k1") == F.col("d_k1")) & (F.col("_k2") == F.col("d_k2")), "left")
    own = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
"""


@register("op4_epsilon_grid_join", ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark, 64)
    return near_vectors(table(spark, sf_dir, "embeddings"))
