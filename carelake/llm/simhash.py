"""SimHash near-duplicates with BK-trees.

A document's fingerprint has a bit where over half of its shingles' XXH64
hashes have it.  Distinct fingerprints within ``RADIUS`` bits are linked by
BK-trees: children are keyed by their Hamming distance to the parent, and a
search follows only edges within the radius of its own distance.

A tree is made per shard, and a shard holds the fingerprints that agree in one
of RADIUS + 1 bit ranges: two fingerprints within the radius agree in at least
one of them, so every link is met in some shard and a fingerprint visits
RADIUS + 1 shards, not all.  Shards and their searches meet by a shuffle; a
broadcast of all trees would grow with the corpus.  A shard over ``SHARD``
fingerprints is dealt into parts, and each pair of parts is a task's group:
the tree of one, searched with the other.  A group sends on one edge per
linked fingerprint (to the smallest it is connected to), never all pairs.

Defined results: null or wordless texts have fingerprint zero and link like
any other; fewer words than a shingle are one shingle; equal fingerprints are
one node, whatever their number; component_id is the smallest non-null doc_id
reachable, null if there is none; an empty table gives no rows; other columns
are passed on by ``keep_one`` and ignored otherwise.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, contract, cut, files_for, prepare, table
from .registry import register

SHINGLE, RADIUS, SEED = 3, 2, 42
SHARD = 1024
_LONG = 1 << 18


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > n:
        starts, ends = starts[:len(words) - n + 1], ends[n - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    h, total = xxhash.xxh64_intdigest, len(starts)
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, total, _LONG):
        part = hashes[i:i + _LONG]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """doc_id, fp (signed long) and th (hash of the text) of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(x, n) for x in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), b.column(2)], names=["doc_id", "fp", "th"])
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th"))
    return rows.mapInArrow(run, "doc_id long, fp long, th long")


def bk_links(tree: list[int], asked: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest one connected) for the linked ones of a BK-tree
    over ``tree``, searched with ``asked`` (with its own members if None)."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    def search(node: tuple, x: int) -> None:
        stack = [node]
        while stack:
            fp, below = stack.pop()
            d = (fp ^ x).bit_count()
            if d <= radius:
                a, b = top(x), top(fp)
                if a != b:
                    up[max(a, b)] = min(a, b)
            if below:
                for e in range(d - radius, d + radius + 1):
                    if e in below:
                        stack.append(below[e])

    root = (tree[0], {})
    for x in tree[1:]:
        if asked is None:
            search(root, x)
        node = root
        while (d := (node[0] ^ x).bit_count()) and (child := node[1].get(d)):
            node = child
        if d:
            node[1][d] = (x, {})
    for x in asked or ():
        search(root, x)
    return [(x, t) for x in up if (t := top(x)) != x]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _trees(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (part of a pair, side, fp), the rows of a pair together."""
    def links(fps: np.ndarray, sides: np.ndarray) -> list[tuple[int, int]]:
        tree, other = fps[sides == 0].tolist(), fps[sides == 1].tolist()
        alone = fps[sides == 2].tolist()
        if alone:
            return bk_links(alone, None, radius)
        return bk_links(tree, other, radius) if tree and other else []

    def run(batches):
        held = np.zeros((0, 6), np.int64)
        for last, b in _with_end(batches):
            rows = held if b is None else np.concatenate([held, np.column_stack(
                [b.column(i).to_numpy() for i in range(6)]).astype(np.int64)])
            if not len(rows):
                continue
            edge = np.flatnonzero(np.any(rows[1:, :4] != rows[:-1, :4], axis=1)) + 1
            edge = np.concatenate([[0], edge, [len(rows)]] if last else [[0], edge])
            held = rows[edge[-1]:]
            found = []
            for x, y in zip(edge[:-1], edge[1:]):
                if y - x > 1:
                    found += links(rows[x:y, 5].view(np.uint64), rows[x:y, 4])
            yield pa.RecordBatch.from_arrays([pa.array([_signed(f[k]) for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return run


def _with_end(batches):
    for b in batches:
        yield False, b
    yield True, None


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints ``fp`` within ``radius``
    bits, contracted in each task."""
    width = 64 // (radius + 1)
    ranges = [(i * width, 64 - i * width if i == radius else width) for i in range(radius + 1)]
    vals = [F.struct(F.lit(i).alias("range"), F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1)).alias("val"))
            for i, (at, n) in enumerate(ranges)]
    rows = fps.select("fp", F.explode(F.array(*vals)).alias("s")).select("fp", "s.range", "s.val")
    many = rows.groupBy("range", "val").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.expr(f"cast((n + {shard - 1}) div {shard} as int)")
    rows = (rows.join(many, ["range", "val"]).withColumn("parts", parts)
            .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
            .withColumn("side", F.when(F.col("i") == F.col("j"), 2).when(F.col("own") == F.col("i"), 0).otherwise(1)))
    keys, trees = ["range", "val", "i", "j"], _trees(radius)
    return (rows.select(*keys, "side", "fp").repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(lambda batches: contract(trees(batches)), "a long, b long"))


def simhash_components(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS, files: int | None = None) -> DataFrame:
    """doc_id, th, fp, component (a fingerprint) and component_id of every row of ``docs``."""
    files = files or files_for(docs)
    rows = cut(fingerprints(docs, n), files)
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), files)
    comp = components(fingerprint_links(nodes.select("fp"), radius), contracted=True, files=files)
    nodes = (nodes.join(comp, nodes.fp == comp.node, "left")
             .select("fp", "first", F.coalesce("component", "fp").alias("component")))
    first = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.join(nodes.select("fp", "component").join(first, "component"), "fp")


def keep_one(docs: DataFrame, n: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without all but one document of each component:
    the one with the smallest doc_id, of equal rows one."""
    files = files_for(docs)
    rows = simhash_components(docs, n, radius, files)
    own = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    best = own.groupBy("component").agg(F.min("th").alias("th"))
    best = (own.join(best, ["component", "th"]).groupBy("component", "doc_id", "th")
            .agg(F.count(F.lit(1)).alias("copies")))
    best = best.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("copies").alias("_copies"))
    kept = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64("text").alias("_t"),
                       F.col("doc_id").cast("long").alias("_own"))
    kept = kept.join(best, (F.col("_t") == F.col("_th")) & F.col("_own").eqNullSafe(F.col("_id")))
    one = kept.where("_copies = 1")
    some = kept.where("_copies > 1").dropDuplicates(["_id", "_th"])
    return one.union(some).select("_row.*").coalesce(files)


@register("op8_simhash_bk_trees")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
