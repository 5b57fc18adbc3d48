"""Exact top-k inner-product search, exhaustive and term at a time.

A dimension is a term, a vector's component its weight there.  Rows are dealt
into candidate blocks and query blocks of bounded size by the hash of their
content; each (candidate block, query block) pair is one task's group.  There
every query row walks its non-zero terms and adds weight x posting list into a
dense score array; a partition selection keeps the best k of the block with
all ties at the edge, and the blocks' lists are merged per query.

Defined results: vectors that are null or hold null or non-finite components
take no part; shorter vectors have no weight in the dimensions they lack;
equal rows are counted once and returned as often as they occur; a query never
meets its own row but meets equal rows; ties go to the smaller id, null ids
last; an empty table gives no rows.  Scores are long integers.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import cut, explode_count, prepare, table
from .registry import register

CANDIDATES, QUERIES = 16384, 1024
_LAST = np.iinfo(np.int64).max
OUT = "query_id long, qkey long, qrows long, vec_id long, score long"


def _matrix(col: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column as a dims x rows matrix, zero where a row ends early."""
    arr = col.combine_chunks()
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], arr.type)
    sizes = np.diff(arr.offsets.to_numpy())
    row = np.repeat(np.arange(len(arr)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((dims, len(arr)), np.int64)
    out[at, row] = arr.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(t: pa.Table) -> int:
    return max([0, *pc.list_value_length(t["v"]).to_pylist()])


def _scores(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def block(cands: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if cands.num_rows and queries.num_rows:
            dims = max(_width(cands), _width(queries))
            posts, weights = _matrix(cands["v"], dims), _matrix(queries["v"], dims)
            top = int(np.abs(posts).max(initial=0)) * int(np.abs(weights).max(initial=0)) * max(dims, 1)
            kind = np.int32 if top < 2**31 else np.int64
            posts, weights = posts.astype(kind), weights.T.astype(kind)
            lists = []  # a posting list is kept dense unless most of its weights are zero
            for t in range(dims):
                ids = np.flatnonzero(posts[t])
                lists.append((None, posts[t]) if len(ids) * 4 > posts.shape[1] else (ids, posts[t][ids]))
            ids = cands["vec_id"].fill_null(_LAST).to_numpy()
            null = cands["vec_id"].is_null().to_numpy()
            rows, ckey = cands["rows"].to_numpy(), cands["key"].to_numpy()
            n, scores, add = len(ids), np.empty(posts.shape[1], kind), np.empty(posts.shape[1], kind)
            for q, (qid, qkey, qrows) in enumerate(zip(queries["vec_id"].to_pylist(), queries["key"].to_pylist(),
                                                       queries["rows"].to_pylist())):
                scores[:] = 0
                for t in np.flatnonzero(weights[q]):
                    at, post = lists[t]
                    if at is None:
                        np.multiply(post, weights[q, t], out=add)
                        scores += add
                    else:
                        scores[at] += post * weights[q, t]
                own = np.flatnonzero((ids == qid) & (ckey == qkey))
                own = [i for i in own if not null[i] and np.array_equal(posts[:, i], weights[q])]
                take = min(n, k + len(own))
                low = np.partition(scores, n - take)[n - take]
                best = np.flatnonzero(scores >= low)
                best = best[np.lexsort((ids[best], null[best], -scores[best].astype(np.int64)))]
                left = k
                for i in best:
                    many = min(int(rows[i]) - (i in own), left)
                    if many > 0:
                        found += [(qid, qkey, qrows, None if null[i] else int(ids[i]), int(scores[i]))] * many
                        left -= many
                    if not left:
                        break
        cols = list(zip(*found)) if found else [[]] * 5
        names = ["query_id", "qkey", "qrows", "vec_id", "score"]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, cols)})
    return block


def top_k(vectors: DataFrame, queries: Column, k: int,
          candidates_a_block: int = CANDIDATES, queries_a_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` (vec_id
    long, v array of long, never null) for those rows for which ``queries``
    holds."""
    rows = vectors.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("rows"))
    rows = cut(rows.withColumn("key", F.xxhash64("vec_id", "v")).withColumn("is_query", F.coalesce(queries, F.lit(False))))
    n, m = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("is_query"), 1))).first()
    c, q = max(1, -(-n // candidates_a_block)), max(1, -(-m // queries_a_block))

    def dealt(df: DataFrame, own: str, mine: int, other: str, others: int) -> DataFrame:
        return (df.select("vec_id", "v", "rows", "key",
                          F.pmod(F.xxhash64("key", F.lit(own)), F.lit(mine)).cast("int").alias(own))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    cand = dealt(rows, "c", c, "q", q).groupBy("c", "q")
    ask = dealt(rows.where("is_query"), "q", q, "c", c).groupBy("c", "q")

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        return _scores(k)(left, right)

    found = cand.cogroup(ask).applyInArrow(pair, OUT)
    w = Window.partitionBy("query_id", "qkey").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return explode_count(best, F.col("qrows"), "_i").select("query_id", "rank", "vec_id", "score")


def scaled(df: DataFrame, factor: int = 64) -> DataFrame:
    """vec_id and v = floor(factor x component) of the vectors that count."""
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x.cast("double")) < F.lit(float("inf"))))
    return df.where(F.coalesce(fine, F.lit(False))).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(factor)))).alias("v"))


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.r <> b.r),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM k WHERE rank <= 20
"""


@register("op10_exact_top_k", ORACLE)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return top_k(scaled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0, 20)
