"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label; each has a window
of scores, from a lower to an upper share of its own, in which it takes the
best rows of other labels.  The windows of an anchor overlap, so they are not
searched one by one: their upper limits cut the scores into disjoint slots, a
row of another label belongs to the one slot that its score falls into, and
only the best ``k`` of a slot are kept, in every block and again, map-side
first, over all blocks.  Read from the highest score down, the slots of an
anchor are one sorted list, and the answer of a window is the beginning, down
to its lower limit, of the suffix that starts at the window's own slot.

Rows are dealt by number into candidate blocks and anchors into anchor blocks
of bounded size, whatever their label, so a label or a vector with a third of
all rows is spread like any other; a (candidate block, anchor block) pair is
one group, scored by one product of integer matrices.  Two such passes run:
same label for the positives, other labels for the slots.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; shorter vectors are zero in the dimensions they lack;
an empty vector scores 0; rows that are there several times count as often,
as anchors, positives and negatives; an anchor is never its own positive, an
equal row is; ties go to the smaller id, null ids last; a row without id is no
anchor; an anchor without positives, and a window without rows or with its
lower limit above its upper one (negative scores), give no rows; an empty
table gives none.  Scores are long integers; if an inner product may not fit
one, the job fails.  Other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, explode_count, prepare, table
from .registry import register
from .vectors import finite, floors, matrix, products

#: Vector components that a candidate block and an anchor block hold, and scores computed at once.
CANDIDATES, ANCHORS, SCORES = 1 << 20, 1 << 18, 1 << 22
_LAST = np.iinfo(np.int64).max
_FOUND = "node long, slot int, vec_id long, score long"


def _best(score: np.ndarray, ids: np.ndarray, null: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of some scores, each as often as its row is there."""
    if len(score) > 4 * k:
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    some = some[np.lexsort((ids[some], null[some], -score[some]))][:k]
    return np.repeat(some, np.minimum(rows[some], k))[:k]


def _scored(cands: pa.Table, asked: pa.Table, dims: int):
    """(index of an anchor, its scores with all candidates), a few anchors at a time."""
    c, a = matrix(cands["v"], dims), matrix(asked["v"], dims)
    step = max(1, SCORES // max(len(c), 1))
    for at in range(0, len(a), step):
        for i, scores in enumerate(products(a[at:at + step], c), at):
            yield i, scores


def _ids(cands: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (cands["vec_id"].fill_null(_LAST).to_numpy(), cands["vec_id"].is_null().to_numpy(zero_copy_only=False),
            cands["rows"].to_numpy())


def _table(found: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    """Found (node, slot, ids, whether null, scores) as rows."""
    sizes = [len(f[2]) for f in found]
    ids, null, score = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (2, 3, 4))
    return pa.table({"node": np.repeat(np.array([f[0] for f in found], np.int64), sizes),
                     "slot": np.repeat(np.array([f[1] for f in found], np.int32), sizes),
                     "vec_id": pa.array(ids.astype(np.int64), mask=null.astype(bool)), "score": score.astype(np.int64)})


def same_label(dims: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ``k`` best candidates of an anchor's label, itself left out (slot 0)."""
    def block(cands: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if cands.num_rows and asked.num_rows:
            ids, null, rows = _ids(cands)
            label, of = cands["label"].to_numpy(), asked["label"].to_numpy()
            node, nodes = asked["node"].to_numpy(), cands["node"].to_numpy()
            for x in np.unique(of):  # candidates of other labels are never scored
                some, mine = np.flatnonzero(label == x), np.flatnonzero(of == x)
                if not len(some):
                    continue
                for i, score in _scored(cands.take(some), asked.take(mine), dims):
                    n = node[mine[i]]
                    left = rows[some] - (nodes[some] == n)
                    fine = np.flatnonzero(left > 0)
                    at = fine[_best(score[fine], ids[some][fine], null[some][fine], left[fine], k)]
                    found.append((n, 0, ids[some][at], null[some][at], score[at]))
        return _table(found)
    return block


def in_slots(dims: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ``k`` best candidates of other labels in every slot of an anchor."""
    def block(cands: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if cands.num_rows and asked.num_rows:
            ids, null, rows = _ids(cands)
            label, of, node = cands["label"].to_numpy(), asked["label"].to_numpy(), asked["node"].to_numpy()
            lows, highs = asked["lows"].to_pylist(), asked["highs"].to_pylist()
            for i, score in _scored(cands, asked, dims):
                low, high = np.array(lows[i]), np.array(highs[i])
                limits = np.unique(high)  # ascending: slot j is above limit j - 1, up to limit j
                # a slot serves the windows that end in it or above; scores under all their lower limits are of no use
                least = np.array([low[high >= u].min() for u in limits])
                some = np.flatnonzero((score >= least.min()) & (score <= limits[-1]) & (label != of[i]))
                slot = np.searchsorted(limits, score[some])
                for j in np.unique(slot):
                    at = some[(slot == j) & (score[some] >= least[j])]
                    at = at[_best(score[at], ids[at], null[at], rows[at], k)]
                    if len(at):
                        found.append((node[i], int(j), ids[at], null[at], score[at]))
        return _table(found)
    return block


def _blocks(df: DataFrame, own: str, mine: int, other: str, others: int) -> DataFrame:
    """``df`` dealt over ``mine`` blocks of its own, a copy for each of the ``others``."""
    return (df.withColumn(own, F.pmod(F.xxhash64("node", F.lit(own)), F.lit(mine)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))


def _kept(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of every slot; Spark keeps a task's best before it shuffles."""
    w = Window.partitionBy("node", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10,
                   window: tuple[int, int] = (30, 90), block: int = CANDIDATES, anchor_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score of ``vectors`` (vec_id long, label long, v array of long; no
    null labels or vectors).  ``window`` are the percentages of the positive's
    score between which a negative's lies, ``block`` and ``anchor_block`` the
    components that a block holds."""
    rows = vectors.groupBy("vec_id", "label", "v").agg(F.count(F.lit(1)).alias("rows"))
    # numbered as they are written, so a row's number is the same for all readers
    rows = cut(rows.withColumn("node", F.monotonically_increasing_id()).withColumn("is_anchor", F.coalesce(anchors, F.lit(False))))
    n, m, dims = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("is_anchor"), 1)), F.max(F.size("v"))).first()
    dims = dims or 0
    c, a = (max(1, -(-x * max(dims, 1) // size)) for x, size in ((n, block), (m, anchor_block)))
    cands = _blocks(rows.select("vec_id", "label", "v", "rows", "node"), "c", c, "a", a).groupBy("c", "a")
    asked = rows.where("is_anchor")

    def ask(df: DataFrame, kernel: Callable) -> DataFrame:
        def pair(left: pa.Table, right: pa.Table) -> pa.Table:
            return kernel(left, right)
        own = df.select(*(F.col(x).alias(x) for x in df.columns))  # columns of its own: both sides come from ``rows``
        return cands.cogroup(_blocks(own, "a", a, "c", c).groupBy("c", "a")).applyInArrow(pair, _FOUND)

    near = _kept(ask(asked.select("node", "label", "v"), same_label(dims, positives)), positives)
    low, high = window
    score = F.col("score").cast("decimal(20,0)")
    limits = near.select("node", "_at", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                         F.ceil(score * low / 100).cast("long").alias("low"), F.floor(score * high / 100).cast("long").alias("high"))
    # at most ``positives`` windows an anchor; without one that can hold a score the anchor is out
    windows = cut(limits.where("low <= high").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("_at", "positive_id", "positive_score", "low", "high"))).alias("windows")))
    asked = asked.select("node", "vec_id", "label", "v", "rows").join(windows, "node")
    slots = _kept(ask(asked.select("node", "label", "v", F.col("windows.low").alias("lows"), F.col("windows.high").alias("highs")),
                      in_slots(dims, negatives)), negatives)
    # slots from the highest down, in each the scores down: one list of at most positives x negatives rows
    merged = slots.groupBy("node").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("slot")).alias("below"), F.col("_at").alias("at"), "vec_id", "score"))).alias("list"))
    found = (asked.select("node", F.col("vec_id").alias("anchor_id"), "rows", "windows").join(merged, "node")
             .withColumn("limits", F.array_sort(F.array_distinct(F.col("windows.high"))))
             .withColumn("w", F.explode("windows")))
    own = F.array_position("limits", F.col("w.high")) - 1
    answer = F.slice(F.filter("list", lambda x: (x["below"] >= -own) & (x["score"] >= F.col("w.low"))), 1, negatives)
    found = (found.select("anchor_id", "rows", "w", F.posexplode(answer).alias("at", "x"))
             .select("anchor_id", F.col("w.positive_id").alias("positive_id"), (F.col("at") + 1).alias("rank"),
                     F.col("x.vec_id").alias("negative_id"), F.col("w.positive_score").alias("positive_score"),
                     F.col("x.score").alias("negative_score"), "rows"))
    return explode_count(found, F.col("rows"), "_i").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM s WHERE same QUALIFY place <= 5),
k AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.r, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM p JOIN s n ON n.r = p.r AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM k WHERE rank <= 10
"""


@register("op11_hard_negatives", ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = table(spark, sf_dir, "embeddings").where(F.col("label").isNotNull() & finite("embedding")).select(
        "vec_id", label.alias("label"), floors("embedding", 256).alias("v"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
