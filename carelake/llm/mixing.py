"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key -ln(u) / quality, u from the md5 of
its identity, so reruns agree.  Sorted by that key within its source, the
documents are prefix-summed against the source's word budget: complete epochs
first (every document once per epoch), then the fraction that is left, up to
the document that crosses the budget.

Only DataFrame functions.  No source is sorted as a whole: words are summed
per (source, key bucket) with map-side combining, the bucket in which the
budget ends is refined once more, and rows are ordered only in that last,
narrow bucket; all others are in or out by comparing their key.

Defined results: null text or no words: size 0, nothing taken; a null source
is a source of its own, last in order; equal rows draw equal keys and are
counted before they are ordered; an empty table gives no rows; other columns
pass through untouched or are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import WORD, cut, explode_count, files_for, prepare, small, table
from .registry import register

WEIGHTS = (1, 2, 3)
MOST = 3
#: Buckets per unit of ln(key): coarse, and within the coarse one that is cut.
COARSE, FINE = 16, 4096


def with_keys(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with _size, _key (ln of the
    exponential key), _fine (its bucket) and _src (source, never null)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    d = docs.withColumn("_size", size).withColumn("_chars", F.char_length(text).cast("long"))
    # quality: how near the mean length of a word, its space included, is to 6 characters
    quality = F.when(F.col("_size") > 0, F.lit(1.0) / (
        F.lit(1.0) + F.abs(F.col("_chars") / F.col("_size") - F.lit(6.0)))).otherwise(F.lit(1.0))
    name = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_size", "_chars")
    u = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return (d.withColumn("_key", F.log(-F.log(u) / quality))
            .withColumn("_fine", F.floor(F.col("_key") * FINE).cast("long"))
            .withColumn("_src", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))))


def budgets(keyed: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: source_size, target, _epochs, _rest (words beyond them).

    Sources stand in code point order, null last, and weigh ``weights`` in
    turn.  With the sources sorted by limit / weight, those that stop at their
    limit are a prefix; the level of all others is what is left over their
    weights.  One row per source takes part."""
    per = keyed.groupBy("_src").agg(F.first("source").alias("source"), F.sum("_size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weigh = F.lit(float(weights[0]))
    for i, x in enumerate(weights):
        weigh = F.when(F.col("_turn") % len(weights) == i, F.lit(float(x))).otherwise(weigh)
    per = per.withColumn("_turn", turn).withColumn("_w", weigh).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    by = Window.orderBy(F.col("_cap") / F.col("_w"), "_turn")
    before, onward = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    per = (per.withColumn("_all", F.sum("source_size").over(whole))
           .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                       / F.sum("_w").over(onward))
           .withColumn("_free", F.col("_cap") > F.col("_level") * F.col("_w"))
           .withColumn("_level", F.min_by("_level", F.when(F.col("_free"), F.col("_cap") / F.col("_w"))).over(whole))
           .withColumn("target", F.when(F.col("_free"), F.least(F.col("_cap"), F.col("_w") * F.col("_level")))
                       .otherwise(F.col("_cap"))))
    budget = F.floor("target").cast("long")
    some = F.greatest(F.col("source_size"), F.lit(1))
    return (per.withColumn("_epochs", F.floor(budget / some).cast("long"))
            .withColumn("_rest", budget - F.col("_epochs") * F.col("source_size"))
            .select("_src", "source_size", "target", "_epochs", "_rest"))


def _crossing(rows: DataFrame, bucket: str, limits: DataFrame) -> DataFrame:
    """Per source the bucket in which the running sum of words passes _rest,
    as _cross, with the words before it as _before."""
    sums = rows.groupBy("_src", bucket).agg(F.sum("_size").alias("_words"))
    w = Window.partitionBy("_src").orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("_to", F.sum("_words").over(w)).join(limits, "_src")
    start = F.col("_to") - F.col("_words") + F.col("_done")
    return sums.where((start <= F.col("_rest")) & (F.col("_rest") < F.col("_to") + F.col("_done"))).select(
        "_src", F.col(bucket).alias("_cross"), start.alias("_before"))


def cuts(keyed: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, files: int | None = None) -> DataFrame:
    """Per source: its budget, the fine bucket that the fraction ends in
    (_cross, null if there are no words) and the words before it (_before)."""
    slim = cut(keyed.select("_src", "source", "_size", "_fine"), files)
    limits = cut(budgets(slim, weights, most))
    coarse = slim.withColumn("_coarse", F.floor(F.col("_fine") / (FINE // COARSE)).cast("long"))
    first = _crossing(coarse, "_coarse", limits.select("_src", "_rest", F.lit(0).cast("long").alias("_done")))
    first = small(cut(first, files))
    inside = coarse.join(first, "_src").where("_coarse = _cross")
    limits2 = first.join(limits, "_src").select("_src", "_rest", F.col("_before").alias("_done"))
    second = _crossing(inside.select("_src", "_fine", "_size"), "_fine", limits2)
    return cut(limits.join(second, "_src", "left"), files)


def split_at_cut(keyed: DataFrame, per_source: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows decided by their bucket alone, with _part (words of the fraction
    taken from the row), and the rows of the last bucket, still to be ordered."""
    rows = keyed.join(small(per_source), "_src")
    clear = F.col("_cross").isNull() | (F.col("_fine") != F.col("_cross"))
    part = F.when(F.col("_fine") < F.col("_cross"), F.col("_size")).otherwise(F.lit(0).cast("long"))
    return rows.where(clear).withColumn("_part", part), rows.where(~clear)


def _part(start):
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("_size"), F.col("_rest") - start))


def mix_words(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``."""
    keyed = with_keys(docs.select("doc_id", "source", "text")).drop("text")
    keyed = cut(keyed)
    clear, last = split_at_cut(keyed, cuts(keyed, weights, most))
    same = ["_src", "_key", "doc_id", "_size", "_chars"]
    rest = ["source_size", "target", "_epochs", "_rest", "_before"]
    groups = last.groupBy(*same, *rest).agg(F.count(F.lit(1)).alias("_rows"))
    w = (Window.partitionBy("_src").orderBy("_key", F.col("doc_id").asc_nulls_first(), "_size", "_chars")
         .rowsBetween(Window.unboundedPreceding, 0))
    words = F.col("_rows") * F.col("_size")
    groups = groups.withColumn("_from", F.sum(words).over(w) - words + F.col("_before"))
    ordered = explode_count(groups, F.col("_rows"), "_i").withColumn(
        "_part", _part(F.col("_from") + F.col("_i") * F.col("_size")))
    out = ["doc_id", F.col("_size").alias("size"), "source_size", "target",
           (F.col("_epochs") * F.col("_size") + F.col("_part")).alias("taken")]
    return clear.select(*out).union(ordered.select(*out))


def mix_documents(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed documents: every row as often as the mix takes it, whole; the
    crossing document of a source is in if at least half of it is.  Rows equal
    in every column are counted before they are ordered."""
    keyed = with_keys(docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row")))
    files = files_for(docs)
    clear, last = split_at_cut(keyed, cuts(keyed, weights, most, files))
    last = last.withColumn("_h1", F.xxhash64("_row")).withColumn("_h2", F.xxhash64(F.lit(1), "_row"))
    same = ["_src", "_key", "doc_id", "_size", "_chars", "_h1", "_h2"]
    groups = last.groupBy(*same, "_rest", "_before").agg(F.count(F.lit(1)).alias("_rows"))
    w = (Window.partitionBy("_src").orderBy("_key", F.col("doc_id").asc_nulls_first(), "_size", "_chars", "_h1", "_h2")
         .rowsBetween(Window.unboundedPreceding, 0))
    words = F.col("_rows") * F.col("_size")
    left = F.col("_rest") - F.col("_before") - F.sum(words).over(w) + words
    # of its equal rows the mix takes those that are in with half their words or more
    taken = F.floor((left - F.ceil(F.col("_size") / 2)) / F.when(F.col("_size") > 0, F.col("_size"))) + 1
    groups = cut(groups.withColumn("_taken", F.coalesce(F.greatest(F.lit(0), F.least("_rows", taken)), F.lit(0)).cast("long"))
                 .select(*(F.col(c).alias(f"_g{c}") for c in same), "_rows", "_taken"), files)
    met = last.join(groups, F.expr(" AND ".join(f"{c} <=> _g{c}" for c in same)))
    whole = met.withColumn("_times", F.col("_epochs") + F.when(F.col("_taken") == F.col("_rows"), 1).otherwise(0))
    some = (met.where("_taken > 0 AND _taken < _rows").groupBy(*same)
            .agg(F.first("_row").alias("_row"), F.max("_taken").alias("_times")))
    rows = clear.withColumn("_times", F.col("_epochs") + F.when((F.col("_part") > 0) & (F.col("_part") * 2 >= F.col("_size")), 1).otherwise(0))
    need = ["_row", "_times"]
    rows = rows.select(*need).union(whole.select(*need)).union(some.select(*need))
    return explode_count(rows, F.col("_times"), "_i").select("_row.*").coalesce(files)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         length(coalesce(text, '')) AS chars
  FROM documents),
k AS (
  SELECT *, ln(-ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || size || '|' || chars), 1, 13)
                    AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
         / CASE WHEN size > 0 THEN 1.0::DOUBLE / (1.0::DOUBLE + abs(chars::DOUBLE / size - 6.0::DOUBLE)) ELSE 1.0::DOUBLE END) AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM k GROUP BY source),
c AS (SELECT *, source_size * 3.0::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE AS total FROM s),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
t AS (
  SELECT source, source_size,
         CASE WHEN cap > level * w
              THEN least(cap, w * min(level) FILTER (WHERE cap / w = first_free) OVER ()) ELSE cap END AS target
  FROM (SELECT *, min(cap / w) FILTER (WHERE cap > level * w) OVER () AS first_free FROM l)),
b AS (
  SELECT *, floor(target)::BIGINT // greatest(source_size, 1) AS epochs,
         floor(target)::BIGINT - floor(target)::BIGINT // greatest(source_size, 1) * source_size AS rest
  FROM t),
r AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.epochs, b.rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size, chars ROWS UNBOUNDED PRECEDING) - k.size AS start
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - start)))::BIGINT AS taken
FROM r
"""


@register("op7_source_mix", ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mix_words(table(spark, sf_dir, "documents"))
