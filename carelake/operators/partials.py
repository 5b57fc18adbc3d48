"""Mergeable partial aggregates: one month of a table changes, one month is read.

A partial row holds, for a month, one value of every dimension and one 64-bit
word of the distinct key's bitmap (``audits.key_bits``), the bits seen and the
sums of the measures.  Bits merge by ``bit_or`` and sums by ``sum``, so any
subset of the dimensions, a rollup of them and exact distinct counts come from
partials alone.  Rows without the distinct key count in the sums only.

``refresh`` keeps partials of a table written with month folders up to date.
The files of each month are its version; months with another version than the
one stored with their partials are read and put in place of the old ones,
months that are gone are dropped, and both happen by one staged commit.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import current_version, read_saved, save_overwrite, small_methods
from ..sources.tables import child_folders, hadoop_path
from .audits import key_bits

#: Name of the folder of rows without a month.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def partials(rows: DataFrame, month: Column, dims: list[str], sums: dict[str, Column], distinct: str) -> DataFrame:
    """month, ``dims``, shape, word, bits and ``sums`` (columns of whole numbers) of ``rows``."""
    bit = key_bits(F.col(distinct))
    there = F.col(distinct).isNotNull()
    keyed = rows.select(F.coalesce(month.cast("string"), F.lit(NO_MONTH)).alias("month"), *dims,
                        F.when(there, bit["shape"]).alias("shape"), F.when(there, bit["word"]).alias("word"),
                        F.when(there, bit["bit"]).alias("_bit"), *(c.cast("bigint").alias(f"_{n}") for n, c in sums.items()))
    return keyed.groupBy("month", *dims, "shape", "word").agg(
        F.coalesce(F.bit_or("_bit"), F.lit(0).cast("bigint")).alias("bits"),
        *(F.coalesce(F.sum(f"_{n}"), F.lit(0).cast("bigint")).alias(n) for n in sums))


def combine(parts: DataFrame, by: list[str], sums: list[str], distinct: str, rollup: bool = False) -> DataFrame:
    """``sums`` and the number of different keys (as ``distinct``) per ``by``
    (a subset of the dimensions and the month), with subtotals and grouping_id
    for ``rollup``.  Subtotals merge bitmaps again: distinct counts do not add."""
    merge = [F.bit_or("bits").alias("bits"), *(F.sum(n).alias(n) for n in sums)]
    total = [F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias(distinct), *(F.sum(n).alias(n) for n in sums)]
    if not rollup:
        return parts.groupBy(*by, "shape", "word").agg(*merge).groupBy(*by).agg(*total)
    slim = parts.groupBy(*by, "shape", "word").agg(*merge)
    levels = None
    for k in range(len(by) + 1):
        kept = [F.col(b) if i < k else F.lit(None).cast(parts.schema[b].dataType).alias(b) for i, b in enumerate(by)]
        level = slim.select(*kept, "shape", "word", "bits", *sums, F.lit((1 << (len(by) - k)) - 1).cast("bigint").alias("grouping_id"))
        levels = level if levels is None else levels.unionByName(level)
    keys = [*by, "grouping_id"]
    return levels.groupBy(*keys, "shape", "word").agg(*merge).groupBy(*keys).agg(*total)


def month_versions(spark: SparkSession, path: str, column: str) -> dict[str, str]:
    """Per month folder of the table at ``path``: a digest of its files' names and sizes."""
    import hashlib
    out = {}
    for name in child_folders(spark, path):
        if name.startswith(f"{column}="):
            fs, at = hadoop_path(spark, f"{path}/{name}")
            files = sorted((f.getPath().getName(), f.getLen()) for f in fs.listStatus(at))
            out[name.split("=", 1)[1]] = hashlib.sha1(repr(files).encode()).hexdigest()
    return out


def refresh(spark: SparkSession, table: str, column: str, path: str, dims: list[str], sums: dict[str, Column],
            distinct: str) -> DataFrame:
    """The partials (with ``version``) at ``path`` of the written ``table``, whose
    folders are the months ``column=...``; only months that changed are read."""
    now = month_versions(spark, table, column)
    stored = read_saved(spark, path) if current_version(spark, path) else None
    old = {} if stored is None else {r.month: r.version for r in stored.select("month", "version").distinct().collect()}
    changed = sorted(m for m, v in now.items() if old.get(m) != v)
    if stored is not None and not changed and old.keys() <= now.keys():
        return stored
    # month folders are text, also where they look like numbers or dates
    raw = spark.read.parquet(table)
    month = F.coalesce(F.col(column).cast("string"), F.lit(NO_MONTH))
    new = partials(raw.where(month.isin(changed)), F.col(column), dims, sums, distinct)
    version = F.element_at(F.create_map(*[F.lit(x) for m in changed for x in (m, now[m])]), F.col("month")) if changed else F.lit("")
    new = new.withColumn("version", version)
    if stored is not None:
        kept = [m for m in now if m not in changed]
        new = stored.where(F.col("month").isin(kept)).unionByName(new)
    with small_methods(spark):
        return save_overwrite(new, path)
