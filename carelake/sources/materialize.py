"""Write the six domain tables once and query the written copies.

Deriving ``appeals`` from ``orders`` costs a scan of ``orders`` per query;
dashboards that run all day should read written tables instead.  The
layout:

* ``claims`` and ``prior_authorizations`` partitioned by submission / request
  month (trend queries prune partitions), ``appeals`` by appeal month;
* rows are range-partitioned on ``(date, key)`` before the write, so each
  task writes a contiguous slice of a few months (few files) and a date that
  holds a third of all rows is still split over many tasks;
* ``claims`` and ``prior_authorizations`` keep the order's date and key, so it
  is the narrow ``orders`` that are dealt out, and their wide rows are derived
  once, behind that shuffle, where they are written (a range shuffle reads its
  input twice, for the bounds and for the rows);
* the dimension tables (``members``, ``providers``, ``eligibility``) are
  written as they are, from their source rows dealt out by key.

Rows of twenty derived columns make a generated method that the JVM does not
compile; ``small_methods`` has Spark split it for these writes.

The job that writes a table also observes its rows and its rows without a
key (``DataFrame.observe``, behind the last shuffle, where a repeated task counts
once); the figures are written beside the tables, so reports on them
(``MaterializedDomain.counts``) read no table again.

Writing also cuts the lineage: work after ``materialize`` restarts from
these files, not from the source scan.
"""
from __future__ import annotations

import copy
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.audits import PRIMARY_KEYS
from .domain import DOMAIN_TABLES, Domain
from .sinks import small_methods, table_root
from .tables import is_folder, listing

LAYOUT = {
    # table: (date column, key column, partition column)
    "claims": ("submitted_date", "claim_key", "submitted_month"),
    "prior_authorizations": ("request_date", "pa_key", "request_month"),
    "appeals": ("appeal_date", "appeal_key", "appeal_month"),
}


#: Folder of the observed figures.
COUNTS = "_counts"
#: Tables whose LAYOUT's date and key are an order's.
FROM_ORDERS = ("claims", "prior_authorizations")


def dealt_out(domain: Domain, n: int) -> Domain:
    """``domain`` over the same source rows, ``orders`` in ``n`` ranges of (date,
    key), customers and suppliers dealt out by key; definitions are built anew."""
    out = copy.copy(domain)
    out.__dict__ = {k: v for k, v in domain.__dict__.items() if k not in (*DOMAIN_TABLES, "_loaded")}
    out._loaded = {"orders": domain.t("orders").repartitionByRange(n, F.col("o_orderdate").cast("date"), "o_orderkey"),
                   "customer": domain.t("customer").repartition("c_custkey"),
                   "supplier": domain.t("supplier").repartition("s_suppkey")}
    return out


def materialize(domain: Domain, root: str | None = None, num_partitions: int | None = None) -> str:
    spark = domain.spark
    root = (root or table_root(spark) + "/domain").rstrip("/")
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt_out(domain, n)
    tables = {name: (domain if name == "appeals" else dealt).table(name) for name in DOMAIN_TABLES}
    with small_methods(spark), ThreadPoolExecutor(len(tables)) as pool:  # a table's few tasks leave no core idle
        counts = list(pool.map(lambda name: _write(tables[name], name, root, n), tables))
    (spark.createDataFrame(counts, "table_name string, row_count long, null_keys long").coalesce(1)
     .write.mode("overwrite").parquet(f"{root}/{COUNTS}"))
    return root


def _write(df: DataFrame, name: str, root: str, n: int) -> tuple[str, int, int]:
    """Write one table; its name, rows and rows without a key."""
    if name in LAYOUT:
        date_col, key_col, part_col = LAYOUT[name]
        df = df.withColumn(part_col, F.date_format(date_col, "yyyy-MM"))  # text: kept as text when read
        if name not in FROM_ORDERS:
            df = df.repartitionByRange(n, date_col, key_col)
    seen = Observation()
    w = df.observe(seen, F.count(F.lit(1)).alias("row_count"),
                   F.count(F.when(F.col(PRIMARY_KEYS[name]).isNull(), 1)).alias("null_keys")).write.mode("overwrite")
    (w.partitionBy(LAYOUT[name][2]) if name in LAYOUT else w).parquet(f"{root}/{name}")
    return name, seen.get["row_count"], seen.get["null_keys"]


class MaterializedDomain(Domain):
    """The same table attributes as ``Domain``, read from written copies."""

    def __init__(self, spark: SparkSession, root: str, as_of: str | None = None):
        from ..functions import constants as C
        super().__init__(spark, root, as_of or C.DEFAULT_AS_OF)
        self.root = root.rstrip("/")
        for name in DOMAIN_TABLES:
            df = spark.read.parquet(f"{self.root}/{name}")
            if name in LAYOUT:
                df = df.withColumn(LAYOUT[name][2], F.col(LAYOUT[name][2]).cast("string"))
            self.__dict__[name] = df  # shadows the derived definitions; keeps the month column

    def table(self, name: str) -> DataFrame:
        return self.__dict__[name]

    def counts(self) -> DataFrame:
        """(table_name, row_count, null_keys) as observed while the tables were written."""
        return self.spark.read.parquet(f"{self.root}/{COUNTS}")

    def between(self, name: str, first, last) -> DataFrame:
        """Rows of a table with dates from ``first`` to ``last`` (dates): the
        months are named as well, so only their folders are read."""
        date_col, _, month = LAYOUT[name]
        return self.table(name).where(
            F.col(date_col).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
            & F.col(month).between(F.date_format(F.lit(first).cast("date"), "yyyy-MM"),
                                   F.date_format(F.lit(last).cast("date"), "yyyy-MM")))


def written(spark: SparkSession, sf_dir: str) -> MaterializedDomain:
    """The written copy of the tables of ``sf_dir``: made once per listing of
    the input, under the shared folder, and read by every later query."""
    import hashlib
    listed = listing(spark, sf_dir)
    d = Domain.of(spark, sf_dir)
    tag = hashlib.sha1(repr((sf_dir.rstrip("/"), listed, d.as_of_text, COUNTS)).encode()).hexdigest()[:16]
    root = f"{table_root(spark)}/written-{tag}"
    if not is_folder(spark, f"{root}/_done"):  # written last, so a broken write is made again
        materialize(d, root)
        spark.range(1).write.mode("overwrite").parquet(f"{root}/_done")
    return MaterializedDomain(spark, root)
