"""Dashboard result sets and key figures.

The five summary queries group or top-k a single table: Catalyst plans a
partial (map-side) aggregate, one shuffle of at most (#groups x #tasks)
rows, and a final aggregate, so a status or reason that holds a third of
all rows is collapsed inside each task before the shuffle.  Top-k queries
plan as ``TakeOrderedAndProject`` (per-task top-k, then a merge), never a
global sort.

Key figures are one-row aggregates.  Figures from other tables enter as
scalar subqueries (``DataFrame.scalar()``), each computed once, so no
cross join and no driver round trip is needed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from ..functions import constants as C
from ..functions.scalars import round_half_up_pct, sum_cents_amount
from ..sources.builds import as_text


def _is_true(c: Column) -> Column:
    """``x = 'true'`` that works for BOOLEAN and for text columns."""
    return c.cast("string") == F.lit("true")


def is_true(df: DataFrame, name: str) -> Column:
    """``name = 'true'`` for ``df``: the boolean itself when the column is
    BOOLEAN (no per-row cast), a case-sensitive text compare otherwise."""
    if df.schema[name].dataType.typeName() == "boolean":
        return F.col(name)
    return F.col(name) == F.lit("true")


# ----------------------------------------------------------------- queries
def appeals_by_status(appeals: DataFrame, ordered: bool = True) -> DataFrame:
    """Appeals and overturned appeals per status, largest first.

    ``ordered=False`` leaves the order to the caller (e.g. a numbering
    window), saving the range-partitioned sort."""
    out = (appeals.groupBy("appeal_status")
           .agg(F.count(F.lit(1)).alias("count"),
                F.count(F.when(is_true(appeals, "is_overturned"), F.lit(1))).alias("overturned")))
    return out.orderBy(F.desc("count"), F.asc("appeal_status")) if ordered else out


def claims_by_status(claims: DataFrame, ordered: bool = True) -> DataFrame:
    """Counts and money per claim status; money summed as exact cents."""
    out = (claims.groupBy("status")
           .agg(F.count(F.lit(1)).alias("count"),
                sum_cents_amount("billed_cents").alias("total_billed"),
                sum_cents_amount("paid_cents").alias("total_paid")))
    return out.orderBy(F.desc("count"), F.asc("status")) if ordered else out


def claims_by_status_text(bronze_claims: DataFrame) -> DataFrame:
    """The same over all-text claims.  Money is summed as decimals, so the cents
    do not depend on the order of rows."""
    return (bronze_claims.groupBy("status")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.sum(F.col("billed_amount").try_cast("decimal(28,2)")).cast("double").alias("total_billed"),
                 F.sum(F.col("paid_amount").try_cast("decimal(28,2)")).cast("double").alias("total_paid"))
            .orderBy(F.desc("count"), F.asc("status")))


def nonblank(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def top_denial_reasons(appeals: DataFrame, k: int = C.TOP_DENIAL_REASONS_LIMIT) -> DataFrame:
    """Top-k reasons by count; ties broken by reason so the cut is stable."""
    return (appeals.where(nonblank(F.col("original_denial_reason")))
            .groupBy(F.col("original_denial_reason").alias("reason"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("reason"))
            .limit(k))


def recent_appeals(appeals: DataFrame, k: int = C.RECENT_APPEALS_LIMIT) -> DataFrame:
    """Latest k appeals; ``appeal_id`` breaks date ties."""
    return (appeals.select("appeal_id", "member_id", "appeal_type", "appeal_status",
                           "original_denial_reason", "appeal_date")
            .orderBy(F.desc_nulls_last("appeal_date"), F.desc("appeal_id"))
            .limit(k))


def member_count(members: DataFrame) -> DataFrame:
    return members.agg(
        F.count_distinct("member_id").alias("members"),
        F.count_distinct(F.when(F.col("plan_type") == "Medicare", F.col("member_id"))).alias("medicare"))


def order_by_count(df: DataFrame, key: str) -> DataFrame:
    """Groups of ``key`` ordered by size, largest first (key breaks ties)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(key)))


def top_k(df: DataFrame, key: str, alias: str, k: int) -> DataFrame:
    """First ``k`` non-blank groups of ``key`` by count."""
    return (df.where(nonblank(F.col(key))).groupBy(F.col(key).alias(alias))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(alias)).limit(k))


# ------------------------------------------------------------- key figures
def find_status_count(grouped: DataFrame, status_col: str, status: str,
                      count_col: str = "count") -> DataFrame:
    """Count for one status, 0 when absent; always exactly one row."""
    return grouped.agg(F.coalesce(F.sum(F.when(F.col(status_col) == status, F.col(count_col))),
                                  F.lit(0)).cast("bigint").alias(f"{status.lower().replace(' ', '_')}_count"))


def total_of(grouped: DataFrame, count_col: str, alias: str) -> DataFrame:
    return grouped.agg(F.coalesce(F.sum(count_col), F.lit(0)).cast("bigint").alias(alias))


def overturn_rate(appeals: DataFrame) -> DataFrame:
    """Overturned share of all appeals in whole percent, half up; 0 when empty.

    Also reports the share of decided (``Resolved*``) appeals, which is
    what the dashboard caption describes."""
    over = F.count(F.when(is_true(appeals, "is_overturned"), F.lit(1)))
    decided = F.count(F.when(F.col("appeal_status").startswith("Resolved"), F.lit(1)))
    n = F.count(F.lit(1))
    return appeals.agg(
        n.alias("appeals"), over.alias("overturned"), decided.alias("decided"),
        F.coalesce(round_half_up_pct(over, n), F.lit(0).cast("bigint")).alias("overturn_rate_pct"),
        F.coalesce(round_half_up_pct(over, decided), F.lit(0).cast("bigint")).alias("overturn_rate_decided_pct"))


def status_share(appeals: DataFrame) -> DataFrame:
    """Per status: count and whole percent of all appeals.

    The table is scanned once: the total is the sum of the per-status counts,
    taken with a window over the grouped rows (one row per status, a fixed
    vocabulary), not over the table and not by a second scan."""
    g = appeals.groupBy("appeal_status").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return g.select("appeal_status", "count", round_half_up_pct(F.col("count"), total).alias("pct"))


def kpi_cards(appeals: DataFrame, claims: DataFrame, members: DataFrame) -> DataFrame:
    """The four dashboard cards as one row."""
    n = F.count(F.lit(1))
    over = F.count(F.when(is_true(appeals, "is_overturned"), F.lit(1)))
    zero = F.lit(None).cast("bigint")
    names = ["total_appeals", "pending_appeals", "total_claims", "overturn_rate_pct", "members", "medicare"]

    def row(df: DataFrame, **own: Column) -> DataFrame:
        return df.select(*[own.get(c, zero).alias(c) for c in names])

    # each table is aggregated once to a row of its own figures; the rows are then laid over each other
    a = row(appeals.agg(n.alias("n"), F.count(F.when(F.col("appeal_status") == "Pending", F.lit(1))).alias("p"),
                        F.coalesce(round_half_up_pct(over, n), F.lit(0).cast("bigint")).alias("r")),
            total_appeals=F.col("n"), pending_appeals=F.col("p"), overturn_rate_pct=F.col("r"))
    c = row(claims.agg(n.alias("n")), total_claims=F.col("n"))
    m = row(member_count(members), members=F.col("members"), medicare=F.col("medicare"))
    return a.unionByName(c).unionByName(m).agg(*[F.max(c).alias(c) for c in names])


# ------------------------------------------------------- result-set export
def result_records(df: DataFrame, order_by: list[Column], bounded: bool = False) -> DataFrame:
    """Result set -> ``(row_no, record)`` with ``record`` a JSON object of
    column name -> text, column order kept and NULL kept as ``null``.

    ``bounded=True`` is for results whose size is fixed by their grouping
    vocabulary or a LIMIT (the dashboard summaries): the row number is a
    window over that small result.  For an arbitrary result use
    ``bounded=False``: the row number comes from the range-partitioned
    ``row_number_within`` and no task holds the whole result."""
    rec = F.to_json(F.struct(*as_text(df)), {"ignoreNullFields": "false"})
    if bounded:
        w = Window.orderBy(*order_by)
        return df.select(F.row_number().over(w).cast("bigint").alias("row_no"), rec.alias("record"))
    from .ranking import row_number_within
    numbered = row_number_within(df.select("*", rec.alias("record")), [], order_by, alias="row_no")
    return numbered.select("row_no", "record")


SUMMARY_ORDER = {
    "appeals_by_status": [("count", "desc"), ("appeal_status", "asc")],
    "claims_by_status": [("count", "desc"), ("status", "asc")],
    "top_denial_reasons": [("count", "desc"), ("reason", "asc")],
    "recent_appeals": [("appeal_date", "desc_nulls_last"), ("appeal_id", "desc")],
    "member_count": [("members", "asc")],
}


def summary_order(name: str) -> list[Column]:
    """Order of a summary query's rows (built lazily: Columns need a session)."""
    return [getattr(F, how)(c) for c, how in SUMMARY_ORDER[name]]


def summary_pack(builders: dict) -> DataFrame:
    """Run the summary queries into one keyed result ``(query, row_no, record, error)``.

    ``builders`` maps a query name to a zero-argument callable returning its
    DataFrame.  A query that fails analysis contributes one error row
    instead of silently disappearing."""
    parts = []
    for name, build in builders.items():
        try:
            df = build()
            part = result_records(df, summary_order(name), bounded=True).select(
                F.lit(name).alias("query"), "row_no", "record",
                F.lit(None).cast("string").alias("error"))
        except AnalysisException as e:  # analysis errors surface as data
            part = df_error(name, str(e))
        parts.append(part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_summary_pack(builders: dict, path: str, limit: float | None = 30.0) -> DataFrame:
    """The summary queries side by side, each written on its own
    (``path/query=<name>``) and given ``limit`` seconds.

    A query runs in a thread of its own under a job tag; when its time is over
    the jobs with that tag are cancelled and the pack has a row that says
    ``timed out``.  A query that fails has a row with its error.
    Neither holds up or fails the others.  Returns the written pack."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Timer
    from uuid import uuid4

    from pyspark import inheritable_thread_target
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    sc = spark.sparkContext  # its tags are seen from all threads; a session's only from the one that set them

    def write(name: str, build) -> None:
        target, tag, late = f"{path.rstrip('/')}/query={name}", f"summary-{uuid4().hex}", []

        def stop() -> None:
            late.append(True)
            sc.cancelJobsWithTag(tag)
        timer = Timer(limit, stop) if limit is not None else None
        sc.addJobTag(tag)
        try:
            if timer:
                timer.start()
            part = result_records(build(), summary_order(name), bounded=True)
            if late:  # the time was over before the first job
                raise TimeoutError
            part.select("row_no", "record", F.lit(None).cast("string").alias("error")).write.mode("overwrite").parquet(target)
        except Exception as e:  # isolate this query; keep the message as data
            sc.removeJobTag(tag)
            said = f"timed out after {limit:g} s" if late else str(e).strip() or type(e).__name__
            df_error(name, said, spark).drop("query").write.mode("overwrite").parquet(target)
        finally:
            if timer:
                timer.cancel()
            sc.removeJobTag(tag)

    with ThreadPoolExecutor(max(1, len(builders))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(write), *x) for x in builders.items()]:
            done.result()
    return spark.read.schema("row_no bigint, record string, error string, query string").parquet(path)


def df_error(name: str, message: str, spark=None) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = spark or SparkSession.getActiveSession()
    return spark.createDataFrame([(name, 0, None, message)],
                                 "query string, row_no bigint, record string, error string")
