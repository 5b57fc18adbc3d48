"""Measures from partial aggregates of the written claims."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import partials as P
from ..sources.materialize import LAYOUT, written
from .oracle_views import with_views
from .registry import register

DIMS = ["service_type", "status"]
SUMS = {"claims": lambda: F.lit(1), "denied": lambda: (F.col("status") == "Denied").cast("int"),
        "billed_cents": lambda: F.col("billed_cents"), "paid_cents": lambda: F.col("paid_cents")}


def _parts(spark, sf_dir):
    root = written(spark, sf_dir).root
    return P.refresh(spark, f"{root}/claims", LAYOUT["claims"][2], f"{root}/_partials_claims", DIMS,
                     {n: c() for n, c in SUMS.items()}, "member_id")


@register("partial_denial_trends", with_views("claims") + """
SELECT strftime(submitted_date, '%Y-%m') AS month, service_type, COUNT(DISTINCT member_id) AS members, COUNT(*) AS claims,
       COUNT(CASE WHEN status = 'Denied' THEN 1 END) AS denied
FROM claims GROUP BY ALL""")
def q_partial_denial_trends(spark, sf_dir):
    """Claims, denials and different members per month and service type, from the partials."""
    return P.combine(_parts(spark, sf_dir), ["month", "service_type"], ["claims", "denied"], "members")


@register("partial_claims_rollup", with_views("claims") + """
SELECT service_type, status, COUNT(DISTINCT member_id) AS members, COUNT(*) AS claims,
       CAST(SUM(billed_cents) AS BIGINT) AS billed_cents, CAST(COALESCE(SUM(paid_cents), 0) AS BIGINT) AS paid_cents,
       CAST(GROUPING(service_type, status) AS BIGINT) AS grouping_id
FROM claims GROUP BY ROLLUP (service_type, status)""")
def q_partial_claims_rollup(spark, sf_dir):
    """Claims, cents and different members per service type and status with subtotals, from the partials."""
    return P.combine(_parts(spark, sf_dir), DIMS, ["claims", "billed_cents", "paid_cents"], "members", rollup=True)
