"""Governed measures over the domain tables (semantics are ours: the source
application names these metric views but does not define them).

A measure is a named aggregate Column; ``metric_view`` groups by any chosen
dimensions (optionally with ROLLUP subtotals).  Every measure is a
decomposable aggregate, so Catalyst combines partially before the shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.scalars import round_half_up_pct
from .predicates import is_glp1
from .ranking import row_number_within


def _cnt(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


APPEAL_MEASURES = {
    "appeals": lambda: F.count(F.lit(1)),
    "overturned": lambda: _cnt(F.col("is_overturned")),
    "withdrawn": lambda: _cnt(F.col("appeal_status") == "Withdrawn"),
    "pending": lambda: _cnt(F.col("appeal_status") == "Pending"),
    "decided": lambda: _cnt(F.col("appeal_status").startswith("Resolved")),
    "documented": lambda: _cnt(F.col("has_documentation")),
}

APPEAL_DIMENSIONS = {
    "appeal_type": lambda: F.col("appeal_type"),
    "appeal_source": lambda: F.col("appeal_source"),
    "appeal_status": lambda: F.col("appeal_status"),
    "original_denial_reason": lambda: F.col("original_denial_reason"),
    "appeal_month": lambda: F.trunc("appeal_date", "month"),
}


def metric_view(df: DataFrame, dims: list[str], measures: list[str], rollup: bool = False,
                dim_defs=APPEAL_DIMENSIONS, measure_defs=APPEAL_MEASURES) -> DataFrame:
    dcols = [dim_defs[d]().alias(d) for d in dims]
    aggs = [measure_defs[m]().alias(m) for m in measures]
    if rollup:
        return df.rollup(*dcols).agg(*aggs, F.grouping_id().cast("bigint").alias("grouping_id"))
    return df.groupBy(*dcols).agg(*aggs)


def denial_trends(claims: DataFrame) -> DataFrame:
    """Claims, denials and denial rate per submission month and service type."""
    n = F.count(F.lit(1))
    den = _cnt(F.col("status") == "Denied")
    return (claims.groupBy(F.trunc("submitted_date", "month").alias("month"), "service_type")
            .agg(n.alias("claims"), den.alias("denied"))
            .withColumn("denial_rate", F.try_divide(F.col("denied").cast("double"), F.col("claims").cast("double"))))


def overturn_rates(appeals: DataFrame, *by: str) -> DataFrame:
    """Overturned / all appeals and overturned / decided appeals, per ``by``
    (the original denial reason if nothing is named)."""
    return (appeals.groupBy(*(by or ("original_denial_reason",)))
            .agg(F.count(F.lit(1)).alias("appeals"),
                 _cnt(F.col("is_overturned")).alias("overturned"),
                 _cnt(F.col("appeal_status").startswith("Resolved")).alias("decided"))
            .withColumn("overturn_rate_pct", round_half_up_pct(F.col("overturned"), F.col("appeals")))
            .withColumn("overturn_rate_decided_pct", round_half_up_pct(F.col("overturned"), F.col("decided"))))


def glp1_utilization(claims: DataFrame) -> DataFrame:
    """GLP-1 claims per drug and month: claims, distinct members, money (cents)."""
    return (claims.where(is_glp1(F.col("drug")))
            .groupBy("drug", F.trunc("submitted_date", "month").alias("month"))
            .agg(F.count(F.lit(1)).alias("claims"),
                 F.count_distinct("member_id").alias("members"),
                 F.sum("billed_cents").cast("bigint").alias("billed_cents"),
                 F.sum("paid_cents").cast("bigint").alias("paid_cents")))


def brand_table(spark) -> DataFrame:
    """Brand -> generic lookup (ours); a fixed 8-row table."""
    return spark.createDataFrame(C.BRAND_TO_GENERIC, "brand string, generic string")


def brand_drug_appeals(appeals: DataFrame, pas: DataFrame, brands: list[str]) -> DataFrame:
    """Appeals whose prior authorization is for the generic of any listed brand.

    The brand table is a fixed 8-row literal, so broadcasting it is bounded;
    appeals and PAs meet in a key join on prior_auth_id."""
    spark = appeals.sparkSession
    generics = F.broadcast(brand_table(spark).where(F.col("brand").isin(*brands))
                           .groupBy("generic").agg(F.array_sort(F.collect_set("brand")).alias("brands")))
    pa = (pas.select("prior_auth_id", F.col("drug"), F.col("denial_reason").alias("pa_denial_reason"))
          .join(generics, F.col("drug") == F.col("generic"), "inner"))
    return (appeals.where(F.col("prior_auth_id").isNotNull())
            .join(pa, "prior_auth_id", "inner")
            .select("appeal_id", "prior_auth_id", "drug", F.array_join("brands", ",").alias("brands"),
                    "appeal_status", "original_denial_reason", "pa_denial_reason"))


def provider_peer_benchmark(claims: DataFrame, providers: DataFrame) -> DataFrame:
    """Each provider's denial rate next to its specialty peers (the specialty
    without the provider), and its rank in the specialty by denial rate.

    Per-provider counts are a partial aggregate; specialty totals are a
    second aggregate over those (one row per specialty) joined back; the
    rank uses ``row_number_within`` (range-partitioned, no per-specialty
    window).  Filter to one provider after this, not before."""
    per = (claims.groupBy("provider_id")
           .agg(F.count(F.lit(1)).alias("claims"), _cnt(F.col("status") == "Denied").alias("denied")))
    prov = (providers.select("provider_id", "specialty").join(per, "provider_id", "left")
            .select("provider_id", "specialty",
                    F.coalesce("claims", F.lit(0)).cast("bigint").alias("claims"),
                    F.coalesce("denied", F.lit(0)).cast("bigint").alias("denied")))
    spec = prov.groupBy("specialty").agg(F.sum("claims").alias("_sc"), F.sum("denied").alias("_sd"))
    rate = F.try_divide(F.col("denied").cast("double"), F.col("claims").cast("double"))
    out = (prov.join(spec, "specialty")
           .select("provider_id", "specialty", "claims", "denied", rate.alias("denial_rate"),
                   (F.col("_sc") - F.col("claims")).cast("bigint").alias("peer_claims"),
                   (F.col("_sd") - F.col("denied")).cast("bigint").alias("peer_denied")))
    out = out.withColumn("peer_denial_rate", F.try_divide(F.col("peer_denied").cast("double"),
                                                          F.col("peer_claims").cast("double")))
    return row_number_within(out, ["specialty"],
                             [F.desc_nulls_last("denial_rate"), F.asc("provider_id")],
                             alias="rank_in_specialty")


def benchmark_provider(claims: DataFrame, providers: DataFrame, provider_id: str) -> DataFrame:
    """One provider against its specialty peers (e.g. ``PRV-0012``).

    The filter is applied after the rank, so the rank is the provider's
    place among all of its specialty, not among a filtered subset."""
    return provider_peer_benchmark(claims, providers).where(F.col("provider_id") == provider_id)
