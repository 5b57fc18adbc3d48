"""Scalar functions and keyed derivations, each applied over a whole table."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..sources.builds import bronze_text, build_claims
from ..sources.domain import Domain
from ..sources.tables import load
from .oracle_views import with_views
from .registry import register


@register("format_id", """
SELECT o_orderkey, printf('CLM-%06d', o_orderkey) AS claim_id, printf('MBR-%05d', o_custkey) AS member_id,
       printf('PA-%02d', o_orderkey) AS short_id
FROM orders""")
def q_format_id(spark, sf_dir):
    """Zero-padded ids; ``short_id`` shows a key wider than the pad is kept whole."""
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", X.format_id("CLM", 6, "o_orderkey").alias("claim_id"),
                    X.format_id("MBR", 5, "o_custkey").alias("member_id"),
                    X.format_id("PA", 2, "o_orderkey").alias("short_id"))


@register("concat_name", with_views("providers") + "SELECT provider_id, provider_name FROM providers")
def q_concat_name(spark, sf_dir):
    return Domain.of(spark, sf_dir).providers.select("provider_id", "provider_name")


@register("csv_join", with_views("claims") + """
SELECT claim_id, concat_ws(',', primary_diagnosis_code, ndc_code, hcpcs_code) AS code_list FROM claims""")
def q_csv_join(spark, sf_dir):
    c = Domain.of(spark, sf_dir).claims
    arr = F.filter(F.array("primary_diagnosis_code", "ndc_code", "hcpcs_code"), lambda x: x.isNotNull())
    return c.select("claim_id", X.csv_join(arr).alias("code_list"))


@register("iso_date", with_views("claims") + """
SELECT claim_id, strftime(submitted_date, '%Y-%m-%d') AS submitted_text FROM claims""")
def q_iso_date(spark, sf_dir):
    return Domain.of(spark, sf_dir).claims.select("claim_id", X.iso_date("submitted_date").alias("submitted_text"))


@register("date_shift", with_views("claims") + """
SELECT claim_id, CAST(submitted_date + 30 AS DATE) AS due_date, CAST(submitted_date - 7 AS DATE) AS week_before,
       processed_date
FROM claims""")
def q_date_shift(spark, sf_dir):
    c = Domain.of(spark, sf_dir).claims
    return c.select("claim_id", X.date_shift("submitted_date", F.lit(30)).alias("due_date"),
                    X.date_shift("submitted_date", F.lit(-7)).alias("week_before"), "processed_date")


@register("amount_chain", with_views("claims") + """
SELECT claim_id, status, billed_cents, allowed_cents, paid_cents,
       allowed_cents <= billed_cents AND paid_cents <= allowed_cents AS chain_ok
FROM claims""")
def q_amount_chain(spark, sf_dir):
    c = Domain.of(spark, sf_dir).claims
    return c.select("claim_id", "status", "billed_cents", "allowed_cents", "paid_cents",
                    ((F.col("allowed_cents") <= F.col("billed_cents"))
                     & (F.col("paid_cents") <= F.col("allowed_cents"))).alias("chain_ok"))


_BRONZE_CLAIMS = with_views("claims", extra=[("bronze_claims", """
SELECT claim_id, status, ndc_code,
       CAST(CAST(CAST(billed_cents AS DOUBLE) / CAST(100 AS DOUBLE) AS DECIMAL(38,2)) AS VARCHAR) AS billed_amount,
       CAST(CAST(CAST(paid_cents AS DOUBLE) / CAST(100 AS DOUBLE) AS DECIMAL(38,2)) AS VARCHAR) AS paid_amount
FROM claims""")])


def _bronze_claims(spark, sf_dir):
    return bronze_text(build_claims(Domain.of(spark, sf_dir)))


@register("round_money", _BRONZE_CLAIMS + """
SELECT status, COUNT(*) AS count,
       CAST(SUM(TRY_CAST(billed_amount AS DECIMAL(28,2))) AS DOUBLE) AS total_billed,
       CAST(SUM(TRY_CAST(paid_amount AS DECIMAL(28,2))) AS DOUBLE) AS total_paid
FROM bronze_claims GROUP BY status""")
def q_round_money(spark, sf_dir):
    """The text-table form of the claims summary: ROUND(SUM(CAST(x AS DOUBLE)), 2)."""
    from ..operators.dashboard import claims_by_status_text
    return claims_by_status_text(_bronze_claims(spark, sf_dir))


@register("cast_double", _BRONZE_CLAIMS + """
SELECT claim_id, TRY_CAST(billed_amount AS DOUBLE) AS billed_amount, TRY_CAST(ndc_code AS DOUBLE) AS ndc_number
FROM bronze_claims""")
def q_cast_double(spark, sf_dir):
    b = _bronze_claims(spark, sf_dir)
    return b.select("claim_id", X.cast_double("billed_amount").alias("billed_amount"),
                    X.cast_double("ndc_code").alias("ndc_number"))


@register("number_or_zero", _BRONZE_CLAIMS + """
SELECT claim_id, COALESCE(TRY_CAST(paid_amount AS DOUBLE), 0.0) AS paid_amount,
       COALESCE(TRY_CAST(ndc_code AS DOUBLE), 0.0) AS ndc_number
FROM bronze_claims""")
def q_number_or_zero(spark, sf_dir):
    b = _bronze_claims(spark, sf_dir)
    return b.select("claim_id", X.number_or_zero("paid_amount").alias("paid_amount"),
                    X.number_or_zero("ndc_code").alias("ndc_number"))


@register("round_half_up_pct", with_views("claims") + """
SELECT provider_id, COUNT(*) AS claims, COUNT(CASE WHEN status = 'Denied' THEN 1 END) AS denied,
       CAST(floor(CAST(COUNT(CASE WHEN status = 'Denied' THEN 1 END) AS DOUBLE) * CAST(100 AS DOUBLE)
                  / CAST(COUNT(*) AS DOUBLE) + 0.5) AS BIGINT) AS denied_pct
FROM claims GROUP BY provider_id""")
def q_round_half_up_pct(spark, sf_dir):
    c = Domain.of(spark, sf_dir).claims
    n = F.count(F.lit(1))
    den = F.count(F.when(F.col("status") == "Denied", F.lit(1)))
    return c.groupBy("provider_id").agg(n.alias("claims"), den.alias("denied"),
                                        X.round_half_up_pct(den, n).alias("denied_pct"))


@register("format_thousands", with_views("claims") + """
SELECT status, format('{:,}', COUNT(*)) AS claims_text,
       '$' || format('{:,.2f}', CAST(CAST(sum(billed_cents) AS BIGINT) AS DOUBLE) / 100.0) AS billed_text
FROM claims GROUP BY status""")
def q_format_thousands(spark, sf_dir):
    from ..operators.dashboard import claims_by_status
    cbs = claims_by_status(Domain.of(spark, sf_dir).claims)
    return cbs.select("status", X.format_thousands("count").alias("claims_text"),
                      X.format_thousands("total_billed", 2, currency=True).alias("billed_text"))


# ------------------------------------------------------------ keyed columns

@register("null_unless", with_views("claims") + """
SELECT claim_id, status, denial_reason, denial_code, denial_category, ndc_code, drug FROM claims""")
def q_null_unless(spark, sf_dir):
    return Domain.of(spark, sf_dir).claims.select("claim_id", "status", "denial_reason", "denial_code",
                                               "denial_category", "ndc_code", "drug")


