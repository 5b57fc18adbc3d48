"""Projections, filters and predicates (each over a whole domain table)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators import dashboard as D
from ..operators import predicates as P
from ..sources.builds import bronze_text, build_appeals
from ..sources.domain import Domain
from .oracle_views import AS_OF, lit, with_views
from .registry import register

GLP1_SQL = "(" + ", ".join(lit(x) for x in C.GLP1_DRUGS) + ")"


@register("project_alias", with_views("appeals") + """
SELECT appeal_id, original_denial_reason AS reason, appeal_status AS status, appeal_date FROM appeals""")
def q_project_alias(spark, sf_dir):
    return Domain.of(spark, sf_dir).appeals.select(
        "appeal_id", F.col("original_denial_reason").alias("reason"),
        F.col("appeal_status").alias("status"), "appeal_date")


@register("nonblank_filter", with_views("claims") + """
SELECT claim_id, denial_reason FROM claims WHERE denial_reason IS NOT NULL AND denial_reason != ''""")
def q_nonblank_filter(spark, sf_dir):
    c = Domain.of(spark, sf_dir).claims
    return c.where(D.nonblank(F.col("denial_reason"))).select("claim_id", "denial_reason")


@register("bool_text_predicate", with_views("appeals") + """
SELECT appeal_id, is_overturned AS via_boolean, CAST(is_overturned AS VARCHAR) = 'true' AS via_text
FROM appeals""")
def q_bool_text_predicate(spark, sf_dir):
    """``x = 'true'`` over the typed table and over its all-text copy."""
    typed = build_appeals(Domain.of(spark, sf_dir))
    text = bronze_text(typed.select("is_overturned"))
    # both copies of a row side by side: the text columns are expressions of the same row, so no join is needed
    both = typed.select("appeal_id", "is_overturned", *[F.col(c).cast("string").alias(f"{c}_text") for c in text.columns])
    return both.select("appeal_id", D._is_true(F.col("is_overturned")).alias("via_boolean"),
                       D._is_true(F.col("is_overturned_text")).alias("via_text"))


@register("case_without_else", with_views("members") + """
SELECT member_id, CASE WHEN plan_type = 'Medicare' THEN member_id END AS medicare_member_id FROM members""")
def q_case_without_else(spark, sf_dir):
    m = Domain.of(spark, sf_dir).members
    return m.select("member_id", F.when(F.col("plan_type") == "Medicare", F.col("member_id"))
                    .alias("medicare_member_id"))


@register("denied_claims", with_views("claims") + """
SELECT claim_id, member_id, provider_id, denial_reason, denial_code, denial_category, billed_cents
FROM claims WHERE status = 'Denied'""")
def q_denied_claims(spark, sf_dir):
    return P.denied_claims(Domain.of(spark, sf_dir).claims).select(
        "claim_id", "member_id", "provider_id", "denial_reason", "denial_code", "denial_category",
        "billed_cents")


@register("denied_prior_auths", with_views("prior_authorizations") + """
SELECT prior_auth_id, member_id, denial_reason, denial_code FROM prior_authorizations WHERE NOT is_approved""")
def q_denied_prior_auths(spark, sf_dir):
    return P.denied_prior_auths(Domain.of(spark, sf_dir).prior_authorizations).select(
        "prior_auth_id", "member_id", "denial_reason", "denial_code")


@register("resolved_prefix", with_views("appeals") + """
SELECT appeal_id, appeal_status, reviewer_notes FROM appeals WHERE starts_with(appeal_status, 'Resolved')""")
def q_resolved_prefix(spark, sf_dir):
    return P.resolved(Domain.of(spark, sf_dir).appeals).select("appeal_id", "appeal_status", "reviewer_notes")


@register("coverage_active", with_views("eligibility") + f"""
SELECT eligibility_id, member_id, coverage_end FROM eligibility WHERE coverage_end >= {AS_OF}""")
def q_coverage_active(spark, sf_dir):
    d = Domain.of(spark, sf_dir)
    return P.coverage_active(d.eligibility, d.as_of).select("eligibility_id", "member_id", "coverage_end")


@register("glp1_filter", with_views("claims") + f"""
SELECT claim_id, member_id, drug FROM claims WHERE drug IN {GLP1_SQL}""")
def q_glp1_filter(spark, sf_dir):
    return P.glp1(Domain.of(spark, sf_dir).claims).select("claim_id", "member_id", "drug")
