"""Audits and lookups."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audits as A
from ..operators import lookups as L
from ..sources.domain import DOMAIN_TABLES, Domain
from .oracle_views import with_views
from .registry import register


def _tables(d):
    return {t: d.table(t) for t in DOMAIN_TABLES}


_FK_SQL = with_views(*DOMAIN_TABLES) + " UNION ALL ".join(
    f"""SELECT '{c}.{fk}' AS fk, COUNT(x.{fk}) AS "references",
       COUNT(CASE WHEN x.{fk} IS NOT NULL AND p._k IS NULL THEN 1 END) AS orphans
FROM {c} x LEFT JOIN (SELECT DISTINCT {pk} AS _k FROM {p}) p ON x.{fk} = p._k"""
    for c, fk, p, pk in A.FOREIGN_KEYS)


@register("fk_audit", _FK_SQL)
def q_fk_audit(spark, sf_dir):
    return A.fk_audit(_tables(Domain.of(spark, sf_dir)))


@register("fk_audit_bitmaps", _FK_SQL)
def q_fk_audit_bitmaps(spark, sf_dir):
    """The same audit with the keys shuffled as bitmaps of 64-bit words."""
    return A.fk_audit_bitmaps(_tables(Domain.of(spark, sf_dir)))


@register("denied_reference_audit", with_views("appeals", "claims", "prior_authorizations") + """
SELECT a.appeal_id, 'claim' AS ref_type, a.claim_id AS ref_id, COALESCE(c.status, 'missing') AS ref_state
FROM appeals a LEFT JOIN claims c ON a.claim_id = c.claim_id
WHERE a.claim_id IS NOT NULL AND (c.status IS NULL OR c.status != 'Denied')
UNION ALL
SELECT a.appeal_id, 'prior_auth', a.prior_auth_id,
       COALESCE(CASE WHEN p.is_approved THEN 'Approved' WHEN NOT p.is_approved THEN 'Denied' END, 'missing')
FROM appeals a LEFT JOIN prior_authorizations p ON a.prior_auth_id = p.prior_auth_id
WHERE a.prior_auth_id IS NOT NULL AND (p.is_approved IS NULL OR p.is_approved)""")
def q_denied_reference_audit(spark, sf_dir):
    d = Domain.of(spark, sf_dir)
    return A.denied_reference_audit(d.appeals, d.claims, d.prior_authorizations)


_DUP_SQL = with_views(*DOMAIN_TABLES) + " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS row_count, COUNT(k) AS distinct_keys,
       COUNT(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END) AS duplicate_keys,
       CAST(COALESCE(SUM(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_keys
FROM (SELECT {pk} AS k, COUNT(*) AS n FROM {t} GROUP BY {pk})"""
    for t, pk in A.PRIMARY_KEYS.items())


@register("duplicate_key_audit", _DUP_SQL)
def q_duplicate_key_audit(spark, sf_dir):
    return A.duplicate_key_audit(_tables(Domain.of(spark, sf_dir)))


# ------------------------------------------------------------------ lookups
_M_COLS = ("member_id, first_name, last_name, date_of_birth, gender, ssn, address, city, state, zip, "
           "phone, email, plan_type, created_at")


@register("member_lookup", with_views("members", "appeals") + f"""
SELECT m.member_id, {', '.join('m.' + c.strip() for c in _M_COLS.split(',')[1:])}
FROM (SELECT DISTINCT member_id FROM appeals WHERE is_overturned) k JOIN members m ON k.member_id = m.member_id""")
def q_member_lookup(spark, sf_dir):
    """Members whose appeal was overturned (request keys derived from appeals)."""
    d = Domain.of(spark, sf_dir)
    keys = d.appeals.where(F.col("is_overturned")).select("member_id")
    return L.member_lookup(d.members, keys)


@register("claim_lookup", with_views("claims", "providers", "prior_authorizations", "appeals") + """
SELECT c.claim_id, c.member_id, c.provider_id, c.prior_auth_id, c.status, c.service_type, c.billed_cents,
       c.paid_cents, c.denial_reason, pr.provider_name, pr.provider_type, pr.specialty,
       pa.is_approved AS pa_approved, pa.decision_date AS pa_decision_date
FROM (SELECT DISTINCT claim_id FROM appeals WHERE claim_id IS NOT NULL) k
JOIN claims c ON k.claim_id = c.claim_id
LEFT JOIN providers pr ON c.provider_id = pr.provider_id
LEFT JOIN prior_authorizations pa ON c.prior_auth_id = pa.prior_auth_id""")
def q_claim_lookup(spark, sf_dir):
    """Detail of every claim cited by an appeal."""
    d = Domain.of(spark, sf_dir)
    keys = d.appeals.where(F.col("claim_id").isNotNull()).select("claim_id")
    return L.claim_lookup(d.claims, d.providers, d.prior_authorizations, keys).select(
        "claim_id", "member_id", "provider_id", "prior_auth_id", "status", "service_type", "billed_cents",
        "paid_cents", "denial_reason", "provider_name", "provider_type", "specialty", "pa_approved",
        "pa_decision_date")


@register("appeal_lookup", with_views("members", "appeals") + """
SELECT a.member_id, a.appeal_id, a.appeal_status, a.appeal_date, a.appeal_type
FROM members m JOIN appeals a ON m.member_id = a.member_id""")
def q_appeal_lookup(spark, sf_dir):
    """Appeal status of every member, by member id."""
    d = Domain.of(spark, sf_dir)
    return L.appeal_lookup(d.appeals, d.members.select("member_id")).select("member_id", "appeal_id", "appeal_status",
                                                   "appeal_date", "appeal_type")


@register("eligibility_lookup", with_views("claims", "eligibility") + """
SELECT c.claim_id, c.member_id, c.service_date, e.eligibility_id, e.coverage_start, e.coverage_end
FROM claims c JOIN eligibility e
  ON c.member_id = e.member_id AND c.service_date BETWEEN e.coverage_start AND e.coverage_end""")
def q_eligibility_lookup(spark, sf_dir):
    """For every claim: the coverage span in force on its service date."""
    d = Domain.of(spark, sf_dir)
    req = d.claims.select("claim_id", "member_id", "service_date")
    return L.eligibility_lookup(d.eligibility, req).select(
        "claim_id", "member_id", "service_date", "eligibility_id", "coverage_start", "coverage_end")


@register("prior_auth_lookup", with_views("claims", "prior_authorizations") + """
SELECT p.prior_auth_id, p.member_id, p.service_type, p.is_approved, p.decision_date, p.denial_reason, p.drug
FROM (SELECT DISTINCT prior_auth_id FROM claims WHERE status = 'Denied' AND prior_auth_id IS NOT NULL) k
JOIN prior_authorizations p ON k.prior_auth_id = p.prior_auth_id""")
def q_prior_auth_lookup(spark, sf_dir):
    """PA detail for every PA cited by a denied claim."""
    d = Domain.of(spark, sf_dir)
    keys = d.claims.where((F.col("status") == "Denied") & F.col("prior_auth_id").isNotNull()).select("prior_auth_id")
    return L.prior_auth_lookup(d.prior_authorizations, keys).select(
        "prior_auth_id", "member_id", "service_type", "is_approved", "decision_date", "denial_reason", "drug")


@register("appeal_claim_denials", with_views("appeals", "claims") + """
SELECT a.appeal_id, a.claim_id, a.original_denial_reason, c.status AS claim_status,
       c.denial_reason AS claim_denial_reason, c.denial_code AS claim_denial_code, c.drug AS claim_drug
FROM appeals a LEFT JOIN claims c ON a.claim_id = c.claim_id""")
def q_appeal_claim_denials(spark, sf_dir):
    d = Domain.of(spark, sf_dir)
    return L.appeal_claim_denials(d.appeals, d.claims).select(
        "appeal_id", "claim_id", "original_denial_reason", "claim_status", "claim_denial_reason",
        "claim_denial_code", "claim_drug")


# -------------------------------------------------------- SQL table functions
def _functions(spark, sf_dir) -> None:
    d = Domain.of(spark, sf_dir)
    L.register_sql_functions(spark, {t: d.table(t) for t in DOMAIN_TABLES})


@register("sql_claims_of_member", with_views("claims", "providers", "prior_authorizations", "members") + """
SELECT m.member_id, c.claim_id, c.status, pr.provider_name, pr.specialty, pa.is_approved AS pa_approved,
       pa.decision_date AS pa_decision_date
FROM members m JOIN claims c ON c.member_id = m.member_id
LEFT JOIN providers pr ON c.provider_id = pr.provider_id
LEFT JOIN prior_authorizations pa ON c.prior_auth_id = pa.prior_auth_id""")
def q_sql_claims_of_member(spark, sf_dir):
    """The claims of every member, by the SQL function for one member."""
    _functions(spark, sf_dir)
    return spark.sql("""SELECT m.member_id, c.claim_id, c.status, c.provider_name, c.specialty, c.pa_approved,
        c.pa_decision_date FROM members m, LATERAL claims_of_member(m.member_id) c""")


@register("sql_claim_lookup", with_views("claims", "providers", "prior_authorizations", "appeals") + """
SELECT a.appeal_id, c.claim_id, c.billed_cents, pr.provider_name, pr.provider_type, pa.is_approved AS pa_approved
FROM appeals a JOIN claims c ON c.claim_id = a.claim_id
LEFT JOIN providers pr ON c.provider_id = pr.provider_id
LEFT JOIN prior_authorizations pa ON c.prior_auth_id = pa.prior_auth_id""")
def q_sql_claim_lookup(spark, sf_dir):
    """The claim behind every appeal that cites one, by the SQL function for one claim."""
    _functions(spark, sf_dir)
    return spark.sql("""SELECT a.appeal_id, c.claim_id, c.billed_cents, c.provider_name, c.provider_type, c.pa_approved
        FROM appeals a, LATERAL claim_lookup(a.claim_id) c WHERE a.claim_id IS NOT NULL""")


@register("sql_prior_auths_of_member", with_views("members", "prior_authorizations") + """
SELECT m.member_id, p.prior_auth_id, p.is_approved, p.drug
FROM members m JOIN prior_authorizations p ON p.member_id = m.member_id""")
def q_sql_prior_auths_of_member(spark, sf_dir):
    """The authorizations of every member, by the SQL function."""
    _functions(spark, sf_dir)
    return spark.sql("""SELECT m.member_id, p.prior_auth_id, p.is_approved, p.drug
        FROM members m, LATERAL prior_auths_of_member(m.member_id) p""")
