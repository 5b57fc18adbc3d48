"""Measures and the prompt-level analyses (semantics are ours)."""
from __future__ import annotations


from ..functions import constants as C
from ..operators import measures as M
from ..sources.domain import Domain
from .oracle_views import lit, with_views
from .registry import register

_PCT = "CAST(floor(CAST({n} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(NULLIF({d}, 0) AS DOUBLE) + 0.5) AS BIGINT)"


@register("metric_appeals_stats", with_views("appeals") + """
SELECT appeal_type, appeal_source, COUNT(*) AS appeals,
       COUNT(CASE WHEN is_overturned THEN 1 END) AS overturned,
       COUNT(CASE WHEN appeal_status = 'Withdrawn' THEN 1 END) AS withdrawn,
       COUNT(CASE WHEN appeal_status = 'Pending' THEN 1 END) AS pending,
       COUNT(CASE WHEN has_documentation THEN 1 END) AS documented,
       CAST(GROUPING(appeal_type, appeal_source) AS BIGINT) AS grouping_id
FROM appeals GROUP BY ROLLUP (appeal_type, appeal_source)""")
def q_metric_appeals_stats(spark, sf_dir):
    return M.metric_view(Domain.of(spark, sf_dir).appeals, ["appeal_type", "appeal_source"],
                         ["appeals", "overturned", "withdrawn", "pending", "documented"], rollup=True)


@register("metric_denial_trends", with_views("claims") + """
SELECT CAST(date_trunc('month', submitted_date) AS DATE) AS month, service_type, COUNT(*) AS claims,
       COUNT(CASE WHEN status = 'Denied' THEN 1 END) AS denied,
       CAST(COUNT(CASE WHEN status = 'Denied' THEN 1 END) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS denial_rate
FROM claims GROUP BY ALL""")
def q_metric_denial_trends(spark, sf_dir):
    return M.denial_trends(Domain.of(spark, sf_dir).claims)


@register("metric_overturn_rates", with_views("appeals") + f"""
SELECT original_denial_reason, COUNT(*) AS appeals, COUNT(CASE WHEN is_overturned THEN 1 END) AS overturned,
       COUNT(CASE WHEN starts_with(appeal_status, 'Resolved') THEN 1 END) AS decided,
       {_PCT.format(n="COUNT(CASE WHEN is_overturned THEN 1 END)", d="COUNT(*)")} AS overturn_rate_pct,
       {_PCT.format(n="COUNT(CASE WHEN is_overturned THEN 1 END)",
                    d="COUNT(CASE WHEN starts_with(appeal_status, 'Resolved') THEN 1 END)")} AS overturn_rate_decided_pct
FROM appeals GROUP BY original_denial_reason""")
def q_metric_overturn_rates(spark, sf_dir):
    return M.overturn_rates(Domain.of(spark, sf_dir).appeals)


@register("metric_overturn_rates_by_type", with_views("appeals") + f"""
SELECT appeal_type, appeal_source, COUNT(*) AS appeals, COUNT(CASE WHEN is_overturned THEN 1 END) AS overturned,
       COUNT(CASE WHEN starts_with(appeal_status, 'Resolved') THEN 1 END) AS decided,
       {_PCT.format(n="COUNT(CASE WHEN is_overturned THEN 1 END)", d="COUNT(*)")} AS overturn_rate_pct,
       {_PCT.format(n="COUNT(CASE WHEN is_overturned THEN 1 END)",
                    d="COUNT(CASE WHEN starts_with(appeal_status, 'Resolved') THEN 1 END)")} AS overturn_rate_decided_pct
FROM appeals GROUP BY appeal_type, appeal_source""")
def q_metric_overturn_rates_by_type(spark, sf_dir):
    return M.overturn_rates(Domain.of(spark, sf_dir).appeals, "appeal_type", "appeal_source")


@register("metric_appeals_by_month", with_views("appeals") + """
SELECT CAST(date_trunc('month', appeal_date) AS DATE) AS appeal_month, appeal_status, COUNT(*) AS appeals,
       COUNT(CASE WHEN is_overturned THEN 1 END) AS overturned
FROM appeals GROUP BY ALL""")
def q_metric_appeals_by_month(spark, sf_dir):
    return M.metric_view(Domain.of(spark, sf_dir).appeals, ["appeal_month", "appeal_status"], ["appeals", "overturned"])


_GLP1 = "(" + ", ".join(lit(x) for x in C.GLP1_DRUGS) + ")"


@register("glp1_utilization", with_views("claims") + f"""
SELECT drug, CAST(date_trunc('month', submitted_date) AS DATE) AS month, COUNT(*) AS claims,
       COUNT(DISTINCT member_id) AS members, CAST(SUM(billed_cents) AS BIGINT) AS billed_cents,
       CAST(SUM(paid_cents) AS BIGINT) AS paid_cents
FROM claims WHERE drug IN {_GLP1} GROUP BY ALL""")
def q_glp1_utilization(spark, sf_dir):
    return M.glp1_utilization(Domain.of(spark, sf_dir).claims)


PROMPT_BRANDS = ["Ozempic", "Wegovy"]
_BRANDS_VALUES = ", ".join(f"({lit(b)}, {lit(g)})" for b, g in C.BRAND_TO_GENERIC)


@register("brand_drug_appeals", with_views("appeals", "prior_authorizations", extra=[
    ("brand_map", f"SELECT * FROM (VALUES {_BRANDS_VALUES}) t(brand, generic)"),
    ("g", "SELECT generic, string_agg(brand, ',' ORDER BY brand) AS brands FROM brand_map "
          "WHERE brand IN (" + ", ".join(lit(b) for b in PROMPT_BRANDS) + ") GROUP BY generic")]) + """
SELECT a.appeal_id, a.prior_auth_id, p.drug, g.brands, a.appeal_status, a.original_denial_reason,
       p.denial_reason AS pa_denial_reason
FROM appeals a JOIN prior_authorizations p ON a.prior_auth_id = p.prior_auth_id
JOIN g ON p.drug = g.generic""")
def q_brand_drug_appeals(spark, sf_dir):
    d = Domain.of(spark, sf_dir)
    return M.brand_drug_appeals(d.appeals, d.prior_authorizations, PROMPT_BRANDS)


@register("provider_peer_benchmark", with_views("claims", "providers", extra=[
    ("per", "SELECT provider_id, COUNT(*) AS claims, COUNT(CASE WHEN status = 'Denied' THEN 1 END) AS denied "
            "FROM claims GROUP BY provider_id"),
    ("prov", "SELECT p.provider_id, p.specialty, CAST(COALESCE(per.claims, 0) AS BIGINT) AS claims, "
             "CAST(COALESCE(per.denied, 0) AS BIGINT) AS denied "
             "FROM providers p LEFT JOIN per ON p.provider_id = per.provider_id"),
    ("x", "SELECT provider_id, specialty, claims, denied, "
          "CAST(denied AS DOUBLE) / CAST(NULLIF(claims, 0) AS DOUBLE) AS denial_rate, "
          "CAST(SUM(claims) OVER (PARTITION BY specialty) - claims AS BIGINT) AS peer_claims, "
          "CAST(SUM(denied) OVER (PARTITION BY specialty) - denied AS BIGINT) AS peer_denied FROM prov")]) + """
SELECT provider_id, specialty, claims, denied, denial_rate, peer_claims, peer_denied,
       CAST(peer_denied AS DOUBLE) / CAST(NULLIF(peer_claims, 0) AS DOUBLE) AS peer_denial_rate,
       CAST(rank() OVER (PARTITION BY specialty ORDER BY denial_rate DESC NULLS LAST, provider_id ASC) AS BIGINT)
         AS rank_in_specialty
FROM x""")
def q_provider_peer_benchmark(spark, sf_dir):
    d = Domain.of(spark, sf_dir)
    return M.provider_peer_benchmark(d.claims, d.providers)
