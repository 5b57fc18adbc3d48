"""Dashboard queries: the five summary result sets, key figures, export."""
from __future__ import annotations

from ..operators import dashboard as D
from ..sources.domain import Domain
from .oracle_views import with_views
from .registry import register

W_APPEALS = with_views("appeals")
W_CLAIMS = with_views("claims")
W_MEMBERS = with_views("members")


@register("appeals_by_status", W_APPEALS + """
SELECT appeal_status, COUNT(*) AS count,
       COUNT(CASE WHEN CAST(is_overturned AS VARCHAR) = 'true' THEN 1 END) AS overturned
FROM appeals GROUP BY appeal_status""")
def q_appeals_by_status(spark, sf_dir):
    return D.appeals_by_status(Domain.of(spark, sf_dir).appeals)


@register("claims_by_status", W_CLAIMS + """
SELECT status, COUNT(*) AS count,
       CAST(CAST(sum(billed_cents) AS BIGINT) AS DOUBLE) / 100.0 AS total_billed,
       CAST(CAST(sum(paid_cents) AS BIGINT) AS DOUBLE) / 100.0 AS total_paid
FROM claims GROUP BY status""")
def q_claims_by_status(spark, sf_dir):
    return D.claims_by_status(Domain.of(spark, sf_dir).claims)


@register("top_denial_reasons", W_APPEALS + """
SELECT original_denial_reason AS reason, COUNT(*) AS count
FROM appeals
WHERE original_denial_reason IS NOT NULL AND original_denial_reason != ''
GROUP BY original_denial_reason ORDER BY count DESC, reason ASC LIMIT 5""")
def q_top_denial_reasons(spark, sf_dir):
    return D.top_denial_reasons(Domain.of(spark, sf_dir).appeals)


@register("recent_appeals", W_APPEALS + """
SELECT appeal_id, member_id, appeal_type, appeal_status, original_denial_reason, appeal_date
FROM appeals ORDER BY appeal_date DESC NULLS LAST, appeal_id DESC LIMIT 8""")
def q_recent_appeals(spark, sf_dir):
    return D.recent_appeals(Domain.of(spark, sf_dir).appeals)


@register("member_count", W_MEMBERS + """
SELECT COUNT(DISTINCT member_id) AS members,
       COUNT(DISTINCT CASE WHEN plan_type = 'Medicare' THEN member_id END) AS medicare
FROM members""")
def q_member_count(spark, sf_dir):
    return D.member_count(Domain.of(spark, sf_dir).members)


# --------------------------------------------------------------- key figures
_ABS_CTE = with_views("appeals", extra=[("abs", """
SELECT appeal_status, COUNT(*) AS count,
       COUNT(CASE WHEN is_overturned THEN 1 END) AS overturned
FROM appeals GROUP BY appeal_status""")])


@register("total_appeals", _ABS_CTE + "SELECT CAST(COALESCE(SUM(count), 0) AS BIGINT) AS total_appeals FROM abs")
def q_total_appeals(spark, sf_dir):
    return D.total_of(D.appeals_by_status(Domain.of(spark, sf_dir).appeals, ordered=False), "count", "total_appeals")


@register("pending_appeals", _ABS_CTE + """
SELECT CAST(COALESCE(SUM(CASE WHEN appeal_status = 'Pending' THEN count END), 0) AS BIGINT) AS pending_count
FROM abs""")
def q_pending_appeals(spark, sf_dir):
    return D.find_status_count(D.appeals_by_status(Domain.of(spark, sf_dir).appeals, ordered=False),
                               "appeal_status", "Pending")


@register("find_status_count", _ABS_CTE + """
SELECT CAST(COALESCE(SUM(CASE WHEN appeal_status = 'Denied' THEN count END), 0) AS BIGINT) AS denied_count
FROM abs""")
def q_find_status_count(spark, sf_dir):
    """A status the appeals never have: the figure is 0, still one row."""
    return D.find_status_count(D.appeals_by_status(Domain.of(spark, sf_dir).appeals, ordered=False),
                               "appeal_status", "Denied")


@register("total_claims", with_views("claims", extra=[("cbs", """
SELECT status, COUNT(*) AS count FROM claims GROUP BY status""")]) + """
SELECT CAST(COALESCE(SUM(count), 0) AS BIGINT) AS total_claims FROM cbs""")
def q_total_claims(spark, sf_dir):
    return D.total_of(D.claims_by_status(Domain.of(spark, sf_dir).claims, ordered=False), "count", "total_claims")


_PCT = "CAST(floor(CAST({n} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(NULLIF({d}, 0) AS DOUBLE) + 0.5) AS BIGINT)"
_OVR = with_views("appeals", extra=[("o", """
SELECT COUNT(*) AS appeals,
       COUNT(CASE WHEN is_overturned THEN 1 END) AS overturned,
       COUNT(CASE WHEN starts_with(appeal_status, 'Resolved') THEN 1 END) AS decided
FROM appeals""")])


@register("overturn_rate", _OVR + f"""
SELECT appeals, overturned, decided,
       COALESCE({_PCT.format(n='overturned', d='appeals')}, 0) AS overturn_rate_pct,
       COALESCE({_PCT.format(n='overturned', d='decided')}, 0) AS overturn_rate_decided_pct
FROM o""")
def q_overturn_rate(spark, sf_dir):
    return D.overturn_rate(Domain.of(spark, sf_dir).appeals)


@register("overturn_rate_decided", _OVR + f"""
SELECT decided, overturned, COALESCE({_PCT.format(n='overturned', d='decided')}, 0) AS overturn_rate_decided_pct
FROM o""")
def q_overturn_rate_decided(spark, sf_dir):
    return D.overturn_rate(Domain.of(spark, sf_dir).appeals).select(
        "decided", "overturned", "overturn_rate_decided_pct")


@register("status_share", W_APPEALS + f"""
SELECT appeal_status, COUNT(*) AS count,
       {_PCT.format(n='COUNT(*)', d='(SELECT COUNT(*) FROM appeals)')} AS pct
FROM appeals GROUP BY appeal_status""")
def q_status_share(spark, sf_dir):
    return D.status_share(Domain.of(spark, sf_dir).appeals)


@register("kpi_cards", with_views("appeals", "claims", "members") + f"""
SELECT COUNT(*) AS total_appeals,
       COUNT(CASE WHEN appeal_status = 'Pending' THEN 1 END) AS pending_appeals,
       (SELECT COUNT(*) FROM claims) AS total_claims,
       COALESCE({_PCT.format(n='COUNT(CASE WHEN is_overturned THEN 1 END)', d='COUNT(*)')}, 0) AS overturn_rate_pct,
       (SELECT COUNT(DISTINCT member_id) FROM members) AS members,
       (SELECT COUNT(DISTINCT CASE WHEN plan_type = 'Medicare' THEN member_id END) FROM members) AS medicare
FROM appeals""")
def q_kpi_cards(spark, sf_dir):
    d = Domain.of(spark, sf_dir)
    return D.kpi_cards(d.appeals, d.claims, d.members)


@register("order_by_count", with_views("claims") + """
SELECT service_type, COUNT(*) AS count FROM claims GROUP BY service_type""")
def q_order_by_count(spark, sf_dir):
    return D.order_by_count(Domain.of(spark, sf_dir).claims, "service_type")


@register("top_k_reasons", with_views("claims") + """
SELECT denial_reason AS reason, COUNT(*) AS count FROM claims
WHERE denial_reason IS NOT NULL AND denial_reason != ''
GROUP BY denial_reason ORDER BY count DESC, reason ASC LIMIT 5""")
def q_top_k_reasons(spark, sf_dir):
    return D.top_k(Domain.of(spark, sf_dir).claims, "denial_reason", "reason", 5)


_REC_ABS = _ABS_CTE + """
SELECT row_number() OVER (ORDER BY count DESC, appeal_status ASC) AS row_no,
       CAST(to_json(struct_pack(appeal_status := CAST(appeal_status AS VARCHAR),
                           count := CAST(count AS VARCHAR),
                           overturned := CAST(overturned AS VARCHAR))) AS VARCHAR) AS record
FROM abs"""


@register("result_records", _REC_ABS)
def q_result_records(spark, sf_dir):
    return D.result_records(D.appeals_by_status(Domain.of(spark, sf_dir).appeals, ordered=False),
                            D.summary_order("appeals_by_status"), bounded=True)  # one row per status


def _summary_builders(spark, sf_dir):
    d = Domain.of(spark, sf_dir)
    return {
        # the pack numbers rows with its own window, so no separate sort
        "appeals_by_status": lambda: D.appeals_by_status(d.appeals, ordered=False),
        "claims_by_status": lambda: D.claims_by_status(d.claims, ordered=False),
        "top_denial_reasons": lambda: D.top_denial_reasons(d.appeals),
        "recent_appeals": lambda: D.recent_appeals(d.appeals),
        "member_count": lambda: D.member_count(d.members),
    }


_PACK = with_views("appeals", "claims", "members", extra=[
    ("abs", "SELECT appeal_status, COUNT(*) AS count, COUNT(CASE WHEN is_overturned THEN 1 END) AS overturned "
            "FROM appeals GROUP BY appeal_status"),
    ("cbs", "SELECT status, COUNT(*) AS count, "
            "CAST(CAST(sum(billed_cents) AS BIGINT) AS DOUBLE) / 100.0 AS total_billed, "
            "CAST(CAST(sum(paid_cents) AS BIGINT) AS DOUBLE) / 100.0 AS total_paid FROM claims GROUP BY status"),
    ("tdr", "SELECT original_denial_reason AS reason, COUNT(*) AS count FROM appeals "
            "WHERE original_denial_reason IS NOT NULL AND original_denial_reason != '' "
            "GROUP BY original_denial_reason ORDER BY count DESC, reason ASC LIMIT 5"),
    ("ra", "SELECT appeal_id, member_id, appeal_type, appeal_status, original_denial_reason, appeal_date "
           "FROM appeals ORDER BY appeal_date DESC NULLS LAST, appeal_id DESC LIMIT 8"),
    ("mc", "SELECT COUNT(DISTINCT member_id) AS members, "
           "COUNT(DISTINCT CASE WHEN plan_type = 'Medicare' THEN member_id END) AS medicare FROM members"),
]) + """
SELECT 'appeals_by_status' AS query, row_number() OVER (ORDER BY count DESC, appeal_status) AS row_no,
       CAST(to_json(struct_pack(appeal_status := CAST(appeal_status AS VARCHAR), count := CAST(count AS VARCHAR),
                           overturned := CAST(overturned AS VARCHAR))) AS VARCHAR) AS record, CAST(NULL AS VARCHAR) AS error
FROM abs
UNION ALL
SELECT 'claims_by_status', row_number() OVER (ORDER BY count DESC, status),
       CAST(to_json(struct_pack(status := CAST(status AS VARCHAR), count := CAST(count AS VARCHAR),
                           total_billed := CAST(CAST(total_billed AS DECIMAL(38,2)) AS VARCHAR),
                           total_paid := CAST(CAST(total_paid AS DECIMAL(38,2)) AS VARCHAR))) AS VARCHAR), NULL
FROM cbs
UNION ALL
SELECT 'top_denial_reasons', row_number() OVER (ORDER BY count DESC, reason),
       CAST(to_json(struct_pack(reason := CAST(reason AS VARCHAR), count := CAST(count AS VARCHAR))) AS VARCHAR), NULL
FROM tdr
UNION ALL
SELECT 'recent_appeals', row_number() OVER (ORDER BY appeal_date DESC NULLS LAST, appeal_id DESC),
       CAST(to_json(struct_pack(appeal_id := appeal_id, member_id := member_id, appeal_type := appeal_type,
                           appeal_status := appeal_status, original_denial_reason := original_denial_reason,
                           appeal_date := CAST(appeal_date AS VARCHAR))) AS VARCHAR), NULL
FROM ra
UNION ALL
SELECT 'member_count', row_number() OVER (ORDER BY members),
       CAST(to_json(struct_pack(members := CAST(members AS VARCHAR), medicare := CAST(medicare AS VARCHAR))) AS VARCHAR), NULL
FROM mc"""


@register("summary_pack", _PACK)
def q_summary_pack(spark, sf_dir):
    return D.summary_pack(_summary_builders(spark, sf_dir))


@register("summary_pack_timed", _PACK)
def q_summary_pack_timed(spark, sf_dir):
    """The five summary queries side by side, each written on its own within 30 s."""
    from uuid import uuid4

    from ..plans.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/carelake_summary/{uuid4().hex}"
    return D.write_summary_pack(_summary_builders(spark, sf_dir), path, limit=30.0).select("query", "row_no", "record", "error")
