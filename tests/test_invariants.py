"""Invariants the source application states for its tables, checked on the
derived tables (whole tables, one aggregate job per table)."""
from pyspark.sql import functions as F

from carelake.functions import constants as C
from carelake.sources.domain import Domain

from .conftest import SF_CHECK


def _violations(df, cond):
    return df.agg(F.count(F.when(~cond, F.lit(1)))).collect()[0][0]


def test_appeal_invariants(spark):
    a = Domain.of(spark, SF_CHECK).appeals
    assert _violations(a, F.col("is_overturned") == (F.col("appeal_status") == "Resolved - Overturned")) == 0
    assert _violations(a, F.col("reviewer_notes").isNull() | F.col("appeal_status").startswith("Resolved")) == 0
    assert _violations(a, F.col("reviewer_notes").isNotNull() | ~F.col("appeal_status").startswith("Resolved")) == 0
    assert _violations(a, F.col("appeal_status").isin(*C.APPEAL_STATUSES)) == 0


def test_claim_invariants(spark):
    c = Domain.of(spark, SF_CHECK).claims
    denied = F.col("status") == "Denied"
    for col in ("denial_reason", "denial_code", "denial_category"):
        assert _violations(c, F.col(col).isNotNull() == denied) == 0
    assert _violations(c, (F.col("paid_cents") == 0) | (F.col("status") == "Approved")) == 0
    assert _violations(c, (F.col("billed_cents") >= F.col("allowed_cents"))
                       & (F.col("allowed_cents") >= F.col("paid_cents"))) == 0
    assert _violations(c, F.col("ndc_code").isNotNull() == F.col("drug").isNotNull()) == 0
    assert _violations(c, F.col("drug").isNotNull() == (F.col("service_type") == "Pharmacy")) == 0
    days = F.datediff("processed_date", "submitted_date")
    assert _violations(c, days.between(3, 45)) == 0


def test_prior_auth_and_eligibility_invariants(spark):
    d = Domain.of(spark, SF_CHECK)
    p = d.prior_authorizations
    for col in ("denial_reason", "denial_code", "denial_category"):
        assert _violations(p, F.col(col).isNotNull() == ~F.col("is_approved")) == 0
    assert _violations(p, F.datediff("decision_date", "request_date").between(1, 14)) == 0
    e = d.eligibility
    assert _violations(e, F.col("is_active") == (F.col("coverage_end") >= d.as_of)) == 0
    assert _violations(e, F.datediff("coverage_end", "coverage_start").isin(365, 730, 1095)) == 0


def test_status_mix_close_to_weights(spark):
    c = Domain.of(spark, SF_CHECK).claims
    n = c.count()
    shares = {r.status: r["count"] / n for r in c.groupBy("status").count().collect()}
    for s, w in zip(C.CLAIM_STATUSES, C.CLAIM_STATUS_WEIGHTS_PCT):
        assert abs(shares[s] - w / 100) < 0.03
