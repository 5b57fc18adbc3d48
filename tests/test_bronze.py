"""The five summary queries over all-text ("bronze") copies of the tables
give the typed results, as the source's SQL expects of its text tables."""
from pyspark.sql import functions as F

from carelake.operators import dashboard as D
from carelake.sources.builds import bronze_text, build_appeals, build_claims, build_members
from carelake.sources.domain import Domain

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_summaries_over_text_tables(spark):
    d = Domain.of(spark, SF_SMALL)
    appeals_t = bronze_text(build_appeals(d))
    claims_t = bronze_text(build_claims(d))
    members_t = bronze_text(build_members(d))
    assert all(t == "string" for _, t in appeals_t.dtypes + claims_t.dtypes + members_t.dtypes)
    assert _rows(D.appeals_by_status(appeals_t)) == _rows(D.appeals_by_status(d.appeals))
    assert _rows(D.top_denial_reasons(appeals_t)) == _rows(D.top_denial_reasons(d.appeals))
    assert _rows(D.recent_appeals(appeals_t)) == _rows(D.recent_appeals(d.appeals))
    assert _rows(D.member_count(members_t)) == _rows(D.member_count(d.members))
    typed = {r.status: (r["count"], r.total_billed, r.total_paid) for r in D.claims_by_status(d.claims).collect()}
    text = {r.status: (r["count"], r.total_billed, r.total_paid) for r in D.claims_by_status_text(claims_t).collect()}
    assert typed == text


def test_text_predicate_is_case_sensitive(spark):
    df = spark.createDataFrame([("True",), ("true",), ("false",)], "is_overturned string")
    assert df.where(D.is_true(df, "is_overturned")).count() == 1
    assert df.select(F.col("is_overturned")).count() == 3
