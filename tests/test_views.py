"""SQL over the registered text views equals the DataFrame operators."""
from carelake.operators import dashboard as D
from carelake.sources.domain import Domain
from carelake.sources.views import register_views

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_sql_over_text_views(spark):
    d = Domain.of(spark, SF_SMALL)
    made = register_views(spark, d)
    assert "bronze_appeals" in made and "claims" in made and len(made) == 12
    by_status = spark.sql("""
        SELECT appeal_status, count(1) AS count,
               sum(CASE WHEN is_overturned = 'true' THEN 1 ELSE 0 END) AS overturned
        FROM bronze_appeals GROUP BY appeal_status""")
    assert _rows(by_status) == _rows(D.appeals_by_status(d.appeals))
    money = spark.sql("""
        SELECT status, count(1) AS count,
               round(sum(try_cast(billed_amount AS DOUBLE)), 2) AS total_billed,
               round(sum(try_cast(paid_amount AS DOUBLE)), 2) AS total_paid
        FROM bronze_claims GROUP BY status""")
    assert _rows(money) == _rows(D.claims_by_status(d.claims))
    people = spark.sql("""
        SELECT count(DISTINCT member_id) AS members,
               count(DISTINCT if(plan_type = 'Medicare', member_id, NULL)) AS medicare
        FROM bronze_members""")
    assert _rows(people) == _rows(D.member_count(d.members))
    latest = spark.sql("""
        SELECT appeal_id, member_id, appeal_type, appeal_status, original_denial_reason, appeal_date
        FROM bronze_appeals ORDER BY appeal_date DESC, appeal_id DESC LIMIT 8""")
    assert _rows(latest) == _rows(D.recent_appeals(d.appeals))
