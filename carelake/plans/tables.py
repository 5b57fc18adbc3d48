"""Table builds, schema conformance, sinks and row counts."""
from __future__ import annotations

from ..operators.audits import PRIMARY_KEYS
from ..sources import builds as B
from ..sources import schemas as S
from ..sources import sinks
from ..sources.domain import DOMAIN_TABLES, Domain
from ..sources.materialize import written
from ..sources.tables import scan_table
from .oracle_views import with_views
from .registry import register


def _iso(c):
    return f"strftime({c}, '%Y-%m-%d') AS {c}"


def _select(schema, special: dict) -> str:
    return ", ".join(special.get(f.name, f.name) for f in schema.fields)


AMT = "CAST({c} AS DOUBLE) / CAST(100 AS DOUBLE) AS {a}"

ORACLE_BUILD = {
    "members": with_views("members") + "SELECT " + _select(
        S.MEMBERS, {c: _iso(c) for c in ("date_of_birth", "created_at")}) + " FROM members",
    "providers": with_views("providers") + "SELECT " + _select(
        S.PROVIDERS, {"created_at": _iso("created_at")}) + " FROM providers",
    "eligibility": with_views("eligibility") + "SELECT " + _select(S.ELIGIBILITY, {}) + " FROM eligibility",
    "prior_authorizations": with_views("prior_authorizations") + "SELECT " + _select(
        S.PRIOR_AUTHORIZATIONS,
        {c: _iso(c) for c in ("service_date", "request_date", "decision_date", "created_at")})
        + " FROM prior_authorizations",
    "claims": with_views("claims") + "SELECT " + _select(
        S.CLAIMS, {**{c: _iso(c) for c in ("service_date", "submitted_date", "processed_date")},
                   "billed_amount": AMT.format(c="billed_cents", a="billed_amount"),
                   "allowed_amount": AMT.format(c="allowed_cents", a="allowed_amount"),
                   "paid_amount": AMT.format(c="paid_cents", a="paid_amount")}) + " FROM claims",
    "appeals": with_views("appeals") + "SELECT " + _select(S.APPEALS, {}) + " FROM appeals",
}


def _build(name):
    def run(spark, sf_dir):
        return B.BUILDERS[name](Domain.of(spark, sf_dir))
    return run


for _key, _table in [("build_members", "members"), ("build_providers", "providers"),
                     ("build_eligibility", "eligibility"), ("build_prior_auths", "prior_authorizations"),
                     ("build_claims", "claims"), ("build_appeals", "appeals")]:
    register(_key, ORACLE_BUILD[_table])(_build(_table))


@register("scan_table", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def q_scan_table(spark, sf_dir):
    """Whole-table scan by name; only the selected columns are read."""
    return scan_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])


@register("apply_schema", ORACLE_BUILD["appeals"])
def q_apply_schema(spark, sf_dir):
    """Appeals conformed to the declared StructType (order, names, types)."""
    return B.conform(Domain.of(spark, sf_dir).appeals, S.APPEALS)


_WRONG_DATE, _WRONG_FLAG = "right(appeal_id, 1) = '3'", "right(appeal_id, 1) IN ('3', '4')"


@register("reconcile_schema", with_views("appeals") + "SELECT " + _select(S.APPEALS, {
    "appeal_context": "CAST(NULL AS VARCHAR) AS appeal_context",
    "appeal_date": f"CASE WHEN NOT ({_WRONG_DATE}) THEN appeal_date END AS appeal_date",
    "is_overturned": f"CASE WHEN NOT ({_WRONG_FLAG}) THEN is_overturned END AS is_overturned"}) + f""",
  concat_ws(',', CASE WHEN {_WRONG_DATE} THEN 'appeal_date=on ' || strftime(appeal_date, '%Y-%m-%d') END,
                 CASE WHEN {_WRONG_FLAG} AND is_overturned IS NOT NULL THEN 'is_overturned=unknown' END) AS rescued
FROM appeals""")
def q_reconcile_schema(spark, sf_dir):
    """Text rows of appeals with a missing and an extra column, and values of the
    wrong type in some rows, brought to the declared schema."""
    from pyspark.sql import functions as F
    raw = B.bronze_text(B.build_appeals(Domain.of(spark, sf_dir))).drop("appeal_context").withColumns({
        "appeal_date": F.expr(f"CASE WHEN {_WRONG_DATE} THEN 'on ' || appeal_date ELSE appeal_date END"),
        "is_overturned": F.expr(f"CASE WHEN {_WRONG_FLAG} AND is_overturned IS NOT NULL THEN 'unknown' ELSE is_overturned END"),
        "batch": F.lit("extra")})
    return B.reconcile(raw, S.APPEALS).withColumn("rescued", F.array_join("rescued", ","))


_BRONZE_APPEALS = with_views("appeals") + "SELECT " + ", ".join(
    f"CAST({f.name} AS VARCHAR) AS {f.name}" for f in S.APPEALS.fields) + " FROM appeals"


@register("bronze_text", _BRONZE_APPEALS)
def q_bronze_text(spark, sf_dir):
    return B.bronze_text(B.build_appeals(Domain.of(spark, sf_dir)))


_COUNTS = with_views(*DOMAIN_TABLES) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in DOMAIN_TABLES)


@register("row_count_report", _COUNTS)
def q_row_count_report(spark, sf_dir):
    d = Domain.of(spark, sf_dir)
    return sinks.row_count_report({t: d.table(t) for t in DOMAIN_TABLES})


@register("save_overwrite", ORACLE_BUILD["appeals"])
def q_save_overwrite(spark, sf_dir):
    """Write the appeals table, replacing what was there: its undecided rows
    first, then, read from the table itself, those and all others."""
    from uuid import uuid4

    from pyspark.sql import functions as F
    path = f"{sinks.table_root(spark)}/{uuid4().hex}/appeals"
    appeals = B.build_appeals(Domain.of(spark, sf_dir))
    decided = F.coalesce(F.col("appeal_status").startswith("Resolved"), F.lit(False))
    sinks.save_overwrite(appeals.where(~decided), path)
    return sinks.save_overwrite(sinks.read_saved(spark, path).unionByName(appeals.where(decided)), path)


@register("create_namespace", _COUNTS)
def q_create_namespace(spark, sf_dir):
    """Create the schema, save the row-count report as a managed table in it,
    and read the table back."""
    import hashlib
    ns = "carelake_" + hashlib.sha1(sf_dir.encode()).hexdigest()[:8]
    sinks.create_namespace(spark, ns)
    d = Domain.of(spark, sf_dir)
    return sinks.save_table(sinks.row_count_report({t: d.table(t) for t in DOMAIN_TABLES}),
                            f"{ns}.row_counts")


# ------------------------------------------------- queries over written tables
@register("written_denied_claims", with_views("claims") + """
SELECT service_type, COUNT(*) AS denied, CAST(SUM(billed_cents) AS BIGINT) AS billed_cents
FROM claims WHERE status = 'Denied' AND submitted_date BETWEEN DATE '1995-03-10' AND DATE '1995-06-20'
GROUP BY service_type""")
def q_written_denied_claims(spark, sf_dir):
    """Denied claims of a date range, from the written table: only the folders
    of its months are read."""
    from pyspark.sql import functions as F
    c = written(spark, sf_dir).between("claims", "1995-03-10", "1995-06-20").where("status = 'Denied'")
    return c.groupBy("service_type").agg(F.count(F.lit(1)).alias("denied"), F.sum("billed_cents").alias("billed_cents"))


@register("written_row_counts", with_views(*DOMAIN_TABLES) + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, COUNT(*) - COUNT({PRIMARY_KEYS[t]}) AS null_keys FROM {t}"
    for t in DOMAIN_TABLES))
def q_written_row_counts(spark, sf_dir):
    """Rows and rows without a key of the six tables, from the figures observed
    by the jobs that wrote them: no table is read again."""
    return written(spark, sf_dir).counts()


@register("written_appeals_by_status", with_views("appeals") + """
SELECT appeal_status, COUNT(*) AS count, COUNT(CASE WHEN is_overturned THEN 1 END) AS overturned
FROM appeals GROUP BY appeal_status""")
def q_written_appeals_by_status(spark, sf_dir):
    """The dashboard's appeals by status, from the written table."""
    from ..operators.dashboard import appeals_by_status
    return appeals_by_status(written(spark, sf_dir).appeals)
