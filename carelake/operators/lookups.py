"""Keyed lookups: member, claim, appeal, eligibility, prior authorization.

Batch form: the table semi-joined with a request DataFrame of keys (no
de-duplication of the requests needed, no repeated rows).  Catalyst/AQE
choose the strategy from measured sizes: a small request set is broadcast,
a large one is sort-merge joined; a hot key on the table side is split by
AQE's skew-join handling.  Semantics are ours (the lookups are named, not
defined, by the source application): row(s) by key, unknown key -> no row.

The same lookups are available as SQL table functions over registered
views (``register_sql_functions``), e.g.
``SELECT * FROM requests r, LATERAL member_lookup(r.member_id)``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def member_lookup(members: DataFrame, keys: DataFrame) -> DataFrame:
    """Member rows whose id is in ``keys`` (a semi join: repeated request
    keys need no de-duplication and never repeat a row)."""
    return members.join(keys.select("member_id"), "member_id", "left_semi")


def left_join_known(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on ``key`` whose rows without a key do not travel: they match
    nothing and would all meet in one task, so they are set apart and put back
    with empty columns."""
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    found = left.where(F.col(key).isNotNull()).join(right, key, "left")
    return found.unionByName(left.where(F.col(key).isNull()).select("*", *extra))


def claim_lookup(claims: DataFrame, providers: DataFrame, pas: DataFrame, keys: DataFrame) -> DataFrame:
    """Claim detail with provider name/type/specialty and the PA decision."""
    return claim_details(claims.join(keys.select("claim_id"), "claim_id", "left_semi"), providers, pas)


def appeal_lookup(appeals: DataFrame, keys: DataFrame, by: str = "member_id") -> DataFrame:
    return appeals.join(keys.select(by), by, "left_semi")


def prior_auth_lookup(pas: DataFrame, keys: DataFrame, by: str = "prior_auth_id") -> DataFrame:
    return pas.join(keys.select(by), by, "left_semi")


def eligibility_lookup(eligibility: DataFrame, requests: DataFrame, date_col: str = "service_date") -> DataFrame:
    """Spans covering a date for a member, both ends inclusive.

    An interval index instead of an equi-join on the member with a residual
    range, which compares all spans of a member with all its requests in one
    task.  A span of up to 2^l days lies in one or two buckets of 2^l days
    (level l), however long it is; a date lies in exactly one bucket of each
    level.  So spans and requests meet by an equi-join on (member, level,
    bucket), each pair once, and the ends are compared only there.  A request
    is copied once for each level that a span has (at most 22 for dates of
    10,000 years, one or two for spans of like length).  Spans whose end is
    before their start, and rows without member, start, end or date, match
    nothing."""
    e = eligibility.select(F.col("member_id").alias("_m"), "eligibility_id", "coverage_start", "coverage_end", "is_active")
    first, last = F.unix_date("coverage_start"), F.unix_date("coverage_end")
    # smallest l with 2^l >= days, from the binary digits of days - 1
    level = F.when(last == first, 0).otherwise(F.length(F.bin((last - first).cast("long"))))
    e = e.where(F.col("coverage_start") <= F.col("coverage_end")).withColumn("_l", level)
    width = F.expr("shiftleft(1L, _l)")
    e = e.withColumn("_b", F.explode(F.array_distinct(F.array(F.floor(first / width), F.floor(last / width)))))
    # the levels that occur, as the bits of one number
    present = (eligibility.where(F.col("coverage_start") <= F.col("coverage_end"))
               .select(level.alias("_l")).agg(F.bit_or(F.expr("shiftleft(1, _l)"))))
    r = (requests.where(F.col("member_id").isNotNull() & F.col(date_col).isNotNull())
         .withColumn("_p", present.scalar())
         .withColumn("_rl", F.explode(F.filter(F.sequence(F.lit(0), F.lit(30)), lambda x: F.getbit(F.col("_p"), x) == 1)))
         .withColumn("_rb", F.floor(F.unix_date(date_col) / F.expr("shiftleft(1L, _rl)"))))
    return (r.join(e, (F.col("member_id") == F.col("_m")) & (F.col("_rl") == F.col("_l")) & (F.col("_rb") == F.col("_b"))
                   & F.col(date_col).between(F.col("coverage_start"), F.col("coverage_end")))
            .drop("_m", "_l", "_b", "_p", "_rl", "_rb"))


def appeal_claim_denials(appeals: DataFrame, claims: DataFrame) -> DataFrame:
    """Appeals with the denial facts of the claim they cite (joined on
    claim_id, never on member_id: the two can disagree)."""
    c = claims.select("claim_id", F.col("status").alias("claim_status"),
                      F.col("denial_reason").alias("claim_denial_reason"),
                      F.col("denial_code").alias("claim_denial_code"),
                      F.col("denial_category").alias("claim_denial_category"),
                      F.col("service_type").alias("claim_service_type"),
                      F.col("drug").alias("claim_drug"))
    return left_join_known(appeals, c, "claim_id")


LOOKUP_FUNCTIONS = {
    "member_lookup": ("p_member_id STRING", "members", "member_id = p_member_id"),
    "claim_lookup": ("p_claim_id STRING", "claim_details", "claim_id = p_claim_id"),
    "claims_of_member": ("p_member_id STRING", "claim_details", "member_id = p_member_id"),
    "appeal_lookup": ("p_member_id STRING", "appeals", "member_id = p_member_id"),
    "prior_auth_lookup": ("p_prior_auth_id STRING", "prior_authorizations", "prior_auth_id = p_prior_auth_id"),
    "prior_auths_of_member": ("p_member_id STRING", "prior_authorizations", "member_id = p_member_id"),
}


def claim_details(claims: DataFrame, providers: DataFrame, pas: DataFrame) -> DataFrame:
    """Every claim with its provider's and its authorization's columns."""
    prov = providers.select("provider_id", "provider_name", "provider_type", "specialty")
    pa = pas.select("prior_auth_id", F.col("is_approved").alias("pa_approved"),
                    F.col("decision_date").alias("pa_decision_date"))
    return left_join_known(claims.join(prov, "provider_id", "left"), pa, "prior_auth_id")


def register_sql_functions(spark: SparkSession, views: dict[str, DataFrame]) -> list[str]:
    """Register the domain tables as temp views and the lookups as SQL table
    functions.  Catalyst plans ``FROM keys, LATERAL f(k)`` as a join."""
    views = {**views, "claim_details": claim_details(views["claims"], views["providers"], views["prior_authorizations"])}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    made = []
    for fname, (params, table, cond) in LOOKUP_FUNCTIONS.items():
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in views[table].schema.fields)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {fname}({params}) RETURNS TABLE ({cols}) "
                  f"RETURN SELECT * FROM {table} WHERE {cond}")
        made.append(fname)
    e_cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in views["eligibility"].schema.fields)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION eligibility_lookup(p_member_id STRING, p_date DATE) "
              f"RETURNS TABLE ({e_cols}) RETURN SELECT * FROM eligibility "
              "WHERE member_id = p_member_id AND p_date BETWEEN coverage_start AND coverage_end")
    made.append("eligibility_lookup")
    return made
