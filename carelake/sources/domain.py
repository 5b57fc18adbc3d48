"""The six claims/appeals tables, derived from the driver's TPC-H-style tables.

Each table is a projection of column expressions over one driver table:
``members``/``eligibility`` over ``customer``, ``providers`` over
``supplier``, ``prior_authorizations``/``claims`` over ``orders`` and
``appeals`` over the denied claims.  There is no driver-side row loop and no
random generator: every attribute is a function of the row key (see
``functions.keyed``), so the tables are identical on every run and under any
partitioning, and they grow with the driver tables.

Typed form (this module): dates are DATE, money is integer cents (BIGINT).
The source application's published layout (ISO-text dates, double amounts,
column order) is produced by ``sources.builds``.

Joins: only ``customer``/``supplier`` with ``nation``.  ``nation`` is a fixed
25-row dimension; Catalyst sees its file size and broadcasts it under the
auto-broadcast threshold, and falls back to a sort-merge join otherwise.
The provider count used for provider keys is a scalar subquery
(``DataFrame.scalar()``), computed once per query.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.keyed import mix, pick, sample_k, seeded_choice, seeded_flag, weighted_choice
from ..functions.scalars import date_shift, dob_for_age, fixed_digits, format_id, pattern_digits
from .tables import listing, load


def _div100(c: Column) -> Column:
    """Integer division by 100 for non-negative BIGINT (SQL ``div``)."""
    return ((c - c % F.lit(100)) / F.lit(100)).cast("bigint")


def pa_approved(key: Column) -> Column:
    """The decision on the prior authorization with this key."""
    return seeded_flag(key, 79, C.PA_APPROVED_PCT)


class Domain:
    """Lazily built domain tables over one scale-factor directory.

    ``Domain.of`` returns one instance per (session, directory, as-of date) as
    long as the directory holds the same files: the table definitions are
    logical plans, built like view definitions (a few thousand JVM calls) and
    executed afresh by every query; new, replaced or removed files make new
    ones."""

    _instances: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, as_of: str = C.DEFAULT_AS_OF) -> "Domain":
        key = (id(spark), sf_dir.rstrip("/"), as_of)
        now = listing(spark, sf_dir)
        d = cls._instances.get(key)
        if d is None or d.spark is not spark or now is None or d.listed != now:
            d = cls._instances[key] = cls(spark, sf_dir, as_of)
            d.listed = now
        return d

    @classmethod
    def reset(cls) -> None:
        """Forget the built definitions."""
        cls._instances.clear()
        from .defined import reset
        reset()

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = C.DEFAULT_AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = F.lit(as_of).cast("date")
        self.as_of_text = as_of

    def t(self, name: str) -> DataFrame:
        """The driver table ``name``, loaded once per domain: every new
        relation lists its files again, which is costly on large layouts."""
        loaded = self.__dict__.setdefault("_loaded", {})
        if name not in loaded:
            loaded[name] = load(self.spark, self.sf_dir, name)
        return loaded[name]

    def provider_count(self) -> Column:
        """Number of providers, as a scalar subquery Column."""
        return self.t("supplier").agg(F.count(F.lit(1))).scalar()

    # ------------------------------------------------------------------ members
    @cached_property
    def members(self) -> DataFrame:
        k = F.col("c_custkey")
        nation = self.t("nation").select("n_nationkey", "n_name")
        cust = self.t("customer").select("c_custkey", "c_name", "c_nationkey")
        return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "inner")
                .select(
                    format_id("MBR", 5, k).alias("member_id"),
                    F.col("c_name").alias("first_name"),
                    F.format_string("LN%04d", mix(k, 173, 10000)).alias("last_name"),
                    dob_for_age(k, 179, 181, self.as_of, 65, 95).alias("date_of_birth"),
                    seeded_choice(k, 191, C.GENDERS).alias("gender"),
                    F.format_string("%03d-%02d-%04d", F.lit(100) + mix(k, 193, 800),
                                    F.lit(10) + mix(k, 197, 90), mix(k, 199, 10000)).alias("ssn"),
                    F.format_string("%d Main St", F.lit(1) + mix(k, 211, 9999)).alias("address"),
                    F.format_string("City %d", mix(k, 223, 100)).alias("city"),
                    F.col("n_name").alias("state"),
                    F.format_string("%05d", mix(k, 227, 10000)).alias("zip"),
                    F.format_string("555-%03d-%04d", mix(k, 229, 1000), mix(k, 233, 10000)).alias("phone"),
                    F.lower(F.concat(format_id("MBR", 5, k), F.lit("@example.org"))).alias("email"),
                    seeded_choice(k, 31, C.PLAN_TYPES).alias("plan_type"),
                    F.date_sub(self.as_of, (F.lit(365) + mix(k, 239, 731)).cast("int")).alias("created_at"),
                ))

    # ---------------------------------------------------------------- providers
    @cached_property
    def providers(self) -> DataFrame:
        k = F.col("s_suppkey")
        nation = self.t("nation").select("n_nationkey", "n_name")
        sup = self.t("supplier").select("s_suppkey", "s_name", "s_nationkey")
        ptype = seeded_choice(k, 17, C.PROVIDER_TYPES)
        return (sup.join(nation, sup.s_nationkey == nation.n_nationkey, "inner")
                .select(
                    format_id("PRV", 4, k).alias("provider_id"),
                    fixed_digits(k, 7919, 10).alias("npi"),
                    F.concat_ws(" ", F.col("s_name"), ptype).alias("provider_name"),
                    ptype.alias("provider_type"),
                    seeded_choice(k, 29, C.SPECIALTIES).alias("specialty"),
                    F.format_string("%d Main St", F.lit(1) + mix(k, 211, 9999)).alias("address"),
                    F.format_string("City %d", mix(k, 223, 100)).alias("city"),
                    F.col("n_name").alias("state"),
                    F.format_string("%05d", mix(k, 227, 10000)).alias("zip"),
                    F.format_string("555-%03d-%04d", mix(k, 229, 1000), mix(k, 233, 10000)).alias("phone"),
                    pattern_digits(k, 241, 7927).alias("tax_id"),
                    F.date_sub(self.as_of, (F.lit(730) + mix(k, 251, 1096)).cast("int")).alias("created_at"),
                ))

    # -------------------------------------------------------------- eligibility
    @cached_property
    def eligibility(self) -> DataFrame:
        k = F.col("c_custkey")
        base = F.lit(C.COVERAGE_BASE).cast("date")
        start_off = mix(k, 41, 900)
        span = F.lit(365) * (F.lit(1) + mix(k, 53, 3))
        start = date_shift(base, start_off)
        end = date_shift(base, start_off + span)
        return (self.t("customer").select("c_custkey")
                .select(
                    format_id("ELG", 5, k).alias("eligibility_id"),
                    format_id("MBR", 5, k).alias("member_id"),
                    start.alias("coverage_start"),
                    end.alias("coverage_end"),
                    (end >= self.as_of).alias("is_active"),
                    seeded_choice(k, 59, C.PLAN_TYPES).alias("plan_type"),
                    start.alias("created_at"),
                ))

    # ----------------------------------------------------- prior_authorizations
    @cached_property
    def prior_authorizations(self) -> DataFrame:
        k = F.col("o_orderkey")
        svc = seeded_choice(k, 73, C.SERVICE_TYPES)
        stage1 = (self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
                  .select(
                      k.alias("pa_key"),
                      format_id("PA", 5, k).alias("prior_auth_id"),
                      format_id("MBR", 5, F.col("o_custkey")).alias("member_id"),
                      (k % self.provider_count()).alias("_prov_ix"),
                      svc.alias("service_type"),
                      pick(mix(k, 257, len(C.CPT_CODES)), C.CPT_CODES).cast("bigint").alias("cpt_code"),
                      seeded_choice(k, 263, C.HCPCS_CODES).alias("hcpcs_code"),
                      F.when(svc == "Pharmacy", seeded_choice(k, 269, C.NDC_CODES)).alias("ndc_code"),
                      seeded_choice(k, 271, C.ICD10_CODES).alias("primary_diagnosis_code"),
                      sample_k(k, 277, 281, 283, C.ICD10_CODES).alias("secondary_diagnosis_codes"),
                      F.col("o_orderdate").cast("date").alias("request_date"),
                      pa_approved(k).alias("is_approved"),
                      fixed_digits(k, 7933, 8).alias("auth_digits"),
                      seeded_choice(k, 67, C.DENIAL_REASONS).alias("_reason"),
                      seeded_choice(k, 307, C.DENIAL_CODES).alias("_code"),
                      seeded_choice(k, 311, C.DENIAL_CATEGORIES).alias("_cat"),
                      seeded_flag(k, 313, C.MEMBER_ACTIVE_PCT).alias("was_member_active"),
                      F.when(svc == "Pharmacy", seeded_choice(k, 61, C.ALL_DRUGS)).alias("drug"),
                      (F.lit(1) + mix(k, 71, 14)).alias("_decision_days"),
                      (F.lit(1) + mix(k, 293, 30)).alias("_service_days"),
                  ))
        decision = date_shift(F.col("request_date"), F.col("_decision_days"))
        denied = ~F.col("is_approved")
        return stage1.select(
            "pa_key", "prior_auth_id", "member_id", format_id("PRV", 4, "_prov_ix").alias("provider_id"),
            "service_type",
            F.concat_ws(" ", F.col("service_type"), F.lit("service, CPT"),
                        F.col("cpt_code").cast("string")).alias("service_description"),
            "cpt_code", "hcpcs_code", "ndc_code", "primary_diagnosis_code",
            "secondary_diagnosis_codes",
            date_shift(decision, F.col("_service_days")).alias("service_date"),
            "request_date",
            decision.alias("decision_date"),
            "is_approved",
            F.concat(F.lit("AUTH-"), F.col("auth_digits")).alias("authorization_number"),
            F.when(denied, F.col("_reason")).alias("denial_reason"),
            F.when(denied, F.col("_code")).alias("denial_code"),
            F.when(denied, F.col("_cat")).alias("denial_category"),
            "was_member_active",
            F.col("request_date").alias("created_at"),
            "drug",
        )

    # ------------------------------------------------------------------- claims
    @cached_property
    def claims(self) -> DataFrame:
        k = F.col("o_orderkey")
        svc = seeded_choice(k, 107, C.SERVICE_TYPES)
        stage1 = (self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
                  .select(
                      k.alias("claim_key"),
                      format_id("CLM", 6, k).alias("claim_id"),
                      format_id("MBR", 5, F.col("o_custkey")).alias("member_id"),
                      ((k * F.lit(7)) % self.provider_count()).alias("_prov_ix"),
                      F.when(seeded_flag(k, 103, C.CLAIM_HAS_PA_PCT),
                             format_id("PA", 5, k)).alias("prior_auth_id"),
                      svc.alias("service_type"),
                      pick(mix(k, 317, len(C.CPT_CODES)), C.CPT_CODES).cast("bigint").alias("cpt_code"),
                      seeded_choice(k, 331, C.HCPCS_CODES).alias("hcpcs_code"),
                      F.when(svc == "Pharmacy", seeded_choice(k, 337, C.NDC_CODES)).alias("ndc_code"),
                      seeded_choice(k, 347, C.ICD10_CODES).alias("primary_diagnosis_code"),
                      sample_k(k, 349, 353, 359, C.ICD10_CODES).alias("secondary_diagnosis_codes"),
                      F.round(F.col("o_totalprice") * F.lit(100)).cast("bigint").alias("billed_cents"),
                      (F.lit(40) + mix(k, 109, 56)).alias("_allowed_pct"),
                      (F.lit(60) + mix(k, 89, 41)).alias("_paid_pct"),
                      weighted_choice(k, 113, C.CLAIM_STATUSES, C.CLAIM_STATUS_WEIGHTS_PCT).alias("status"),
                      seeded_choice(k, 97, C.DENIAL_REASONS).alias("_reason"),
                      seeded_choice(k, 373, C.DENIAL_CODES).alias("_code"),
                      seeded_choice(k, 379, C.DENIAL_CATEGORIES).alias("_cat"),
                      seeded_flag(k, 383, C.MEMBER_ACTIVE_PCT).alias("was_member_active"),
                      F.col("o_orderdate").cast("date").alias("submitted_date"),
                      mix(k, 367, 31).alias("_service_back"),
                      (F.lit(3) + mix(k, 101, 43)).alias("_processed_days"),
                      F.when(svc == "Pharmacy", seeded_choice(k, 83, C.ALL_DRUGS)).alias("drug"),
                  ))
        allowed = _div100(F.col("billed_cents") * F.col("_allowed_pct"))
        denied = F.col("status") == "Denied"
        return stage1.select(
            "claim_key", "claim_id", "member_id", format_id("PRV", 4, "_prov_ix").alias("provider_id"),
            "prior_auth_id", "service_type",
            F.concat_ws(" ", F.col("service_type"), F.lit("service, CPT"),
                        F.col("cpt_code").cast("string")).alias("service_description"),
            "cpt_code", "hcpcs_code", "ndc_code", "primary_diagnosis_code",
            "secondary_diagnosis_codes",
            F.date_sub(F.col("submitted_date"), F.col("_service_back")).alias("service_date"),
            "billed_cents",
            allowed.alias("allowed_cents"),
            F.when(F.col("status") == "Approved", _div100(allowed * F.col("_paid_pct")))
             .otherwise(F.lit(0).cast("bigint")).alias("paid_cents"),
            "status",
            F.when(denied, F.col("_reason")).alias("denial_reason"),
            F.when(denied, F.col("_code")).alias("denial_code"),
            F.when(denied, F.col("_cat")).alias("denial_category"),
            "was_member_active",
            "submitted_date",
            date_shift(F.col("submitted_date"), F.col("_processed_days")).alias("processed_date"),
            "drug",
        )

    # ------------------------------------------------------------------ appeals
    @cached_property
    def appeals(self) -> DataFrame:
        k = F.col("claim_key")
        status_ix = mix(k, 157, len(C.APPEAL_STATUSES))
        status = pick(status_ix, C.APPEAL_STATUSES)
        a_type = seeded_choice(k, 127, C.APPEAL_TYPES)
        a_src = seeded_choice(k, 131, C.APPEAL_SOURCES)
        reason = seeded_choice(k, 149, C.DENIAL_REASONS)
        appeal_date = date_shift(F.col("processed_date"), F.lit(1) + mix(k, 151, 60))
        return (self.claims.where(F.col("status") == "Denied")
                .select(
                    k.alias("appeal_key"),
                    format_id("APL", 5, k).alias("appeal_id"),
                    a_type.alias("appeal_type"),
                    a_src.alias("appeal_source"),
                    "member_id",
                    "provider_id",
                    # only a denied authorization is appealed; its decision is a function of its key
                    F.when(seeded_flag(k, 137, C.APPEAL_HAS_PA_PCT) & ~pa_approved(k), F.col("prior_auth_id"))
                     .alias("prior_auth_id"),
                    F.when(seeded_flag(k, 139, C.APPEAL_HAS_CLAIM_PCT), F.col("claim_id")).alias("claim_id"),
                    reason.alias("original_denial_reason"),
                    appeal_date.alias("appeal_date"),
                    status.alias("appeal_status"),
                    (status_ix == F.lit(3)).alias("is_overturned"),
                    seeded_flag(k, 163, C.APPEAL_DOCUMENTED_PCT).alias("has_documentation"),
                    F.concat_ws(" ", a_type, F.lit("appeal from"), a_src, F.lit("contesting:"), reason)
                     .alias("appeal_context"),
                    F.when(status.startswith("Resolved"), F.concat(F.lit("Decision recorded: "), status))
                     .alias("reviewer_notes"),
                    appeal_date.alias("created_at"),
                ))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)


DOMAIN_TABLES = ("members", "providers", "eligibility", "prior_authorizations", "claims", "appeals")
