"""DuckDB text of the six domain tables, for the correctness oracle.

The Spark side builds the same tables with Column expressions
(``sources.domain``); this module writes the same formulas once more as
plain DuckDB SQL so an independent engine can check every query.  Only the
driver's base tables are registered in DuckDB, so each oracle query carries
the domain tables it needs as CTEs (``with_views``).
"""
from __future__ import annotations

from ..functions import constants as C


def mix(k: str, p: int, m: int) -> str:
    return f"CAST(({k}) * {p} % 10007 % {m} AS INTEGER)"


def lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def pick(idx: str, values) -> str:
    return "([" + ", ".join(lit(v) for v in values) + f"])[({idx}) + 1]"


def choice(k: str, p: int, values) -> str:
    return pick(mix(k, p, len(values)), values)


def flag(k: str, p: int, pct: int) -> str:
    return f"({mix(k, p, 100)} < {pct})"


def dadd(d: str, n: str) -> str:
    return f"CAST(({d}) + CAST(({n}) AS INTEGER) AS DATE)"


def dsub(d: str, n: str) -> str:
    return f"CAST(({d}) - CAST(({n}) AS INTEGER) AS DATE)"


def weighted(k: str, p: int, values, weights) -> str:
    r = mix(k, p, 100)
    parts, acc = [], 0
    for v, w in zip(values[:-1], weights[:-1]):
        acc += w
        parts.append(f"WHEN {r} < {acc} THEN {lit(v)}")
    return "CASE " + " ".join(parts) + f" ELSE {lit(values[-1])} END"


def sample_k(k: str, pc: int, ps: int, pst: int, values, max_k: int = 3) -> str:
    n = len(values)
    cnt, s, step = mix(k, pc, max_k + 1), mix(k, ps, n), f"(1 + {mix(k, pst, n - 1)})"
    parts = [f"CASE WHEN {cnt} > {i} THEN {pick(f'(({s}) + ({step}) * {i}) % {n}', values)} END"
             for i in range(max_k)]
    return "concat_ws(',', " + ", ".join(parts) + ")"


def fixed_digits(k: str, p: int, digits: int) -> str:
    lo = 10 ** (digits - 1)
    return f"printf('%0{digits}d', {lo} + (({k}) * {p}) % {9 * lo})"


AS_OF = f"DATE '{C.DEFAULT_AS_OF}'"
NSUPP = "(SELECT count(*) FROM supplier)"


def members_sql(as_of: str = AS_OF) -> str:
    k = "c_custkey"
    return f"""
SELECT printf('MBR-%05d', {k}) AS member_id,
       c_name AS first_name,
       printf('LN%04d', {mix(k, 173, 10000)}) AS last_name,
       CAST(CAST({as_of} - to_months(CAST(12 * (65 + {mix(k, 179, 31)}) AS INTEGER)) AS DATE)
            - CAST({mix(k, 181, 365)} AS INTEGER) AS DATE) AS date_of_birth,
       {choice(k, 191, C.GENDERS)} AS gender,
       printf('%03d-%02d-%04d', 100 + {mix(k, 193, 800)}, 10 + {mix(k, 197, 90)}, {mix(k, 199, 10000)}) AS ssn,
       printf('%d Main St', 1 + {mix(k, 211, 9999)}) AS address,
       printf('City %d', {mix(k, 223, 100)}) AS city,
       n_name AS state,
       printf('%05d', {mix(k, 227, 10000)}) AS zip,
       printf('555-%03d-%04d', {mix(k, 229, 1000)}, {mix(k, 233, 10000)}) AS phone,
       lower(printf('MBR-%05d', {k}) || '@example.org') AS email,
       {choice(k, 31, C.PLAN_TYPES)} AS plan_type,
       {dsub(as_of, '365 + ' + mix(k, 239, 731))} AS created_at
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def providers_sql(as_of: str = AS_OF) -> str:
    k = "s_suppkey"
    ptype = choice(k, 17, C.PROVIDER_TYPES)
    return f"""
SELECT printf('PRV-%04d', {k}) AS provider_id,
       {fixed_digits(k, 7919, 10)} AS npi,
       concat_ws(' ', s_name, {ptype}) AS provider_name,
       {ptype} AS provider_type,
       {choice(k, 29, C.SPECIALTIES)} AS specialty,
       printf('%d Main St', 1 + {mix(k, 211, 9999)}) AS address,
       printf('City %d', {mix(k, 223, 100)}) AS city,
       n_name AS state,
       printf('%05d', {mix(k, 227, 10000)}) AS zip,
       printf('555-%03d-%04d', {mix(k, 229, 1000)}, {mix(k, 233, 10000)}) AS phone,
       printf('%02d-%07d', 10 + {mix(k, 241, 90)}, ({k} * 7927) % 10000000) AS tax_id,
       {dsub(as_of, '730 + ' + mix(k, 251, 1096))} AS created_at
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def eligibility_sql(as_of: str = AS_OF) -> str:
    k = "c_custkey"
    base = f"DATE '{C.COVERAGE_BASE}'"
    start = dadd(base, mix(k, 41, 900))
    end = dadd(base, f"{mix(k, 41, 900)} + 365 * (1 + {mix(k, 53, 3)})")
    return f"""
SELECT printf('ELG-%05d', {k}) AS eligibility_id,
       printf('MBR-%05d', {k}) AS member_id,
       {start} AS coverage_start,
       {end} AS coverage_end,
       ({end} >= {as_of}) AS is_active,
       {choice(k, 59, C.PLAN_TYPES)} AS plan_type,
       {start} AS created_at
FROM customer"""


def prior_authorizations_sql() -> str:
    k = "o_orderkey"
    svc = choice(k, 73, C.SERVICE_TYPES)
    cpt = f"CAST({choice(k, 257, C.CPT_CODES)} AS BIGINT)"
    req = "CAST(o_orderdate AS DATE)"
    decision = dadd(req, f"1 + {mix(k, 71, 14)}")
    denied = f"NOT {flag(k, 79, C.PA_APPROVED_PCT)}"
    return f"""
SELECT {k} AS pa_key,
       printf('PA-%05d', {k}) AS prior_auth_id,
       printf('MBR-%05d', o_custkey) AS member_id,
       printf('PRV-%04d', {k} % {NSUPP}) AS provider_id,
       {svc} AS service_type,
       concat_ws(' ', {svc}, 'service, CPT', CAST({cpt} AS VARCHAR)) AS service_description,
       {cpt} AS cpt_code,
       {choice(k, 263, C.HCPCS_CODES)} AS hcpcs_code,
       CASE WHEN {svc} = 'Pharmacy' THEN {choice(k, 269, C.NDC_CODES)} END AS ndc_code,
       {choice(k, 271, C.ICD10_CODES)} AS primary_diagnosis_code,
       {sample_k(k, 277, 281, 283, C.ICD10_CODES)} AS secondary_diagnosis_codes,
       {dadd(decision, f"1 + {mix(k, 293, 30)}")} AS service_date,
       {req} AS request_date,
       {decision} AS decision_date,
       {flag(k, 79, C.PA_APPROVED_PCT)} AS is_approved,
       'AUTH-' || {fixed_digits(k, 7933, 8)} AS authorization_number,
       CASE WHEN {denied} THEN {choice(k, 67, C.DENIAL_REASONS)} END AS denial_reason,
       CASE WHEN {denied} THEN {choice(k, 307, C.DENIAL_CODES)} END AS denial_code,
       CASE WHEN {denied} THEN {choice(k, 311, C.DENIAL_CATEGORIES)} END AS denial_category,
       {flag(k, 313, C.MEMBER_ACTIVE_PCT)} AS was_member_active,
       {req} AS created_at,
       CASE WHEN {svc} = 'Pharmacy' THEN {choice(k, 61, C.ALL_DRUGS)} END AS drug
FROM orders"""


def claims_sql() -> str:
    k = "o_orderkey"
    svc = choice(k, 107, C.SERVICE_TYPES)
    cpt = f"CAST({choice(k, 317, C.CPT_CODES)} AS BIGINT)"
    billed = "CAST(round(o_totalprice * 100) AS BIGINT)"
    allowed = f"({billed} * (40 + {mix(k, 109, 56)}) // 100)"
    status = weighted(k, 113, C.CLAIM_STATUSES, C.CLAIM_STATUS_WEIGHTS_PCT)
    sub = "CAST(o_orderdate AS DATE)"
    denied = f"({status}) = 'Denied'"
    return f"""
SELECT {k} AS claim_key,
       printf('CLM-%06d', {k}) AS claim_id,
       printf('MBR-%05d', o_custkey) AS member_id,
       printf('PRV-%04d', ({k} * 7) % {NSUPP}) AS provider_id,
       CASE WHEN {flag(k, 103, C.CLAIM_HAS_PA_PCT)} THEN printf('PA-%05d', {k}) END AS prior_auth_id,
       {svc} AS service_type,
       concat_ws(' ', {svc}, 'service, CPT', CAST({cpt} AS VARCHAR)) AS service_description,
       {cpt} AS cpt_code,
       {choice(k, 331, C.HCPCS_CODES)} AS hcpcs_code,
       CASE WHEN {svc} = 'Pharmacy' THEN {choice(k, 337, C.NDC_CODES)} END AS ndc_code,
       {choice(k, 347, C.ICD10_CODES)} AS primary_diagnosis_code,
       {sample_k(k, 349, 353, 359, C.ICD10_CODES)} AS secondary_diagnosis_codes,
       {dsub(sub, mix(k, 367, 31))} AS service_date,
       {billed} AS billed_cents,
       CAST({allowed} AS BIGINT) AS allowed_cents,
       CAST(CASE WHEN ({status}) = 'Approved' THEN {allowed} * (60 + {mix(k, 89, 41)}) // 100 ELSE 0 END AS BIGINT)
         AS paid_cents,
       {status} AS status,
       CASE WHEN {denied} THEN {choice(k, 97, C.DENIAL_REASONS)} END AS denial_reason,
       CASE WHEN {denied} THEN {choice(k, 373, C.DENIAL_CODES)} END AS denial_code,
       CASE WHEN {denied} THEN {choice(k, 379, C.DENIAL_CATEGORIES)} END AS denial_category,
       {flag(k, 383, C.MEMBER_ACTIVE_PCT)} AS was_member_active,
       {sub} AS submitted_date,
       {dadd(sub, f"3 + {mix(k, 101, 43)}")} AS processed_date,
       CASE WHEN {svc} = 'Pharmacy' THEN {choice(k, 83, C.ALL_DRUGS)} END AS drug
FROM orders"""


def appeals_sql() -> str:
    k = "claim_key"
    six = mix(k, 157, len(C.APPEAL_STATUSES))
    status = pick(six, C.APPEAL_STATUSES)
    a_type = choice(k, 127, C.APPEAL_TYPES)
    a_src = choice(k, 131, C.APPEAL_SOURCES)
    reason = choice(k, 149, C.DENIAL_REASONS)
    adate = dadd("processed_date", f"1 + {mix(k, 151, 60)}")
    return f"""
SELECT {k} AS appeal_key,
       printf('APL-%05d', {k}) AS appeal_id,
       {a_type} AS appeal_type,
       {a_src} AS appeal_source,
       member_id,
       provider_id,
       CASE WHEN {flag(k, 137, C.APPEAL_HAS_PA_PCT)}
             AND prior_auth_id IN (SELECT prior_auth_id FROM prior_authorizations WHERE NOT is_approved)
            THEN prior_auth_id END AS prior_auth_id,
       CASE WHEN {flag(k, 139, C.APPEAL_HAS_CLAIM_PCT)} THEN claim_id END AS claim_id,
       {reason} AS original_denial_reason,
       {adate} AS appeal_date,
       {status} AS appeal_status,
       ({six} = 3) AS is_overturned,
       {flag(k, 163, C.APPEAL_DOCUMENTED_PCT)} AS has_documentation,
       concat_ws(' ', {a_type}, 'appeal from', {a_src}, 'contesting:', {reason}) AS appeal_context,
       CASE WHEN starts_with({status}, 'Resolved') THEN 'Decision recorded: ' || {status} END AS reviewer_notes,
       {adate} AS created_at
FROM claims WHERE status = 'Denied'"""


VIEWS = {
    "members": (members_sql, ()),
    "providers": (providers_sql, ()),
    "eligibility": (eligibility_sql, ()),
    "prior_authorizations": (prior_authorizations_sql, ()),
    "claims": (claims_sql, ()),
    "appeals": (appeals_sql, ("claims", "prior_authorizations")),
}


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause defining the named domain tables (and dependencies),
    followed by any extra ``(name, sql)`` CTEs."""
    order: list[str] = []

    def add(n):
        for dep in VIEWS[n][1]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({VIEWS[n][0]()})" for n in order]
    parts += [f"{n} AS ({sql})" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
