"""Declared schemas of the six tables in the source application's layout.

Four of the source tables were created without a schema, so their columns
come out in alphabetical order with Python-derived types (text dates,
BIGINT codes, DOUBLE money); ``eligibility`` and ``appeals`` were declared
explicitly with DATE and BOOLEAN columns.  We declare all six.
"""
from pyspark.sql.types import (BooleanType, DateType, DoubleType, LongType, StringType,
                               StructField, StructType)

S, L, D, B, DT = StringType(), LongType(), DoubleType(), BooleanType(), DateType()


def _schema(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


MEMBERS = _schema(*[(n, S) for n in sorted([
    "member_id", "first_name", "last_name", "date_of_birth", "gender", "ssn", "address",
    "city", "state", "zip", "phone", "email", "plan_type", "created_at"])])

PROVIDERS = _schema(*[(n, S) for n in sorted([
    "provider_id", "npi", "provider_name", "provider_type", "specialty", "address", "city",
    "state", "zip", "phone", "tax_id", "created_at"])])

ELIGIBILITY = _schema(
    ("eligibility_id", S), ("member_id", S), ("coverage_start", DT), ("coverage_end", DT),
    ("is_active", B), ("plan_type", S), ("created_at", DT))

_PA_TYPES = {"cpt_code": L, "is_approved": B, "was_member_active": B}
PRIOR_AUTHORIZATIONS = _schema(*[(n, _PA_TYPES.get(n, S)) for n in sorted([
    "prior_auth_id", "member_id", "provider_id", "service_type", "service_description",
    "cpt_code", "hcpcs_code", "ndc_code", "primary_diagnosis_code", "secondary_diagnosis_codes",
    "service_date", "request_date", "decision_date", "is_approved", "authorization_number",
    "denial_reason", "denial_code", "denial_category", "was_member_active", "created_at", "drug"])])

_CLAIM_TYPES = {"cpt_code": L, "billed_amount": D, "allowed_amount": D, "paid_amount": D,
                "was_member_active": B}
CLAIMS = _schema(*[(n, _CLAIM_TYPES.get(n, S)) for n in sorted([
    "claim_id", "member_id", "provider_id", "prior_auth_id", "service_type", "service_description",
    "cpt_code", "hcpcs_code", "ndc_code", "primary_diagnosis_code", "secondary_diagnosis_codes",
    "service_date", "billed_amount", "allowed_amount", "paid_amount", "status", "denial_reason",
    "denial_code", "denial_category", "was_member_active", "submitted_date", "processed_date"])])

APPEALS = _schema(
    ("appeal_id", S), ("appeal_type", S), ("appeal_source", S), ("member_id", S),
    ("provider_id", S), ("prior_auth_id", S), ("claim_id", S), ("original_denial_reason", S),
    ("appeal_date", DT), ("appeal_status", S), ("is_overturned", B), ("has_documentation", B),
    ("appeal_context", S), ("reviewer_notes", S), ("created_at", DT))

SCHEMAS = {"members": MEMBERS, "providers": PROVIDERS, "eligibility": ELIGIBILITY,
           "prior_authorizations": PRIOR_AUTHORIZATIONS, "claims": CLAIMS, "appeals": APPEALS}
