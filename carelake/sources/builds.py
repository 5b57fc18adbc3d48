"""The six tables in the source application's published layout.

``conform`` is the schema step: select the declared columns by name, cast
each to its declared type, fail on a missing column.  Text dates are ISO
``YYYY-MM-DD``; money is cents / 100 as DOUBLE.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import cents_to_amount, iso_date
from . import schemas
from .domain import Domain


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Reconcile ``df`` to ``schema`` with ``DataFrame.to``: columns reordered
    by name, extra columns dropped, compatible types up-cast, an unsafe cast
    (e.g. text to number) is an analysis error.  ``to`` would fill a missing
    nullable column with NULL; a missing column is an error here instead."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns for schema: {missing}")
    return df.to(schema)


def reconcile(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows that do not fit ``schema``, kept: its columns in its order, and
    ``rescued``.  A missing column is null, an extra column goes, and a value that
    is no value of the declared type is null and stands in ``rescued`` as
    ``name=text`` (in the order of the schema; empty where all fit)."""
    have = {c: F.col(c) for c in df.columns}
    fitted, bad = [], []
    for f in schema.fields:
        value = have[f.name].try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        fitted.append(value.alias(f.name))
        if f.name in have:
            wrong = have[f.name].isNotNull() & value.isNull()
            bad.append(F.when(wrong, F.concat(F.lit(f"{f.name}="), have[f.name].cast("string"))))
    return df.select(*fitted, (F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")).alias("rescued"))


def _iso(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: iso_date(n) for n in names})


def build_members(d: Domain) -> DataFrame:
    return conform(_iso(d.members, "date_of_birth", "created_at"), schemas.MEMBERS)


def build_providers(d: Domain) -> DataFrame:
    return conform(_iso(d.providers, "created_at"), schemas.PROVIDERS)


def build_eligibility(d: Domain) -> DataFrame:
    return conform(d.eligibility, schemas.ELIGIBILITY)


def build_prior_auths(d: Domain) -> DataFrame:
    return conform(_iso(d.prior_authorizations, "service_date", "request_date", "decision_date",
                        "created_at"), schemas.PRIOR_AUTHORIZATIONS)


def build_claims(d: Domain) -> DataFrame:
    df = _iso(d.claims, "service_date", "submitted_date", "processed_date").withColumns({
        "billed_amount": cents_to_amount("billed_cents"),
        "allowed_amount": cents_to_amount("allowed_cents"),
        "paid_amount": cents_to_amount("paid_cents"),
    })
    return conform(df, schemas.CLAIMS)


def build_appeals(d: Domain) -> DataFrame:
    return conform(d.appeals, schemas.APPEALS)


BUILDERS = {
    "members": build_members, "providers": build_providers, "eligibility": build_eligibility,
    "prior_authorizations": build_prior_auths, "claims": build_claims, "appeals": build_appeals,
}


#: Columns that hold money: written with two decimals.
MONEY = ("billed_amount", "allowed_amount", "paid_amount", "total_billed", "total_paid")


def as_text(df: DataFrame, money: tuple[str, ...] = MONEY) -> list:
    """Every column as text (booleans ``'true'``/``'false'``, dates ISO): DOUBLE
    columns named in ``money`` with two decimals, all others in full."""
    return [(F.col(f.name).cast("decimal(38,2)") if f.name in money and f.dataType.typeName() == "double"
             else F.col(f.name)).cast("string").alias(f.name) for f in df.schema.fields]


def bronze_text(df: DataFrame, money: tuple[str, ...] = MONEY) -> DataFrame:
    """All-text copy of ``df`` (see ``as_text``)."""
    return df.select(*as_text(df, money))
