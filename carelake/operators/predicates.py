"""Row predicates of the claims/appeals model (pushed into scans by Catalyst
wherever they touch a stored column)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C


def denied_claims(claims: DataFrame) -> DataFrame:
    return claims.where(F.col("status") == "Denied")


def denied_prior_auths(pas: DataFrame) -> DataFrame:
    return pas.where(~F.col("is_approved"))


def resolved(appeals: DataFrame) -> DataFrame:
    """Decided appeals: status text starts with ``Resolved``."""
    return appeals.where(F.col("appeal_status").startswith("Resolved"))


def coverage_active(eligibility: DataFrame, as_of: Column) -> DataFrame:
    return eligibility.where(F.col("coverage_end") >= as_of)


def is_glp1(drug: Column) -> Column:
    return drug.isin(*C.GLP1_DRUGS)


def glp1(df: DataFrame, drug_col: str = "drug") -> DataFrame:
    return df.where(is_glp1(F.col(drug_col)))
