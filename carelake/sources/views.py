"""Register the domain tables as SQL views.

``register_views`` makes the six typed tables and their all-text copies
(``bronze_<table>``, every column as text, money with two decimals) available
to ``spark.sql``, so SQL written for text tables (``x = 'true'``,
``CAST(amount AS DOUBLE)``) runs unchanged against derived data.  Views are
definitions only; every query reads the current data.
"""
from __future__ import annotations

from pyspark.sql import SparkSession

from .builds import BUILDERS, bronze_text
from .domain import DOMAIN_TABLES, Domain


def register_views(spark: SparkSession, domain: Domain, prefix: str = "", bronze: bool = True,
                   global_views: bool = False) -> list[str]:
    made = []
    for name in DOMAIN_TABLES:
        published = BUILDERS[name](domain)
        views = [(f"{prefix}{name}", published)]
        if bronze:
            views.append((f"{prefix}bronze_{name}", bronze_text(published)))
        for view, df in views:
            (df.createOrReplaceGlobalTempView if global_views else df.createOrReplaceTempView)(view)
            made.append(view)
    return made
