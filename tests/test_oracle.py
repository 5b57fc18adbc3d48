"""Every registered query against its DuckDB oracle (small scale)."""
import pytest

import __spark_entry__ as E
from carelake.plans import registry
from carelake.plans.compare import compare

from .conftest import SF_SMALL

registry.load_all()
QUERIES, ORACLE = registry.QUERIES, registry.ORACLE


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert not missing, f"queries without oracle: {missing}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name not in ORACLE:
        df.count()
        return
    r = compare(df, duck_small, ORACLE[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["appeal_status", "count", "overturned"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_types_match_oracle(spark, duck_small, name):
    import sys
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0] + "/scripts")
    from check_types import norm_duck
    s = dict(QUERIES[name](spark, SF_SMALL).dtypes)
    rel = duck_small.sql(ORACLE[name])
    d = {c: norm_duck(t) for c, t in zip(rel.columns, rel.types)}
    assert s == d
