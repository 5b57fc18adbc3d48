"""Property tests for the key-derived column helpers (Spark vs plain Python)."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelake.functions import keyed as K
from carelake.functions import scalars as X

KEYS = st.lists(st.integers(min_value=0, max_value=10**12), min_size=1, max_size=40)


def _eval(spark, keys, *cols):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    return df.select("k", *cols).collect()


@settings(max_examples=15, deadline=None)
@given(keys=KEYS, p=st.integers(1, 10**4), m=st.integers(1, 500))
def test_mix_matches_python(spark, keys, p, m):
    for r in _eval(spark, keys, K.mix(F.col("k"), p, m).alias("x")):
        assert r.x == r.k * p % 10007 % m and 0 <= r.x < m


@settings(max_examples=10, deadline=None)
@given(keys=KEYS)
def test_weighted_choice_thresholds(spark, keys):
    vals, w = ["a", "b", "c", "d"], [55, 25, 12, 8]
    for r in _eval(spark, keys, K.weighted_choice(F.col("k"), 113, vals, w).alias("x")):
        b = r.k * 113 % 10007 % 100
        assert r.x == ("a" if b < 55 else "b" if b < 80 else "c" if b < 92 else "d")


@settings(max_examples=10, deadline=None)
@given(keys=KEYS)
def test_sample_k_distinct_and_bounded(spark, keys):
    codes = [f"X{i}" for i in range(17)]
    for r in _eval(spark, keys, K.sample_k(F.col("k"), 3, 5, 7, codes).alias("s")):
        parts = [x for x in r.s.split(",") if x]
        assert len(parts) == len(set(parts)) == r.k * 3 % 10007 % 4


@settings(max_examples=10, deadline=None)
@given(keys=KEYS, width=st.integers(1, 8))
def test_format_id_matches_python_format(spark, keys, width):
    for r in _eval(spark, keys, X.format_id("ID", width, F.col("k")).alias("x")):
        assert r.x == f"ID-{r.k:0{width}d}"


@settings(max_examples=10, deadline=None)
@given(keys=KEYS)
def test_fixed_and_pattern_digits_shape(spark, keys):
    for r in _eval(spark, keys, X.fixed_digits(F.col("k"), 7919, 10).alias("a"),
                   X.pattern_digits(F.col("k"), 241, 7927).alias("b")):
        assert len(r.a) == 10 and r.a.isdigit() and r.a[0] != "0"
        left, right = r.b.split("-")
        assert len(left) == 2 and len(right) == 7 and (left + right).isdigit()
