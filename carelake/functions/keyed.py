"""Keyed column derivation.

Every "random" attribute of a row is a pure function of the row's key:
``mix(k, p, m) = CAST(k * p % 10007 % m AS INT)``.  Unlike ``rand(seed)``
this is stable under task retry, speculative execution and repartitioning,
so a lost executor recomputes exactly the same values.  The prime modulus
decorrelates the bucket from ``k mod n`` for other small ``n``; every
derived column uses its own multiplier ``p``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MIX_PRIME = 10007


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mix(key, p: int, m: int) -> Column:
    """Integer bucket in ``[0, m)`` from an integral key and a multiplier."""
    return ((_col(key) * F.lit(p)) % F.lit(MIX_PRIME) % F.lit(m)).cast("int")


def pick(index: Column, values: Sequence) -> Column:
    """``values[index]`` for a 0-based integer Column (literal array lookup)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + F.lit(1))


def seeded_choice(key, p: int, values: Sequence) -> Column:
    """Uniform choice among ``values`` keyed by ``key``."""
    return pick(mix(key, p, len(values)), values)


def weighted_choice(key, p: int, values: Sequence, weights_pct: Sequence[int]) -> Column:
    """Categorical choice with integer percent weights (must sum to 100)."""
    if sum(weights_pct) != 100:
        raise ValueError("weights must sum to 100")
    r = mix(key, p, 100)
    out = None
    acc = 0
    for v, w in zip(values[:-1], weights_pct[:-1]):
        acc += w
        out = F.when(r < acc, F.lit(v)) if out is None else out.when(r < acc, F.lit(v))
    return out.otherwise(F.lit(values[-1]))


def seeded_flag(key, p: int, pct: int) -> Column:
    """Bernoulli flag, true with probability ``pct`` percent."""
    return mix(key, p, 100) < F.lit(pct)


def seeded_int(key, p: int, lo: int, hi: int) -> Column:
    """Integer in ``[lo, hi]`` inclusive."""
    return F.lit(lo) + mix(key, p, hi - lo + 1)


def sample_k(key, p_count: int, p_start: int, p_step: int, values: Sequence,
             max_k: int = 3, sep: str = ",") -> Column:
    """Comma-joined sample of 0..max_k distinct elements of ``values``.

    With ``len(values)`` prime, index ``(s + i * step) % n`` for a step in
    ``[1, n)`` visits distinct elements, so the sample is without
    replacement.  Empty sample gives ``''`` (never NULL).
    """
    n = len(values)
    k = mix(key, p_count, max_k + 1)
    s = mix(key, p_start, n)
    step = F.lit(1) + mix(key, p_step, n - 1)
    parts = [F.when(k > F.lit(i), pick((s + step * F.lit(i)) % F.lit(n), values))
             for i in range(max_k)]
    return F.concat_ws(sep, *parts)


def null_unless(cond: Column, value: Column) -> Column:
    """``CASE WHEN cond THEN value END``."""
    return F.when(cond, value)


def fk_choice(key, parent_count: Column, fmt: str, multiplier: int = 1,
              present: Column | None = None) -> Column:
    """Pick a parent key from a dense key space ``[0, parent_count)``.

    ``parent_count`` is typically ``parent_df.agg(count).scalar()``: a
    scalar subquery computed once per query, not a cross join and not a
    driver-side collect.  ``present`` optionally nulls the reference.
    """
    ref = F.format_string(fmt, (_col(key) * F.lit(multiplier)) % parent_count)
    return ref if present is None else F.when(present, ref)


def pick_parent(child, key: str, parents, pk: str, p: int, alias: str | None = None):
    """Give every child row a parent key when parent keys are not dense.

    Parents are numbered 1..n by ``row_number_within`` (range-partitioned, no
    single-task window); each child computes ``1 + (key * p) % n`` (``n`` a
    scalar subquery) and meets its parent in an equi-join on that number.
    Deterministic for a given parent set, under any partitioning."""
    from ..operators.ranking import row_number_within
    numbered = row_number_within(parents.select(pk), [], [F.asc(pk)], alias="_parent_no")
    n = parents.agg(F.count(F.lit(1))).scalar()
    with_no = child.withColumn("_parent_no", (F.lit(1) + (F.col(key) * F.lit(p)) % n).cast("bigint"))
    out = with_no.join(numbered, "_parent_no", "left").drop("_parent_no")
    return out.withColumnRenamed(pk, alias) if alias else out
