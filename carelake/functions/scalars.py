"""Scalar Column helpers (formatting, dates, money, rates)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keyed import mix


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def format_id(prefix: str, width: int, key) -> Column:
    """``PFX-`` + zero-padded key, as ``'%0<width>d'`` formats it; never truncates.

    ``lpad`` alone truncates a key wider than the pad, so it is used only for
    keys in ``[0, 10**width)``; longer keys stand as they are, and only
    negative and null keys go through ``format_string``.
    The common paths avoid per-row format parsing."""
    k = _col(key)
    digits = k.cast("string")
    return F.concat(F.lit(f"{prefix}-"),
                    F.when(k >= F.lit(10 ** width), digits)
                     .when(k >= F.lit(0), F.lpad(digits, width, "0"))
                     .otherwise(F.format_string(f"%0{width}d", k)))


def fixed_digits(key, p: int, digits: int) -> Column:
    """Stable ``digits``-long numeric string (first digit non-zero); only
    negative and null keys need a per-row format."""
    lo = 10 ** (digits - 1)
    span = 9 * lo
    n = F.lit(lo) + (_col(key) * F.lit(p)) % F.lit(span)
    return F.when(n >= F.lit(lo), n.cast("string")).otherwise(F.format_string(f"%0{digits}d", n))


def pattern_digits(key, p1: int, p2: int) -> Column:
    """Stable identifier shaped ``##-#######``."""
    return F.format_string("%02d-%07d", F.lit(10) + mix(key, p1, 90),
                           (_col(key) * F.lit(p2)) % F.lit(10_000_000))


def concat_name(*cols) -> Column:
    return F.concat_ws(" ", *[_col(c) for c in cols])


def csv_join(arr) -> Column:
    """Array of strings → comma text; empty array → ''."""
    return F.array_join(_col(arr), ",")


def iso_date(d) -> Column:
    """DATE → ``YYYY-MM-DD`` text (the DATE-to-string cast: ISO for years
    0000-9999, without a per-row pattern formatter)."""
    return _col(d).cast("date").cast("string")


def date_shift(d, days) -> Column:
    """``d + days``; days are cast to INT (``date_add`` rejects BIGINT)."""
    return F.date_add(_col(d), _col(days).cast("int"))


def date_in_range(key, p: int, as_of, min_days_ago: int, max_days_ago: int) -> Column:
    """Keyed date between ``as_of - max_days_ago`` and ``as_of - min_days_ago``."""
    span = max_days_ago - min_days_ago + 1
    return F.date_sub(_col(as_of), (F.lit(min_days_ago) + mix(key, p, span)).cast("int"))


def dob_for_age(key, p_age: int, p_day: int, as_of, min_age: int, max_age: int) -> Column:
    """Birth date giving an age in ``[min_age, max_age]`` at ``as_of``."""
    years = F.lit(min_age) + mix(key, p_age, max_age - min_age + 1)
    return F.date_sub(F.add_months(_col(as_of), (years * F.lit(-12)).cast("int")),
                      mix(key, p_day, 365))


def cents_to_amount(cents) -> Column:
    """Integer cents → double amount (exact: one correctly rounded division)."""
    return _col(cents).cast("double") / F.lit(100.0)


def sum_cents_amount(cents) -> Column:
    """Sum integer cents exactly and convert at the output edge."""
    return F.sum(_col(cents)).cast("bigint").cast("double") / F.lit(100.0)


def round_money(x) -> Column:
    return F.round(_col(x), 2)


def cast_double(x) -> Column:
    """Text → double; NULL instead of an error on bad text (ANSI-safe)."""
    return _col(x).try_cast("double")


def number_or_zero(x) -> Column:
    return F.coalesce(_col(x).cast("string").try_cast("double"), F.lit(0.0))


def round_half_up_pct(num, den) -> Column:
    """``Math.round(num / den * 100)``; NULL when the denominator is 0."""
    return F.floor(F.try_divide(_col(num).cast("double") * F.lit(100.0), _col(den).cast("double"))
                   + F.lit(0.5)).cast("bigint")


def format_thousands(x, decimals: int = 0, currency: bool = False) -> Column:
    """``1234567`` → ``1,234,567`` (``$`` prefix for money)."""
    txt = F.format_number(_col(x), decimals)
    return F.concat(F.lit("$"), txt) if currency else txt
