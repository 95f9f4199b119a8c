"""Numeric helpers that keep the NULL / NaN rules in one place."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tickframe.functions.times import as_col

LN_EPSILON = 1e-8


def ratio(num: Column, den: Column) -> Column:
    """Division that is NULL, never an error or NaN, on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def drop_nan(c: str | Column) -> Column:
    """NaN becomes NULL, so aggregates skip it."""
    return F.nanvl(as_col(c).cast("double"), F.lit(None).cast("double"))


def clip(c: str | Column, lo: float | None, hi: float | None) -> Column:
    """Clamp to [lo, hi]; NaN stays NaN and NULL stays NULL."""
    x = as_col(c).cast("double")
    y = x
    if lo is not None:
        y = F.when(y < F.lit(float(lo)), F.lit(float(lo))).otherwise(y)
    if hi is not None:
        y = F.when((y > F.lit(float(hi))) & ~F.isnan(x), F.lit(float(hi))).otherwise(y)
    return y


def log_eps(c: str | Column, epsilon: float = LN_EPSILON) -> Column:
    """ln(x + epsilon); NaN where the argument is not positive or already NaN."""
    arg = as_col(c).cast("double") + F.lit(float(epsilon))
    return (
        F.when(F.isnan(arg) | (arg < 0), F.lit(float("nan")))
        .when(arg == 0, F.lit(float("-inf")))
        .otherwise(F.ln(arg))
    )


def pos_inf(c: str | Column) -> Column:
    return as_col(c) == F.lit(float("inf"))


def neg_inf(c: str | Column) -> Column:
    return as_col(c) == F.lit(float("-inf"))


def significant(c: str | Column, digits: int) -> Column:
    """Round to a number of significant digits."""
    x = as_col(c).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(digits - 1.0) - F.floor(F.log10(F.abs(x))))
    plain = (x == 0) | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(plain, x).otherwise(F.rint(x * scale) / scale)


def spread(bid: str | Column, ask: str | Column) -> Column:
    return as_col(ask) - as_col(bid)


def mid(bid: str | Column, ask: str | Column) -> Column:
    return (as_col(bid) + as_col(ask)) / F.lit(2.0)


def spread_bps(bid: str | Column, ask: str | Column) -> Column:
    """Spread over mid in basis points."""
    return ratio(spread(bid, ask), mid(bid, ask)) * F.lit(10_000.0)


def change_pct(now: str | Column, before: str | Column) -> Column:
    """Change against an earlier price, in percent."""
    return (ratio(as_col(now), as_col(before)) - F.lit(1.0)) * F.lit(100.0)


# Coefficients of Acklam's public rational approximation of the normal quantile.
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
      1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
      6.680131188771972e01, -1.328068155288572e01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
      -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
      3.754408661907416e00)
_LOW = 0.02425


def _poly(x: Column, coefs: tuple[float, ...]) -> Column:
    out = F.lit(coefs[0])
    for c in coefs[1:]:
        out = out * x + F.lit(c)
    return out


def probit(p: Column) -> Column:
    """Normal quantile of p in (0, 1), relative error below 1.2e-9."""
    centre = p - 0.5
    r = centre * centre
    mid_part = _poly(r, _A) * centre / _poly(r, _B + (1.0,))
    q_lo = F.sqrt(F.lit(-2.0) * F.ln(p))
    q_hi = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - p))
    low = _poly(q_lo, _C) / _poly(q_lo, _D + (1.0,))
    high = -_poly(q_hi, _C) / _poly(q_hi, _D + (1.0,))
    return F.when(p < _LOW, low).when(p > 1 - _LOW, high).otherwise(mid_part)


def erfinv(x: Column) -> Column:
    return probit((x + 1.0) / 2.0) / F.lit(math.sqrt(2.0))


def parse_number(c: str | Column) -> Column:
    """Text to double; NULL on junk. Scientific notation is accepted, blanks around it are not."""
    c = as_col(c)
    return F.when(c == F.trim(c), c.try_cast("double"))


def valid_price(c: str | Column) -> Column:
    """Finite and not negative."""
    c = as_col(c)
    return F.coalesce((c >= 0) & (c < F.lit(float("inf"))) & ~F.isnan(c), F.lit(False))


def valid_size(c: str | Column) -> Column:
    """Finite and positive."""
    c = as_col(c)
    return F.coalesce((c > 0) & (c < F.lit(float("inf"))) & ~F.isnan(c), F.lit(False))


def valid_symbol(c: str | Column) -> Column:
    return F.coalesce(F.length(as_col(c)) > 0, F.lit(False))
