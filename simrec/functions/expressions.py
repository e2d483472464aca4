"""Native column expressions (no Python UDF): hashing, weights, clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import DEFAULT_STARS, MAX_STARS, MIN_STARS, STARS_TYPE

#: the largest n whose square, the bound of a*x + b, fits into 63 bits
MAX_SQUARE = 3_037_000_499


def hash_coefficients(raw_a: int, raw_b: int, n: int) -> tuple[int, int]:
    """(a, b) of one universal hash for modulus ``n``: a odd in [1, n-1]
    (1 when n <= 2), b in [0, n-1]."""
    return 1 + 2 * (raw_a % max(n // 2, 1)), raw_b % max(n, 1)


def universal_hash(x: Column, a: int, b: int, n: int) -> Column:
    """(a*x + b) mod n on BIGINT, for 0 <= a, b, x < n <= 2^62.

    While n^2 < 2^63 the per-row work is one multiply-add and one modulo. For a larger n the
    product would overflow: a is cut into digits of as many bits as n leaves free, and the
    product is built from the highest digit down, reduced after every step.
    """
    x, m = x.cast("long"), F.lit(max(n, 1)).cast("long")
    if n <= MAX_SQUARE:
        return F.pmod(x * F.lit(a).cast("long") + F.lit(b).cast("long"), m)
    if n > 1 << 62:
        raise ValueError("n must be at most 2^62")
    bits = 63 - (n - 1).bit_length()               # digit * x and rest * 2^bits stay below 2^63
    digits = [(a >> k) & ((1 << bits) - 1) for k in range(0, a.bit_length(), bits)]
    total = F.lit(0).cast("long")
    for i, digit in enumerate(reversed(digits)):
        step = x * F.lit(digit).cast("long") % m
        total = step if i == 0 else (total * F.lit(1 << bits).cast("long") % m + step) % m
    return (total + F.lit(b).cast("long")) % m


def clamp_stars(x: Column) -> Column:
    return F.greatest(F.lit(MIN_STARS), F.least(F.lit(MAX_STARS), x))


def default_stars() -> Column:
    return F.lit(DEFAULT_STARS).cast("double")


def centred_moments(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column,
                    sxy: Column) -> tuple[Column, Column, Column]:
    """n-scaled centred sums: (n*Sxy - Sx*Sy, n*Sxx - Sx^2, n*Syy - Sy^2).

    The sums are DECIMAL, so a zero covariance or a zero spread is detected exactly,
    whatever the stars and the summation order.
    """
    cxy = n * sxy - sx * sy
    cxx = n * sxx - sx * sx
    cyy = n * syy - sy * sy
    return cxy, cxx, cyy


def similarity_ratio(n: Column, cxy: Column, cxx: Column, cyy: Column) -> tuple[Column, Column]:
    """(is_degenerate, d1/d2) with d1 = Σ(x-x̄)(y-ȳ), d2 = ‖x-x̄‖ + ‖y-ȳ‖.

    d2 is the *sum* of the two norms (not their product). Degenerate means
    d2 = 0, i.e. both sides constant over the co-rated entries.
    """
    n = n.cast("double")
    d1 = cxy.cast("double") / n
    d2 = F.sqrt(cxx.cast("double") / n) + F.sqrt(cyy.cast("double") / n)
    degenerate = (cxx <= 0) & (cyy <= 0)
    return degenerate, F.when(degenerate, F.lit(None).cast("double")).otherwise(F.try_divide(d1, d2))


def exact_stars(stars: Column) -> Column:
    return stars.cast(STARS_TYPE)


def is_zero_weight(total: Column, eps: float = 0.0) -> Column:
    """Whether a weight sum is zero: exactly for sums of non-negative terms; sums of signed
    terms can miss zero by rounding, so they are compared with ``eps``."""
    return total.isNull() | (F.abs(total) < F.lit(eps) if eps else total == 0)
